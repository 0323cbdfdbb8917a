"""The operators of this subpackage run over whole supplied tables, with the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.checks import SQL as SQL  # the entry module takes it from here
from gridloom.llm.fingerprints import edit_fingerprints
from gridloom.llm.hard_negatives import mine_hard_negatives, quantised, usable
from gridloom.llm.length_buckets import pack_documents, word_length
from gridloom.llm.mixing import mix_documents
from gridloom.llm.ngram_join import ngram_jaccard_join
from gridloom.llm.periodic_runs import find_runs
from gridloom.llm.preferences import format_pairs, swapped_pairs
from gridloom.llm.quality_rules import quality_rules
from gridloom.llm.secret_scan import scan_secrets
from gridloom.llm.site_quality import site_quality
from gridloom.llm.token_counts import count_tokens
from gridloom.llm.toxicity import fit_ordinal, score_toxicity
from gridloom.llm.url_rules import ALLOW, BLOCK, Glob, HostRule, filter_urls
from gridloom.sources.scratch import materialise


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return edit_fingerprints(_table(spark, folder, "documents"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Grades from the labels: 0 not toxic, 1 toxic, 2 toxic and of low quality."""
    documents, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    grades = labels.select("doc_id", (F.col("toxic") * (2 - F.coalesce("quality", F.lit(1)))).alias("grade"))
    return score_toxicity(documents, fit_ordinal(documents, grades, 3))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(_table(spark, folder, "documents"))


def op4_preferences(spark: SparkSession, folder: str) -> DataFrame:
    return format_pairs(swapped_pairs(_table(spark, folder, "conversations")))


def op5_length_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(_table(spark, folder, "documents"))


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    light = _table(spark, folder, "documents").select("doc_id", "lang", "source", word_length(F.col("text")).alias("n_tokens"))
    mixed, name = mix_documents(materialise(light), length=F.col("n_tokens"))
    return mixed.select("doc_id", f"{name}.*")


def op7_site_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Documents carry no address: their source stands for the host, the language in it for the path."""
    documents = _table(spark, folder, "documents")
    labels = _table(spark, folder, "labels").select("doc_id", F.col("quality").alias("good"))
    judged, name = site_quality(documents, labels, F.col("source"), F.col("lang"), carry=["doc_id"])
    return judged.select("doc_id", f"{name}.*")


def op8_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_secrets(_table(spark, folder, "documents"))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged, rules = quality_rules(_table(spark, folder, "documents"), carry=["doc_id"])
    first = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score", "low", "high", "model"]
    first += ["exact_score", "exact_low", "exact_high", "byte_score", "byte_low", "byte_high"]
    return judged.select("doc_id", *[F.col(rules)[c].alias(c) for c in first])


def op10_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_jaccard_join(_table(spark, folder, "documents"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of ids divisible by 7 are moved on by one, as noise; ids divisible by 50 are anchors."""
    sound = _table(spark, folder, "embeddings").filter(usable("vec_id", "embedding", "label"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = sound.select(F.col("vec_id").alias("id"), label.alias("label"), quantised(F.col("embedding")).alias("vector"))
    return mine_hard_negatives(vectors, F.col("id") % 50 == 0)


def with_periodic_ends(documents: DataFrame) -> DataFrame:
    """(doc_id, text), where a tenth of the texts repeats its own words with a period from some word on."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    a = g % F.greatest(n, F.lit(1))
    p = 1 + F.floor((n - a) / (3 + g % 8))
    tail = F.flatten(F.array_repeat(F.slice(words, a.cast("int") + 1, p.cast("int")), F.ceil((n - a) / p).cast("int")))
    edited = F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(tail, F.lit(1), (n - a).cast("int"))), " ")
    return documents.select("doc_id", F.when(F.coalesce(h % 10 == 0, F.lit(False)) & (n > 0), edited).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found, name = find_runs(with_periodic_ends(_table(spark, folder, "documents")), carry=["doc_id"])
    runs = F.col(name)["runs"]
    # The greatest exact length / period; products compare without rounding.
    ahead = lambda x, y: x["length"] * y["period"] - y["length"] * x["period"]
    best = F.aggregate(F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0))), F.get(runs, F.lit(0)), lambda m, x: F.when(ahead(x, m) > 0, x).otherwise(m))
    listed = F.transform(runs, lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"), F.sha2(F.col(name)["collapsed"], 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


URL_RULES = [
    HostRule(ALLOW, "com", "/"),
    HostRule(BLOCK, "example.com", "/en/"),
    HostRule(ALLOW, "www.example.com", "/en/"),
    HostRule(BLOCK, "net", "/es/"),
    HostRule(BLOCK, "net", "/fr/"),
]
#: Judge the URLs that no host rule fits: betting, pills and advertising hosts, downloads and account pages; help pages are let through.
URL_GLOBS = [
    *[Glob(BLOCK, p) for p in ("*casino*", "*bets*", "*betting*", "*poker*", "*cheap-*", "*pills*", "*pharm?cy*", "ads-*", "*.ads-*", "track.*", "*.track.*", "track?.*", "*.track?.*")],
    *[Glob(BLOCK, p) for p in ("*/wp-login.*", "*/**/wp-login.*", "*/**/cart/**", "*/login", "*/login/**", "**.exe", "**.apk", "*/tag/**", "*/**/page/*")],
    *[Glob(ALLOW, p) for p in ("help.*", "*/help/**")],
]


def op13_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged, name = filter_urls(_table(spark, folder, "pages"), URL_RULES, URL_GLOBS, carry=["page_id"])
    return judged.select("page_id", *[F.col(name)[c].alias(c) for c in ("host", "path", "rule", "verdict")])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_fingerprints, op2_toxicity, op3_token_counts, op4_preferences, op5_length_buckets, op6_mixing, op7_site_quality,
        op8_secret_scan, op9_quality_rules, op10_ngram_join, op11_hard_negatives, op12_periodic_runs, op13_url_rules,
    )
}
