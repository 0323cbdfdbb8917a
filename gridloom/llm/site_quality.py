"""Document quality by hierarchical empirical Bayes over sites.

A logistic classifier on text statistics gives each document evidence: its
probability of being good. Sites have two levels, hosts and paths of a host.
With m the global mean, a host's mean is shrunk towards m and a path's towards
its host, each with the strength (in rows) that the variances inside hosts (paths)
and between them imply:

    host = (s0 * m + sum of p) / (s0 + n),  path = (s1 * host + sum of p) / (s1 + n)

leaving out the document that is judged. Its quality combines both:

    logit(quality) = logit(p) + logit(path) - logit(m)

Sums are grouped aggregates, paths first and hosts from paths, so a host with a
third of all rows costs a row per task. Labelled rows are bounded by
``MAX_LABELLED``, chosen by a hash of the id; sites and documents are all used.

Defined cases: a null or empty text has statistics of 0 (and no words); null
hosts and paths are sites of their own; a site with one document has its
parent's mean; null ids or labels are not learned from; without labels, or with
one kind only, the classifier leans on its prior (``PRIOR_ROWS`` of each kind at
0), so p is the same for all; repeated rows count as often as they occur. The
struct column is named otherwise where the table has one of its name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.llm.flatwords import sums_by_text, word_chunks
from gridloom.llm.quality_rules import base_counts
from gridloom.sources.scratch import materialise

MAX_LABELLED = 50_000
PRIOR_ROWS = 1.0
RIDGE = 0.01
STEPS = 30
CUT = 0.5
_LEAST = 1e-6

STATISTICS = ("symbols", "capitals", "digits", "repeated lines", "repeated windows", "word length", "distinct words", "bars", "exclamations", "words")


def statistics(words) -> np.ndarray:
    """One row per text: shares and logarithms in the order of ``STATISTICS``, each between 0 and about 1."""
    counts = base_counts(words)
    data, bounds = words.data, words.bounds
    n = np.maximum(counts["n_words"], 1)
    letters = np.maximum(counts["word_chars"], 1)

    def share(mask: np.ndarray) -> np.ndarray:
        return sums_by_text(mask.astype(np.int64), bounds) / letters

    owner = words.owner().astype(np.uint64)
    keyed = words.hashes() ^ (owner * np.uint64(0x9E3779B97F4A7C15))
    _, earliest = np.unique(keyed, return_index=True)
    distinct = np.bincount(owner[earliest].astype(np.int64), minlength=words.texts)
    # Capital letters beyond ASCII follow the byte 0xC3 as 0x80 to 0x9E.
    wide = np.zeros(len(data), bool)
    wide[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
    return np.column_stack(
        [
            np.minimum(counts["n_symbols"] / letters, 1),
            share(((data >= 65) & (data <= 90)) | wide),
            share((data >= 48) & (data <= 57)),
            counts["n_dup_lines"] / n,
            counts["n_repeat_words"] / n,
            np.minimum(counts["word_chars"] / n / 20, 1),
            distinct / n,
            share(data == ord("|")),
            share(data == ord("!")),
            np.log1p(counts["n_words"]) / 10,
        ]
    )


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, end, words in word_chunks(batch.column(1)):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), pa.array(list(statistics(words)), pa.list_(pa.float64()))], names=["good", "x"])


def _expand(x: np.ndarray) -> np.ndarray:
    """A constant, the statistics and their square roots: junk shows in small shares already."""
    return np.hstack([np.ones((len(x), 1)), x, np.sqrt(np.maximum(x, 0))])


def _probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_expand(x) @ w, -30, 30)))


def fit_classifier(documents: DataFrame, labels: DataFrame, most: int = MAX_LABELLED) -> np.ndarray:
    """Weights of a logistic model of label (doc_id, good), by Newton steps; one aggregate per step."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("good").isNotNull()).select(F.col("doc_id").cast("long"), F.col("good").cast("int"))
    n = known.count()
    if n > most:
        buckets = 1 << 20
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(buckets)) < int(buckets * most / n))
    sample = materialise(known.groupBy("doc_id").agg(F.min("good").alias("good")))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id").select("good", "text")
    # The sample is bounded, so a few files serve the steps that follow.
    table = materialise(texts.mapInArrow(_describe, "good int, x array<double>").repartition(8))
    size = 1 + 2 * len(STATISTICS)
    w = np.zeros(size)
    for _ in range(STEPS):

        def part(batches: Iterator[pa.RecordBatch], w: np.ndarray = w) -> Iterator[pa.RecordBatch]:
            gradient, info = np.zeros(size), np.zeros((size, size))
            for batch in batches:
                if batch.num_rows:
                    x = np.stack(batch.column(1).to_numpy(zero_copy_only=False))
                    p, wide = _probability(x, w), _expand(x)
                    gradient += wide.T @ (batch.column(0).to_numpy() - p)
                    info += (wide * (p * (1 - p))[:, None]).T @ wide
            yield pa.RecordBatch.from_arrays([pa.array([gradient.tobytes()], pa.binary()), pa.array([info.tobytes()], pa.binary())], names=["g", "h"])

        start = 1 / (1 + np.exp(-w[0]))
        gradient = -RIDGE * w * (np.arange(size) > 0)
        gradient[0] += PRIOR_ROWS * (1 - 2 * start)
        info = np.eye(size) * RIDGE
        info[0, 0] += 2 * PRIOR_ROWS * start * (1 - start)
        for r in table.mapInArrow(part, "g binary, h binary").collect():
            gradient = gradient + np.frombuffer(r["g"])
            info = info + np.frombuffer(r["h"]).reshape(size, size)
        step = np.linalg.solve(info, gradient)
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        w = w + step
        if np.abs(step).max() < 1e-4:
            break
    return w


def evidence(documents: DataFrame, w: np.ndarray, carry: list[str]) -> tuple[DataFrame, str]:
    """``carry`` columns and the probability of being good; also the new column's name."""
    name = "evidence"
    while name in documents.columns:
        name += "_"
    needed = list(dict.fromkeys([*carry, "text"]))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, words in word_chunks(batch.column(needed.index("text"))):
                p = pa.array(_probability(statistics(words), w))
                yield pa.RecordBatch.from_arrays([batch.column(needed.index(c)).slice(row, end - row) for c in carry] + [p], names=[*carry, name])

    schema = T.StructType([documents.schema[c] for c in carry] + [T.StructField(name, T.DoubleType())])
    return documents.select(*needed).mapInArrow(judge, schema), name


def _strength(sites: DataFrame, centre: Column, total: Column, n: Column, squares: Column | None = None) -> float:
    """Prior rows: the variance of p inside sites over that of the sites' means around their centres.

    Of the spread of the means, what n rows of the inner variance explain is taken
    off. Without ``squares``, the sums of p * p, p is 0 or 1.
    """
    mean = total / n
    squares = total if squares is None else squares
    r = sites.filter(n > 1).agg(
        F.sum(squares - total * mean).alias("inside"), F.sum(n - 1).alias("free"), F.avg((mean - centre) ** 2).alias("apart"), F.avg(1 / n).alias("each")
    ).first()
    if not r["free"]:
        return 1e6
    within = max(0.0, r["inside"] / r["free"])
    between = r["apart"] - within * r["each"]
    return 1e6 if between <= 0 else float(min(1e6, max(1.0, within / between)))


def _logit(p: Column) -> Column:
    held = F.least(F.greatest(p, F.lit(_LEAST)), F.lit(1 - _LEAST))
    return F.ln(held / (1 - held))


def site_quality(
    documents: DataFrame, labels: DataFrame, host: Column, path: Column, carry: list[str] | None = None, cut: float = CUT, most: int = MAX_LABELLED
) -> tuple[DataFrame, str]:
    """``carry`` columns and a struct (host, path, evidence, host_mean, path_mean, quality, keep); also its name."""
    carry = documents.columns if carry is None else carry
    w = fit_classifier(documents, labels, most)
    sited = documents.withColumns({"__host": host.cast("string"), "__path": path.cast("string")})
    judged, p_name = evidence(sited, w, [*carry, "__host", "__path"])
    judged = materialise(judged)
    p = F.col(p_name)
    paths = materialise(judged.groupBy("__host", "__path").agg(F.sum(p).alias("path_sum"), F.sum(p * p).alias("path_squares"), F.count("*").alias("path_n")))
    hosts = materialise(paths.groupBy("__host").agg(*[F.sum(f"path_{c}").alias(f"host_{c}") for c in ("sum", "squares", "n")]))
    whole = hosts.agg((F.sum("host_sum") / F.sum("host_n")).alias("m")).first()["m"]
    m = 0.5 if whole is None else float(whole)
    s0 = _strength(hosts, F.lit(m), F.col("host_sum"), F.col("host_n"), F.col("host_squares"))
    host_mean = (F.lit(s0 * m) + F.col("host_sum")) / (F.lit(s0) + F.col("host_n"))
    h, q = hosts.alias("h"), paths.alias("q")
    both = materialise(q.join(h, F.col("q.__host").eqNullSafe(F.col("h.__host"))).select("q.*", "host_sum", "host_n"))
    s1 = _strength(both, host_mean, F.col("path_sum"), F.col("path_n"), F.col("path_squares"))
    sites = both.select(F.col("__host").alias("site_host"), F.col("__path").alias("site_path"), "path_sum", "path_n", "host_sum", "host_n")
    on = F.col("__host").eqNullSafe(F.col("site_host")) & F.col("__path").eqNullSafe(F.col("site_path"))
    without = judged.join(sites, on)
    host_left = (F.lit(s0 * m) + F.col("host_sum") - p) / (F.lit(s0) + F.col("host_n") - 1)
    without = without.withColumn("__host_mean", host_left)
    without = without.withColumn("__path_mean", (F.lit(s1) * F.col("__host_mean") + F.col("path_sum") - p) / (F.lit(s1) + F.col("path_n") - 1))
    odds = _logit(p) + _logit(F.col("__path_mean")) - _logit(F.lit(m))
    without = without.withColumn("__quality", 1 / (1 + F.exp(-odds)))
    name = "site"
    while name in carry:
        name += "_"
    result = F.struct(
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        p.alias("evidence"),
        F.col("__host_mean").alias("host_mean"),
        F.col("__path_mean").alias("path_mean"),
        F.col("__quality").alias("quality"),
        (F.col("__quality") >= cut).alias("keep"),
    )
    return without.select(*carry, result.alias(name)), name
