import collections

import pytest
from pyspark.sql import functions as F

from gridloom.functions import text
from gridloom.operators import tfidf
from gridloom.operators.clean import fit_fill_stats
from gridloom.operators.encode import QuantileNormal
from gridloom.plans.features import FeatureConfig, TextOptions, build_feature_tables

WORDS = [["a", "b", "a", "b"], None, [], ["a"], ["a b", "a", "b", None, "c"], ["b"], ["c", "c", "c"]]


@pytest.mark.parametrize("low,high,piece", [(1, 2, 1), (2, 3, 3), (1, 1, 100)])
def test_terms_counted_by_batches(spark, monkeypatch, low, high, piece):
    """Counts of n-grams and their totals against plain Python; no array function runs word by word."""
    monkeypatch.setattr(tfidf, "PIECE_WORDS", piece)
    df = spark.createDataFrame(list(enumerate(WORDS)), "id long, w array<string>")
    want = collections.Counter()
    for i, words in enumerate(WORDS):
        words = [w for w in words or [] if w is not None]
        for n in range(low, high + 1):
            want.update((i, " ".join(words[j : j + n])) for j in range(len(words) - n + 1))
    counts = tfidf.term_counts(df, "id", "w", low, high)
    assert "transform(" not in counts._jdf.queryExecution().toString()
    assert {(r.id, r.term): r.tf for r in counts.collect()} == want
    some = {r.term for r in tfidf.term_counts(df, "id", "w", low, high, ["b", "a b", "none"]).collect()}
    assert some == {t for _, t in want} & {"b", "a b"}
    totals = {r.term: (r.df, r.freq) for r in tfidf.term_totals(df, "w", low, high).collect()}
    terms = {t for _, t in want}
    assert totals == {t: (sum(x == t for _, x in want), sum(n for (_, x), n in want.items() if x == t)) for t in terms}


def test_texts_of_both_sides_are_cleaned_once(spark):
    rows = [(i, "warm river stones " * (1 + i % 3) + "again") for i in range(12)]
    docs = spark.createDataFrame(rows, "match_id long, radiant_chat string")
    cfg = FeatureConfig({"text": ("radiant_chat",)}, text=TextOptions(max_features=20, min_df=1, max_df=1.0))
    tables = build_feature_tables(docs, docs, cfg, use_tabular=False)
    assert "regexp" not in tables.other._jdf.queryExecution().toString()
    assert tables.other.count() == tables.train.count() == 12


def test_lemmas_without_a_search_for_every_token(spark):
    rows = [(1, ["running", "x", "running", None]), (2, None), (3, []), (4, ["y"]), (5, ["sing", "running"]), (None, ["running"])]
    df = spark.createDataFrame(rows, "id long, tk array<string>")
    lemmas = spark.createDataFrame([("running", "run"), ("running", "runs"), ("sing", "s")], "token string, lemma string")
    out = text.lemmatise(df, "id", "tk", lemmas)
    assert "element_at" not in out._jdf.queryExecution().toString()
    got = {r.id: r.lemmas for r in out.collect()}
    assert got == {1: ["run", "x", "run", None], 2: [], 3: [], 4: ["y"], 5: ["s", "run"], None: ["running"]}


def test_normal_scores_are_looked_up_by_batches(spark):
    law = QuantileNormal((1.0, 2.0, 2.0, 5.0))
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 1.5, 2.0, 3.5, 5.0, 9.0, float("nan"), None)], "x double")
    out = df.select("x", law.share(F.col("x")).alias("share"), law.forward("x").alias("z")).withColumn("back", law.inverse("z"))
    assert "aggregate(" not in out._jdf.queryExecution().toString()
    rows = out.collect()
    assert [r.share for r in rows] == pytest.approx([0, 0, 1 / 6, 0.5, 5 / 6, 1, 1, None, None], abs=1e-12)
    assert [r.back for r in rows[1:6]] == pytest.approx([1, 1.5, 2, 3.5, 5], abs=1e-5)
    assert rows[0].back == 1 and rows[6].back == 5 and rows[7].z is rows[8].z is rows[8].back is None


def test_fill_means_take_one_pass(spark):
    rows = [("a", "x", 1.0), ("a", "x", 2.0), ("a", "y", None), ("a", "z", 6.0), (None, "x", 5.0), ("b", None, None)]
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame(rows, "region string, game_mode string, avg_mmr double").mapInArrow(seen, "region string, game_mode string, avg_mmr double")
    stats = fit_fill_stats(df)
    assert read.value == len(rows)
    assert stats.global_mean == 3.5
    assert {r.region: r[1] for r in stats.region_means.collect()} == {"a": 3.0, None: 5.0, "b": None}
    groups = {(r.region, r.game_mode): r[2] for r in stats.group_means.collect()}
    assert groups == {("a", "x"): 1.5, ("a", "y"): None, ("a", "z"): 6.0, (None, "x"): 5.0, ("b", None): None}
