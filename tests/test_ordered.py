"""Ordered operators on hot groups: the range-split way must equal the plain one."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gridloom.operators import ordered, profile


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of 3,000 rows in one group, values with many repeats, a few nulls."""
    rng = random.Random(5)
    rows = [
        (i, "hot" if i % 3 else f"g{i % 7}", None if i % 50 == 0 else float(rng.randint(0, 400))) for i in range(3000)
    ]
    return spark.createDataFrame(rows, "id int, grp string, v double").repartition(4), rows


def test_rank_in_hot_group(skewed):
    df, rows = skewed
    got = {(r.id): r["rank"] for r in ordered.rank_in_group(df, ["grp"], ["v", "id"]).collect()}
    want = {}
    for g in {r[1] for r in rows}:
        members = sorted((r for r in rows if r[1] == g), key=lambda r: (r[2] is not None, r[2] or 0, r[0]))
        want.update({r[0]: i for i, r in enumerate(members)})
    assert got == want


def test_prefix_sums_equal_a_plain_window(skewed):
    df, _ = skewed
    a = ordered.prefix_sums(df, ["grp"], ["v", "id"], {"s": F.col("id")})
    b = df.withColumn("s", F.sum("id").over(Window.partitionBy("grp").orderBy("v", "id")))
    assert a.columns == b.columns
    assert sorted(map(tuple, a.select("id", "s").collect())) == sorted(map(tuple, b.select("id", "s").collect()))


def test_row_index(skewed):
    df, rows = skewed
    got = [r.id for r in ordered.row_index(df, [F.col("v").asc_nulls_last(), "id"]).orderBy("row").collect()]
    assert got == [r[0] for r in sorted(rows, key=lambda r: (r[2] is None, r[2] or 0, r[0]))]


@pytest.mark.parametrize("bound", [7, 40_000])
def test_top_by_limit(skewed, bound):
    df, rows = skewed
    limited = df.withColumn("cap", F.when(F.col("grp") == "hot", 7).otherwise(2))
    got = {r.id for r in ordered.top_by_limit(limited, ["grp"], ["v", "id"], "cap", bound).collect()}
    want = set()
    for g in {r[1] for r in rows}:
        members = sorted((r for r in rows if r[1] == g), key=lambda r: (r[2] is not None, r[2] or 0, r[0]))
        want |= {r[0] for r in members[: 7 if g == "hot" else 2]}
    assert got == want


def test_quantiles(skewed):
    df, rows = skewed
    probs = [0.0, 0.1, 0.5, 0.73, 1.0]
    got = {
        (r.grp, r.p): r.value for r in ordered.grouped_quantiles(df, "v", probs, ["grp"]).collect()
    }
    for g in {r[1] for r in rows}:
        values = [r[2] for r in rows if r[1] == g and r[2] is not None]
        for p in probs:
            assert got[g, p] == pytest.approx(np.quantile(values, p))


def test_quantiles_without_groups_and_nearest(skewed):
    df, rows = skewed
    values = sorted(r[2] for r in rows if r[2] is not None)
    got = {r.p: r.value for r in ordered.quantiles(df, "v", [0.25, 0.5]).collect()}
    assert got[0.5] == pytest.approx(statistics.median(values))
    near = {r.p: r.value for r in ordered.quantiles(df, "v", [0.25], "nearest").collect()}
    assert near[0.25] == np.quantile(values, 0.25, method="nearest")


def test_quantile_of_one_repeated_value(spark):
    df = spark.range(20_000).select(F.lit(3.5).alias("v"))
    assert [r.value for r in ordered.quantiles(df, "v", [0.0, 0.5, 1.0]).collect()] == [3.5] * 3


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert ordered.quantiles(df, "v", [0.5]).collect() == []


@pytest.mark.parametrize(
    "values, verdict", [([1, 1, 2], "ascending"), ([3, 2, 2], "descending"), ([1, 3, 2], "unsorted")]
)
def test_sortedness(spark, values, verdict):
    df = spark.createDataFrame(list(enumerate(values)), "i int, v int").repartition(3)
    assert ordered.sortedness(df, "i", "v").first()["verdict"] == verdict


def test_latest_breaks_ties(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("b", None, 3), ("b", 0, 4)], "k string, t int, id int")
    got = {r.k: r.id for r in ordered.latest(df, "k", ["t", "id"]).collect()}
    assert got == {"a": 2, "b": 4}


def test_bootstrap_matches_resampling(spark):
    rng = np.random.default_rng(1)
    values = rng.normal(size=301).round(3)
    df = spark.createDataFrame([("a", float(v)) for v in values], "k string, v double")
    row = profile.bootstrap_ci(df, "k", "v", 0.96, 2000, seed=3).first()
    medians = [np.median(rng.choice(values, len(values))) for _ in range(4000)]
    low, high = np.quantile(medians, [0.02, 0.98])
    assert row["median"] == pytest.approx(np.median(values))
    assert row["low"] == pytest.approx(low, abs=0.03)
    assert row["high"] == pytest.approx(high, abs=0.03)


def test_bootstrap_draws_are_expressions(spark):
    """Even sizes, tiny groups and no Python in the plan of the draws."""
    rng = np.random.default_rng(2)
    groups = {"even": rng.exponential(size=200).round(3), "one": np.array([5.0]), "two": np.array([1.0, 2.0])}
    df = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs], "k string, v double")
    ci = profile.bootstrap_ci(df, "k", "v", 0.9, 2000, seed=5)
    assert "Python" not in _plan(ci) and "ArrowEval" not in _plan(ci)
    got = {r.k: r for r in ci.collect()}
    medians = np.median(rng.choice(groups["even"], (4000, 200)), axis=1)
    assert got["even"].low == pytest.approx(np.quantile(medians, 0.05), abs=0.03)
    assert got["even"].high == pytest.approx(np.quantile(medians, 0.95), abs=0.03)
    assert (got["one"].low, got["one"].high) == (5.0, 5.0) and (got["two"].low, got["two"].high) == (1.0, 2.0)


def test_running_totals_shuffle_rows_once(spark, skewed):
    """The slices lie in buckets: ranking them exchanges nothing but one row per slice and group."""
    df, _ = skewed
    of_rows = _plan(ordered.rank_in_group(df, ["grp"], ["v", "id"])).split("BroadcastExchange")[0]
    assert "Window" in of_rows and "Bucketed: true" in of_rows and "Exchange" not in of_rows


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_group_limits_cut_rows_before_the_shuffle(spark, skewed):
    df, _ = skewed
    assert _plan(ordered.latest(df, "grp", ["v", "id"])).count("WindowGroupLimit") == 2
    capped = df.withColumn("cap", F.lit(5))
    # Salted slices and the final ranking each limit before and after their shuffle.
    assert _plan(ordered.top_by_limit(capped, ["grp"], ["v", "id"], "cap", 5)).count("WindowGroupLimit") == 4


def test_no_unpartitioned_window_over_rows(spark, skewed):
    """Only the table of slices, one row each, may meet a window without partitions."""
    df, _ = skewed
    plan = _plan(ordered.row_index(df, ["v", "id"]))
    assert "SinglePartition" in plan and plan.count("Exchange SinglePartition") == 1
