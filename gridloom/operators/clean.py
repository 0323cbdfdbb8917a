"""Cleaning of group tables, mean fills, chat tables and series features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.dates import extract_date_features
from gridloom.functions.numeric import transform_value
from gridloom.operators.frame import drop_nulls, not_equal, to_numeric, union_aligned
from gridloom.operators.joins import filter_by_ids, lookup_null_safe
from gridloom.operators.ordered import keep_last
from gridloom.sources.scratch import materialise

PLAYER_IDS = ("match_id", "hero_id", "player_slot")


def normalize_players(df: DataFrame) -> DataFrame:
    return to_numeric(df, PLAYER_IDS)


def preprocess_players(df: DataFrame, group_size: int = 10) -> DataFrame:
    """Drop broken accounts and null keys, then whole groups that are not proper.

    A proper group has exactly ``group_size`` rows and as many different items,
    none of them item 0. A row with a null account stays.
    """
    df = normalize_players(df)
    if "account_id" in df.columns:
        df = df.filter(not_equal("account_id", -1))
    keys = [c for c in PLAYER_IDS if c in df.columns]
    if keys:
        df = drop_nulls(df, keys)
    if not {"match_id", "hero_id"} <= set(df.columns):
        return df
    stats = df.groupBy("match_id").agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("hero_id").alias("n_items"),
        F.count_if(F.col("hero_id") == 0).alias("n_zero"),
    )
    proper = stats.filter(
        (F.col("n_rows") == group_size) & (F.col("n_items") == group_size) & (F.col("n_zero") == 0)
    )
    return df.join(proper.select("match_id"), "match_id", "left_semi")


def _group_counts(df: DataFrame, key: str, item: str) -> DataFrame:
    """(key, n_rows, n_items, n_zero); null counts as an item."""
    return df.groupBy(key).agg(
        F.count("*").alias("n_rows"),
        (F.count_distinct(item) + F.max(F.col(item).isNull().cast("int"))).cast("long").alias("n_items"),
        F.count_if(F.col(item) == 0).alias("n_zero"),
    )


def mismatched_groups(df: DataFrame, key: str = "match_id", item: str = "hero_id") -> DataFrame:
    """Groups with fewer different items than rows; null counts as an item."""
    return _group_counts(df, key, item).filter(F.col("n_rows") != F.col("n_items")).drop("n_zero")


def clean_groups_strict(df: DataFrame, key: str = "match_id", item: str = "hero_id") -> DataFrame:
    """Drop groups with repeated items or with item 0, then every row with a null.

    One aggregate and one semi join; a null key goes with the nulls.
    """
    proper = _group_counts(df, key, item).filter((F.col("n_rows") == F.col("n_items")) & (F.col("n_zero") == 0))
    return drop_nulls(df.join(proper.select(key), key, "left_semi"))


def item_zero_users(df: DataFrame, user: str = "account_id", item: str = "hero_id") -> DataFrame:
    """Who used item 0, and how often."""
    return df.filter(F.col(item) == 0).groupBy(user).agg(F.count("*").alias("n"))


def prepare_players_for_run(
    players_train: DataFrame,
    players_test: DataFrame,
    train: DataFrame,
    test: DataFrame,
    group_size: int = 10,
    preprocess: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Clean both sides as one table, then give each side its own ids back."""
    a, b = normalize_players(players_train), normalize_players(players_test)
    if not preprocess:
        return a, b
    if "match_id" not in a.columns and "match_id" not in b.columns:
        raise KeyError("neither table has a match_id column")
    both = preprocess_players(union_aligned(a, b), group_size)
    return filter_by_ids(both, train, "match_id"), filter_by_ids(both, test, "match_id")


@dataclass(frozen=True)
class FillStats:
    group_means: DataFrame
    region_means: DataFrame
    global_mean: float


def fit_fill_stats(
    df: DataFrame, value: str = "avg_mmr", outer: str = "region", inner: str = "game_mode"
) -> FillStats:
    """Means by (outer, inner), by outer, and overall (0 when there is none).

    One pass: the sums of the inner groups, written, add up to the others. The
    tables are written, so that applying them does not fit them again.
    """
    x = F.col(value).try_cast("double")
    sums = materialise(df.groupBy(outer, inner).agg(F.sum(x).alias("__sum"), F.count(x).alias("__n")))
    x = F.try_divide(F.sum("__sum"), F.sum("__n"))
    overall = sums.agg(x).first()[0]
    finite = overall is not None and overall == overall and abs(overall) != float("inf")
    return FillStats(
        materialise(sums.groupBy(outer, inner).agg(x.alias("__group_mean"))),
        materialise(sums.groupBy(outer).agg(x.alias("__region_mean"))),
        float(overall) if finite else 0.0,
    )


def transform_fill(
    df: DataFrame,
    stats: FillStats,
    value: str = "avg_mmr",
    outer: str = "region",
    inner: str = "game_mode",
    flag: str = "mmr_missing",
) -> DataFrame:
    """Missing flag, then the first known of group mean, region mean, global mean."""
    if value not in df.columns:
        return df
    x = F.col(value).try_cast("double")
    df = df.withColumn(value, x).withColumn(flag, F.col(value).isNull().cast("byte"))
    found = [F.col(value)]
    if {outer, inner} <= set(df.columns):
        df = lookup_null_safe(df, stats.group_means, [outer, inner])
        df = lookup_null_safe(df, stats.region_means, [outer])
        found += [F.col("__group_mean"), F.col("__region_mean")]
    filled = F.coalesce(*found, F.lit(stats.global_mean))
    return df.withColumn(value, filled).drop("__group_mean", "__region_mean")


def preprocess_fold(
    train: DataFrame, other: DataFrame, mode: str = "raw"
) -> tuple[DataFrame, DataFrame]:
    """Date features, train-fitted mean fill and value transform on both sides."""
    sides = [extract_date_features(train), extract_date_features(other)]
    if {"avg_mmr", "region", "game_mode"} <= set(train.columns):
        stats = fit_fill_stats(sides[0])
        sides = [transform_fill(s, stats) for s in sides]
    sides = [
        s.withColumn("avg_mmr", transform_value("avg_mmr", mode)) if "avg_mmr" in s.columns else s
        for s in sides
    ]
    return sides[0], sides[1]


def normalize_chat(df: DataFrame, text_cols: Sequence[str], order: str, key: str = "match_id") -> DataFrame:
    """One row per key, the last in ``order``; null text becomes ""."""
    missing = [c for c in (key, *text_cols) if c not in df.columns]
    if missing:
        raise ValueError(f"chat table has no columns {missing}")
    df = to_numeric(df, [key])
    df = df.withColumns({c: F.coalesce(c, F.lit("")) for c in text_cols}) if text_cols else df
    return keep_last(drop_nulls(df, [key]), key, order)


def series_features(
    df: DataFrame, key: str, t: str, v: str, bins: Sequence[tuple[str, float, float]] = ()
) -> DataFrame:
    """Summary and trend of a value over time per key.

    ``t`` is numeric time. ``bins`` are (name, from, to) time ranges whose mean
    value becomes a column. A key whose times do not vary has no trend: slope,
    intercept and r2 are 0 and ``trend_was_imputed`` is set. r2 of a constant
    value is 0 too. All parts are partial aggregates of one grouping.
    """
    time, x = F.col(t).cast("double"), F.col(v).cast("double")
    var_t, var_x, cov = F.var_pop(time), F.var_pop(x), F.covar_pop(x, time)
    aggs: list[Column] = [
        F.avg(x).alias("adv_mean"),
        F.coalesce(F.stddev_samp(x), F.lit(0.0)).alias("adv_std"),
        F.min(x).alias("adv_min"),
        F.max(x).alias("adv_max"),
        F.max(F.abs(x)).alias("abs_max"),
        F.greatest(F.max(x), F.lit(0.0)).alias("peak_a"),
        F.greatest(-F.min(x), F.lit(0.0)).alias("peak_b"),
        F.avg((x > 0).cast("double")).alias("share_positive"),
        F.max_by(x, F.struct(time, x)).alias("last"),
        *[
            F.avg(F.when((time >= lo) & (time < hi), x)).alias(name)
            for name, lo, hi in bins
        ],
        var_t.alias("__vt"),
        var_x.alias("__vx"),
        cov.alias("__cov"),
        F.avg(time).alias("__mt"),
    ]
    out = df.groupBy(key).agg(*aggs)
    flat = ~(F.col("__vt") > 0)
    slope = F.when(flat, 0.0).otherwise(F.col("__cov") / F.nullif("__vt", F.lit(0.0)))
    r2 = F.when(flat | ~(F.col("__vx") > 0), 0.0).otherwise(
        F.col("__cov") * F.col("__cov")
        / F.nullif(F.col("__vt"), F.lit(0.0))
        / F.nullif(F.col("__vx"), F.lit(0.0))
    )
    return out.withColumns({
        "slope": slope,
        "intercept": F.when(flat, 0.0).otherwise(F.col("adv_mean") - slope * F.col("__mt")),
        "r2": r2,
        "trend_was_imputed": flat.cast("int"),
    }).drop("__vt", "__vx", "__cov", "__mt")
