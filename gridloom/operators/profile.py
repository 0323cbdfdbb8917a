"""Counts, shares, descriptions and distribution tables."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.numeric import let
from gridloom.operators.ordered import column_quantiles, group_median, prefix_sums
from gridloom.sources.scratch import materialise


def distinct_count(df: DataFrame, col: str, cond: Column, name: str = "n") -> DataFrame:
    return df.filter(cond).agg(F.count_distinct(col).alias(name))


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, nulls) for every column, from one pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], list(df.columns), "column_name", "nulls")


def group_count(df: DataFrame, keys: Sequence[str], having: Column | None = None, name: str = "n") -> DataFrame:
    counts = df.groupBy(*keys).agg(F.count("*").alias(name))
    return counts if having is None else counts.filter(having)


def value_share(df: DataFrame, col: str) -> DataFrame:
    """Count and percent of all rows per value."""
    total = df.agg(F.count("*").alias("total")).scalar()
    return group_count(df, [col]).withColumn("percent", F.col("n") / total * 100)


def group_mean(df: DataFrame, key: str, col: str, mean: str, count: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(col).alias(mean), F.count("*").alias(count))


def most_frequent(df: DataFrame, col: str) -> DataFrame:
    return group_count(df, [col]).orderBy(F.col("n").desc(), F.col(col)).limit(1)


def argmin_group(df: DataFrame, key: str, col: str) -> DataFrame:
    """The group with the smallest mean, with its size."""
    return group_mean(df, key, col, "mean_value", "n").orderBy("mean_value", key).limit(1)


def target_rate(df: DataFrame, date_col: str, unit: str, target: str) -> DataFrame:
    """Mean target by a calendar key: date, weekday (Monday 0), month or weekend."""
    d = F.col(date_col)
    key = {
        "date": F.date_format(d, "yyyy-MM-dd"),
        "weekday": F.weekday(d),
        "month": F.month(d),
        "weekend": F.weekday(d) >= 5,
    }
    if unit not in key:
        raise ValueError(f"unknown unit: {unit}")
    return df.groupBy(key[unit].alias(unit)).agg(F.avg(target).alias("rate"))


def group_nunique(df: DataFrame, key: str, col: str, count_null: bool = False) -> DataFrame:
    """Rows and distinct values per group; ``count_null`` counts null as a value."""
    distinct = F.count_distinct(col)
    if count_null:
        distinct = distinct + F.max(F.col(col).isNull().cast("int"))
    return df.groupBy(key).agg(F.count("*").alias("n_rows"), distinct.cast("long").alias("n_items"))


def group_count_if(df: DataFrame, key: str, cond: Column, name: str = "n") -> DataFrame:
    return df.groupBy(key).agg(F.count_if(cond).alias(name))


def describe(df: DataFrame, cols: Sequence[str], interpolation: str = "linear") -> DataFrame:
    """One row per column: count, nulls, mean, std (sample), min, quartiles, max."""
    stats = ("count", "nulls", "mean", "std", "min", "max")
    aggs = []
    for c in cols:
        x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))  # NaN counts as missing
        aggs += [
            F.struct(
                F.count(x).alias("count"),
                F.count_if(x.isNull()).alias("nulls"),
                F.avg(x).alias("mean"),
                F.stddev_samp(x).alias("std"),
                F.min(x).alias("min"),
                F.max(x).alias("max"),
            ).alias(c)
        ]
    wide = df.agg(*aggs)
    long = wide.select(
        F.explode(
            F.array(*[
                F.struct(F.lit(c).alias("column_name"), *[F.col(f"`{c}`.{s}").alias(s) for s in stats])
                for c in cols
            ])
        ).alias("s")
    ).select("s.*")
    q = column_quantiles(df, cols, [0.25, 0.5, 0.75], interpolation)
    rows = [(c, q[c].get(0.25), q[c].get(0.5), q[c].get(0.75)) for c in cols]
    quart = df.sparkSession.createDataFrame(rows, "column_name string, q25 double, q50 double, q75 double")
    return long.join(F.broadcast(quart), "column_name")


def correlations(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation of each column with the target, one pass."""
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "feature", "corr").orderBy(F.col("corr").desc(), "feature")


def auto_bins(n: int, lo: float, hi: float, q25: float, q75: float) -> int:
    """Bin count from the narrower of the Freedman-Diaconis and Sturges widths."""
    if n == 0 or hi == lo:
        return 1
    sturges = (hi - lo) / (np.log2(n) + 1)
    fd = 2 * (q75 - q25) / n ** (1 / 3)
    width = min(fd, sturges) if fd > 0 else sturges
    return max(1, int(np.ceil((hi - lo) / width)))


def histogram(df: DataFrame, col: str, bins: int | str = 10) -> DataFrame:
    """(bin, bin_left, n) over equal-width bins; the last bin includes the maximum."""
    values = df.select(F.col(col).cast("double").alias("__x")).dropna()  # drops NaN too
    n, lo, hi = values.agg(F.count("*"), F.min("__x"), F.max("__x")).first()
    if not n:
        return df.sparkSession.createDataFrame([], "bin long, bin_left double, n long")
    if bins == "auto":
        q = column_quantiles(values, ["__x"], [0.25, 0.75])["__x"]
        bins = auto_bins(n, lo, hi, q[0.25], q[0.75])
    if hi == lo:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    slot = F.least(F.floor((F.col("__x") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1).cast("long"))
    return (
        values.groupBy(slot.alias("bin"))
        .agg(F.count("*").alias("n"))
        .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_left"), "n")
    )


#: Draws after which a gamma variable is its shape's mode; each is taken with a chance of 0.95 or more.
_TRIES = 12


def _uniform(seed: int, key: str, tag: str) -> Column:
    """In (0, 1), from a hash of the group, the replicate and a name for the draw."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key).cast("string"), "replicate", F.lit(tag)), 11)
    return (bits + 0.5) * F.lit(2.0**-53)


def _gamma(shape: Column, uniform: Callable[[str], Column], tag: str) -> Column:
    """A gamma variable of a shape of at least 1 (Marsaglia and Tsang's method, the first accepted draw)."""

    def draw(d: Column, i: int) -> Column:
        normal = F.sqrt(-2 * F.log(uniform(f"{tag}{i}a"))) * F.cos(F.lit(2 * math.pi) * uniform(f"{tag}{i}b"))

        def accepted(x: Column) -> Column:
            return let(F.pow(1 + x / F.sqrt(9 * d), 3), lambda v: F.when(
                (v > 0) & (F.log(uniform(f"{tag}{i}c")) < x * x / 2 + d - d * v + d * F.log(F.greatest(v, F.lit(1e-300)))), d * v
            ))

        return let(normal, accepted)

    return let(shape - F.lit(1 / 3), lambda d: F.coalesce(*[draw(d, i) for i in range(_TRIES)], d))


def bootstrap_ci(
    df: DataFrame, key: str, col: str, level: float = 0.96, replicates: int = 1000, seed: int = 0
) -> DataFrame:
    """(key, median, low, high): percentile bootstrap interval of a group median.

    Resampling n rows with replacement draws n uniform positions in the sorted
    group, so a replicate's middle order statistics sit at the middle order
    statistics of n uniforms. Those are drawn directly from their Beta laws: the
    replicates have exactly the bootstrap distribution, yet cost ``replicates``
    draws per group instead of a copy of the data per replicate.
    """
    values = df.select(key, F.col(col).cast("double").alias("__v")).filter(F.col("__v").isNotNull())
    counts = materialise(values.groupBy(key, "__v").agg(F.count("*").alias("__n")))
    upto = prefix_sums(counts, [key], ["__v"], {"__hi": F.col("__n")})
    sizes = counts.groupBy(key).agg(F.sum("__n").alias("n"))

    # Of n uniforms the m-th smallest is G / (G + H), gamma variables of shapes m and n + 1 - m;
    # the next one lies above it by the smallest of the n - m uniforms that are left.
    n = F.col("n")
    m = F.floor((n + 1) / 2)
    uniform = lambda tag: _uniform(seed, key, tag)
    share = let(F.struct(_gamma(m, uniform, "g").alias("g"), _gamma(n + 1 - m, uniform, "h").alias("h")), lambda s: s["g"] / (s["g"] + s["h"]))
    rest = F.greatest(n - m, F.lit(1))
    next_share = F.when(n % 2 == 1, F.col("u")).otherwise(1 - (1 - F.col("u")) * F.pow(uniform("next"), 1 / rest))
    at = lambda x: F.least(F.floor(x * n), n - 1)
    draws = sizes.select(key, "n", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("replicate")).withColumn("u", share)
    draws = materialise(draws.select(key, "replicate", at(F.col("u")).alias("lo"), at(next_share).alias("up")))
    picked = draws.select(key, "replicate", F.explode(F.array("lo", "up")).alias("pos"))
    # Distinct positions wanted per group, so that the value table is met once
    # per position and not once per replicate.
    want = picked.groupBy(key, "pos").agg(F.count("*").alias("uses"))
    # Positions and value ends merged in one order: the value that covers a
    # position is the first one whose running count exceeds it.
    both = upto.select(key, F.col("__hi").alias("pos"), F.col("__v").alias("value")).unionByName(
        want.select(key, (F.col("pos") + F.lit(1)).alias("pos"), F.lit(None).cast("double").alias("value"))
    )
    located = _next_value(both, key)
    medians = (
        picked.join(located, [key, "pos"])
        .groupBy(key, "replicate")
        .agg(F.avg("value").alias("m"))
    )
    tail = (1 - level) / 2
    # A group has `replicates` medians here, whatever its number of rows.
    ci = medians.groupBy(key).agg(
        F.percentile("m", F.lit(tail)).alias("low"), F.percentile("m", F.lit(1 - tail)).alias("high")
    )
    return group_median(values, key, "__v").join(ci, key)


def _next_value(both: DataFrame, key: str) -> DataFrame:
    """(key, pos, value) for the null-valued rows of ``both``: value of the next end at or after."""
    # Rank of the next value end = number of ends strictly before the position.
    marked = both.select(
        key, "pos", "value", F.col("value").isNotNull().cast("int").alias("__is_end")
    )
    upto = prefix_sums(
        marked,
        [key],
        ["pos", F.col("__is_end").asc()],
        {"__ends": F.col("__is_end")},
    )
    ends = upto.filter("__is_end = 1").select(key, (F.col("__ends") - 1).alias("__ends"), "value")
    asks = upto.filter("__is_end = 0").select(key, (F.col("pos") - 1).alias("pos"), "__ends")
    return asks.join(ends, [key, "__ends"]).select(key, "pos", "value")
