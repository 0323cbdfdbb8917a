"""Order-dependent operators that stay distributed for any group size.

A plain window puts each partition-by group into one task. Here a group may
hold most of the table, so:

* ``top_by_limit`` ranks inside salted slices first and re-ranks the survivors;
* ``prefix_sums`` (and ranks, row indexes, quantiles built on it) range-splits
  the rows on group *and* order, sums inside each slice and adds the totals of
  the earlier slices. Slices are pinned by a written table, because range
  boundaries come from a sample and must not differ between two reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.sources.scratch import materialise, materialise_by

#: Rows that salted slices may leave of a group for its last ranking in ``top_by_limit``.
WINDOW_ROWS = 1_000_000
#: Slices per hot group in ``top_by_limit``.
SALTS = 32

#: Stretches that the positions of a group are cut into when looking up quantiles.
_POSITION_BUCKETS = 4096
#: Rows of a derived table that is known to be small enough for every task.
_SMALL_ROWS = 100_000

_SLICE, _POS, _SALT, _RANK = "__slice", "__pos", "__salt", "__rank"


def as_column(key: str | Column) -> Column:
    return F.col(key) if isinstance(key, str) else key


def range_slices(df: DataFrame, keys: Sequence[str | Column], sort: bool = False) -> DataFrame:
    """Pin ``df`` split by ranges of ``keys``; adds the slice number.

    The copy is bucketed by slice, so windows inside slices need no further shuffle.
    With ``sort`` the rows are ordered inside each slice and numbered instead.
    """
    cols = [as_column(k) for k in keys]
    sliced = df.repartitionByRange(*cols)
    if not sort:
        return materialise_by(sliced.withColumn(_SLICE, F.spark_partition_id()), _SLICE)
    numbered = sliced.sortWithinPartitions(*cols).withColumn(_POS, F.monotonically_increasing_id())
    # The id is (task number << 33) + position in the task.
    return materialise(
        numbered.withColumn(_SLICE, F.shiftright(_POS, 33).cast("int")).withColumn(
            _POS, F.col(_POS).bitwiseAND(F.lit((1 << 33) - 1))
        )
    )


def row_index(df: DataFrame, order: Sequence[str | Column], name: str = "row") -> DataFrame:
    """Global 0-based row number in key order.

    ``order`` must end in a unique key for a repeatable answer. One range
    shuffle; the only unpartitioned window sees one row per slice.
    """
    sliced = range_slices(df, order, sort=True)
    sizes = sliced.groupBy(_SLICE).agg((F.max(_POS) + 1).alias("__n"))
    before = Window.orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col(_SLICE), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")
    )
    # One row per slice, and there are never more slices than shuffle partitions.
    return (
        sliced.join(F.broadcast(starts), _SLICE)
        .withColumn(name, (F.col("__start") + F.col(_POS)).cast("long"))
        .drop(_SLICE, _POS, "__start")
    )


def prefix_sums(
    df: DataFrame, part: Sequence[str], order: Sequence[str | Column], sums: dict[str, str | Column]
) -> DataFrame:
    """Add running totals (including the current row) per group in key order.

    ``sums`` maps new column names to the values to add up. ``order`` must be
    unique inside a group. A group may be of any size: it is cut where the range
    slices are.
    """
    return _running(range_slices(df, [*part, *order]), part, order, sums).drop(_SLICE)


def _running(
    sliced: DataFrame, part: Sequence[str], order: Sequence[str | Column], sums: dict[str, str | Column]
) -> DataFrame:
    """``prefix_sums`` of a table that is already cut by ``range_slices`` on (part, order)."""
    values = {name: as_column(v) for name, v in sums.items()}
    keys = [as_column(k) for k in order]
    totals = sliced.groupBy(_SLICE, *part).agg(
        *[F.sum(v).alias(f"__total_{name}") for name, v in values.items()]
    )
    earlier = Window.orderBy(_SLICE)
    if part:
        earlier = Window.partitionBy(*part).orderBy(_SLICE)
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        _SLICE,
        *part,
        F.row_number().over(Window.partitionBy(*part).orderBy(_SLICE) if part else Window.orderBy(_SLICE)).alias("__nth"),
        *[F.sum(f"__total_{name}").over(earlier).alias(f"__before_{name}") for name in values],
    )
    # A group continues into a later slice at most once per slice boundary, so
    # these rows number fewer than the slices.
    offsets = offsets.filter(F.col("__nth") > 1).drop("__nth")
    inside = Window.partitionBy(_SLICE, *part).orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    local = sliced.withColumns({name: F.sum(v).over(inside) for name, v in values.items()})
    left, right = local.alias("l"), F.broadcast(offsets).alias("o")
    same = F.col(f"l.{_SLICE}") == F.col(f"o.{_SLICE}")
    for p in part:
        same = same & F.col(f"l.{p}").eqNullSafe(F.col(f"o.{p}"))
    joined = left.join(right, same, "left")
    return joined.select(
        *[F.col(f"l.{c}") for c in sliced.columns if c not in values],
        *[
            (F.col(f"l.{n}") + F.coalesce(F.col(f"o.__before_{n}"), F.lit(0))).alias(n)
            for n in values
        ],
    )


def rank_in_group(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str | Column],
    name: str = "rank",
) -> DataFrame:
    """0-based rank in each group; ``order`` must end in a unique key."""
    ranked = prefix_sums(df, part, order, {name: F.lit(1)})
    return ranked.withColumn(name, (F.col(name) - 1).cast("long"))


def top_by_limit(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[str | Column],
    limit_col: str,
    bound: int | None = None,
    salt_on: Sequence[str] | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Rows whose rank in their group is below the group's own limit column.

    ``bound`` is a known upper bound of the limits (found by one aggregate when
    not given). Small limits: every salted slice keeps its own best ``bound``
    rows, already cut per input task by Spark's group limit, and only those are
    ranked together; a row in the true top is in the top of its slice, so the
    result is exact. Large limits: rows are ranked by range slices.
    """
    if bound is None:
        bound = df.agg(F.max(limit_col)).first()[0] or 0
    keys = [as_column(k) for k in order]
    if bound * salts > WINDOW_ROWS:
        ranked = rank_in_group(df, part, keys, _RANK)
        return ranked.filter(F.col(_RANK) < F.col(limit_col)).drop(_RANK)
    kept = df
    if salts > 1:
        salt_cols = salt_on or [k for k in order if isinstance(k, str)]
        salted = df.withColumn(_SALT, F.pmod(F.xxhash64(*salt_cols), F.lit(salts)))
        slice_rank = F.row_number().over(Window.partitionBy(*part, _SALT).orderBy(*keys))
        kept = (
            salted.withColumn(_RANK, slice_rank)
            .filter((F.col(_RANK) <= F.lit(bound)) & (F.col(_RANK) <= F.col(limit_col)))
            .drop(_RANK, _SALT)
        )
    final_rank = F.row_number().over(Window.partitionBy(*part).orderBy(*keys))
    return (
        kept.withColumn(_RANK, final_rank)
        .filter((F.col(_RANK) <= F.lit(bound)) & (F.col(_RANK) <= F.col(limit_col)))
        .drop(_RANK)
    )


def value_counts(df: DataFrame, col: str, by: Sequence[str] = (), name: str = "n") -> DataFrame:
    """Rows per distinct non-null value (and group)."""
    return df.filter(F.col(col).isNotNull()).groupBy(*by, col).agg(F.count("*").alias(name))


def grouped_quantiles(
    df: DataFrame,
    col: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    interpolation: str = "linear",
) -> DataFrame:
    """Exact quantiles: one row per group and probability -> (by..., p, value).

    Equal values are counted first; the counts are written once, in slices. Running counts
    then say which value covers each wanted position. No task holds a group's
    distinct values, which the built-in exact ``percentile`` would.
    """
    if interpolation not in ("linear", "nearest"):
        raise ValueError(f"unknown interpolation: {interpolation}")
    by = list(by)
    counts = value_counts(df.select(*by, F.col(col).cast("double").alias("__v")), "__v", by, "__n")
    counts = range_slices(counts, [*by, "__v"])
    sizes = counts.groupBy(*by).agg(F.sum("__n").alias("__size"))
    n_groups, biggest = sizes.agg(F.count("*"), F.max("__size")).first()
    step = max(1, (biggest or 0) // _POSITION_BUCKETS)

    grid = sizes.filter(F.col("__size") > 0).select(
        *by, "__size", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p")
    )
    at = F.col("p") * (F.col("__size") - 1)
    if interpolation == "nearest":
        grid = grid.withColumns({"__lo": F.floor(at + 0.5), "__up": F.floor(at + 0.5), "__frac": F.lit(0.0)})
    else:
        grid = grid.withColumns({"__lo": F.floor(at), "__up": F.ceil(at), "__frac": at - F.floor(at)})
    asks = grid.select(
        *by, "p", "__frac", "__lo", "__up", F.explode(F.array_distinct(F.array("__lo", "__up"))).alias("__pos")
    ).withColumn(_SLICE, F.floor(F.col("__pos") / step))
    if n_groups * len(probs) <= _SMALL_ROWS:
        asks = F.broadcast(asks)

    # A value covers the positions [hi - n, hi). It meets a position through the
    # stretch of positions both lie in; all stretches together outnumber the
    # values by at most _POSITION_BUCKETS per group.
    upto = _running(counts, by, ["__v"], {"__hi": F.col("__n")}).drop(_SLICE)
    first = F.col("__hi") - F.col("__n")
    spread = upto.withColumns({
        "__first": first,
        _SLICE: F.explode(F.sequence(F.floor(first / step), F.floor((F.col("__hi") - 1) / step))),
    })
    rows = (
        spread.alias("u")
        .join(asks.alias("a"), _all_equal("u", "a", by) & (F.col(f"u.{_SLICE}") == F.col(f"a.{_SLICE}")))
        .filter((F.col("a.__pos") >= F.col("u.__first")) & (F.col("a.__pos") < F.col("u.__hi")))
        .select(*[F.col(f"u.{b}").alias(b) for b in by], "u.__v", "a.p", "a.__pos", "a.__lo", "a.__up", "a.__frac")
    )
    lo = F.max(F.when(F.col("__pos") == F.col("__lo"), F.col("__v")))
    up = F.max(F.when(F.col("__pos") == F.col("__up"), F.col("__v")))
    frac = F.max("__frac")
    return rows.groupBy(*by, "p").agg(F.when(frac == 0, lo).otherwise(lo + (up - lo) * frac).alias("value"))


def _all_equal(left: str, right: str, names: Sequence[str]) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & F.col(f"{left}.{n}").eqNullSafe(F.col(f"{right}.{n}"))
    return cond


def column_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], interpolation: str = "linear"
) -> dict[str, dict[float, float]]:
    """Exact quantiles of several columns as driver values (columns x probs numbers); NaN counts as missing."""
    long = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols])
    long = long.unpivot([], list(cols), "__name", "__value") if len(cols) else None
    if long is None:
        return {}
    rows = grouped_quantiles(long, "__value", probs, ["__name"], interpolation).collect()
    out: dict[str, dict[float, float]] = {c: {} for c in cols}
    for row in rows:
        out[row["__name"]][row["p"]] = row["value"]
    return out


def quantiles(
    df: DataFrame, col: str, probs: Sequence[float], interpolation: str = "linear"
) -> DataFrame:
    """(p, value) table of exact quantiles of one column."""
    return grouped_quantiles(df, col, probs, (), interpolation)


def group_median(df: DataFrame, key: str, col: str, name: str = "median") -> DataFrame:
    return grouped_quantiles(df, col, [0.5], [key]).select(key, F.col("value").alias(name))


def sortedness(df: DataFrame, row_id: str, col: str) -> DataFrame:
    """One row: is ``col`` ascending / descending when read in ``row_id`` order.

    Neighbours are compared inside range slices; then the edges of the slices,
    one row each, are compared with one another.
    """
    sliced = range_slices(df.select(row_id, col), [row_id])
    w = Window.partitionBy(_SLICE).orderBy(row_id)
    prev = F.lag(col).over(w)
    steps = sliced.withColumn("__prev", prev).groupBy(_SLICE).agg(
        F.bool_and(F.coalesce(F.col(col) >= F.col("__prev"), F.lit(True))).alias("up"),
        F.bool_and(F.coalesce(F.col(col) <= F.col("__prev"), F.lit(True))).alias("down"),
        F.min_by(col, row_id).alias("first"),
        F.max_by(col, row_id).alias("last"),
    )
    edge = Window.orderBy(_SLICE)
    joined = steps.withColumn("before", F.lag("last").over(edge))
    return joined.agg(
        F.bool_and(F.col("up") & F.coalesce(F.col("first") >= F.col("before"), F.lit(True))).alias("ascending"),
        F.bool_and(F.col("down") & F.coalesce(F.col("first") <= F.col("before"), F.lit(True))).alias("descending"),
    ).select(
        "ascending",
        "descending",
        F.when(F.col("ascending"), "ascending").when(F.col("descending"), "descending").otherwise("unsorted").alias("verdict"),
    )


def latest(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row per key that sorts last; ties are broken by the rest of ``order``.

    ``row_number() = 1`` becomes a group limit, so every input task sends at
    most one row per key into the shuffle.
    """
    keys = [key] if isinstance(key, str) else list(key)
    desc = [(F.col(o).desc_nulls_last() if isinstance(o, str) else o) for o in order]
    w = Window.partitionBy(*keys).orderBy(*desc)
    return df.withColumn(_RANK, F.row_number().over(w)).filter(F.col(_RANK) == 1).drop(_RANK)


def first_by(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row per key that sorts first."""
    keys = [key] if isinstance(key, str) else list(key)
    asc = [(F.col(o).asc_nulls_last() if isinstance(o, str) else o) for o in order]
    w = Window.partitionBy(*keys).orderBy(*asc)
    return df.withColumn(_RANK, F.row_number().over(w)).filter(F.col(_RANK) == 1).drop(_RANK)


def keep_last(df: DataFrame, key: str, order: str) -> DataFrame:
    """Keep-last de-duplication on ``key`` in the input order column."""
    return latest(df, key, [order])
