"""Projection, filtering, schema and sampling operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def empty(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """Typed table with no rows."""
    return spark.createDataFrame([], schema)


def cols_of_type(df: DataFrame, types: tuple[type, ...]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def numeric_cols(df: DataFrame) -> list[str]:
    return cols_of_type(df, NUMERIC)


def not_equal(col: str, value, keep_null: bool = True) -> Column:
    """``col != value``; null rows stay unless ``keep_null`` is off."""
    test = F.col(col) != F.lit(value)
    return (F.col(col).isNull() | test) if keep_null else test


def partition_by_mask(df: DataFrame, cond: Column) -> tuple[DataFrame, DataFrame]:
    """Rows where ``cond`` holds, and all others (null counts as not holding)."""
    holds = F.coalesce(cond, F.lit(False))
    return df.filter(holds), df.filter(~holds)


def fill_by_type(df: DataFrame) -> DataFrame:
    """Null -> False / "" / 0 by column type; NaN in doubles also becomes 0."""

    def filled(f: T.StructField) -> Column:
        c = F.col(f.name)
        match f.dataType:
            case T.BooleanType():
                c = F.coalesce(c, F.lit(False))
            case T.StringType():
                c = F.coalesce(c, F.lit(""))
            case T.LongType():
                c = F.coalesce(c, F.lit(0).cast("long"))
            case T.DoubleType():
                c = F.nanvl(F.coalesce(c, F.lit(0.0)), F.lit(0.0))
        return c.alias(f.name)

    return df.select(*[filled(f) for f in df.schema.fields])


def fill_null(col: str | Column, value) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(value))


def fill_const(df: DataFrame, cols: Sequence[str], value: str = "NotGiven") -> DataFrame:
    return df.fillna({c: value for c in cols})


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=list(subset) if subset else None)


def to_numeric(df: DataFrame, cols: Sequence[str], dtype: str = "long") -> DataFrame:
    """Cast that turns unreadable values into null; absent columns are skipped."""
    return df.withColumns({c: F.col(c).try_cast(dtype) for c in cols if c in df.columns})


def align(df: DataFrame, cols: Mapping[str, str]) -> DataFrame:
    """Exactly ``cols`` (name -> type) in that order; absent ones are all null."""
    return df.select(*[
        (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in cols.items()
    ])


def shift_priorities(
    df: DataFrame, cols: Sequence[str], forbidden: str, guard: Column, any_position: bool = False
) -> DataFrame:
    """Drop a forbidden first choice and move the later two up; the last becomes "".

    ``any_position`` also removes the forbidden value from a later place.
    """
    p1, p2, p3 = cols
    first = guard & (F.col(p1) == forbidden)
    out = {
        p1: F.when(first, F.col(p2)).otherwise(F.col(p1)),
        p2: F.when(first, F.col(p3)).otherwise(F.col(p2)),
        p3: F.when(first, F.lit("")).otherwise(F.col(p3)),
    }
    if any_position:
        second = guard & ~F.coalesce(first, F.lit(False)) & (F.col(p2) == forbidden)
        third = guard & ~F.coalesce(first, F.lit(False)) & (F.col(p3) == forbidden)
        out[p2] = F.when(second, F.col(p3)).otherwise(out[p2])
        out[p3] = F.when(second | third, F.lit("")).otherwise(out[p3])
    return df.withColumns(out)


def lookup(col: str | Column, mapping: Mapping, default) -> Column:
    """Literal map lookup with a default."""
    c = F.col(col) if isinstance(col, str) else col
    if not mapping:
        return F.lit(default)
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.element_at(table, c), F.lit(default))


def with_required(
    df: DataFrame,
    cohort_col: str,
    cohorts: Sequence[str],
    other_cohort: Column,
    flag: Column,
    name: str = "required",
) -> DataFrame:
    """Speciality flag and the number of courses to choose.

    Listed cohorts choose two; the flagged part of the other cohort belongs to
    the speciality but still chooses one.
    """
    listed = F.col(cohort_col).isin(list(cohorts))
    return df.withColumns({
        "is_special": listed | (other_cohort & flag),
        name: F.when(listed, F.lit(2)).otherwise(F.lit(1)).cast("long"),
    })


def row_count(df: DataFrame) -> DataFrame:
    """Row count as a one-row table; no column is read."""
    return df.select(F.count("*").alias("n"))


def repeat_rows(df: DataFrame, n: int, name: str | None = None) -> DataFrame:
    """Every row ``n`` times, without a join or a shuffle."""
    copies = F.explode(F.sequence(F.lit(1), F.lit(n)))
    out = df.withColumn(name or "__copy", copies)
    return out if name else out.drop("__copy")


def repeat_df(df: DataFrame, n: int, key: str = "timestamp") -> DataFrame:
    """Scale-out copy keyed on ``key``: a keyed row appears ``n`` times.

    Null keys match nothing, but are one key: where there are any, ``n`` rows without values stand for them.
    """
    unmatched = df.filter(F.col(key).isNull()).limit(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    return repeat_rows(df.filter(F.col(key).isNotNull()).union(unmatched), n)


def head(df: DataFrame, order: Sequence[str | Column], k: int) -> DataFrame:
    keys = [F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order]
    return df.orderBy(*keys).limit(k)


def tail(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    return df.orderBy(*[F.col(o).desc_nulls_first() for o in order]).limit(k)


def order_by(df: DataFrame, keys: Sequence[str], desc: Sequence[bool] | None = None) -> DataFrame:
    """Sort with nulls last in either direction."""
    desc = desc or [False] * len(keys)
    return df.orderBy(*[
        F.col(k).desc_nulls_last() if d else F.col(k).asc_nulls_last() for k, d in zip(keys, desc)
    ])


def sample_n(df: DataFrame, n: int, seed: int, key: Sequence[str], hashed: Column | None = None) -> DataFrame:
    """``n`` rows without replacement, the same ones under any partitioning: those of the smallest hashes of their key.

    ``hashed`` is a 64-bit hash to use instead of a seeded one. The n-th smallest hash is found by counting
    rows by hash prefix, 16 more bits at a time and inside one prefix only, so the sample is a
    filter over the rows as they lie; rows of equal hash are taken in key order.
    """
    h = F.xxhash64(F.lit(seed), *key) if hashed is None else hashed
    rest, inside = n, F.lit(True)
    if n <= 0:
        return df.limit(0)
    for bits in (48, 32, 16, 0):
        prefix = F.shiftright(h, bits)
        found = None
        for row in sorted(df.filter(inside).groupBy(prefix.alias("p")).count().collect(), key=lambda r: r["p"]):
            if row["count"] >= rest:
                found = row
                break
            rest -= row["count"]
        if found is None:
            return df  # fewer than n rows in all
        if found["count"] == rest:
            return df.filter(prefix <= found["p"])
        inside = prefix == found["p"]
    tied = df.filter(inside).orderBy(*key).limit(rest)
    return df.filter(h < found["p"]).unionAll(tied)


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def union_aligned(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def distinct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def explode_columns(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """One row per listed column's value."""
    return df.select(F.explode(F.array(*cols)).alias(name))


def common_values(a: DataFrame, b: DataFrame, cols: Sequence[str], name: str = "value") -> DataFrame:
    """Non-blank values found in both tables' list columns."""
    left, right = (_distinct_values(t, cols, name) for t in (a, b))
    return left.join(right, name, "left_semi")


def only_in(a: DataFrame, b: DataFrame, cols: Sequence[str], name: str = "value") -> DataFrame:
    left, right = (_distinct_values(t, cols, name) for t in (a, b))
    return left.join(right, name, "left_anti")


def _distinct_values(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    return explode_columns(df, cols, name).filter(F.col(name) != "").distinct()


def has_ties(df: DataFrame, id_col: str, col: str) -> DataFrame:
    """One row: do two different ids share a value."""
    pairs = df.select(id_col, col).distinct()
    tied = pairs.groupBy(col).count().filter(F.col("count") > 1).limit(1)
    return tied.agg((F.count("*") > 0).alias("has_ties"))


def has_any_nonzero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: does any of the columns hold a non-zero value."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.coalesce(F.col(c) != 0, F.lit(False))
    return df.filter(cond).limit(1).agg((F.count("*") > 0).alias("any_nonzero"))
