"""Join operators. Strategy and skew handling are left to Catalyst and AQE."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def inner(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return left.join(right, on, "inner")


def left(a: DataFrame, b: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return a.join(b, on, "left")


def anti(a: DataFrame, b: DataFrame, on: str | Sequence[str]) -> DataFrame:
    keys = [on] if isinstance(on, str) else list(on)
    return a.join(b.select(*keys), keys, "left_anti")


def filter_by_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among ``ids``; no key column means no rows."""
    if key not in df.columns:
        return df.filter(F.lit(False))
    return df.join(ids.select(key).filter(F.col(key).isNotNull()), key, "left_semi")


def lookup_null_safe(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join in which a null key matches a null key."""
    a, b = df.alias("a"), stats.alias("b")
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    extra = [F.col(f"b.{c}") for c in stats.columns if c not in keys]
    return a.join(b, cond, "left").select("a.*", *extra)


def lookup_ordered(ids: DataFrame, table: DataFrame, key: str, col: str, default: str = "") -> DataFrame:
    """Every id keeps its place; ids without a row get ``default``."""
    found = ids.join(table.select(key, col), key, "left")
    return found.withColumn(col, F.coalesce(F.col(col), F.lit(default)))


def split_by_ids(
    df: DataFrame, train_ids: DataFrame, test_ids: DataFrame, key: str
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by id; raises when an id is on both sides."""
    shared = train_ids.select(key).join(test_ids.select(key), key, "left_semi")
    if shared.limit(1).count():
        raise ValueError(f"the same {key} is in both the train and the test ids")
    return filter_by_ids(df, train_ids, key), filter_by_ids(df, test_ids, key)
