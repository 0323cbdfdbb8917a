"""Row splits: hashed, expanding in time, and contiguous folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.ordered import row_index

_SPACE = 1_000_000


def random_split(
    df: DataFrame, key: str, train: float = 0.75, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """Split by a seeded hash of the key: the same rows under any partitioning."""
    return split_at(df, F.pmod(F.xxhash64(F.lit(seed), key), F.lit(_SPACE)), int(train * _SPACE))


def split_at(df: DataFrame, bucket: Column, cut: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose bucket number is below the cut, and the rest."""
    return df.filter(bucket < cut), df.filter(bucket >= cut)


def time_bounds(n: int, n_splits: int) -> list[tuple[int, int]]:
    """(first, end) validation rows of each expanding fold."""
    if n_splits < 2:
        raise ValueError("need at least two splits")
    size = n // (n_splits + 1)
    if size == 0:
        raise ValueError(f"{n} rows are too few for {n_splits} splits")
    return [(n - (n_splits - i) * size, n - (n_splits - i - 1) * size) for i in range(n_splits)]


def time_ordered(df: DataFrame, date: str, key: str, name: str = "row") -> DataFrame:
    """Rows numbered by date, undated ones last, ties by key."""
    return row_index(df, [F.col(date).asc_nulls_last(), F.col(key)], name)


def time_split_table(df: DataFrame, date: str, key: str, n_splits: int) -> DataFrame:
    """(key, row, fold, role) membership of every expanding fold."""
    rows = time_ordered(df.select(key, date), date, key).select(key, "row")
    return _roles(rows, time_bounds(rows.count(), n_splits), F.col("row") < F.col("f.first"))


def kfold_bounds(n: int, k: int) -> list[tuple[int, int]]:
    """Contiguous folds; the first n mod k hold one row more."""
    if not 2 <= k <= n:
        raise ValueError(f"cannot cut {n} rows into {k} folds")
    base, extra = divmod(n, k)
    ends = [base * (i + 1) + min(i + 1, extra) for i in range(k)]
    return list(zip([0, *ends[:-1]], ends))


def kfold_column(bounds: Sequence[tuple[int, int]], row: str = "row") -> Column:
    """Fold number (from 0) of a row number, for contiguous folds."""
    fold = F.lit(0)
    for first, _ in bounds[1:]:
        fold = fold + (F.col(row) >= first).cast("int")
    return fold


def kfold_table(df: DataFrame, key: Sequence[str], k: int) -> DataFrame:
    """``df`` with its ``row`` and ``fold`` number in key order."""
    rows = row_index(df, list(key), "row")
    return rows.withColumn("fold", kfold_column(kfold_bounds(rows.count(), k)))


def _roles(rows: DataFrame, bounds: Sequence[tuple[int, int]], before: Column) -> DataFrame:
    folds = F.explode(F.array(*[
        F.struct(F.lit(i).alias("fold"), F.lit(a).alias("first"), F.lit(b).alias("end"))
        for i, (a, b) in enumerate(bounds, start=1)
    ]))
    role = F.when(before, "train").when(F.col("row") < F.col("f.end"), "valid")
    return (
        rows.withColumn("f", folds)
        .withColumn("role", role)
        .filter(F.col("role").isNotNull())
        .withColumn("fold", F.col("f.fold"))
        .drop("f")
    )
