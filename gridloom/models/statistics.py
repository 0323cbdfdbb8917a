"""Sufficient statistics of a least-squares problem, gathered in one pass.

Everything a linear model with squared loss needs is the centred Gram matrix.
It is summed inside the tasks; only d x d numbers per segment or fold come back.
Statistics of disjoint row sets add up, so cross-validation over any grid of
penalties reads the data once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Stats:
    """Sums over rows of z = (x - shift, y - y_shift): count, z and z z'."""

    n: float
    shift: np.ndarray
    total: np.ndarray
    cross: np.ndarray

    def __add__(self, other: "Stats") -> "Stats":
        return Stats(self.n + other.n, self.shift, self.total + other.total, self.cross + other.cross)

    def __sub__(self, other: "Stats") -> "Stats":
        return Stats(self.n - other.n, self.shift, self.total - other.total, self.cross - other.cross)

    @property
    def d(self) -> int:
        return len(self.total) - 1

    def means(self) -> np.ndarray:
        return self.shift + self.total / self.n

    def centred(self) -> np.ndarray:
        """Sums of products around the means; the last row and column are y's."""
        return self.cross - np.outer(self.total, self.total) / self.n

    def raw(self) -> np.ndarray:
        """Sums of products around zero."""
        s = self.shift
        return self.cross + np.outer(self.total, s) + np.outer(s, self.total) + self.n * np.outer(s, s)

    def squared_error(self, w: np.ndarray, b: float) -> float:
        """Sum of squared residuals of y = x w + b over these rows."""
        v = np.append(-w, 1.0)
        offset = self.means() @ v - b
        return max(0.0, float(v @ self.centred() @ v + self.n * offset * offset))


def gather(df: DataFrame, x: Sequence[str], y: str, by: str | None = None) -> dict:
    """Statistics per value of ``by`` (one entry under None without it).

    Rows with a null or NaN in any of the columns are left out, whatever the
    number of columns. Columns are shifted by their overall means first, which
    keeps the products small where a mean is large against its spread.
    """
    names = [*x, y]
    clean = df.select(*([by] if by else []), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    clean = clean.dropna(subset=[f"c{i}" for i in range(len(names))])  # NaN counts as missing here
    row = clean.agg(*[F.avg(f"c{i}") for i in range(len(names))]).first()
    if row[0] is None:
        return {}
    shift = np.array([float(v) for v in row])
    shifted = clean.select(
        *([by] if by else []),
        *[(F.col(f"c{i}") - F.lit(shift[i])).alias(f"c{i}") for i in range(len(names))],
    )
    return _sums(shifted, len(names), shift, by)


def _sums(df: DataFrame, k: int, shift: np.ndarray, by: str | None) -> dict:
    """Each task multiplies its batches and sends one small matrix, or one per segment."""
    keys = ["seg"] if by else []
    columns = df.select(*[f"c{i}" for i in range(k)], *([F.col(by).alias("seg")] if by else []))
    at_i, at_j = np.triu_indices(k + 1)

    def parts(batch: pa.RecordBatch, z: np.ndarray) -> Iterator[tuple]:
        if not by:
            yield None, z
            return
        coded = batch.column(k).dictionary_encode()
        codes = coded.indices.fill_null(-1).to_numpy()
        for code in np.unique(codes):
            yield (None if code < 0 else coded.dictionary[int(code)].as_py()), z[codes == code]

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        kind = pa.null()
        for batch in batches:
            kind = batch.schema.field(k).type if by else kind
            z = np.column_stack([np.ones(batch.num_rows), *[batch.column(i).to_numpy() for i in range(k)]])
            for seg, rows in parts(batch, z):
                sums[seg] = sums.get(seg, 0) + rows.T @ rows
        for seg, m in sums.items():
            cells = [pa.array(at_i, pa.int32()), pa.array(at_j, pa.int32()), pa.array(m[at_i, at_j])]
            names = ["i", "j", "v"]
            yield pa.RecordBatch.from_arrays([pa.array([seg] * len(at_i), kind), *cells] if by else cells, names=[*keys, *names])

    seg_type = f"seg {columns.schema['seg'].dataType.simpleString()}, " if by else ""
    summed = columns.mapInArrow(block, f"{seg_type}i int, j int, v double").groupBy(*keys, "i", "j").agg(F.sum("v").alias("v"))
    found: dict = {}
    for row in summed.collect():
        m = found.setdefault(row["seg"] if by else None, np.zeros((k + 1, k + 1)))
        m[row["i"], row["j"]] = m[row["j"], row["i"]] = row["v"]
    return {seg: Stats(m[0, 0], shift, m[0, 1:], m[1:, 1:]) for seg, m in found.items()}


def gram_table(df: DataFrame, x: Sequence[str], y: str) -> DataFrame:
    """(row, col, value) of X'X and X'y (col "y") as a distributed aggregate."""
    names = [*x, y]
    aggs = [
        F.sum(F.col(a).cast("double") * F.col(b).cast("double")).alias(f"{i}:{i + j}")
        for i, a in enumerate(x)
        for j, b in enumerate(names[i:])
    ]
    wide = df.agg(*aggs)
    long = wide.unpivot([], [f"`{c}`" for c in wide.columns], "cell", "value")
    labels = F.array(*[F.lit(c) for c in names])
    part = F.split("cell", ":")
    at = lambda k: F.element_at(labels, part[k].cast("int") + 1)
    return long.select(at(0).alias("row"), at(1).alias("col"), "value")
