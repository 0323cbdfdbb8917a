"""Encoders and scalers fitted on a train table and applied to any table.

A fitted encoder keeps what its model is made of: per-category tables stay
DataFrames, per-column numbers are driver values.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.numeric import let
from gridloom.operators.ordered import column_quantiles, row_index
from gridloom.operators.reshape import to_arrays, to_vectors
from gridloom.sources.scratch import materialise


#: Most items or categories that may become cells or columns; more are an error.
MOST_NAMES = 100_000

# --- category encoders -------------------------------------------------------

def one_hot(train: DataFrame, other: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    """Long one-hot rows of ``other``: (key, feature, category, value 1).

    Categories come from ``train``; null is a category of its own there. A value
    never seen in train gives no row, which is a zero vector.
    """
    return _long(other, cols, key).join(
        materialise(categories(train, cols)).alias("d"),
        F.col("feature").eqNullSafe(F.col("d.f")) & F.col("category").eqNullSafe(F.col("d.c")),
        "left_semi",
    ).withColumn("value", F.lit(1))


def categories(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct (f, c) pairs: feature name and category."""
    return _long(df, cols, None).select(F.col("feature").alias("f"), F.col("category").alias("c")).distinct()


def _long(df: DataFrame, cols: Sequence[str], key: str | None) -> DataFrame:
    keys = [key] if key else []
    text = df.select(*keys, *[F.col(c).cast("string").alias(f"__{c}") for c in cols])
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"__{c}").alias("category")) for c in cols
    ]))
    return text.select(*keys, pairs.alias("p")).select(*keys, "p.feature", "p.category")


def one_hot_named(train: DataFrame, other: DataFrame, col: str) -> DataFrame:
    """``other`` with one named 0/1 column per train category and one for unknown.

    One column per category: the category list is as wide as the result's schema.
    """
    values = _bounded(train.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col))
    known = F.coalesce(F.col(col).isin(values), F.lit(False)) if values else F.lit(False)
    flags = {f"{col}_{v}": F.coalesce(F.col(col) == v, F.lit(False)).cast("int") for v in values}
    return other.withColumns({**flags, f"{col}_unknown": (~known).cast("int")})


def _bounded(names: DataFrame) -> list:
    """The only column of ``names``; raises when it is longer than ``MOST_NAMES``."""
    found = [r[0] for r in names.limit(MOST_NAMES + 1).collect()]
    if len(found) > MOST_NAMES:
        raise ValueError(f"more than {MOST_NAMES} distinct values of {names.columns[0]}")
    return found


def category_weight(n: Column, min_leaf: float = 20.0, smoothing: float = 10.0) -> Column:
    """Weight of a category's own mean against the prior, by its number of rows."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(n - F.lit(min_leaf)) / F.lit(smoothing)))


def target_stats(
    train: DataFrame, col: str, y: str, min_leaf: float = 20.0, smoothing: float = 10.0
) -> tuple[DataFrame, float]:
    """(category, encoding) table and the prior for everything not in it."""
    prior = train.agg(F.avg(F.col(y).cast("double"))).first()[0]
    prior = 0.0 if prior is None else float(prior)
    weight = category_weight(F.col("__n"), min_leaf, smoothing)
    table = (
        train.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count("*").alias("__n"), F.avg(F.col(y).cast("double")).alias("__mean"))
        .select(col, (F.lit(prior) * (1 - weight) + F.col("__mean") * weight).alias("__enc"))
    )
    return materialise(table), prior


def target_encode(
    train: DataFrame, other: DataFrame, col: str, y: str, min_leaf: float = 20.0, smoothing: float = 10.0,
    out: str | None = None,
) -> DataFrame:
    """Smoothed target mean of the category; unknown and missing get the prior.

    Train rows encoded this way include their own target.
    """
    table, prior = target_stats(train, col, y, min_leaf, smoothing)
    found = other.join(table, col, "left")
    return found.withColumn(out or f"{col}_te", F.coalesce("__enc", F.lit(prior))).drop("__enc")


# --- numeric columns ---------------------------------------------------------

def medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    return {c: q.get(0.5) for c, q in column_quantiles(df, cols, [0.5]).items()}


def impute_median(train: DataFrame, other: DataFrame, cols: Sequence[str]) -> DataFrame:
    return _impute(other, medians(train, cols))


def impute_mean(train: DataFrame, other: DataFrame, cols: Sequence[str]) -> DataFrame:
    row = train.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first()
    return _impute(other, row.asDict())


def _impute(df: DataFrame, fills: dict[str, float | None]) -> DataFrame:
    known = {c: v for c, v in fills.items() if v is not None}
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in known.items()})


def scale_stats(train: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; a constant column gets 1."""
    row = train.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(cols)],
    ).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(cols)}


def scale(train: DataFrame, other: DataFrame, cols: Sequence[str]) -> DataFrame:
    stats = scale_stats(train, cols)
    return other.withColumns({
        c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, (m, s) in stats.items()
    })


def polynomial(df: DataFrame, cols: Sequence[str], degree: int = 2) -> DataFrame:
    """All monomials up to ``degree`` without the constant, as named columns."""
    out: dict[str, Column] = {}
    for d in range(1, degree + 1):
        for combo in combinations_with_replacement(cols, d):
            product = F.lit(1.0)
            for c in combo:
                product = product * F.col(c).cast("double")
            out["poly_" + "_".join(combo)] = product
    return df.withColumns(out)


def quantile_edges(train: DataFrame, col: str, n_bins: int = 5) -> list[float]:
    """Distinct edges at equally spaced quantiles."""
    probs = [i / n_bins for i in range(n_bins + 1)]
    found = column_quantiles(train, [col], probs)[col]
    edges: list[float] = []
    for p in probs:
        if not edges or found[p] - edges[-1] > 1e-8:
            edges.append(found[p])
    return edges


def quantile_bins(train: DataFrame, other: DataFrame, col: str, n_bins: int = 5) -> DataFrame:
    """Bin number by train quantiles and one 0/1 column per bin.

    Values outside the train range fall into the first or last bin.
    """
    edges = quantile_edges(train, col, n_bins)
    inner = edges[1:-1]
    slot = F.lit(0)
    for e in inner:
        slot = slot + (F.col(col) >= F.lit(e)).cast("int")
    out = other.withColumn(f"{col}_bin", slot)
    return out.withColumns({
        f"{col}_bin_{i}": (F.col(f"{col}_bin") == i).cast("int") for i in range(len(inner) + 1)
    })


def trim_outliers(df: DataFrame, err: str, q: float = 0.95) -> DataFrame:
    """Rows whose error is strictly below its ``q`` quantile."""
    cut = column_quantiles(df, [err], [q])[err].get(q)
    return df if cut is None else df.filter(F.col(err) < F.lit(cut))


# --- quantile -> normal ------------------------------------------------------

# Coefficients of P. Acklam's rational approximation of the
# inverse normal distribution (central part a/b, tails c/d, split at _TAIL).
_A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02,
      1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
_B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02,
      6.680131188771972e01, -1.328068155288572e01, 1.0)
_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00,
      -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00,
      3.754408661907416e00, 1.0)
_TAIL = 0.02425
# Fixed value: probabilities are kept this far from 0 and 1.
_EDGE = 1e-7
# Coefficients of J. Hart's rational approximation of the normal tail
# exp(-z * z / 2) * p / q for 0 <= z < _FAR, highest power first.
_HART_P = (3.52624965998911e-02, 7.00383064443688e-01, 6.37396220353165e00, 3.3912866078383e01,
           1.12079291497871e02, 2.21213596169931e02, 2.20206867912376e02)
_HART_Q = (8.83883476483184e-02, 1.75566716318264e00, 1.6064177579207e01, 8.67807322029461e01,
           2.96564248779674e02, 6.37333633378831e02, 7.93826512519948e02, 4.40413735824752e02)
_FAR = 7.07106781186547


def _polynomial_of(coefficients: Sequence[float], x: Column) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + F.lit(c)
    return out


def normal_ppf(p: Column) -> Column:
    """Inverse of the normal distribution function, probabilities kept off 0 and 1."""

    def of(p: Column) -> Column:
        near = F.least(p, 1 - p)
        tail = let(F.sqrt(-2 * F.log(near)), lambda t: _polynomial_of(_C, t) / _polynomial_of(_D, t))
        centre = let(p - 0.5, lambda q: let(q * q, lambda r: _polynomial_of(_A, r) * q / _polynomial_of(_B, r)))
        return F.when(near < _TAIL, F.when(p < 0.5, tail).otherwise(-tail)).otherwise(centre)

    return let(F.least(F.greatest(p, F.lit(_EDGE)), F.lit(1 - _EDGE)), of)


def normal_cdf(z: Column) -> Column:
    """Distribution function of the normal law, to fourteen digits."""

    def of(z: Column) -> Column:
        size = F.abs(z)
        tail = F.exp(-z * z / 2) * _polynomial_of(_HART_P, size) / _polynomial_of(_HART_Q, size)
        tail = F.when(size < _FAR, tail).otherwise(0.0)
        return F.when(z > 0, 1 - tail).otherwise(tail)

    return let(z, of)


@dataclass(frozen=True)
class QuantileNormal:
    """Maps a column to a normal law through its train quantiles, and back.

    Holds ``n`` quantiles, so the model does not grow with the data. Both
    directions are columns: a binary search in the sorted quantiles and a straight
    line between two of them, and the normal law as rational functions, over batches. Null and NaN give null.
    """

    quantiles: tuple[float, ...]

    @staticmethod
    def fit(train: DataFrame, col: str, n: int = 300) -> "QuantileNormal":
        n = max(2, min(n, train.filter(F.col(col).isNotNull()).count()))
        probs = [float(p) for p in np.linspace(0, 1, n)]
        found = column_quantiles(train, [col], probs)[col]
        return QuantileNormal(tuple(float(q) for q in np.maximum.accumulate([found[p] for p in probs])))

    def _share(self, v: np.ndarray) -> np.ndarray:
        q = np.array(self.quantiles)
        last = len(q) - 1
        under, upto = np.searchsorted(q, v, "left"), np.searchsorted(q, v, "right")
        low, high = q[np.clip(under - 1, 0, last)], q[np.minimum(under, last)]
        between = under - 1 + (v - low) / np.where(high > low, high - low, 1.0)
        inside = np.where(upto > under, (under + upto - 1) / 2.0, between) / last
        found = np.where(v - _EDGE < q[0], 0.0, np.where(v + _EDGE > q[last], 1.0, inside))
        return np.where(np.isnan(v), np.nan, found)

    def _score(self, v: np.ndarray) -> np.ndarray:
        """The steps of ``normal_ppf`` over the shares of a batch."""
        p = np.clip(self._share(v), _EDGE, 1 - _EDGE)
        near, q = np.minimum(p, 1 - p), p - 0.5
        t, r = np.sqrt(-2 * np.log(near)), q * q
        tail = np.polyval(_C, t) / np.polyval(_D, t)
        return np.where(near < _TAIL, np.where(p < 0.5, tail, -tail), np.polyval(_A, r) * q / np.polyval(_B, r))

    def _value(self, z: np.ndarray) -> np.ndarray:
        """Train values of normal scores, by the steps of ``normal_cdf``."""
        q = np.array(self.quantiles)
        last, size = len(q) - 1, np.minimum(np.abs(z), _FAR)
        tail = np.exp(-z * z / 2) * np.polyval(_HART_P, size) / np.polyval(_HART_Q, size)
        tail = np.where(np.abs(z) < _FAR, tail, 0.0)
        p = np.where(z > 0, 1 - tail, tail)
        at = np.clip(np.floor(p * last), 0, last - 1).astype(np.int64)
        line = q[at] + (p * last - at) * (q[at + 1] - q[at])
        found = np.where(p <= _EDGE * 1.01, q[0], np.where(p >= 1 - _EDGE * 1.01, q[last], line))
        return np.where(np.isnan(z), np.nan, found)

    def share(self, x: Column) -> Column:
        """Share of the train values up to x, in the middle of equal ones."""
        return _over_batches(self._share)(x)

    def forward(self, col: str | Column) -> Column:
        return _over_batches(self._score)((F.col(col) if isinstance(col, str) else col).cast("double"))

    def inverse(self, col: str | Column) -> Column:
        return _over_batches(self._value)((F.col(col) if isinstance(col, str) else col).cast("double"))


def _over_batches(function: Callable[[np.ndarray], np.ndarray]):
    """A function of numbers as a column function; null is NaN inside, and NaN comes back as null."""

    @F.pandas_udf("double")
    def of(x: pd.Series) -> pd.Series:
        return pd.Series(function(x.to_numpy(np.float64, na_value=np.nan)))

    return of


# --- set encoder -------------------------------------------------------------

@dataclass(frozen=True)
class Side:
    """Slots of one side: the weight of an item there, and the block of columns it counts in."""

    first: int
    last: int
    weight: int
    block: int


#: One block, in which the sides cancel each other out; or a block for each side.
SIGNED = (Side(0, 4, 1, 0), Side(128, 132, -1, 0))
SPLIT = (Side(0, 4, 1, 0), Side(128, 132, 1, 1))


@dataclass(frozen=True)
class SetEncoder:
    """Items of a match as a vector: the sign of the weights that its sides give each item.

    ``dictionary`` is (hero_id, col), the items numbered by ascending id.
    """

    dictionary: DataFrame
    n_items: int
    sides: tuple[Side, ...] = SIGNED

    @property
    def n_features(self) -> int:
        return self.n_items * (1 + max(side.block for side in self.sides))

    @staticmethod
    def fit(items: DataFrame, split_teams: bool = False, sides: tuple[Side, ...] | None = None) -> "SetEncoder":
        named = [c for c in items.columns if c in ("id", "hero_id")]
        if not named:
            raise ValueError("the item table has neither an id nor a hero_id column")
        item = F.col("id" if "id" in named else "hero_id").try_cast("int").alias("hero_id")
        # As many rows as a block of the encoded vectors has cells.
        listed = _bounded(items.select(item).dropna().distinct().orderBy("hero_id"))
        table = items.sparkSession.createDataFrame([(v, i) for i, v in enumerate(listed)], "hero_id int, col int")
        return SetEncoder(table, len(listed), sides or (SPLIT if split_teams else SIGNED))

    def coordinates(self, players: DataFrame) -> DataFrame:
        """(match_id, col, value) of non-zero cells; raises at once on an item that the table lacks."""
        match, item, slot = (F.col(c).try_cast(t) for c, t in (("match_id", "long"), ("hero_id", "int"), ("player_slot", "int")))
        side = F.coalesce(*[
            F.when(slot.between(s.first, s.last), F.struct(F.lit(s.weight).alias("weight"), F.lit(s.block).alias("block"))) for s in self.sides
        ])
        seen = players.select(match.alias("match_id"), item.alias("hero_id"), side.alias("side"))
        seen = seen.filter("match_id IS NOT NULL AND side IS NOT NULL AND hero_id != 0")
        # At most MOST_NAMES rows; a shuffle by item would put a popular item into one task.
        known = F.broadcast(self.dictionary)
        stray = seen.join(known, "hero_id", "left_anti").select("hero_id").head()
        if stray:
            raise ValueError(f"the item table lacks item {stray[0]}")
        cells = seen.join(known, "hero_id").groupBy("match_id", (F.col("col") + F.col("side.block") * self.n_items).alias("col"))
        return cells.agg(F.signum(F.sum("side.weight")).cast("int").alias("value")).filter("value != 0")

    def _rows(self, players: DataFrame, matches: DataFrame | None) -> DataFrame:
        """Ids that get a row: those of ``matches`` with their repeats, or each one of ``players``."""
        ids = (matches if matches is not None else players).select(F.col("match_id").try_cast("long").alias("match_id"))
        return ids if matches is not None else ids.distinct()

    def vectors(self, players: DataFrame, matches: DataFrame | None = None, name: str = "features") -> DataFrame:
        """One sparse vector per match; a match without rows has an empty one."""
        return to_vectors(self.coordinates(players), "match_id", self.n_features, name, self._rows(players, matches))

    def transform(self, players: DataFrame, matches: DataFrame | None = None, name: str = "features") -> DataFrame:
        """One dense array per match, for few items; ``vectors`` does not grow with their number."""
        rows = to_arrays(self.coordinates(players), "match_id", self.n_features, name)
        zero = F.array_repeat(F.lit(0.0), self.n_features)
        return self._rows(players, matches).join(rows, "match_id", "left").withColumn(name, F.coalesce(name, zero))

    def transform_batches(self, players: DataFrame, matches: DataFrame, batch_size: int = 100_000, name: str = "features") -> DataFrame:
        """``vectors`` with the batch number of each match, in match order.

        Batches are cut by match, so one match is never split; Spark's own
        partitions bound the memory.
        """
        numbered = row_index(matches.select("match_id"), ["match_id"], "row")
        batches = numbered.select(F.col("match_id").try_cast("long").alias("match_id"), F.floor(F.col("row") / batch_size).alias("batch"))
        return to_vectors(self.coordinates(players), "match_id", self.n_features, name, batches)
