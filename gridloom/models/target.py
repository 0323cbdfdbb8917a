"""Regression on a transformed target."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.models.linear import LinearModel, fit_ridge
from gridloom.models.search import grid_search
from gridloom.operators.encode import QuantileNormal
from gridloom.sources.scratch import materialise


@dataclass(frozen=True)
class LogLaw:
    """The logarithm as a target's shape."""

    def forward(self, col: str | Column) -> Column:
        return F.log(col)

    def inverse(self, col: str | Column) -> Column:
        return F.exp(col)


@dataclass(frozen=True)
class TransformedTarget:
    model: LinearModel
    law: QuantileNormal | LogLaw

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        raw = self.model.predict(df, "__raw")
        return raw.withColumn(out, self.law.inverse(F.col("__raw"))).drop("__raw")


def fit_transformed_target(
    df: DataFrame,
    x: Sequence[str],
    y: str,
    n_quantiles: int = 300,
    alpha: float | None = 1.0,
    alphas: Sequence[float] = (0.1, 1.0, 10.0),
    order: Sequence[str] = (),
    k: int = 5,
) -> TransformedTarget:
    """Ridge on the target's normal scores; predictions come back in target units.

    Without ``alpha`` the penalty is chosen from ``alphas`` over k folds in ``order``.
    """
    # Quantiles, folds and sums read the rows several times: they are written once, and their scores once.
    df = materialise(df.select(*dict.fromkeys([*order, *x, y])))
    law = QuantileNormal.fit(df, y, n_quantiles)
    shaped = materialise(df.withColumn("__target", law.forward(y)))
    if alpha is None:
        model = grid_search(shaped, x, "__target", alphas, k, order).model
    else:
        model = fit_ridge(shaped, x, "__target", alpha)
    return TransformedTarget(model, law)


def fit_log_target(df: DataFrame, x: Sequence[str], y: str, alpha: float = 0.0) -> TransformedTarget:
    """Least squares on the log of the target."""
    shaped = df.withColumn("__target", LogLaw().forward(y))
    return TransformedTarget(fit_ridge(shaped, x, "__target", alpha), LogLaw())
