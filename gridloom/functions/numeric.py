"""Numeric column functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def transform_value(col: str, mode: str = "raw") -> Column:
    """Null -> 0, negatives -> 0, then raw / log1p / sqrt; unknown modes act as raw."""
    x = F.greatest(F.coalesce(F.col(col).cast("double"), F.lit(0.0)), F.lit(0.0))
    return {"log1p": F.log1p(x), "sqrt": F.sqrt(x)}.get(mode, x)


def transform_known(col: str, mode: str) -> Column:
    """log / sqrt / inv / exp_log of the value itself; null stays null.

    Outside a function's domain the result is infinite or NaN, not null.
    """
    x = F.col(col).cast("double")
    forms = {
        "log": _log(F.lit(1.0) + x, F.log1p(x)),
        "sqrt": F.sqrt(x),
        "inv": F.when(x == -1.0, float("inf")).otherwise(F.lit(1.0) / F.nullif(F.lit(1.0) + x, F.lit(0.0))),
        "exp_log": F.exp(_log(x, F.log(x))),
    }
    if mode not in forms:
        raise ValueError(f"unknown transform: {mode}")
    return forms[mode]


def _log(argument: Column, value: Column) -> Column:
    below = F.when(argument == 0, float("-inf")).when(argument < 0, float("nan"))
    return F.when(argument > 0, value).otherwise(below)


def log_target(col: str | Column) -> Column:
    x = F.col(col) if isinstance(col, str) else col
    return _log(x, F.log(x))


def exp_target(col: str | Column) -> Column:
    return F.exp(col)


def clip(col: str | Column, low, high) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.greatest(F.least(c, F.lit(high)), F.lit(low))


def residuals(df: DataFrame, y: str, p: str) -> DataFrame:
    """Adds the residual ``y - p`` and its square."""
    r = F.col(y) - F.col(p)
    return df.withColumns({"residual": r, "squared_error": r * r})


def dot(cols: Sequence[str], weights: Sequence[float]) -> Column:
    """Linear prediction as one expression."""
    if len(cols) != len(weights):
        raise ValueError(f"{len(cols)} columns for {len(weights)} weights")
    total = F.lit(0.0)
    for c, w in zip(cols, weights):
        total = total + F.col(c).cast("double") * F.lit(float(w))
    return total
