"""Penalty grids over folds, and seeded random search."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.models.linear import LinearModel, lasso_path, solve_ridge
from gridloom.models.splits import kfold_table
from gridloom.models.statistics import Stats, gather

#: Weights and intercept for each of several penalties.
SOLVERS = {
    "ridge": lambda stats, alphas: [solve_ridge(stats, a) for a in alphas],
    "lasso": lambda stats, alphas: [(f.weights, f.intercept) for f in lasso_path(stats, alphas)],
}


@dataclass(frozen=True)
class GridResult:
    alphas: tuple[float, ...]
    scores: np.ndarray  # alphas x folds, RMSE
    best_alpha: float
    model: LinearModel

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (float(a), i, float(s)) for a, row in zip(self.alphas, self.scores) for i, s in enumerate(row)
        ]
        return spark.createDataFrame(rows, "alpha double, fold int, rmse double")


def fold_statistics(df: DataFrame, x: Sequence[str], y: str, k: int, order: Sequence[str]) -> list[Stats]:
    """Statistics of contiguous folds in ``order``; one pass for all of them."""
    folds = kfold_table(df.select(*dict.fromkeys([*order, *x, y])), order, k)
    found = gather(folds, x, y, "fold")
    return [found[i] for i in range(k)]


def grid_search(
    df: DataFrame,
    x: Sequence[str],
    y: str,
    alphas: Sequence[float],
    k: int = 10,
    order: Sequence[str] = ("id",),
    estimator: str = "ridge",
) -> GridResult:
    """Penalty with the smallest mean RMSE over k contiguous folds, refitted on all rows.

    Train statistics are the total minus the fold's own, and the error on a fold
    follows from its statistics, so alphas x folds fits cost no further pass. Lasso
    fits of a fold start from one another, from the greatest penalty down.
    """
    solve = SOLVERS[estimator]
    folds = fold_statistics(df, x, y, k, order)
    whole = folds[0]
    for f in folds[1:]:
        whole = whole + f
    scores = np.array([
        [math.sqrt(f.squared_error(*model) / f.n) for model in solve(whole - f, alphas)] for f in folds
    ]).T
    best = float(alphas[int(np.argmin(scores.mean(axis=1)))])
    return GridResult(tuple(map(float, alphas)), scores, best, LinearModel(tuple(x), *solve(whole, [best])[0]))


def kfold_scores(
    df: DataFrame, x: Sequence[str], y: str, k: int, order: Sequence[str], alpha: float = 1.0
) -> list[float]:
    """RMSE of a ridge model on each of k contiguous folds."""
    return grid_search(df, x, y, [alpha], k, order).scores[0].tolist()


# --- random search -----------------------------------------------------------

@dataclass(frozen=True)
class Choice:
    values: tuple

    def draw(self, rng: np.random.Generator):
        return self.values[int(rng.integers(len(self.values)))]


@dataclass(frozen=True)
class LogUniform:
    low: float
    high: float

    def draw(self, rng: np.random.Generator) -> float:
        return float(math.exp(rng.uniform(math.log(self.low), math.log(self.high))))


@dataclass(frozen=True)
class Uniform:
    low: float
    high: float

    def draw(self, rng: np.random.Generator) -> float:
        return float(rng.uniform(self.low, self.high))


@dataclass(frozen=True)
class IntStep:
    low: int
    high: int
    step: int = 1

    def draw(self, rng: np.random.Generator) -> int:
        return self.low + self.step * int(rng.integers((self.high - self.low) // self.step + 1))


@dataclass(frozen=True)
class OnlyIf:
    """A parameter that exists only while another one has a given value."""

    name: str
    value: object
    space: object


def draw(space: Mapping[str, object], rng: np.random.Generator) -> dict:
    out: dict = {}
    for name, s in space.items():
        if isinstance(s, OnlyIf):
            out[name] = s.space.draw(rng) if out.get(s.name) == s.value else None
        else:
            out[name] = s.draw(rng)
    return out


def random_search(
    spark: SparkSession,
    score: Callable[[dict], tuple[float, Sequence[float]]],
    space: Mapping[str, object],
    n_trials: int,
    seed: int = 0,
    attributes: Mapping[str, object] | None = None,
) -> DataFrame:
    """Leaderboard (trial, params, mean_score, fold_scores, attributes), best first.

    ``score`` runs one configuration as Spark jobs and returns mean and folds.
    """
    rng = np.random.default_rng(seed)
    rows = []
    for trial in range(n_trials):
        params = draw(space, rng)
        mean, folds = score(params)
        rows.append((
            trial, json.dumps(params), float(mean), [float(f) for f in folds], json.dumps(dict(attributes or {})),
        ))
    schema = "trial int, params string, mean_score double, fold_scores array<double>, attributes string"
    return spark.createDataFrame(rows, schema).orderBy(F.col("mean_score").desc_nulls_last(), "trial")
