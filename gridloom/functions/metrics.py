"""Ranking and regression metrics, each one distributed aggregate."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.ordered import prefix_sums


def gini_table(df: DataFrame, y: str, score: str) -> DataFrame:
    """One row (gini): 2 * AUC - 1 with tied scores counted half.

    Labels are counted per distinct score, then each score needs only the number
    of negatives below it. A row without a score is an error.
    """
    label = F.col(y).cast("long")
    known = F.coalesce(F.col(score).cast("double"), F.raise_error(F.lit("a row has no score")).cast("double"))
    per_score = (
        df.select(label.alias("__y"), known.alias("__s"))
        .groupBy("__s")
        .agg(F.sum("__y").alias("__pos"), F.sum(F.lit(1) - F.col("__y")).alias("__neg"))
    )
    upto = prefix_sums(per_score, [], ["__s"], {"__neg_upto": F.col("__neg")})
    below = F.col("__neg_upto") - F.col("__neg")
    wins = F.sum(F.col("__pos").cast("double") * (below + F.col("__neg") * F.lit(0.5)))
    pairs = F.sum("__pos").cast("double") * F.sum("__neg")
    auc = F.when(pairs > 0, wins / pairs)
    return upto.agg((F.lit(2.0) * auc - F.lit(1.0)).alias("gini"))


def gini_score(df: DataFrame, y: str, score: str) -> float | None:
    return gini_table(df, y, score).first()["gini"]


def rmse(y: str | Column, p: str | Column) -> Column:
    d = _c(y) - _c(p)
    return F.sqrt(F.avg(d * d))


def mae(y: str | Column, p: str | Column) -> Column:
    return F.avg(F.abs(_c(y) - _c(p)))


@dataclass(frozen=True)
class Scorer:
    """A metric used for selection; larger is better after ``sign``."""

    metric: Callable[[str, str], Column]
    greater_is_better: bool = True

    def table(self, df: DataFrame, y: str, p: str, name: str = "score") -> DataFrame:
        value = self.metric(y, p)
        return df.agg((value if self.greater_is_better else -value).alias(name))

    def __call__(self, df: DataFrame, y: str, p: str) -> float:
        return self.table(df, y, p).first()[0]


def make_scorer(metric: Callable[[str, str], Column], greater_is_better: bool = True) -> Scorer:
    return Scorer(metric, greater_is_better)


def constant_baseline(train: DataFrame, test: DataFrame, y: str) -> DataFrame:
    """RMSE of the train mean on both sides: (part, rmse)."""
    mean = train.agg(F.avg(y)).first()[0]
    return (
        train.agg(rmse(y, F.lit(mean)).alias("rmse")).withColumn("part", F.lit("train"))
        .unionByName(test.agg(rmse(y, F.lit(mean)).alias("rmse")).withColumn("part", F.lit("test")))
        .select("part", "rmse")
    )


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col
