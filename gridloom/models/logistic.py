"""Penalised logistic regression on assembled feature vectors."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Defaults of the inverse penalty and the iteration limit.
DEFAULT_C = 1.0
DEFAULT_MAX_ITER = 2000


def fit_logistic(
    df: DataFrame,
    C: float = DEFAULT_C,
    max_iter: int = DEFAULT_MAX_ITER,
    penalty: str | None = "l2",
    l1_ratio: float | None = None,
    tol: float = 1e-6,
    class_weight: str | None = None,
    features: str = "features",
    label: str = "label",
) -> LogisticRegressionModel:
    """Minimise C * sum(log loss) + penalty, the intercept free.

    Spark averages the loss over the rows, so its penalty is 1 / (C n).
    """
    mix = {"l2": 0.0, "l1": 1.0, "elasticnet": l1_ratio or 0.0, None: 0.0}
    if penalty not in mix:
        raise ValueError(f"unknown penalty: {penalty}")
    rows = df.select(features, F.col(label).cast("double").alias(label))
    n, positives = rows.agg(F.count("*"), F.sum(label)).first()
    if not n:
        raise ValueError("no rows to fit on")
    estimator = LogisticRegression(
        featuresCol=features,
        labelCol=label,
        regParam=0.0 if penalty is None else 1.0 / (C * n),
        elasticNetParam=mix[penalty],
        standardization=False,
        maxIter=max_iter,
        tol=tol,
        family="binomial",
    )
    if class_weight == "balanced" and 0 < positives < n:
        weight = F.when(F.col(label) > 0, n / (2 * positives)).otherwise(n / (2 * (n - positives)))
        rows = rows.withColumn("weight", weight)
        estimator = estimator.setWeightCol("weight")
    return estimator.fit(rows)


def positive_probability(model: LogisticRegressionModel, df: DataFrame, out: str = "score") -> DataFrame:
    scored = model.transform(df)
    return scored.withColumn(out, vector_to_array(model.getProbabilityCol())[1]).drop(
        model.getProbabilityCol(), model.getRawPredictionCol(), model.getPredictionCol()
    )
