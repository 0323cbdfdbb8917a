"""Result files: tables, submissions, run records and fitted models."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.ordered import row_index
from gridloom.sources.fitted import load_fitted, save_fitted
from gridloom.sources.scratch import materialise
from gridloom.sources.tables import CSV_TEXT, read_csv


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; one file per partition under ``path``.

    Quotes are doubled, an empty text is written as "" and a null as nothing, so
    ``read_csv`` and other readers get every value back, line breaks and outer blanks included.
    """
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(header=True, **blanks, **CSV_TEXT).csv(path)


def predictions_table(
    test: DataFrame, scored: DataFrame, id_col: str = "match_id", score: str = "score", order: Sequence[str] = ()
) -> DataFrame:
    """(ID, Value) for every test row; raises when a row has no score or a score no row.

    Without an id column in ``test`` the ID is the row number in ``order``, and
    ``scored`` must hold the same order columns.
    """
    keys = [id_col] if id_col in test.columns else list(order)
    if not keys:
        raise ValueError(f"test rows have no {id_col} and no order was given")
    rows = test.select(*keys, F.lit(1).alias("__more")).unionAll(scored.select(*keys, F.lit(-1).alias("__more")))
    if rows.groupBy(*keys).agg(F.sum("__more").alias("__more")).filter(F.col("__more") != 0).limit(1).count():
        raise ValueError("the scores do not match the test rows")
    value = F.col(score).cast("double").alias("Value")
    if id_col in test.columns:
        return scored.select(F.col(id_col).alias("ID"), value)
    return row_index(scored.select(*keys, score), keys, "ID").select("ID", value)


def save_test_predictions(
    test: DataFrame, scored: DataFrame, path: str, id_col: str = "match_id", **options
) -> DataFrame:
    table = predictions_table(test, materialise(scored), id_col, **options)
    write_csv(table, path)
    return read_csv(table.sparkSession, path, table.schema)


def run_record(
    mean: float,
    folds: Sequence[float],
    *,
    groups: Sequence[str] = (),
    use_heroes: bool = False,
    split_teams: bool = True,
    config: Mapping | None = None,
    model_params: Mapping | None = None,
) -> dict:
    """What a run was and how it scored, scores to six digits."""
    return {
        "selected_feature_groups": list(groups),
        "use_heroes": use_heroes,
        "split_teams": split_teams,
        "feature_config": dict(config or {}),
        "model_params": dict(model_params or {}),
        "cv_mean_gini": round(float(mean), 6),
        "cv_fold_ginis": [round(float(f), 6) for f in folds],
    }


def save_run_record(spark: SparkSession, record: Mapping, path: str) -> DataFrame:
    """One JSON line under ``path``."""
    line = spark.createDataFrame([(json.dumps(record, ensure_ascii=False),)], "value string")
    line.coalesce(1).write.mode("overwrite").text(path)
    return spark.read.json(path)


@dataclass(frozen=True)
class ResultStore:
    """Scored configurations, appended as JSON lines to one folder."""

    path: str

    def log(
        self,
        spark: SparkSession,
        stage: str,
        name: str,
        config: Mapping,
        mean: float,
        folds: Sequence[float],
        model: str = "LogisticRegression",
    ) -> None:
        cfg = dict(config)
        if not cfg.get("text_cols"):
            cfg.update({k: None for k in cfg if k.startswith("text_") and k != "text_cols"})
        record = {
            "timestamp": datetime.now().isoformat(),
            "stage": stage,
            "model": model,
            "features": name,
            **cfg,
            "fold_ginis": [round(float(f), 6) for f in folds],
            "gini": round(float(mean), 6),
        }
        line = spark.createDataFrame([(json.dumps(record, ensure_ascii=False),)], "value string")
        line.coalesce(1).write.mode("append").text(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.json(self.path)


def save(model, path: str) -> None:
    """Persist a fitted Spark model, stage or pipeline, or a fitted object of this library; the former replace what is there."""
    if hasattr(model, "write"):
        model.write().overwrite().save(path)
    else:
        save_fitted(model, path, SparkSession.active())


def load(kind: type, path: str):
    """What ``save`` has written, in any later session; ``kind`` is its class."""
    if hasattr(kind, "load"):
        return kind.load(path)
    found = load_fitted(path, SparkSession.active())
    if not isinstance(found, kind):
        raise TypeError(f"{path} holds a {type(found).__name__}")
    return found
