"""Time-ordered validation, final fit and the end-to-end run."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.dates import parse_date
from gridloom.functions.metrics import gini_score
from gridloom.models.logistic import fit_logistic, positive_probability
from gridloom.models.splits import time_bounds, time_ordered
from gridloom.operators.clean import prepare_players_for_run
from gridloom.operators.encode import SetEncoder
from gridloom.operators.joins import filter_by_ids, split_by_ids
from gridloom.plans.features import (
    TABULAR,
    FeatureConfig,
    FeatureSelection,
    FeatureTables,
    add_sets,
    add_words,
    build_feature_config,
    build_feature_tables,
)
from gridloom.plans.folds import fold_features
from gridloom.sources.scratch import materialise
from gridloom.sources.sinks import run_record, save_run_record, save_test_predictions

#: Folds prepared or fitted side by side.
PARALLEL_FOLDS = 4


def fold_tables(
    train: DataFrame,
    cfg: FeatureConfig,
    *,
    players: DataFrame | None = None,
    key: str = "match_id",
    n_splits: int = 5,
    **options,
) -> list[FeatureTables]:
    """Written feature tables of every expanding fold, fitted on its own past.

    They do not depend on model parameters, so a search reuses them.
    """
    dated = train.withColumn("date", parse_date("date"))
    rows = time_ordered(dated, "date", key, "__row")
    heroes, with_sets = options.get("heroes"), options.get("use_heroes", False)
    # Whatever does not depend on the fold is worked out once and written.
    if cfg.of("text"):
        rows = add_words(rows, cfg, key, options.get("chat"), options.get("chat_order"))
    if with_sets and heroes is not None:
        encoder = SetEncoder.fit(heroes, options.get("split_teams", True))
        rows = add_sets(rows, encoder, filter_by_ids(players, rows, key), key)
    if cfg.of("text") or with_sets:
        rows = materialise(rows)

    def table(bounds: tuple[int, int]) -> FeatureTables:
        first, end = bounds
        past = rows.filter(F.col("__row") < first).drop("__row")
        valid = rows.filter((F.col("__row") >= first) & (F.col("__row") < end)).drop("__row")
        sides = {}
        if with_sets:
            sides = {
                "train_players": filter_by_ids(players, past, key),
                "other_players": filter_by_ids(players, valid, key),
            }
        t = build_feature_tables(past, valid, cfg, key=key, **sides, **options)
        return FeatureTables(materialise(t.train), materialise(t.other), t.width, t.blocks)

    return _at_once(train.sparkSession, table, time_bounds(rows.count(), n_splits))


def _at_once(spark: SparkSession, work: Callable, items: Sequence) -> list:
    """Run independent folds side by side, so that their small jobs share the cluster."""
    with ThreadPoolExecutor(max_workers=min(len(items), PARALLEL_FOLDS)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), items))


def score_folds(folds: list[FeatureTables], params: Mapping | None = None) -> tuple[float, list[float]]:
    """Mean and per-fold Gini of a logistic model fitted on each fold's past."""

    def score(fold: FeatureTables) -> float | None:
        model = fit_logistic(fold.train, **(params or {}))
        return gini_score(positive_probability(model, fold.other), "label", "score")

    ginis = _at_once(folds[0].train.sparkSession, score, folds)
    # A fold without both labels has no Gini, and then there is no mean either.
    undefined = not ginis or any(g is None for g in ginis)
    return (float("nan") if undefined else sum(ginis) / len(ginis)), ginis


def cross_validate(
    train: DataFrame, cfg: FeatureConfig, *, model_params: Mapping | None = None, **options
) -> tuple[float, list[float]]:
    """Mean and per-fold Gini; preprocessing is fitted for all folds at once from blocks of time.

    Only where the items of sets must be learned from each fold's own players are fold tables written.
    """
    learns_items = options.get("use_heroes", False) and options.get("heroes") is None
    folds = (fold_tables if learns_items else fold_features)(train, cfg, **options)
    return score_folds(folds, model_params)


def fit_and_predict(
    train: DataFrame,
    test: DataFrame,
    cfg: FeatureConfig,
    *,
    players_train: DataFrame | None = None,
    players_test: DataFrame | None = None,
    key: str = "match_id",
    model_params: Mapping | None = None,
    **options,
) -> tuple[LogisticRegressionModel, DataFrame]:
    """Fit on all of train; returns the model and (key, score) for test."""
    use_heroes = options.get("use_heroes", False)
    if use_heroes and not players_test.limit(1).count():
        warnings.warn("the test players table is empty")
    tables = build_feature_tables(
        train, test, cfg, key=key, train_players=players_train, other_players=players_test, **options
    )
    fitted = materialise(tables.train)
    other = materialise(tables.other)
    if use_heroes and not has_any_feature(other):
        warnings.warn("the test rows have no non-zero feature")
    model = fit_logistic(fitted, **(model_params or {}))
    return model, positive_probability(model, other).select(key, "score")


def has_any_feature(df: DataFrame, features: str = "features") -> bool:
    """One aggregate as wide as a vector; no row is spelt out."""
    # Grouped by a constant, an empty table gives no row, where the summarizer alone would fail.
    counts = df.groupBy(F.lit(1)).agg(Summarizer.numNonZeros(F.col(features)).alias("n")).first()
    return counts is not None and bool(counts["n"].toArray().any())


@dataclass(frozen=True)
class Run:
    """Prepare, validate, fit, score and record one feature selection."""

    selection: FeatureSelection
    results_path: str
    submission_path: str
    n_splits: int = 5
    submission_id_col: str = "match_id"
    target_col: str = "radiant_win"
    preprocess_players: bool = True
    group_size: int = 10
    model_params: dict = field(default_factory=dict)

    def __call__(
        self,
        train: DataFrame,
        test: DataFrame,
        players: DataFrame | None = None,
        heroes: DataFrame | None = None,
        chat: DataFrame | None = None,
        chat_order: str | None = None,
    ) -> dict:
        cfg = build_feature_config(self.selection)
        use_tabular = bool(cfg.of(*TABULAR))
        use_heroes = self.selection.use_heroes
        if not use_tabular and not use_heroes and not cfg.of("text"):
            raise ValueError("at least one feature block must be on")
        # Ids, folds, statistics and vectors each read the matches: they are written once.
        train, test = materialise(train), materialise(test)
        players_train = players_test = None
        if use_heroes:
            if players is None:
                raise ValueError("set features need a players table")
            players_train, players_test = split_by_ids(players, train, test, "match_id")
            players_train, players_test = (
                materialise(p)
                for p in prepare_players_for_run(
                    players_train, players_test, train, test, self.group_size, self.preprocess_players
                )
            )
        options = {
            "heroes": heroes,
            "chat": chat,
            "chat_order": chat_order,
            "use_tabular": use_tabular,
            "use_heroes": use_heroes,
            "split_teams": self.selection.split_teams,
            "target_col": self.target_col,
        }
        mean, ginis = cross_validate(
            train, cfg, players=players_train, n_splits=self.n_splits, model_params=self.model_params, **options
        )
        model, scored = fit_and_predict(
            train, test, cfg, players_train=players_train, players_test=players_test,
            model_params=self.model_params, **options,
        )
        submission = save_test_predictions(test, scored, self.submission_path, self.submission_id_col)
        record = run_record(
            mean, [g if g is not None else float("nan") for g in ginis],
            groups=self.selection.enabled, use_heroes=use_heroes,
            split_teams=self.selection.split_teams, config=cfg.record(), model_params=self.model_params,
        )
        save_run_record(train.sparkSession, record, self.results_path)
        return {
            "model": model,
            "test_pred": scored,
            "submission": submission,
            "submission_path": self.submission_path,
            "cv_mean_gini": mean,
            "cv_fold_ginis": ginis,
            "run_meta": record,
        }
