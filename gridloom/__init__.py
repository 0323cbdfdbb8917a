"""User-level analytics operators over Spark DataFrames."""

from gridloom.functions.dates import extract_date_features
from gridloom.functions.metrics import constant_baseline, gini_score, mae, make_scorer, rmse
from gridloom.functions.text import lemmatise, preprocess_text
from gridloom.models.linear import (
    Huber, L2, LogCosh, Mse, fit_adam, fit_block_sag, fit_closed_form, fit_gd, fit_lasso, fit_momentum, fit_ols, fit_ridge,
    fit_sag, fit_segmented, fit_sgd, fit_svd, lasso_path, weights_report,
)
from gridloom.models.logistic import fit_logistic, positive_probability
from gridloom.models.search import grid_search, kfold_scores, random_search
from gridloom.models.splits import kfold_table, random_split, time_split_table
from gridloom.models.target import fit_log_target, fit_transformed_target
from gridloom.operators.clean import (
    normalize_chat, prepare_players_for_run, preprocess_fold, preprocess_players, series_features,
)
from gridloom.operators.encode import (
    QuantileNormal, SetEncoder, impute_mean, impute_median, one_hot, one_hot_named, polynomial, quantile_bins, scale,
    target_encode, trim_outliers,
)
from gridloom.operators.ordered import latest, quantiles, rank_in_group, row_index, sortedness, top_by_limit
from gridloom.operators.profile import bootstrap_ci, correlations, describe, histogram, null_counts, value_share
from gridloom.operators.reshape import finalize_result, to_wide
from gridloom.operators.tfidf import TfIdf, tfidf
from gridloom.plans.allocation import allocate, allocate_season, build_applications, compare_assignments
from gridloom.plans.features import FeatureConfig, FeatureSelection, TextOptions, build_feature_config, build_feature_tables
from gridloom.plans.runs import Run, cross_validate, fit_and_predict
from gridloom.sources.sinks import ResultStore, load, save, save_test_predictions, write_csv
from gridloom.sources.tables import read_csv, read_parquet, read_table

__all__ = [name for name in dir() if not name.startswith("_")]
