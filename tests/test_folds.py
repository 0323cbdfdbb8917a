"""Folds from block statistics against folds fitted one by one; fitted stages saved and reloaded."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from gridloom.models import linear, stages
from gridloom.models.target import LogLaw, TransformedTarget, fit_log_target
from gridloom.operators import encode, reshape
from gridloom.operators.tfidf import TfIdf
from gridloom.plans.features import FeatureConfig, TextOptions
from gridloom.plans.folds import fold_features
from gridloom.plans.runs import cross_validate, fold_tables, has_any_feature, score_folds
from gridloom.sources import sinks
from gridloom.sources.scratch import scratch_path, written_paths

SCHEMA = "match_id long, date timestamp, region string, game_mode string, avg_mmr double, gold double, radiant_chat string, radiant_win int"


@pytest.fixture(scope="module")
def matches(spark):
    r = random.Random(3)
    rows = []
    for i in range(240):
        late = i > 150
        region = r.choice(["eu", "us", None, "asia"] + ["new"] * 2 * late)
        mmr = None if r.random() < 0.3 else r.uniform(-5, 4000)
        gold = None if r.random() < 0.2 else r.gauss(0, 50)
        words = " ".join(r.choices(["good", "game", "bad", "team", "push", "mid"] + ["late"] * 3 * late, k=r.randint(0, 8)))
        rows.append((i, datetime(2024, 1, 1) + timedelta(hours=5 * i), region, r.choice(["ranked", "turbo"]), mmr, gold, words, int(r.random() < 0.5)))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def players(spark):
    r = random.Random(4)
    rows = [(i, r.randint(1, 9), slot) for i in range(240) for slot in (0, 1, 130, 131)]
    return spark.createDataFrame(rows, "match_id long, hero_id int, player_slot int")


CONFIGS = {
    "all kinds": FeatureConfig({"target": ("region",), "ohe": ("region", "month", "game_mode"), "numeric": ("avg_mmr", "mmr_missing", "gold")}, mmr_transform="sqrt"),
    "raw": FeatureConfig({"numeric": ("gold", "avg_mmr")}),
    "text": FeatureConfig({"ohe": ("is_weekend",), "text": ("radiant_chat",)}, text=TextOptions(max_features=12, min_df=3, max_df=0.9)),
}


def vectors(table):
    return {r.match_id: (r.label, r.features.toArray()) for r in table.collect()}


@pytest.mark.parametrize("name", CONFIGS)
def test_folds_equal_folds_fitted_one_by_one(matches, players, spark, name):
    options = {"n_splits": 3}
    if name == "raw":
        options |= {"use_heroes": True, "players": players, "heroes": spark.range(1, 10).select(F.col("id").cast("int"))}
    got, want = fold_features(matches, CONFIGS[name], **options), fold_tables(matches, CONFIGS[name], **options)
    assert [f.width for f in got] == [f.width for f in want]
    for a, b in zip(got, want):
        for side in ("train", "other"):
            x, y = vectors(getattr(a, side)), vectors(getattr(b, side))
            assert x.keys() == y.keys() and len(x) > 50
            for k in x:
                assert x[k][0] == y[k][0]
                # Blocks may stand in another order; each has the same columns.
                assert np.allclose(np.sort(x[k][1]), np.sort(y[k][1]), atol=1e-9), (k, x[k], y[k])
    if name == "all kinds":
        (mean, ginis), (mean2, ginis2) = score_folds(got), score_folds(want)
        assert np.allclose([mean, *ginis], [mean2, *ginis2], atol=1e-6)


def test_no_fold_is_written(matches, spark):
    before = set(written_paths())
    cfg = FeatureConfig({"target": ("region",), "ohe": ("region", "month"), "numeric": ("avg_mmr", "mmr_missing")}, mmr_transform="sqrt")
    folds = fold_features(matches, cfg, n_splits=3)
    made = [p for p in written_paths() if p not in before]
    widest = max((spark.read.parquet(p) for p in made), key=lambda d: d.count())
    assert widest.count() == 240  # the rows in time order, once
    assert sum(spark.read.parquet(p).count() >= 60 for p in made) == 1
    assert len(folds) == 3 and folds[2].train.count() == 180


def test_fold_guards(matches, players, spark):
    with pytest.raises(ValueError, match="no such feature"):
        fold_features(matches, FeatureConfig({"numeric": ("nope",)}), n_splits=2)
    with pytest.raises(ValueError):
        fold_features(matches, FeatureConfig(), n_splits=2, use_tabular=False)
    with pytest.raises(ValueError, match="item table"):
        fold_features(matches, FeatureConfig(), n_splits=2, players=players, use_heroes=True)
    mean, ginis = cross_validate(matches, FeatureConfig(), n_splits=2, players=players, use_heroes=True, use_tabular=False)
    assert len(ginis) == 2 and -1 <= mean <= 1


def test_constant_numbers_scale_to_zero(matches):
    steady = matches.withColumns({"gold": F.lit(0.1), "avg_mmr": F.lit(0.3)})
    for fold in fold_features(steady, FeatureConfig({"numeric": ("gold", "avg_mmr", "mmr_missing")}), n_splits=2):
        assert all(np.abs(v).max() < 1e-9 for _, v in vectors(fold.other).values())


# --- fitted stages -----------------------------------------------------------

def test_preprocessor_survives_saving(matches, spark):
    early, third = matches.filter("match_id < 120"), matches.filter("match_id >= 200").drop("radiant_win")
    unfitted = stages.make_preprocessor(["region"], ["game_mode"], ["avg_mmr", "gold"], "radiant_win", mode="log1p")
    fitted = unfitted.fit(early)
    path = scratch_path(spark, "model")
    sinks.save(fitted, path)
    loaded = sinks.load(PipelineModel, path)
    assert [type(s) for s in loaded.stages] == [type(s) for s in fitted.stages]
    both = {}
    for model in (fitted, loaded):
        out = model.transform(third)
        assert "__te0" not in out.columns and out.filter("features IS NULL").count() == 0
        both[model] = sorted((r.match_id, tuple(r.features.toArray())) for r in out.collect())
    assert both[fitted] == both[loaded] and len(both[fitted]) == 40
    sinks.save(fitted, path)  # replaces what is there
    pipeline_path = scratch_path(spark, "unfitted")
    sinks.save(unfitted, pipeline_path)
    again = Pipeline.load(pipeline_path).fit(early).transform(third)
    assert sorted((r.match_id, tuple(r.features.toArray())) for r in again.collect()) == both[fitted]


def test_model_trained_on_stages_scores_after_reload(matches, spark):
    from pyspark.ml.classification import LogisticRegression

    pipeline = stages.make_preprocessor(["region"], ["game_mode"], ["gold"], "radiant_win")
    whole = Pipeline(stages=[*pipeline.getStages(), LogisticRegression(labelCol="radiant_win")]).fit(matches)
    path = scratch_path(spark, "whole")
    sinks.save(whole, path)
    a, b = (m.transform(matches).orderBy("match_id").select(vector_to_array("probability")[1].alias("p")).collect() for m in (whole, sinks.load(PipelineModel, path)))
    assert a == b


def test_fill_and_bins(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, 4.0), (None, 8.0), (5.0, 8.0)], "a double, b double")
    params = {"inputCols": ["a", "b"], "outputCols": ["x", "y"]}
    rows = stages.FillScale(**params, strategy="mean", scaled=False).fit(df).transform(df).collect()
    assert [(r.x, r.y) for r in rows] == [(1.0, 20 / 3), (3.0, 4.0), (3.0, 8.0), (5.0, 8.0)]
    model = stages.FillScale(**params).fit(df)
    assert model.value("fills") == [3.0, 8.0] and model.value("means") == [3.0, 7.0]
    with pytest.raises(ValueError):
        stages.FillScale(**params, strategy="mode").fit(df)
    bins = stages.QuantileBins(inputCol="a", outputCol="bin", bins=2).fit(df)
    assert [r.bin for r in bins.transform(spark.createDataFrame([(-9.0,), (2.9,), (3.0,), (99.0,)], "a double")).collect()] == [0, 0, 1, 1]
    with pytest.raises(ValueError):
        stages.make_preprocessor()


def test_own_models_survive_saving(spark):
    df = spark.createDataFrame([(float(i), float(2 * i + 1)) for i in range(1, 30)], "x double, y double")
    items = spark.createDataFrame([(9,), (5,)], "id int")
    words = spark.createDataFrame([(i, ["a", "b"] if i % 2 else ["b"]) for i in range(20)], "id int, w array<string>")
    for fitted in (
        linear.fit_ridge(df, ["x"], "y", 1.0), encode.QuantileNormal.fit(df, "x", 10), encode.SetEncoder.fit(items, True),
        TfIdf.fit(words, "id", "w", min_df=1, max_df=1.0), fit_log_target(df, ["x"], "y"), LogLaw(),
    ):
        path = scratch_path(spark, "own")
        sinks.save(fitted, path)
        again = sinks.load(type(fitted), path)
        assert type(again) is type(fitted)
        if isinstance(fitted, (linear.LinearModel, TransformedTarget)):
            assert fitted.predict(df).collect() == again.predict(df).collect()
        elif isinstance(fitted, encode.SetEncoder):
            assert again.sides == fitted.sides and sorted(again.dictionary.collect()) == sorted(fitted.dictionary.collect())
        elif isinstance(fitted, TfIdf):
            assert sorted(again.transform(words, "id", "w").collect()) == sorted(fitted.transform(words, "id", "w").collect())
        else:
            assert again == fitted
        with pytest.raises(TypeError):
            sinks.load(Fake, path)
    with pytest.raises(TypeError):
        sinks.save(object(), scratch_path(spark, "none"))


class Fake:
    pass


# --- sparse rows -------------------------------------------------------------

def test_sparse_vectors(spark):
    coords = spark.createDataFrame([(1, 99_999, -1), (1, 3, 2), (2, 0, 5)], "k long, col int, value int")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (7, "d")], "k long, name string")
    got = {r.name: r.features for r in reshape.to_vectors(coords, "k", 100_000, rows=rows).collect()}
    assert {n: (v.size, dict(zip(v.indices.tolist(), v.values.tolist()))) for n, v in got.items()} == {
        "a": (100_000, {3: 2.0, 99_999: -1.0}), "b": (100_000, {0: 5.0}), "c": (100_000, {0: 5.0}), "d": (100_000, {}),
    }
    plan = reshape.sparse_rows(coords, "k", 100_000)._jdf.queryExecution().toString()
    assert "Python" not in plan and "array_repeat" not in plan


def test_set_vectors_do_not_grow_with_items(spark):
    players = spark.createDataFrame([(1, 5, 0), (1, 70_000, 128), (2, 9, 60)], "match_id int, hero_id int, player_slot int")
    items = spark.range(1, 70_001).select(F.col("id").cast("int"))
    matches = spark.createDataFrame([(1,), (2,), (1,)], "match_id int")
    vectors = encode.SetEncoder.fit(items).vectors(players, matches)
    got = sorted((r.match_id, r.features.size, r.features.indices.tolist(), r.features.values.tolist()) for r in vectors.collect())
    assert got == [(1, 70_000, [4, 69_999], [1.0, -1.0])] * 2 + [(2, 70_000, [], [])]
    assert has_any_feature(vectors) and not has_any_feature(vectors.filter("match_id = 2")) and not has_any_feature(vectors.limit(0))
    batches = encode.SetEncoder.fit(items, split_teams=True).transform_batches(players, matches.distinct(), 1)
    assert sorted((r.match_id, r.batch, r.features.indices.tolist()) for r in batches.collect()) == [(1, 0, [4, 139_999]), (2, 1, [])]
