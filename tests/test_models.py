"""Closed forms, penalties, losses, descent, splits and searches against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.models import linear, search, splits, statistics
from gridloom.operators import tfidf

X = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3)) * [1, 5, 0.1] + [0, 100, 2]
    x[:, 2] = 1.0
    y = x @ [2.0, -0.5, 7.0] + rng.normal(size=300)
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, y double").repartition(3), x, y


def test_statistics(data):
    df, x, y = data
    found = statistics.gather(df.withColumn("f", F.col("id") % 2), X, "y", "f")
    z = np.column_stack([x, y])
    for seg in (0, 1):
        part = z[seg::2]
        assert found[seg].n == len(part)
        assert np.allclose(found[seg].raw(), part.T @ part)
        assert np.allclose(found[seg].centred(), len(part) * np.cov(part.T, bias=True), atol=1e-8)
    whole = found[0] + found[1]
    assert np.allclose((whole - found[1]).raw(), found[0].raw())
    w = np.array([1.0, 0.2, 3.0])
    assert whole.squared_error(w, 0.5) == pytest.approx(np.sum((y - x @ w - 0.5) ** 2))


def test_closed_forms(data):
    df, x, y = data
    assert np.allclose(linear.fit_closed_form(df, X, "y").weights, np.linalg.lstsq(x, y, rcond=None)[0])
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    want = vt[:2].T @ ((u[:, :2].T @ y) / s[:2])
    assert np.allclose(linear.fit_svd(df, X, "y").weights, want)
    mu = 0.7
    free = np.diag([1.0, 1.0, 0.0])
    want = np.linalg.solve(2 / 300 * x.T @ x + mu * free, 2 / 300 * x.T @ y)
    assert np.allclose(linear.fit_closed_form(df, X, "y", linear.ridge_solution(mu)).weights, want)


def test_ridge_and_lasso_are_optimal(data):
    df, x, y = data
    x2 = x[:, :2]
    m = linear.fit_ridge(df, X[:2], "y", 30.0)
    r = y - x2 @ m.weights - m.intercept
    assert np.allclose(x2.T @ r - 30.0 * m.weights, 0, atol=1e-6) and abs(r.sum()) < 1e-6
    m = linear.fit_lasso(df, X[:2], "y", 0.3)
    g = x2.T @ (y - x2 @ m.weights - m.intercept) / 300
    for gj, wj in zip(g, m.weights):
        assert gj == pytest.approx(0.3 * np.sign(wj), abs=1e-6) if wj else abs(gj) <= 0.3 + 1e-9
    assert linear.fit_lasso(df, X[:2], "y", 1e6).zeros == 2


@pytest.mark.parametrize("loss", [linear.Mse(), linear.LogCosh(), linear.Huber(2.0), linear.L2(linear.Huber(2.0), 0.4)])
def test_gradients_match_differences(data, loss):
    df, _, _ = data
    w = np.array([0.3, -0.1, 1.0])
    _, grad = linear.evaluate(df, loss, X, "y", w)
    for j in range(3):
        step = np.eye(3)[j] * 1e-5
        up, down = (linear.evaluate(df, loss, X, "y", w + s)[0] for s in (step, -step))
        assert grad[j] == pytest.approx((up - down) / 2e-5, rel=1e-4, abs=1e-6)


def test_log_cosh_does_not_overflow(spark):
    df = spark.createDataFrame([(1.0, 5000.0)], "a double, y double")
    assert linear.evaluate(df, linear.LogCosh(), ["a"], "y", np.zeros(1))[0] == pytest.approx(5000 - np.log(2))


def test_descent(data):
    df, x, y = data
    small = df.withColumn("b", F.col("b") / 100)
    m = linear.fit_gd(small, X, "y", lr=linear.ConstantLR(0.1), max_iter=200)
    assert all(b <= a + 1e-12 for a, b in zip(m.loss_history, m.loss_history[1:]))
    assert m.loss_history[0] == pytest.approx(np.mean(y**2))
    again = linear.fit_momentum(small, X, "y", lr=linear.ConstantLR(0.05), max_iter=50)
    assert again.weights.tolist() == linear.fit_momentum(small, X, "y", lr=linear.ConstantLR(0.05), max_iter=50).weights.tolist()


def test_stochastic_methods_with_whole_batch_equal_descent(data):
    df, x, y = data
    few = df.withColumn("b", F.col("b") / 100).limit(40)
    few = few.sparkSession.createDataFrame(few.collect(), few.schema)
    options = {"lr": linear.ConstantLR(0.05), "max_iter": 3, "tolerance": 0.0}
    want = linear.fit_gd(few, X, "y", **options).weights
    assert np.allclose(linear.fit_sgd(few, X, "y", ["id"], batch_size=40, **options).weights, want)
    assert np.allclose(linear.fit_sag(few, X, "y", ["id"], batch_size=40, **options).weights, want)


def test_stochastic_methods_equal_numpy_and_leave_out_gaps(spark, monkeypatch):
    monkeypatch.setattr(linear, "DRAWN_ROWS", 16)  # several fetches
    monkeypatch.setattr(linear, "LOSSES_AT_ONCE", 2)
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(30, 2)), rng.normal(size=30)
    rows = [(i, float(a), float(b), float(t)) for i, (a, b), t in zip(range(30), x, y)]
    gaps = [(30, None, 1.0, 1.0), (31, 1.0, float("nan"), 1.0), (32, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows + gaps, "id int, a double, b double, y double")
    loss, options = linear.L2(linear.Mse(), 0.1), {"lr": linear.ConstantLR(0.05), "batch_size": 5, "max_iter": 9, "tolerance": 0.0, "seed": 4}

    def slopes(w, at):
        return 2 * (x[at] @ w - y[at])[:, None] * x[at] + loss.penalty_slope(w)

    sgd, sag, memory = [np.zeros(2)], [np.zeros(2)], np.zeros((30, 2))
    for it in range(9):
        at = np.random.default_rng((4, it)).choice(30, 5, replace=False)
        sgd.append(sgd[-1] - 0.05 * slopes(sgd[-1], at).mean(axis=0))
        memory[at] = slopes(sag[-1], at)
        sag.append(sag[-1] - 0.05 * memory.sum(axis=0) / 30)
    for fit, path in ((linear.fit_sgd, sgd), (linear.fit_sag, sag)):
        model = fit(df, ["a", "b"], "y", ["id"], loss, **options)
        assert np.allclose(model.weights, path[-1])
        assert np.allclose(model.loss_history, [np.mean((x @ w - y) ** 2) + loss.penalty(w) for w in path])
    with pytest.raises(ValueError):
        linear.fit_sgd(df, ["a", "b"], "y", ["id"], batch_size=17)
    with pytest.raises(ValueError):
        linear.fit_sag(df.filter("id > 29"), ["a", "b"], "y", ["id"], batch_size=4)


def test_lasso_path_starts_from_the_fit_before(spark):
    rng = np.random.default_rng(5)
    mixed = rng.normal(size=(400, 12)) @ rng.normal(size=(12, 12)) + 0.3 * rng.normal(size=(400, 1))
    target = mixed[:, 0] - 2 * mixed[:, 3] + 0.1 * rng.normal(size=400)
    z = np.column_stack([mixed, mixed[:, 0] * 0 + 4.0])  # the last column is constant
    names = [f"c{i}" for i in range(13)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in np.column_stack([z, target])], ", ".join(f"{c} double" for c in [*names, "y"]))
    stats = linear.gather(df, names, "y")[None]
    alphas = [float(a) for a in np.logspace(-3, 1, 15)]
    path = linear.lasso_path(stats, alphas)
    alone = [linear.lasso_path(stats, [a])[0] for a in alphas]
    zc, yc = z - z.mean(axis=0), target - target.mean()
    for fit, one, alpha in zip(path, alone, alphas):
        assert fit.alpha == alpha and np.allclose(fit.weights, one.weights, atol=1e-6) and np.isclose(fit.intercept, one.intercept)
        slope = zc.T @ (yc - zc @ fit.weights) / 400
        kept = fit.weights != 0
        assert np.allclose(slope[kept], alpha * np.sign(fit.weights[kept]), atol=1e-6) and (np.abs(slope[~kept]) <= alpha + 1e-6).all()
    assert sum(f.rounds for f in path) < sum(f.rounds for f in alone)
    assert path[0].weights[12] == 0 and linear.lasso_path(stats, [1e9])[0].rounds == 1
    assert linear.lasso_path(stats, []) == []


@pytest.mark.parametrize("loss", [linear.Mse(), linear.L2(linear.Mse(), 0.2), linear.LogCosh(), linear.L2(linear.Huber(0.7), 0.1)])
def test_block_sag_equals_numpy(spark, loss):
    rng = np.random.default_rng(2)
    x, y, blocks = rng.normal(size=(60, 2)), rng.normal(size=60), 5
    dealt = np.array([i % 4 if i % 7 else 4 for i in range(60)])
    rows = [(int(b), float(p), float(q), float(t)) for b, (p, q), t in zip(dealt, x, y)]
    gaps = [(0, None, 1.0, 1.0), (1, 1.0, float("nan"), 1.0), (None, 1.0, 1.0, 1.0), (9, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows + gaps, "b int, p double, q double, y double")
    core = loss.core if isinstance(loss, linear.L2) else loss
    extra = loss.penalty_slope if isinstance(loss, linear.L2) else np.zeros_like
    path, memory = [np.zeros(2)], np.zeros((blocks, 2))
    for it in range(7):
        w = path[-1]
        for b in linear.drawn_blocks(3, it, blocks, 2):
            at = dealt == b
            memory[b] = (core.slope_of(x[at] @ w - y[at])[:, None] * x[at] + extra(w)).sum(axis=0)
        path.append(w - 0.1 * memory.sum(axis=0) / 60)
    options = {"lr": linear.ConstantLR(0.1), "per_step": 2, "max_iter": 7, "tolerance": 0.0, "seed": 3}
    model = linear.fit_block_sag(df, ["p", "q"], "y", F.col("b"), blocks, loss, **options)
    assert np.allclose(model.weights, path[-1]) and len(model.loss_history) == 8
    assert model.loss_history[-1] == pytest.approx(linear.evaluate(df.filter("b < 5").dropna(), loss, ["p", "q"], "y", path[-1])[0])
    whole = linear.fit_block_sag(df.filter("b < 5"), ["p", "q"], "y", F.col("b"), blocks, loss, **(options | {"per_step": blocks}))
    assert np.allclose(whole.weights, linear.fit_gd(df.filter("b < 5").dropna(), ["p", "q"], "y", loss, linear.ConstantLR(0.1), max_iter=7, tolerance=0.0).weights)
    with pytest.raises(ValueError):
        linear.fit_block_sag(df, ["p", "q"], "y", F.col("b"), blocks, loss, per_step=6)
    with pytest.raises(ValueError):
        linear.fit_block_sag(df.filter("b > 5"), ["p", "q"], "y", F.col("b"), blocks, loss)


def test_every_block_is_drawn_once_a_round():
    for per_step in (1, 2, 3):
        drawn = [b for it in range(6) for b in linear.drawn_blocks(1, it, 6, per_step)]
        assert len(drawn) == 6 * per_step and all(sorted(drawn[i : i + 6]) == list(range(6)) for i in range(0, len(drawn), 6))


def test_step_sizes():
    assert linear.ConstantLR(0.3)(9) == 0.3
    assert linear.TimeDecayLR(2.0)(3) == pytest.approx(1.0)


def test_time_folds():
    assert splits.time_bounds(13, 3) == [(4, 7), (7, 10), (10, 13)]
    with pytest.raises(ValueError):
        splits.time_bounds(3, 5)
    assert splits.kfold_bounds(10, 4) == [(0, 3), (3, 6), (6, 8), (8, 10)]


def test_undated_rows_come_last(spark):
    df = spark.createDataFrame([(1, None), (2, "2024-01-02"), (3, "2024-01-01")], "match_id int, date string")
    got = [r.match_id for r in splits.time_ordered(df, "date", "match_id").orderBy("row").collect()]
    assert got == [3, 2, 1]


def test_grid_search_equals_separate_fits(data):
    df, x, y = data
    found = search.grid_search(df, X[:2], "y", [0.1, 50.0], 4, ["id"])
    for row, alpha in zip(found.scores, found.alphas):
        for (a, b), score in zip(splits.kfold_bounds(300, 4), row):
            keep = np.r_[0:a, b:300]
            xt, yt = x[keep, :2], y[keep]
            xc = xt - xt.mean(0)
            w = np.linalg.solve(xc.T @ xc + alpha * np.eye(2), xc.T @ (yt - yt.mean()))
            r = y[a:b] - yt.mean() - (x[a:b, :2] - xt.mean(0)) @ w
            assert score == pytest.approx(np.sqrt(np.mean(r**2)))


def test_random_search_orders_and_repeats(spark):
    space = {
        "kind": search.Choice(("l2", "elasticnet")),
        "C": search.LogUniform(0.1, 10),
        "n": search.IntStep(200, 3000, 500),
        "mix": search.OnlyIf("kind", "elasticnet", search.Uniform(0, 1)),
    }
    score = lambda p: (p["C"], [p["C"]])
    a = search.random_search(spark, score, space, 6, seed=4).collect()
    b = search.random_search(spark, score, space, 6, seed=4).collect()
    assert a == b
    assert [r.mean_score for r in a] == sorted((r.mean_score for r in a), reverse=True)


def test_tfidf_by_hand(spark):
    docs = spark.createDataFrame([(1, "cat dog cat"), (2, "dog fox"), (3, "")], "id int, t string")
    got = {
        (r.id, r.term): r.weight
        for r in tfidf.tfidf(docs, docs, "id", "t", max_features=None, min_df=1, max_df=1.0).collect()
    }
    idf = {"cat": np.log(4 / 2) + 1, "dog": np.log(4 / 3) + 1, "cat dog": np.log(2) + 1, "dog cat": np.log(2) + 1}
    raw = {"cat": 2 * idf["cat"], "dog": idf["dog"], "cat dog": idf["cat dog"], "dog cat": idf["dog cat"]}
    norm = np.sqrt(sum(v * v for v in raw.values()))
    for term, v in raw.items():
        assert got[1, term] == pytest.approx(v / norm)
    assert not [k for k in got if k[0] == 3]


def test_wide_weights(data):
    df, _, _ = data
    models = linear.fit_segmented(df, ["a"], "y", "b", 100.0)
    assert set(models) == {True, False}
    out = linear.predict_segmented(df, models, "b", 100.0)
    assert out.filter("prediction is null").count() == 0


@pytest.mark.parametrize("d", [3, 9])
def test_incomplete_rows_are_left_out_at_every_width(spark, d):
    rng = np.random.default_rng(d)
    x = rng.normal(size=(400, d))
    y = x @ np.arange(1, d + 1) + rng.normal(scale=0.01, size=400)
    gaps = rng.random(400) < 0.2
    rows = [[None if g else float(v[0]), *map(float, v[1:]), float(t)] for v, t, g in zip(x, y, gaps)]
    rows[5][1] = float("nan")
    df = spark.createDataFrame(rows, ", ".join(f"x{i} double" for i in range(d)) + ", y double")
    keep = ~gaps
    keep[5] = False
    want = np.linalg.lstsq(np.column_stack([x[keep], np.ones(keep.sum())]), y[keep], rcond=None)[0]
    model = linear.fit_ols(df, [f"x{i}" for i in range(d)], "y")
    assert np.allclose([*model.weights, model.intercept], want, atol=1e-8)
