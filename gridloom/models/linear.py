"""Linear regression: closed forms, penalties, losses and descent methods."""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from gridloom.functions.numeric import dot
from gridloom.models.statistics import Stats, gather
from gridloom.operators.ordered import row_index
from gridloom.sources.scratch import materialise


@dataclass(frozen=True)
class LinearModel:
    names: tuple[str, ...]
    weights: np.ndarray
    intercept: float = 0.0
    loss_history: tuple[float, ...] = field(default=(), compare=False)

    def expression(self) -> Column:
        return dot(self.names, self.weights) + F.lit(float(self.intercept))

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return df.withColumn(out, self.expression())

    @property
    def zeros(self) -> int:
        return int(np.sum(self.weights == 0))


# --- closed forms ------------------------------------------------------------

def solve_ridge(stats: Stats, alpha: float = 0.0) -> tuple[np.ndarray, float]:
    """Weights and unpenalised intercept of |y - Xw - b|^2 + alpha |w|^2."""
    c, d = stats.centred(), stats.d
    w = np.linalg.lstsq(c[:d, :d] + alpha * np.eye(d), c[:d, d], rcond=None)[0]
    m = stats.means()
    return w, float(m[d] - m[:d] @ w)


@dataclass(frozen=True)
class LassoFit:
    alpha: float
    weights: np.ndarray
    intercept: float
    rounds: int  # sweeps over the weights


def _lasso_rounds(q: np.ndarray, r: np.ndarray, alpha: float, w: np.ndarray, tol: float, max_iter: int) -> int:
    """Bring ``w`` to the optimum of w'qw/2 - r'w + alpha |w|_1, in place; the number of sweeps.

    Only the active weights are swept: those that are not zero, then those whose
    slope at zero exceeds the penalty. The slopes of all the others are followed,
    one column per changed weight, and looked at again once the active ones stand.
    """
    diag, slope = np.diag(q), r - q @ w
    free = diag > 0
    active = free & (w != 0)
    for done in range(max_iter):
        biggest = 0.0
        for j in np.flatnonzero(active):
            rho = slope[j] + diag[j] * w[j]
            new = math.copysign(max(abs(rho) - alpha, 0.0), rho) / diag[j]
            moved = new - w[j]
            if moved:
                slope -= moved * q[:, j]
                w[j] = new
                biggest = max(biggest, abs(moved) * math.sqrt(diag[j]))
        if biggest < tol:
            slope = r - q @ w  # rounding of the many small updates
            # A weight at zero whose slope exceeds the penalty would move by more than the tolerance.
            found = free & ~active & (np.abs(slope) - alpha >= tol * np.sqrt(np.maximum(diag, 0)))
            if not found.any():
                return done + 1
            active |= found
    warnings.warn(f"lasso has not converged in {max_iter} rounds", RuntimeWarning, stacklevel=3)
    return max_iter


def lasso_path(stats: Stats, alphas: Sequence[float], tol: float = 1e-10, max_iter: int = 10_000) -> list[LassoFit]:
    """Minimisers of |y - Xw - b|^2 / (2n) + alpha |w|_1 for each penalty, in the order given.

    The penalties are taken from the greatest down; each fit starts from the one before.
    """
    c, d = stats.centred() / stats.n, stats.d
    q, r, m = c[:d, :d], c[:d, d], stats.means()
    least = tol * max(1.0, math.sqrt(c[d, d]))
    w, found = np.zeros(d), {}
    for alpha in sorted(set(alphas), reverse=True):
        rounds = _lasso_rounds(q, r, alpha, w, least, max_iter)
        found[alpha] = LassoFit(alpha, w.copy(), float(m[d] - m[:d] @ w), rounds)
    return [found[a] for a in alphas]


def solve_lasso(
    stats: Stats, alpha: float, tol: float = 1e-10, max_iter: int = 10_000
) -> tuple[np.ndarray, float]:
    """Weights and intercept of |y - Xw - b|^2 / (2n) + alpha |w|_1.

    Coordinate steps on the d x d statistics; the data are not read again.
    """
    fit = lasso_path(stats, [alpha], tol, max_iter)[0]
    return fit.weights, fit.intercept


def _one(df: DataFrame, x: Sequence[str], y: str) -> Stats:
    found = gather(df, x, y)
    if None not in found:
        raise ValueError("no rows to fit on")
    return found[None]


def fit_ols(df: DataFrame, x: Sequence[str], y: str) -> LinearModel:
    return fit_ridge(df, x, y, 0.0)


def fit_ridge(df: DataFrame, x: Sequence[str], y: str, alpha: float = 1.0) -> LinearModel:
    return LinearModel(tuple(x), *solve_ridge(_one(df, x, y), alpha))


def fit_lasso(df: DataFrame, x: Sequence[str], y: str, alpha: float = 1.0) -> LinearModel:
    return LinearModel(tuple(x), *solve_lasso(_one(df, x, y), alpha))


def plain_solution(stats: Stats) -> np.ndarray:
    """inv(X'X) X'y; no intercept is added."""
    g, d = stats.raw(), stats.d
    return np.linalg.solve(g[:d, :d], g[:d, d])


def svd_solution(stats: Stats) -> np.ndarray:
    """Truncated form: all singular directions but the weakest, tiny ones cut.

    The squares of the singular values are the eigenvalues of X'X.
    """
    g, d = stats.raw(), stats.d
    lam, v = np.linalg.eigh(g[:d, :d])
    keep = int(min(stats.n, d)) - 1
    s, v = np.sqrt(np.maximum(lam[d - keep:], 0)), v[:, d - keep:]
    if not keep:
        return np.zeros(d)
    ok = s > 1e-8 * max(stats.n, d) * s.max()
    inv = np.where(ok, 1 / np.where(ok, s, 1.0) ** 2, 0.0)
    return v @ (inv * (v.T @ g[:d, d]))


def ridge_solution(mu: float) -> Callable[[Stats], np.ndarray]:
    """Closed form of mean squared error + mu/2 |w|^2 with a free last weight."""

    def solve(stats: Stats) -> np.ndarray:
        g, d = stats.raw(), stats.d
        free = np.diag([1.0] * (d - 1) + [0.0])
        return np.linalg.solve(2 / stats.n * g[:d, :d] + mu * free, 2 / stats.n * g[:d, d])

    return solve


def fit_closed_form(
    df: DataFrame, x: Sequence[str], y: str, solution: Callable[[Stats], np.ndarray] = plain_solution
) -> LinearModel:
    return LinearModel(tuple(x), solution(_one(df, x, y)))


def fit_svd(df: DataFrame, x: Sequence[str], y: str) -> LinearModel:
    return fit_closed_form(df, x, y, svd_solution)


def fit_segmented(
    df: DataFrame, x: Sequence[str], y: str, col: str, threshold: float, alpha: float = 1.0
) -> dict[bool, LinearModel]:
    """One ridge model at or below the threshold and one for the rest, from one pass."""
    low = F.coalesce(F.col(col) <= threshold, F.lit(False)).cast("int")
    parts = gather(df.withColumn("__low", low), x, y, "__low")
    return {bool(seg): LinearModel(tuple(x), *solve_ridge(s, alpha)) for seg, s in parts.items()}


def predict_segmented(
    df: DataFrame, models: dict[bool, LinearModel], col: str, threshold: float, out: str = "prediction"
) -> DataFrame:
    """Each row gets the prediction of its own segment."""
    low = F.coalesce(F.col(col) <= threshold, F.lit(False))
    missing = F.lit(None).cast("double")
    side = lambda k: models[k].expression() if k in models else missing
    return df.withColumn(out, F.when(low, side(True)).otherwise(side(False)))


def weights_report(spark: SparkSession, model: LinearModel, scales: dict[str, float]) -> DataFrame:
    """(weight, feature, scale), largest weight first."""
    rows = [(float(w), n, float(scales[n])) for n, w in zip(model.names, model.weights)]
    rows.sort(reverse=True)
    return spark.createDataFrame(rows, "weight double, feature string, scale double")


# --- losses ------------------------------------------------------------------

@dataclass(frozen=True)
class Mse:
    def value(self, r: Column) -> Column:
        return r * r

    def slope(self, r: Column) -> Column:
        return 2 * r

    def slope_of(self, r: np.ndarray) -> np.ndarray:
        return 2 * r


@dataclass(frozen=True)
class LogCosh:
    def value(self, r: Column) -> Column:
        # log cosh r without overflow for large r
        a = F.abs(r)
        return a + F.log1p(F.exp(-2 * a)) - F.lit(math.log(2))

    def slope(self, r: Column) -> Column:
        return F.tanh(r)

    def slope_of(self, r: np.ndarray) -> np.ndarray:
        return np.tanh(r)


@dataclass(frozen=True)
class Huber:
    delta: float = 1.0

    def value(self, r: Column) -> Column:
        a, d = F.abs(r), F.lit(self.delta)
        return F.when(a < d, 0.5 * r * r).otherwise(d * a - 0.5 * d * d)

    def slope(self, r: Column) -> Column:
        d = F.lit(self.delta)
        return F.when(F.abs(r) < d, r).otherwise(d * F.signum(r))

    def slope_of(self, r: np.ndarray) -> np.ndarray:
        return np.where(np.abs(r) < self.delta, r, self.delta * np.sign(r))


@dataclass(frozen=True)
class L2:
    """Any loss plus mu/2 |w|^2; the last weight (the bias) is free."""

    core: Mse | LogCosh | Huber
    mu: float = 1.0

    def penalty(self, w: np.ndarray) -> float:
        return 0.5 * self.mu * float(np.sum(w[:-1] ** 2))

    def penalty_slope(self, w: np.ndarray) -> np.ndarray:
        return self.mu * np.append(w[:-1], 0.0)


def loss_columns(loss, x: Sequence[str], y: str, w: Sequence[float]) -> list[Column]:
    """Aggregates ``loss`` and ``grad_<column>`` of the mean loss, before any penalty."""
    core = loss.core if isinstance(loss, L2) else loss
    r = dot(x, w) - F.col(y).cast("double")
    slope = core.slope(r)
    return [
        F.avg(core.value(r)).alias("loss"),
        *[F.avg(slope * F.col(c).cast("double")).alias(f"grad_{c}") for c in x],
    ]


def loss_table(df: DataFrame, loss, x: Sequence[str], y: str, w: Sequence[float]) -> DataFrame:
    """One row: loss and gradient at ``w``, penalty included."""
    out = df.agg(*loss_columns(loss, x, y, w))
    if not isinstance(loss, L2):
        return out
    w = np.asarray(w, dtype=float)
    extra = loss.penalty_slope(w)
    return out.select(
        (F.col("loss") + F.lit(loss.penalty(w))).alias("loss"),
        *[(F.col(f"grad_{c}") + F.lit(float(e))).alias(f"grad_{c}") for c, e in zip(x, extra)],
    )


def evaluate(df: DataFrame, loss, x: Sequence[str], y: str, w: np.ndarray) -> tuple[float, np.ndarray]:
    row = loss_table(df, loss, x, y, w).first()
    if row["loss"] is None:
        raise ValueError("no rows to evaluate")
    return float(row["loss"]), np.array([float(v) for v in row[1:]])


# --- step sizes and descent methods -------------------------------------------

@dataclass(frozen=True)
class ConstantLR:
    lr: float

    def __call__(self, iteration: int) -> float:
        return self.lr


@dataclass(frozen=True)
class TimeDecayLR:
    """scale * (s0 / (s0 + iteration)) ** p"""

    scale: float = 1.0
    s0: float = 1.0
    p: float = 0.5

    def __call__(self, iteration: int) -> float:
        return self.scale * (self.s0 / (self.s0 + iteration)) ** self.p


@dataclass
class Vanilla:
    def step(self, grad: np.ndarray, lr: float) -> np.ndarray:
        return -lr * grad


@dataclass
class Momentum:
    beta: float = 0.9
    velocity: np.ndarray | float = 0.0

    def step(self, grad: np.ndarray, lr: float) -> np.ndarray:
        self.velocity = self.beta * self.velocity + lr * grad
        return -self.velocity


@dataclass
class Adam:
    beta1: float = 0.9
    beta2: float = 0.999
    eps: float = 1e-8
    m: np.ndarray | float = 0.0
    v: np.ndarray | float = 0.0
    t: int = 0

    def step(self, grad: np.ndarray, lr: float) -> np.ndarray:
        self.t += 1
        self.m = self.beta1 * self.m + (1 - self.beta1) * grad
        self.v = self.beta2 * self.v + (1 - self.beta2) * grad**2
        m_hat = self.m / (1 - self.beta1**self.t)
        v_hat = self.v / (1 - self.beta2**self.t)
        return -lr * m_hat / (np.sqrt(v_hat) + self.eps)


def _training_rows(df: DataFrame, x: Sequence[str], y: str) -> DataFrame:
    """Only the needed columns, spread over all task slots and kept for the passes that follow."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.select(*dict.fromkeys([*x, y])).repartition(slots).persist(StorageLevel.MEMORY_AND_DISK)


def _descend(
    x: Sequence[str],
    full: Callable[[np.ndarray], tuple[float, np.ndarray]],
    step: Callable[[int, np.ndarray, np.ndarray], np.ndarray],
    tolerance: float,
    max_iter: int,
) -> LinearModel:
    """Shared loop: ``full`` gives loss and gradient, ``step`` the weight change."""
    w = np.zeros(len(x))
    loss, grad = full(w)
    history = [loss]
    for it in range(max_iter):
        delta = step(it, w, grad)
        w = w + delta
        loss, grad = full(w)
        history.append(loss)
        if np.isnan(delta).any() or float(np.sum(delta**2)) < tolerance:
            break
    return LinearModel(tuple(x), w, 0.0, tuple(history))


def fit_gd(
    df: DataFrame,
    x: Sequence[str],
    y: str,
    loss=Mse(),
    lr: Callable[[int], float] = TimeDecayLR(),
    tolerance: float = 1e-6,
    max_iter: int = 1000,
    method: Callable[[], Vanilla | Momentum | Adam] = Vanilla,
) -> LinearModel:
    """Full-batch descent from zero weights.

    One aggregate gives the loss after a step together with the gradient for the
    next. The squared loss needs the data once only: its value and gradient
    follow from the Gram matrix.
    """
    update = method()
    core = loss.core if isinstance(loss, L2) else loss
    if isinstance(core, Mse):
        full = _gram_loss(_one(df, x, y), loss)
        return _descend(x, full, lambda it, w, g: update.step(g, lr(it)), tolerance, max_iter)
    rows = _training_rows(df, x, y)
    try:
        return _descend(
            x,
            lambda w: evaluate(rows, loss, x, y, w),
            lambda it, w, g: update.step(g, lr(it)),
            tolerance,
            max_iter,
        )
    finally:
        rows.unpersist()


def _gram_loss(stats: Stats, loss) -> Callable[[np.ndarray], tuple[float, np.ndarray]]:
    g, d, n = stats.raw(), stats.d, stats.n

    def full(w: np.ndarray) -> tuple[float, np.ndarray]:
        value = stats.squared_error(w, 0.0) / n
        grad = 2 / n * (g[:d, :d] @ w - g[:d, d])
        if isinstance(loss, L2):
            return value + loss.penalty(w), grad + loss.penalty_slope(w)
        return value, grad

    return full


def fit_momentum(df: DataFrame, x: Sequence[str], y: str, beta: float = 0.9, **options) -> LinearModel:
    return fit_gd(df, x, y, method=lambda: Momentum(beta), **options)


def fit_adam(
    df: DataFrame, x: Sequence[str], y: str, beta1: float = 0.9, beta2: float = 0.999, eps: float = 1e-8, **options
) -> LinearModel:
    return fit_gd(df, x, y, method=lambda: Adam(beta1, beta2, eps), **options)


#: Drawn rows that the driver holds at once.
DRAWN_ROWS = 100_000
#: Weight vectors whose losses one pass over the rows gives.
LOSSES_AT_ONCE = 32


def _numbered(df: DataFrame, x: Sequence[str], y: str, key: Sequence[str]) -> DataFrame:
    """The complete rows' numbers in key order, from 0, and values; written once."""
    values = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in dict.fromkeys([*x, y])]
    order = [F.col(k).alias(f"__key{i}") for i, k in enumerate(key)]
    complete = df.select(*order, *values).dropna(subset=[*x, y])
    numbered = row_index(complete, [f"__key{i}" for i in range(len(key))], "__row")
    return materialise(numbered.drop(*[f"__key{i}" for i in range(len(key))]))


def _drawn(rows: DataFrame, places: np.ndarray, x: Sequence[str], y: str) -> tuple[np.ndarray, np.ndarray]:
    """Matrix and target of the rows at these ascending places, by one join."""
    wanted = rows.sparkSession.createDataFrame([(int(p),) for p in places], "__row long")
    got = rows.join(F.broadcast(wanted), "__row").select("__row", *x, F.col(y).alias("__y")).toPandas().sort_values("__row")
    return got[list(x)].to_numpy(float), got["__y"].to_numpy(float)


def losses_at(df: DataFrame, loss, x: Sequence[str], y: str, weights: Sequence[np.ndarray]) -> list[float]:
    """The loss at each of several weights; a pass over the rows serves ``LOSSES_AT_ONCE`` of them."""
    found: list[float] = []
    for start in range(0, len(weights), LOSSES_AT_ONCE):
        part = weights[start : start + LOSSES_AT_ONCE]
        row = df.agg(*[loss_columns(loss, x, y, w)[0].alias(f"at{i}") for i, w in enumerate(part)]).first()
        found += [float(v) + (loss.penalty(w) if isinstance(loss, L2) else 0.0) for v, w in zip(row, part)]
    return found


def _stochastic(
    df: DataFrame,
    x: Sequence[str],
    y: str,
    key: Sequence[str],
    loss,
    batch_size: int,
    tolerance: float,
    max_iter: int,
    seed: int,
    rule: Callable[[int], Callable],
) -> LinearModel:
    """Shared loop of the methods that see ``batch_size`` rows a step.

    The places of all batches follow from the seed, so the rows of many steps
    come in one job, and no step reads the table. ``rule(n)`` makes the function
    from (step, weights, places, matrix, slopes at the rows) to the weight change.
    The losses of the whole path are worked out after it.
    """
    if not 0 < batch_size <= DRAWN_ROWS:
        raise ValueError(f"a batch has 1 to {DRAWN_ROWS} rows; use full descent for more")
    rows = _numbered(df, x, y, key)
    n = rows.count()
    if not n:
        raise ValueError("no rows to fit on")
    size, step = min(batch_size, n), rule(n)
    core = loss.core if isinstance(loss, L2) else loss
    path, ended = [np.zeros(len(x))], False
    ahead = max(1, DRAWN_ROWS // size)
    for start in range(0, max_iter, ahead):
        batches = [
            np.sort(np.random.default_rng((seed, it)).choice(n, size, replace=False))
            for it in range(start, min(start + ahead, max_iter))
        ]
        places = np.unique(np.concatenate(batches))
        matrix, target = _drawn(rows, places, x, y)
        for it, batch in enumerate(batches, start):
            w, at = path[-1], np.searchsorted(places, batch)
            slopes = core.slope_of(matrix[at] @ w - target[at])[:, None] * matrix[at]
            if isinstance(loss, L2):
                slopes = slopes + loss.penalty_slope(w)
            delta = step(it, batch, slopes)
            path.append(w + delta)
            ended = np.isnan(delta).any() or float(np.sum(delta**2)) < tolerance
            if ended:
                break
        if ended:
            break
    return LinearModel(tuple(x), path[-1], 0.0, tuple(losses_at(rows, loss, x, y, path)))


def fit_sgd(
    df: DataFrame,
    x: Sequence[str],
    y: str,
    key: Sequence[str],
    loss=Mse(),
    lr: Callable[[int], float] = TimeDecayLR(),
    batch_size: int = 32,
    tolerance: float = 1e-6,
    max_iter: int = 1000,
    seed: int = 0,
) -> LinearModel:
    """Mini-batch descent; every step draws its own complete rows without replacement."""

    def rule(_n: int) -> Callable:
        return lambda it, _batch, slopes: -lr(it) * slopes.mean(axis=0)

    return _stochastic(df, x, y, key, loss, batch_size, tolerance, max_iter, seed, rule)


def fit_sag(
    df: DataFrame,
    x: Sequence[str],
    y: str,
    key: Sequence[str],
    loss=Mse(),
    lr: Callable[[int], float] = TimeDecayLR(),
    batch_size: int = 32,
    tolerance: float = 1e-6,
    max_iter: int = 1000,
    seed: int = 0,
) -> LinearModel:
    """Stochastic average gradient with one remembered gradient per row.

    The memory holds the gradients of the rows drawn so far (at most batch_size
    per step); a row never drawn counts as zero.
    """

    def rule(n: int) -> Callable:
        known, held, total = np.zeros(0, np.int64), np.zeros((0, len(x))), np.zeros(len(x))

        def step(it: int, batch: np.ndarray, slopes: np.ndarray) -> np.ndarray:
            nonlocal known, held, total
            every = np.union1d(known, batch)
            if len(every) > len(known):
                moved = np.zeros((len(every), len(x)))
                moved[np.searchsorted(every, known)] = held
                known, held = every, moved
            at = np.searchsorted(known, batch)
            total = total + (slopes - held[at]).sum(axis=0)
            held[at] = slopes
            return -lr(it) * total / n

        return step

    return _stochastic(df, x, y, key, loss, batch_size, tolerance, max_iter, seed, rule)


#: Gradient sums that the driver holds for blocks of rows.
MOST_BLOCKS = 4_096


def fit_block_sag(
    df: DataFrame,
    x: Sequence[str],
    y: str,
    block: Column,
    blocks: int,
    loss=Mse(),
    lr: Callable[[int], float] = TimeDecayLR(),
    per_step: int = 1,
    tolerance: float = 1e-6,
    max_iter: int = 1000,
    seed: int = 0,
) -> LinearModel:
    """Stochastic average gradient with one remembered gradient per block of rows.

    ``block`` deals the rows to 0 .. blocks - 1, by a hash of their key for instance;
    rows that it gives null are left out, as are rows that are not complete. A step
    refreshes the gradient sums of ``per_step`` blocks (``drawn_blocks``) and moves by
    the mean gradient of all rows, those of blocks never drawn counting as zero. The
    driver remembers blocks x d numbers, whatever the number of steps and rows.

    The sums of the squared loss follow from the blocks' statistics, gathered in one
    pass. Other losses take one aggregate a step over the drawn blocks, which lie in
    folders of their own.
    """
    if not 0 < per_step <= blocks <= MOST_BLOCKS:
        raise ValueError(f"a step takes 1 to {blocks} blocks of at most {MOST_BLOCKS}")
    core = loss.core if isinstance(loss, L2) else loss
    named = block.cast("int").alias("__block")
    values = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in dict.fromkeys([*x, y])]
    rows = df.select(named, *values).dropna().filter(F.col("__block").between(0, blocks - 1))
    if isinstance(core, Mse):
        stats = gather(rows, x, y, "__block")
        sizes = {b: s.n for b, s in stats.items()}
        raw = {b: s.raw() for b, s in stats.items()}

        def sums(drawn: Sequence[int], w: np.ndarray) -> dict[int, np.ndarray]:
            return {b: 2 * (raw[b][:-1, :-1] @ w - raw[b][:-1, -1]) for b in drawn if b in raw}
    else:
        rows = materialise(rows.hint("rebalance", "__block"), by="__block")
        sizes = {b: n for b, n in rows.groupBy("__block").count().collect()}

        def sums(drawn: Sequence[int], w: np.ndarray) -> dict[int, np.ndarray]:
            slope = core.slope(dot(x, w) - F.col(y))
            asked = rows.filter(F.col("__block").isin([int(b) for b in drawn]))
            found = asked.groupBy("__block").agg(*[F.sum(slope * F.col(c)) for c in x])
            return {r[0]: np.array(r[1:], dtype=float) for r in found.collect()}

    n = sum(sizes.values())
    if not n:
        raise ValueError("no rows to fit on")
    memory, total, path = np.zeros((blocks, len(x))), np.zeros(len(x)), [np.zeros(len(x))]
    for it in range(max_iter):
        w = path[-1]
        for b, fresh in sums(drawn_blocks(seed, it, blocks, per_step), w).items():
            if isinstance(loss, L2):
                fresh = fresh + sizes[b] * loss.penalty_slope(w)
            total += fresh - memory[b]
            memory[b] = fresh
        delta = -lr(it) * total / n
        path.append(w + delta)
        if np.isnan(delta).any() or float(np.sum(delta**2)) < tolerance:
            break
    if isinstance(core, Mse):
        whole = stats.pop(next(iter(stats)))
        for s in stats.values():
            whole = whole + s
        full = _gram_loss(whole, loss)
        losses = [full(w)[0] for w in path]
    else:
        losses = losses_at(rows, loss, x, y, path)
    return LinearModel(tuple(x), path[-1], 0.0, tuple(losses))


def drawn_blocks(seed: int, it: int, blocks: int, per_step: int) -> list[int]:
    """Blocks of a step: consecutive stretches of a new order for every round through all of them."""
    out = []
    for place in range(it * per_step, (it + 1) * per_step):
        out.append(int(np.random.default_rng((seed, place // blocks)).permutation(blocks)[place % blocks]))
    return list(dict.fromkeys(out))
