"""Severity of toxic texts by cumulative-link ordinal regression on sparse word features.

P(grade <= j) = logistic(threshold_j - x . w): one weight per term, shared by
all ordered thresholds. The features are the terms that separate toxic from
other labelled documents best by the likelihood-ratio statistic G2, valued
ln(1 + occurrences in 100 words); a term is a whole word or its first 5 or 7
letters, since languages build words from common stems. Counting terms and every step of the fit (Fisher scoring, one
aggregate of gradient and information per step) are Spark jobs; the driver
holds (terms + thresholds)^2 numbers.

Labelled rows are bounded by ``MAX_LABELLED``: beyond it, a share of them chosen
by a hash of their id is used, the same on every run. Everything else covers all
documents and whole texts.

Defined cases: a null or empty text has no features and gets the severity of a
text without known terms; null ids or grades are not learned from; of several
grades of a document the highest counts; every grade has a small prior weight
(``PRIOR``), so absent grades or empty labels give a defined model, under which
no document is toxic. Repeated rows are scored one by one; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.sources.scratch import materialise

MAX_LABELLED = 20_000
TERMS = 256
MIN_DOCUMENTS = 5
STEMS = (5, 7)
RIDGE = 0.05
STEPS = 25
#: Weight of one text without terms, for grade 0 and for each higher grade.
PRIOR = (1.0, 0.05)

_WORD = re.compile(r"[^\W_]+")


def terms_of(word: str) -> list[str]:
    return [word, *[word[:n] + "*" for n in STEMS if len(word) >= n]]


def word_counts(text: str | None) -> Counter:
    return Counter(_WORD.findall(text.lower())) if text else Counter()


def value(count: float, n_words: int) -> float:
    return math.log1p(100 * count / n_words)


def _list_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, values = [], []
        for scalar in batch.column(1):
            words, found = word_counts(scalar.as_py()), Counter()
            for word, n in words.items():
                for term in terms_of(word):
                    found[term] += n
            total = words.total()
            names.append(list(found))
            values.append([value(n, total) for n in found.values()])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(names, pa.list_(pa.string())), pa.array(values, pa.list_(pa.float32()))],
            names=["grade", "terms", "x"],
        )


def _xlogx(value: Column) -> Column:
    return F.when(value > 0, value * F.ln(value)).otherwise(F.lit(0.0))


def choose_terms(listed: DataFrame, terms: int = TERMS, min_documents: int = MIN_DOCUMENTS) -> list[str]:
    """The ``terms`` best terms by G2 of presence against grade > 0, ties by name."""
    sizes = listed.agg(F.count("*").alias("n"), F.count(F.when(F.col("grade") > 0, 1)).alias("n1")).first()
    n, n1 = float(sizes["n"] or 0), float(sizes["n1"] or 0)
    held = listed.select("grade", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count("*").cast("double").alias("a"), F.count(F.when(F.col("grade") > 0, 1)).cast("double").alias("b")
    )
    a, b = F.col("a"), F.col("b")
    cells = _xlogx(b) + _xlogx(a - b) + _xlogx(n1 - b) + _xlogx(n - n1 - a + b)
    margins = _xlogx(a) + _xlogx(n - a) + _xlogx(F.lit(n1)) + _xlogx(F.lit(n - n1)) - _xlogx(F.lit(n))
    best = held.filter(a >= min_documents).select("term", (cells - margins).alias("g2")).filter("g2 > 0")
    return [r["term"] for r in best.orderBy(F.desc("g2"), "term").limit(terms).collect()]


def _sums(x: np.ndarray, y: np.ndarray, weight: np.ndarray, theta: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log likelihood, gradient and expected information in (thresholds, weights)."""
    k = len(theta)
    eta = x @ w
    gamma = 1 / (1 + np.exp(-np.clip(theta[None, :] - eta[:, None], -35, 35)))
    slope = gamma * (1 - gamma)
    zero, one = np.zeros((len(eta), 1)), np.ones((len(eta), 1))
    p = np.maximum(np.diff(np.hstack([zero, gamma, one]), axis=1), 1e-12)
    s = np.hstack([zero, slope, zero])
    # d p_grade / d (thresholds, eta)
    dp = np.zeros((len(eta), k + 1, k + 1))
    for grade in range(k + 1):
        if grade < k:
            dp[:, grade, grade] += s[:, grade + 1]
        if grade > 0:
            dp[:, grade, grade - 1] -= s[:, grade]
        dp[:, grade, k] = -(s[:, grade + 1] - s[:, grade])
    rows = np.arange(len(eta))
    score = dp[rows, y] / p[rows, y][:, None] * weight[:, None]
    info = np.einsum("ngi,ngj->nij", dp / p[:, :, None], dp) * weight[:, None, None]
    gradient = np.concatenate([score[:, :k].sum(0), x.T @ score[:, k]])
    cross = x.T @ info[:, k, :k]
    whole = np.block([[info[:, :k, :k].sum(0), cross.T], [cross, (x * info[:, k, k][:, None]).T @ x]])
    return float((weight * np.log(p[rows, y])).sum()), gradient, whole


@dataclass(frozen=True)
class OrdinalModel:
    """``thresholds`` ascending, one weight per term."""

    terms: tuple[str, ...]
    weights: np.ndarray
    thresholds: np.ndarray

    def severity(self, eta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(expected grade, probability of a grade above 0)."""
        above = 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - eta[:, None], -35, 35)))
        return above.sum(axis=1), above[:, 0]


def sample_labels(labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, grade) of at most about ``most`` documents, chosen by a hash of the id."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("grade").isNotNull()).select(F.col("doc_id").cast("long"), F.col("grade").cast("int"))
    n = known.count()
    if n > most:
        buckets = 1 << 20
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(buckets)) < int(buckets * most / n))
    return known.groupBy("doc_id").agg(F.max("grade").alias("grade"))


def fit_ordinal(documents: DataFrame, labels: DataFrame, grades: int, terms: int = TERMS, most: int = MAX_LABELLED, ridge: float = RIDGE) -> OrdinalModel:
    """Fit on ``labels`` (doc_id, grade from 0 to ``grades`` - 1)."""
    sample = materialise(sample_labels(labels, most).filter(F.col("grade").between(0, grades - 1)))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # The sample is bounded by ``most``, so every task may hold it.
    listed = materialise(
        texts.join(F.broadcast(sample), "doc_id").select("grade", "text").mapInArrow(_list_terms, "grade int, terms array<string>, x array<float>")
    )
    chosen = choose_terms(listed, terms)
    place = {t: i for i, t in enumerate(chosen)}
    d, k = len(chosen), grades - 1

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, values = [], []
            for names, xs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                mine = [(place[t], x) for t, x in zip(names, xs, strict=True) if t in place]
                at.append([i for i, _ in mine])
                values.append([v for _, v in mine])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(at, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float64()))], names=["grade", "at", "x"]
            )

    table = materialise(listed.mapInArrow(features, "grade int, at array<int>, x array<double>").coalesce(8))
    prior = np.array([PRIOR[0]] + [PRIOR[1]] * k)
    theta = np.log((np.cumsum(prior) / prior.sum())[:k] / (1 - (np.cumsum(prior) / prior.sum())[:k]))
    w = np.zeros(d)

    def total(theta: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            value, gradient, info = 0.0, np.zeros(k + d), np.zeros((k + d, k + d))
            for batch in batches:
                for start in range(0, batch.num_rows, 2048):
                    piece = batch.slice(start, 2048)
                    x = np.zeros((piece.num_rows, d))
                    for i, (at, xs) in enumerate(zip(piece.column(1).to_pylist(), piece.column(2).to_pylist(), strict=True)):
                        x[i, at] = xs
                    y = piece.column(0).to_numpy()
                    v, g, h = _sums(x, y, np.ones(len(y)), theta, w)
                    value, gradient, info = value + v, gradient + g, info + h
            yield pa.RecordBatch.from_arrays(
                [pa.array([value]), pa.array([gradient.tobytes()], pa.binary()), pa.array([info.tobytes()], pa.binary())], names=["v", "g", "h"]
            )

        value, gradient, info = _sums(np.zeros((k + 1, d)), np.arange(k + 1), prior, theta, w)
        for r in table.mapInArrow(part, "v double, g binary, h binary").collect():
            value += r["v"]
            gradient = gradient + np.frombuffer(r["g"])
            info = info + np.frombuffer(r["h"]).reshape(k + d, k + d)
        penalty = np.concatenate([np.zeros(k), np.full(d, ridge)])
        return value - ridge * float(w @ w) / 2, gradient - penalty * np.concatenate([theta, w]), info + np.diag(penalty + 1e-9)

    now = total(theta, w)
    for _ in range(STEPS):
        step = np.linalg.solve(now[2], now[1])
        scale = 1.0
        while True:
            moved = theta + scale * step[:k], w + scale * step[k:]
            if np.all(np.diff(moved[0]) > 0):
                after = total(*moved)
                if after[0] >= now[0] - 1e-9 or scale < 1e-3:
                    break
            scale /= 2
        gain = after[0] - now[0]
        theta, w, now = *moved, after
        if gain < 1e-3:
            break
    return OrdinalModel(tuple(chosen), w, theta)


def score_toxicity(documents: DataFrame, model: OrdinalModel, cut: float = 0.5) -> DataFrame:
    """(doc_id, expected_severity, p_toxic, toxic), one row per row of ``documents``."""
    weight = dict(zip(model.terms, model.weights.tolist(), strict=True))
    seen: dict[str, list[str]] = {}

    def known(word: str) -> list[str]:
        if word not in seen:
            if len(seen) >= 200_000:
                seen.clear()
            seen[word] = [t for t in terms_of(word) if t in weight]
        return seen[word]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            eta = np.zeros(batch.num_rows)
            for i, scalar in enumerate(batch.column(1)):
                words, found = word_counts(scalar.as_py()), Counter()
                for word, n in words.items():
                    for term in known(word):
                        found[term] += n
                if found:
                    total = words.total()
                    eta[i] = math.fsum(weight[t] * value(n, total) for t, n in found.items())
            expected, above = model.severity(eta)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(expected), pa.array(above), pa.array(above >= cut)],
                names=["doc_id", "expected_severity", "p_toxic", "toxic"],
            )

    table = documents.select("doc_id", "text")
    fields = [T.StructField("expected_severity", T.DoubleType()), T.StructField("p_toxic", T.DoubleType()), T.StructField("toxic", T.BooleanType())]
    return table.mapInArrow(score, T.StructType([table.schema["doc_id"], *fields]))
