"""Hard negatives by a vertical scan of vectors (BOND: branch and bound on decomposed data).

For each anchor the first ``positives`` other rows of its label are its positives; for each of
them the first ``negatives`` rows of other labels whose score lies in a window below the positive's
score are its hard negatives. Scores are integer inner products of quantised vectors, higher first,
ties by the smaller id.

Both searches read the vectors by dimension. A task holds one block of at most ``ANCHORS``
anchors and meets one of ``SPLITS`` parts of the rows as a stream of batches, each turned into columns by dimension.
Each anchor takes the columns in descending order of its own components' magnitude, a few at a
time, and adds them to the partial scores of the candidates left. What the remaining columns
can still add lies between sums of min(a * least, a * most) and max(a * least, a * most) over
them, from the least and most value of each column in the batch. Candidates that can no longer
enter leave the bitmap: in the first search those whose upper bound is below the best
``positives`` lower bounds or scores known so far; in the second those whose bounds meet no
window, where a window that is already full begins at its last score. Those left after the last column have their exact score.

Each part gives at most ``positives`` (``negatives`` a window) rows an anchor, however large it is,
and one grouped aggregate over the few parts keeps the best of them. Rows are dealt to the parts by a
hash of id and vector; equal rows have been counted before, so a row in many copies is one
candidate that counts as often. Nothing is kept for pairs that the bounds exclude.

Defined cases: rows with a null label, a null id, a null vector, or any null or non-finite component take no part;
a shorter vector counts as padded with zeros; every one of several equal rows is an anchor, positive or negative
of its own; an anchor without positives, or a positive without negatives, has no rows; other columns are ignored.
Scores must stay below 2^55: larger components are an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.sources.scratch import materialise

POSITIVES = 5
NEGATIVES = 3
#: Anchors of a task, parts that each block of anchors meets the rows in, rows of a batch, columns read between two bounds.
ANCHORS = 4096
SPLITS = 16
BATCH = 8192
STEP = 8
_LOWEST = np.iinfo(np.int64).min

#: (lowest, highest) score of a window for a positive's score, as Spark columns.
Window = Callable[[Column], tuple[Column, Column]]


def half_to_most(score: Column) -> tuple[Column, Column]:
    """50 * score <= 100 * s <= 95 * score, in whole numbers."""
    return -_floor_div(-score * 50, 100), _floor_div(score * 95, 100)


def _floor_div(a: Column, b: int) -> Column:
    return F.call_function("div", a - F.pmod(a, F.lit(b)), F.lit(b))


def quantised(vector: Column, scale: int = 256) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def usable(key: str, vector: str, label: str) -> Column:
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & F.coalesce(sound, F.lit(False))


class Columns:
    """A batch of rows by dimension, sorted by label."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, copies: np.ndarray, vectors: np.ndarray):
        by = np.lexsort((ids, labels))
        self.ids, self.labels, self.copies = ids[by], labels[by], copies[by]
        self.data = np.ascontiguousarray(vectors[by].T)  # dimension by row

    def part(self, label: int) -> slice:
        return slice(*np.searchsorted(self.labels, [label, label + 1]))


class Scan:
    """The vertical scan of one batch for a block of anchors."""

    def __init__(self, anchors: np.ndarray, data: np.ndarray):
        self.anchors, self.data = anchors, data
        size = np.abs(anchors)
        self.order = np.argsort(-size, axis=1, kind="stable")
        least, most = data.min(axis=1), data.max(axis=1)
        ends = np.sort(np.stack([anchors * least, anchors * most]), axis=0)
        low, high = (np.take_along_axis(e, self.order, 1) for e in ends)
        # what the columns from the k-th on add at least and at most
        self.low = np.pad(np.cumsum(low[:, ::-1], axis=1)[:, ::-1], ((0, 0), (0, 1)))
        self.high = np.pad(np.cumsum(high[:, ::-1], axis=1)[:, ::-1], ((0, 0), (0, 1)))

    def survivors(self, anchor: int, rows: np.ndarray, alive: Callable[[np.ndarray, float, float], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Places and exact scores of the ``rows`` that ``alive(partial, low, high)`` leaves to the end."""
        vector, order = self.anchors[anchor], self.order[anchor]
        partial = np.zeros(len(rows), self.data.dtype)
        whole = len(rows) == self.data.shape[1]
        for k in range(0, len(order), STEP):
            take = order[k : k + STEP]
            columns = self.data[take] if whole else self.data[np.ix_(take, rows)]
            partial += vector[take] @ columns
            done = min(k + STEP, len(order))
            stay = alive(partial, self.low[anchor, done], self.high[anchor, done])
            if done == len(order) or stay.mean() < 0.75:
                rows, partial, whole = rows[stay], partial[stay], False
                if not len(rows):
                    break
        return rows, partial


def _best(score: np.ndarray, ids: np.ndarray, copies: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    by = np.lexsort((ids, -score))[:k]
    return score[by], ids[by], copies[by]


class _Positives:
    """Best rows of the anchors' own labels."""

    def __init__(self, anchors: pa.Table, dims: int):
        self.key = anchors["anchor"].to_numpy()
        self.ids, self.labels = anchors["id"].to_numpy(), anchors["label"].to_numpy()
        self.vectors = _matrix(anchors["vector"], dims)
        none = np.zeros(0, np.int64)
        self.found = [(none, none, none)] * len(self.key)

    def add(self, rows: Columns, scan: Scan) -> None:
        for a in range(len(self.key)):
            part = rows.part(self.labels[a])
            if part.start == part.stop:
                continue
            held = self.found[a]
            floor = float(held[0][-1]) if len(held[0]) == POSITIVES else -np.inf

            def alive(partial, low, high, floor=floor):
                # One row may be the anchor itself, so one more lower bound is needed than places.
                if len(partial) > POSITIVES:
                    floor = max(floor, float(np.partition(partial, -POSITIVES - 1)[-POSITIVES - 1]) + low)
                return partial + high >= floor

            at, score = scan.survivors(a, np.arange(part.start, part.stop), alive)
            copies = rows.copies[at]
            own = (rows.ids[at] == self.ids[a]) & (rows.data[:, at] == scan.anchors[a][:, None]).all(axis=0)
            copies = copies - own
            at, score, copies = at[copies > 0], score[copies > 0], copies[copies > 0]
            if len(at):
                new = score.astype(np.int64), rows.ids[at], copies
                self.found[a] = _best(*(np.concatenate(x) for x in zip(held, new, strict=True)), POSITIVES)

    def out(self) -> pa.RecordBatch:
        n = [len(f[0]) for f in self.found]
        score, ids, copies = (np.concatenate([f[i] for f in self.found]) for i in range(3))
        return pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (np.repeat(self.key, n), score * 0, score * 0, score, ids, copies)], names=FOUND
        )


class _Negatives(_Positives):
    """Best rows of other labels in each of the anchor's windows."""

    def __init__(self, anchors: pa.Table, dims: int):
        super().__init__(anchors, dims)
        none = np.zeros(0, np.int64)
        lows, highs = anchors["lows"].to_pylist(), anchors["highs"].to_pylist()
        self.windows = [list(dict.fromkeys(zip(x, y, strict=True))) for x, y in zip(lows, highs, strict=True)]
        self.found = [[(none, none, none)] * len(w) for w in self.windows]

    def add(self, rows: Columns, scan: Scan) -> None:
        n = len(rows.ids)
        for a in range(len(self.key)):
            part = rows.part(self.labels[a])
            if part.stop - part.start == n or not self.windows[a]:
                continue
            held = self.found[a]
            floors = [max(low, h[0][-1]) if len(h[0]) == NEGATIVES else low for (low, _), h in zip(self.windows[a], held, strict=True)]
            spans = [(f, high) for f, (_, high) in zip(floors, self.windows[a], strict=True) if f <= high]

            def alive(partial, low, high, spans=spans):
                # A window that will be filled from this batch alone begins at its last certain score.
                stay = np.zeros(len(partial), bool)
                for first, last in spans:
                    sure = partial[(partial + low >= first) & (partial + high <= last)]
                    if len(sure) >= NEGATIVES:
                        first = max(first, float(np.partition(sure, -NEGATIVES)[-NEGATIVES]) + low)
                    stay |= (partial + high >= first) & (partial + low <= last)
                return stay

            if not spans:
                continue
            others = np.concatenate([np.arange(part.start), np.arange(part.stop, n)])
            at, score = scan.survivors(a, others, alive)
            score, ids, copies = score.astype(np.int64), rows.ids[at], rows.copies[at]
            for w, ((_, high), floor) in enumerate(zip(self.windows[a], floors, strict=True)):
                fit = (score >= floor) & (score <= high)
                if fit.any():
                    new = score[fit], ids[fit], copies[fit]
                    held[w] = _best(*(np.concatenate(x) for x in zip(held[w], new, strict=True)), NEGATIVES)

    def out(self) -> pa.RecordBatch:
        flat = [(k, *w, f) for k, windows, found in zip(self.key, self.windows, self.found, strict=True) for w, f in zip(windows, found, strict=True)]
        n = [len(f[0]) for *_, f in flat]
        columns = [np.repeat(np.array([x[i] for x in flat], np.int64), n) for i in range(3)]
        columns += [np.concatenate([f[i] for *_, f in flat]) if flat else np.zeros(0, np.int64) for i in range(3)]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=FOUND)


FOUND = ["anchor", "low", "high", "score", "id", "copies"]


def _matrix(vectors: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Vectors as rows, padded with zeros."""
    arrays = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    flat, lengths = arrays.flatten().to_numpy(), np.diff(arrays.offsets.to_numpy())
    if (lengths == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def _exact(vectors: np.ndarray, bound: int) -> np.ndarray:
    """As floating point where every sum is a whole number that it holds exactly, else as they are."""
    return vectors.astype(np.float64) if bound < 1 << 53 else vectors


def _searcher(kind: type[_Positives], dims: int, bound: int):
    """Streams (block, split)-sorted rows, each group's anchors before its rows."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, block, waiting, anchors = None, None, [], []

        def score() -> None:
            table = pa.Table.from_batches(waiting)
            waiting.clear()
            rows = Columns(*(table[c].to_numpy() for c in ("id", "label", "copies")), _exact(_matrix(table["vector"], dims), bound))
            block.add(rows, Scan(_exact(block.vectors, bound), rows.data))

        def finish() -> Iterator[pa.RecordBatch]:
            if waiting and block is not None:
                score()
            waiting.clear()
            if block is not None:
                yield block.out()

        for batch in batches:
            key = batch.column("block").to_numpy().astype(np.int64) * SPLITS + batch.column("split").to_numpy()
            is_row = batch.column("is_row").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero((np.diff(key) != 0) | (np.diff(is_row.astype(np.int8)) != 0)) + 1).tolist(), len(key)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if key[a] != group:
                    yield from finish()
                    group, block, anchors = key[a], None, []
                if not is_row[a]:
                    anchors.append(batch.slice(a, b - a))
                    continue
                if block is None and anchors:
                    block, anchors = kind(pa.Table.from_batches(anchors), dims), []
                if block is None:
                    continue
                for start in range(a, b, BATCH):
                    waiting.append(batch.slice(start, min(BATCH, b - start)))
                    if sum(x.num_rows for x in waiting) >= BATCH:
                        score()
        yield from finish()

    return search


def _search(kind: type[_Positives], rows: DataFrame, anchors: DataFrame, blocks: int, dims: int, bound: int) -> DataFrame:
    """Each block of anchors against all rows: (anchor, low, high, score, id, copies), the window as it was given."""
    left = [f.name for f in anchors.schema.fields if f.name in ("lows", "highs")]
    block = F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("int")
    split = F.pmod(F.xxhash64("id", "vector"), F.lit(SPLITS)).cast("int")
    held = anchors.select(
        block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(SPLITS - 1))).alias("split"), F.lit(False).alias("is_row"),
        "id", "label", "copies", "vector", "anchor", *left,
    )
    met = rows.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), split.alias("split"), F.lit(True).alias("is_row"),
        "id", "label", "copies", "vector", F.lit(None).cast("long").alias("anchor"),
        *[F.lit(None).cast("array<bigint>").alias(c) for c in left],
    )
    dealt = held.union(met).repartitionById(blocks * SPLITS, F.col("block") * SPLITS + F.col("split"))
    ordered = dealt.sortWithinPartitions("block", "split", "is_row")
    return ordered.mapInArrow(_searcher(kind, dims, bound), ", ".join(f"{c} long" for c in FOUND))


def _first(k: int, found: DataFrame, *by: str) -> DataFrame:
    """``best``: the first k of each group's rows as structs (score, id), each as often as it occurs."""
    entries = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("down"), "id", "copies")))
    repeated = F.transform(
        F.slice("best", 1, k),
        lambda x: F.array_repeat(F.struct((-x["down"]).alias("score"), x["id"].alias("id")), F.least(x["copies"], F.lit(k)).cast("int")),
    )
    return found.groupBy(*by).agg(entries.alias("best")).withColumn("best", F.slice(F.flatten(repeated), 1, k))


def mine_hard_negatives(vectors: DataFrame, anchor: Column, window: Window = half_to_most) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of (id, label, vector).

    ``anchor`` tells which ids are anchors; ``vector`` holds whole numbers, as ``quantised`` gives them.
    """
    rows = vectors.groupBy(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "vector").agg(F.count("*").alias("copies"))
    rows = materialise(rows)
    anchors = materialise(rows.filter(anchor).withColumn("anchor", F.monotonically_increasing_id()))
    most = F.aggregate("vector", F.lit(0).cast("long"), lambda m, x: F.greatest(m, F.abs(x)))
    size = rows.agg(F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("dims"), F.coalesce(F.max(most), F.lit(0)).alias("most")).first()
    dims, bound = max(1, size["dims"]), size["dims"] * size["most"] ** 2
    if bound >= 1 << 55:  # a score times 95 must fit as well
        raise ValueError("scores of these vectors may reach 2^55")
    blocks = max(1, -(-anchors.count() // ANCHORS))

    first = materialise(_first(POSITIVES, _search(_Positives, rows, anchors, blocks, dims, bound), "anchor"))
    positives = first.select("anchor", F.explode("best").alias("p")).select("anchor", "p.id", "p.score")
    low, high = window(F.col("score"))
    positives = positives.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), low.alias("low"), high.alias("high"))
    windows = positives.filter("low <= high").groupBy("anchor").agg(F.collect_set(F.struct("low", "high")).alias("w"))
    windows = windows.select("anchor", F.col("w.low").alias("lows"), F.col("w.high").alias("highs"))
    second = _search(_Negatives, rows, anchors.join(windows, "anchor"), blocks, dims, bound)
    negatives = materialise(_first(NEGATIVES, second, "anchor", "low", "high"))

    ids = anchors.select("anchor", F.col("id").alias("anchor_id"), F.explode(F.sequence(F.lit(1), F.col("copies"))))
    met = positives.join(negatives, ["anchor", "low", "high"]).join(ids, "anchor")
    ranked = met.select("anchor_id", "positive_id", "positive_score", F.posexplode("best").alias("at", "n"))
    return ranked.select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.id").alias("negative_id"),
        "positive_score", F.col("n.score").alias("negative_score"),
    )
