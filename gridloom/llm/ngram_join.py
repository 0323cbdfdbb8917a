"""Similarity join of documents on the Jaccard likeness of their word n-gram sets.

MinHash signatures are cut into bands; the numbers of bands and rows follow from
the likeness wanted and the recall to be reached at exactly that likeness. The
shuffle on band hashes ties every document of a bucket to the bucket's smallest
id, one edge each, and the components of these edges are clusters: any two
documents that agree in a band are in one cluster. Inside a cluster all pairs
are verified on the full sets, block against block, as products of incidence
matrices. A block pair puts out one row per document that has links - their
number and the smallest id they reach - and never the pairs, so the output of a
group of near copies grows with the group and not with its square.

Documents with equal n-gram sets collapse into one class before the bands, so
thousands of copies cost one signature row each and nothing more.

Defined cases: a null text counts as empty; texts without a word have equal
(empty) sets and form one class without links to others; a text of fewer words
than n has one n-gram, all its words; a document with a null id has null
columns besides its id; repeated rows of an id and text count as one document;
an id with several texts is linked through any of them. Other columns of the
table are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.flatwords import mix64, window_hashes, word_chunks
from gridloom.sources.scratch import materialise

NGRAM = 5
LIKENESS = 0.8
RECALL = 0.999
#: Signature length that the bands may use; longer ones only cut candidates further.
MAX_PERMUTATIONS = 224
#: Documents of a cluster that are compared with as many others at once.
BLOCK = 512
#: Columns of an incidence matrix that are multiplied at once.
_COLUMNS = 8_192


def choose_bands(likeness: float, recall: float, permutations: int = MAX_PERMUTATIONS) -> tuple[int, int]:
    """(bands, rows): most rows whose bands reach ``recall`` at ``likeness`` within the signature."""
    best = None
    for rows in range(1, permutations + 1):
        hit = likeness**rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if bands * rows <= permutations:
            best = bands, rows
    if best is None:
        raise ValueError("no bands reach this recall; allow more permutations")
    return best


def _constants(n: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix64(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return x[:n] | np.uint64(1), x[n:]


def _signer(bands: int, rows: int, ngram: int):
    length = bands * rows
    multiply, flip = _constants(length)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for row, end, words in word_chunks(batch.column(1)):
                grams, first = window_hashes(words, ngram, short=True)
                has = np.diff(first) > 0
                signature = np.zeros((length, int(has.sum())), np.uint64)
                if len(grams):
                    at, room = first[:-1][has], np.empty_like(grams)
                    for p in range(length):
                        np.bitwise_xor(grams, flip[p], out=room)
                        np.multiply(room, multiply[p], out=room)
                        signature[p] = np.minimum.reduceat(room, at)
                signature = mix64(signature)
                keys = np.zeros((bands, signature.shape[1]), np.uint64)
                for band in range(bands):
                    key = np.full(signature.shape[1], band + 1, np.uint64)
                    for r in range(rows):
                        key = mix64(key ^ signature[band * rows + r])
                    keys[band] = key
                digests = [
                    hashlib.blake2b(np.unique(grams[a:b]).tobytes(), digest_size=16).digest()
                    for a, b in zip(first[:-1], first[1:], strict=True)
                ]
                found = np.where(has, np.cumsum(has) - 1, -1)
                keys = keys.T.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(row, end - row),
                        pa.array(digests, pa.binary()),
                        pa.array([keys[i] if i >= 0 else [] for i in found], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "digest", "bands"],
                )

    return sign


def _sets(ngram: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, words in word_chunks(batch.column(1)):
                grams, first = window_hashes(words, ngram, short=True)
                sets = [np.unique(grams[a:b]).view(np.int64) for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "grams"]
                )

    return build


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets on the left with all on the right."""
    sets = [*left, *right]
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    often = times[column] > 1  # a gram of one set only is in no intersection
    row, column = row[often], column[often]
    by = np.argsort(column, kind="stable")
    row, column = row[by], column[by]
    total = np.zeros((len(left), len(right)), np.float32)
    at = 0
    while at < len(column):
        end = int(np.searchsorted(column, column[at] + _COLUMNS))
        held = np.zeros((len(sets), int(column[end - 1] - column[at]) + 1), np.float32)
        held[row[at:end], column[at:end] - column[at]] = 1
        total += held[: len(left)] @ held[len(left) :].T
        at = end
    return total.astype(np.int64)  # whole numbers far below 2^24


def _roots(links: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id that each row reaches over the symmetric matrix ``links``."""
    least = ids.copy()
    while True:
        after = np.minimum(least, np.where(links, least[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (after == least).all():
            return least
        least = after


def _verifier(likeness: float):
    millionths = round(likeness * 1_000_000)

    def verify(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        cluster, low, high, block, ids, copies = (table[c].to_numpy() for c in ("cluster", "low", "high", "block", "id", "copies"))
        grams = table["grams"].combine_chunks() if isinstance(table["grams"], pa.ChunkedArray) else table["grams"]
        values, bounds = grams.values.to_numpy(), grams.offsets.to_numpy()
        out: list[list[np.ndarray]] = [[], [], []]
        order = np.lexsort((ids, cluster))
        for rows in np.split(order, np.flatnonzero(np.diff(cluster[order])) + 1):
            across = low[rows[0]] != high[rows[0]]
            left = rows[block[rows] == low[rows[0]]]
            right = rows[block[rows] == high[rows[0]]]
            if not len(left) or not len(right):
                continue
            x, y = ([values[bounds[r] : bounds[r + 1]] for r in part] for part in (left, right))
            shared = shared_counts(x, y)
            either = np.array([len(g) for g in x])[:, None] + np.array([len(g) for g in y])[None, :] - shared
            near = (shared * 1_000_000 >= either * millionths) & (ids[left][:, None] != ids[right][None, :])
            both = np.concatenate([left, right]) if across else left
            links = near
            if across:
                links = np.zeros((len(both), len(both)), bool)
                links[: len(left), len(left) :] = near
                links[len(left) :, : len(left)] = near.T
            some = links.any(axis=1)
            if some.any():
                out[0].append(ids[both][some])
                out[1].append(_roots(links, ids[both])[some])
                out[2].append((links @ copies[both])[some])
        flat = [np.concatenate(o) if o else np.zeros(0, np.int64) for o in out]
        return pa.table([pa.array(f, pa.int64()) for f in flat], names=["id", "root", "linked"])

    return verify


def connected(edges: DataFrame) -> DataFrame:
    """(id, class_id): smallest id reachable over ``edges`` (a, b), for all ids that occur.

    Alternates the large-star and small-star steps of Kiveris et al. (2014), whose
    rounds grow with the logarithm of the longest path, not with its length. Each
    round is a written table; only a checksum of it reaches the driver.
    """
    now = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())
    seen = None
    while True:
        both = now.union(now.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = materialise(small.select("e.u", "e.v").filter("u != v").distinct())
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return now.groupBy("u").agg(F.min("v").alias("class_id")).withColumnRenamed("u", "id").union(
        now.select(F.col("v").alias("id"), F.col("v").alias("class_id")).distinct()
    )


def ngram_jaccard_join(
    documents: DataFrame, likeness: float = LIKENESS, recall: float = RECALL, ngram: int = NGRAM, permutations: int = MAX_PERMUTATIONS
) -> DataFrame:
    """One row per document: (doc_id, class_id, copy_of, n_links).

    ``copy_of`` is the smallest id with the same n-gram set, ``class_id`` the
    smallest id reachable over links, ``n_links`` the number of other documents
    with a likeness of at least ``likeness``, copies included.
    """
    bands, rows = choose_bands(likeness, recall, permutations)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL")
    signed = materialise(texts.mapInArrow(_signer(bands, rows, ngram), "doc_id long, digest binary, bands array<long>"))
    classes = materialise(signed.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.countDistinct("doc_id").alias("copies")))
    members = materialise(signed.select("doc_id", "digest").join(classes, "digest").select("doc_id", "digest", "rep", "copies").distinct())

    first = members.filter("doc_id = rep").select("doc_id", "digest")
    meet = signed.join(first, ["doc_id", "digest"], "left_semi").select(F.explode("bands").alias("band"), F.col("doc_id").alias("id")).distinct()
    lowest = meet.groupBy("band").agg(F.min("id").alias("low"), F.count("*").alias("n")).filter("n > 1").select("band", "low")
    ties = materialise(meet.join(lowest, "band").filter("id != low").select(F.col("low").alias("a"), F.col("id").alias("b")).distinct())

    clusters = connected(ties).toDF("id", "cluster")
    blocks = F.ceil(F.count("*") / BLOCK).cast("int")
    sized = materialise(clusters.join(clusters.groupBy("cluster").agg(blocks.alias("blocks")), "cluster"))
    sets = texts.join(sized.select(F.col("id").alias("doc_id")), "doc_id", "left_semi").distinct()
    sets = materialise(sets.mapInArrow(_sets(ngram), "doc_id long, grams array<long>")).withColumnRenamed("doc_id", "id")
    weights = members.filter("doc_id = rep").groupBy(F.col("doc_id").alias("id")).agg(F.max("copies").alias("copies"))
    bins = max(1, -(-sized.count() // BLOCK))
    cut = sized.join(weights, "id").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    # Small clusters share a task; a block pair of a large one is a group of its own.
    cut = cut.withColumn("bin", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(bins))).otherwise(-1 - F.col("cluster")))
    compared = cut.select("id", "cluster", "copies", "block", "low", "high", "bin").join(sets, "id")
    found = materialise(compared.groupBy("bin", "low", "high").applyInArrow(_verifier(likeness), "id long, root long, linked long"))

    near = connected(found.select(F.col("id").alias("a"), F.col("root").alias("b"))).toDF("rep", "class_id")
    linked = found.groupBy(F.col("id").alias("rep")).agg(F.sum("linked").alias("linked"))
    by_rep = members.join(linked, "rep", "left").join(near, "rep", "left")
    known = by_rep.groupBy("doc_id").agg(
        F.min(F.coalesce("class_id", "rep")).alias("class_id"),
        F.min("rep").alias("copy_of"),
        F.max(F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).cast("long").alias("n_links"),
    )
    nameless = documents.filter(F.col("doc_id").isNull()).select(
        F.col("doc_id").cast("long"), *[F.lit(None).cast("long").alias(c) for c in ("class_id", "copy_of", "n_links")]
    )
    return known.unionByName(nameless)


def keep_one_per_class(documents: DataFrame, **settings) -> DataFrame:
    """One row of each class of linked texts: that of the smallest id, null ids last, and of an id's texts that of the smallest digest.

    Texts are linked by what they hold, whatever their ids: an id with several unlike
    texts keeps them all, and rows without an id take part.
    """
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    name = "__text_key"
    keyed = documents.withColumn(name, key)
    found = ngram_jaccard_join(keyed.select(F.col(name).alias("doc_id"), "text"), **settings)
    classes = materialise(found.select(F.col("doc_id").alias(name), "class_id"))
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", name)
    first = keyed.select("doc_id", name).join(classes, name).groupBy("class_id").agg(F.min(order).alias("first"))
    stay = materialise(first.select(F.col("first.doc_id").alias("__id"), F.col(f"first.{name}").alias("__key")))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col(name) == F.col("__key"))
    return keyed.join(stay, same, "left_semi").dropDuplicates(["doc_id", name]).select(documents.columns)
