"""Length buckets that minimise padding, and token-budget batches inside them.

The histogram of lengths is counted over all rows; a dynamic program over it
finds the ``buckets`` upper bounds with the least total padding. A batch of a
bucket holds as many rows as fit the token budget at the bucket's bound. Rows
are numbered inside a bucket without gathering it: hash slices of bounded size
are numbered on their own and start where the earlier slices end.

The driver holds the histogram only, one entry for each distinct length: n of them
need at least n * (n - 1) / 2 words in the table, so they grow with its square root at most.

Defined cases: a null or empty text has length 0; a row longer than the budget
is a batch of its own; fewer distinct lengths than buckets give one bucket for
each; repeated rows are packed one by one; an empty table gives an empty result.
Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.sources.scratch import materialise

BUCKETS = 16
BUDGET = 65_536
ROWS_PER_SLICE = 2_048
SEED = 17


def word_length(text: Column) -> Column:
    """Length in words; any tokenizer's length column can take its place."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def best_bounds(lengths: np.ndarray, counts: np.ndarray, totals: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds, ascending, that minimise sum(bound - length).

    ``lengths`` are distinct and ascending; ``totals`` the sums of the rows' lengths. The best split point moves right with the end (the
    cost meets the quadrangle inequality), so each layer halves its ranges.
    """
    n = len(lengths)
    if n == 0:
        return []
    c = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    s = np.concatenate([[0], np.cumsum(totals)]).astype(np.int64)
    best = np.concatenate([[0], lengths * c[1:] - s[1:]]).astype(np.int64)
    cuts = []
    for layer in range(1, min(buckets, n)):
        after, cut = best.copy(), np.zeros(n + 1, np.int64)
        todo = [(layer + 1, n, layer, n - 1)]
        while todo:
            lo, hi, left, right = todo.pop()
            if lo > hi:
                continue
            end = (lo + hi) // 2
            at = np.arange(left, min(right, end - 1) + 1)
            cost = best[at] + lengths[end - 1] * (c[end] - c[at]) - (s[end] - s[at])
            k = int(np.argmin(cost))
            after[end], cut[end] = cost[k], at[k]
            todo += [(lo, end - 1, left, int(at[k])), (end + 1, hi, int(at[k]), right)]
        best = after
        cuts.append(cut)
    bounds, end = [], n
    for cut in reversed(cuts):
        bounds.append(int(lengths[end - 1]))
        end = int(cut[end])
    return sorted([int(lengths[end - 1]), *bounds])


def plan_buckets(rows: DataFrame, buckets: int = BUCKETS) -> list[int]:
    counted = rows.groupBy("n_tokens").agg(F.count("*").alias("n")).orderBy("n_tokens").toPandas()
    lengths, counts = (counted[c].to_numpy(np.int64) for c in ("n_tokens", "n"))
    return best_bounds(lengths, counts, lengths * counts, buckets)


def pack(rows: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, seed: int = SEED) -> DataFrame:
    """From (doc_id, n_tokens): (doc_id, n_tokens, bucket, bound, batch, slot, padding).

    ``batch`` counts from 0 in its bucket, ``slot`` from 0 in its batch.
    """
    rows = materialise(rows.select("doc_id", F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens")))
    bounds = plan_buckets(rows, buckets)
    if not bounds:
        empty = [F.lit(None).cast("long").alias(c) for c in ("bucket", "bound", "batch", "slot", "padding")]
        return rows.select("*", *empty)
    bucket = F.lit(0).cast("long")
    for b in bounds[:-1]:
        bucket = bucket + (F.col("n_tokens") > b).cast("long")
    slices = max(1, -(-rows.count() // ROWS_PER_SLICE))
    order = F.xxhash64(F.lit(seed), "doc_id", "n_tokens")
    sliced = rows.withColumns({"bucket": bucket, "order": order}).withColumn("slice", F.pmod("order", F.lit(slices)))
    sizes = sliced.groupBy("bucket", "slice").count()
    earlier = Window.partitionBy("bucket").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialise(sizes.select("bucket", "slice", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("start")))
    inside = Window.partitionBy("bucket", "slice").orderBy("order", "doc_id", "n_tokens")
    placed = sliced.withColumn("nth", F.row_number().over(inside) - 1).join(starts, ["bucket", "slice"])
    bound = F.element_at(F.array(*[F.lit(b) for b in bounds]), (F.col("bucket") + 1).cast("int")).cast("long")
    room = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(budget) / F.greatest(F.col("bound"), F.lit(1))).cast("long"))
    placed = placed.withColumn("bound", bound).withColumns({"room": room, "at": F.col("start") + F.col("nth")})
    return placed.select(
        "doc_id",
        "n_tokens",
        "bucket",
        "bound",
        F.floor(F.col("at") / F.col("room")).cast("long").alias("batch"),
        F.pmod("at", "room").cast("long").alias("slot"),
        (F.col("bound") - F.col("n_tokens")).alias("padding"),
    )


def pack_documents(documents: DataFrame, **settings) -> DataFrame:
    return pack(documents.select("doc_id", word_length(F.col("text")).alias("n_tokens")), **settings)
