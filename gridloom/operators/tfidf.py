"""TF-IDF over uni- and bigrams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions.text import preprocess_text
from gridloom.sources.scratch import materialise


def ngrams(words: str, low: int = 1, high: int = 2) -> Column:
    """All word n-grams of an array column, in text order per length.

    ``words`` must be a column, not an expression: it is read once per n-gram.
    """
    w = F.col(words)

    def of_length(n: int) -> Column:
        starts = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - n + 1))
        return F.transform(
            F.coalesce(starts, F.array().cast("array<int>")), lambda i: F.array_join(F.slice(w, i, n), " ")
        )

    return F.concat(*[w if n == 1 else of_length(n) for n in range(low, high + 1)])


def clean_words(col: str) -> Column:
    return preprocess_text(col)


#: Words that are counted at once; only a longer row makes a larger piece.
PIECE_WORDS = 1 << 20


def _pieces(lists: pa.ListArray) -> Iterator[tuple[int, int]]:
    """(first, end) rows of a batch that hold about ``PIECE_WORDS`` words."""
    upto = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    row = 0
    while row < len(lists):
        before = upto[row - 1] if row else 0
        end = max(row + 1, int(np.searchsorted(upto, before + PIECE_WORDS, "right")))
        yield row, end
        row = end


def _counted(lists: pa.ListArray, low: int, high: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct n-grams of some rows; and for each pair of a row and one of its n-grams the row, the n-gram's place and its count."""
    words, row = lists.flatten(), pc.list_parent_indices(lists).to_numpy()
    row, coded = row[words.is_valid().to_numpy(zero_copy_only=False)], words.drop_null().dictionary_encode()
    base, code = coded.dictionary, coded.indices.to_numpy()
    size = np.int64(len(base) or 1)
    grams, pairs, place = base, code.astype(np.int64), code  # of the n-grams that start at each word
    terms, found, offset = [], [], 0
    for n in range(1, high + 1):
        if n > 1:
            starts = np.flatnonzero(row[: max(len(row) - n + 1, 0)] == row[n - 1 :])
            ids = np.full(len(row), -1, np.int64)
            ids[starts] = pairs[starts] * size + code[starts + n - 1]
            made, at = np.unique(ids[starts], return_inverse=True)
            grams = pc.binary_join_element_wise(grams.take(pa.array(made // size)), base.take(pa.array(made % size)), " ")
            pairs, place = np.zeros(len(row), np.int64), at
            pairs[starts] = at
        else:
            starts = np.arange(len(row))
        if n >= low:
            found.append((row[starts], offset + place))
            terms.append(grams)
            offset += len(grams)
    terms, rows, at = pa.concat_arrays(terms), *(np.concatenate(x) for x in zip(*found, strict=True))
    if pc.any(pc.match_substring(base, " ")).as_py():  # n-grams of several lengths may be spelt alike
        coded = terms.dictionary_encode()
        terms, at = coded.dictionary, coded.indices.to_numpy()[at]
    width = np.int64(len(terms) or 1)
    pair, tf = np.unique(rows * width + at, return_counts=True)
    return terms, pair // width, pair % width, tf


def term_counts(
    df: DataFrame, key: str, words: str, low: int = 1, high: int = 2, among: Sequence[str] | None = None
) -> DataFrame:
    """(key, term, tf), of the terms in ``among`` only where given; ``key`` is unique.

    A row's n-grams are counted in its own task, over Arrow batches, so counting
    needs no shuffle. Null words are no terms.
    """
    wanted = None if among is None else pa.array(among, pa.string())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end in _pieces(batch.column(1)):
                terms, row, at, tf = _counted(batch.column(1).slice(first, end - first), low, high)
                if wanted is not None:
                    kept = pc.is_in(terms, value_set=wanted).to_numpy(zero_copy_only=False)[at]
                    row, at, tf = row[kept], at[kept], tf[kept]
                columns = [batch.column(0).take(pa.array(row + first)), terms.take(pa.array(at)), pa.array(tf, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=[key, "term", "tf"])

    schema = T.StructType([df.schema[key], T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())])
    return df.select(key, words).mapInArrow(count, schema)


def term_totals(df: DataFrame, words: str, low: int = 1, high: int = 2) -> DataFrame:
    """(term, df, freq): rows that hold a term and how often all of them do. Each task adds up what it counts at once before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end in _pieces(batch.column(0)):
                terms, _, at, tf = _counted(batch.column(0).slice(first, end - first), low, high)
                rows, freq = np.bincount(at, minlength=len(terms)), np.bincount(at, tf, len(terms)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([terms, pa.array(rows, pa.int64()), pa.array(freq)], names=["term", "df", "freq"])

    counted = df.select(words).mapInArrow(count, "term string, df long, freq long")
    return counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("freq").alias("freq"))


def smooth_idf(n_docs: int, df: Column) -> Column:
    return F.log((F.lit(1.0) + F.lit(n_docs)) / (F.lit(1.0) + df)) + F.lit(1.0)


@dataclass(frozen=True)
class TfIdf:
    """Fitted vocabulary: (term, idf), at most ``max_features`` rows."""

    vocabulary: DataFrame
    max_features: int | None
    ngram_range: tuple[int, int]

    @staticmethod
    def fit(
        train: DataFrame,
        key: str,
        words: str,
        max_features: int | None = 5000,
        min_df: int | float = 10,
        max_df: int | float = 0.8,
        ngram_range: tuple[int, int] = (1, 2),
    ) -> "TfIdf":
        """Keep terms in [min_df, max_df] documents, most frequent ones first.

        Whole numbers count documents, fractions are shares of the documents.
        """
        n_docs = train.count()
        low = min_df if isinstance(min_df, int) else min_df * n_docs
        high = max_df if isinstance(max_df, int) else max_df * n_docs
        idf = smooth_idf(n_docs, F.col("df"))
        terms = term_totals(train, words, *ngram_range).filter((F.col("df") >= low) & (F.col("df") <= high))
        if max_features is not None:
            terms = terms.orderBy(F.col("freq").desc(), "term").limit(max_features)
        return TfIdf(materialise(terms.select("term", idf.alias("idf"))), max_features, ngram_range)

    def transform(self, df: DataFrame, key: str, words: str) -> DataFrame:
        """(key, term, weight): tf * idf, scaled to unit length per row."""
        # A vocabulary of bounded length goes along; only its terms leave the tasks.
        bounded = self.max_features is not None
        known = [r["term"] for r in self.vocabulary.select("term").collect()] if bounded else None
        raw = (
            term_counts(df, key, words, *self.ngram_range, known)
            .join(self.vocabulary, "term")  # a written table: its real size and AQE's skew handling pick the join
            .select(key, "term", (F.col("tf") * F.col("idf")).alias("__w"))
        )
        # The only shuffle. One document's terms: at most the vocabulary, all from one row.
        norm = F.sqrt(F.sum(F.col("__w") * F.col("__w")).over(Window.partitionBy(key)))
        return raw.select(key, "term", (F.col("__w") / norm).alias("weight"))


def tfidf(train: DataFrame, other: DataFrame, key: str, text: str, **options) -> DataFrame:
    """Fit on the cleaned train text, return the weights of ``other``."""
    a, b = (df.select(key, clean_words(text).alias("__words")) for df in (train, other))
    return TfIdf.fit(a, key, "__words", **options).transform(b, key, "__words")
