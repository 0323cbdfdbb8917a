"""From raw documents to packed batches, one written table per stage.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor
kept, and returns the columns of ``documents``; the last one returns the batches.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from gridloom.llm.length_buckets import pack_documents
from gridloom.llm.mixing import mix_documents
from gridloom.llm.ngram_join import keep_one_per_class
from gridloom.llm.quality_rules import keep_good
from gridloom.llm.secret_scan import redact_secrets
from gridloom.sources.scratch import discard, materialise, written_paths

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left: list[str] = []


def _stage(work: Stage) -> Stage:
    """A stage that deletes what its predecessor wrote on the way: its ``docs`` have been written and reread."""

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(spark, _left)
        before = set(written_paths())
        result = work(spark, docs, sf_dir)
        _left[:] = [p for p in written_paths() if p not in before]
        return result

    return run_stage


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the perplexity band of their language."""
    return keep_good(docs)


@_stage
def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates."""
    return keep_one_per_class(docs)


@_stage
def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret's value replaced by a mark."""
    return redact_secrets(docs)


@_stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the budget of their source reads, once for each epoch."""
    mixed, name = mix_documents(docs)
    return mixed.drop(name)


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row's bucket, batch and slot."""
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("secret_scans", secret_scans),
    ("mixing", mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held: list[str] = []
    for _, stage in STAGES:
        result = stage(spark, docs, sf_dir)
        docs = materialise(result)
        discard(spark, held)
        held = written_paths()[-1:]
    return docs


#: MinHash bands and the perplexity model have no counterpart in SQL.
ORACLE_SQL = None
