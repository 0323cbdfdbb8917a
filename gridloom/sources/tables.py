"""Typed readers for delimited and Parquet tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: How texts are quoted, on writing and on reading.
CSV_TEXT = {"quote": '"', "escape": '"', "emptyValue": '""', "nullValue": ""}


def read_csv(
    spark: SparkSession, path: str, schema: str | T.StructType | None = None, sep: str = ",", infer: bool = False, line_breaks: bool = True
) -> DataFrame:
    """Delimited table with a header; a large file is read by many tasks.

    Quoted texts may hold line breaks (``read_records``); a file without any is read faster
    with ``line_breaks`` off. The schema is given, or guessed by a further pass where
    ``infer`` asks for it; that pass reads each file in one task if there may be line breaks.
    """
    if (schema is None) != infer:
        raise ValueError("give a schema, or ask for it to be inferred")
    # The reader stands its null value for a missing field, so that must differ from an empty text.
    options = CSV_TEXT | {"emptyValue": "", "nullValue": "\0", "sep": sep}
    reader = spark.read.options(**options, header=True, multiLine=line_breaks and infer, inferSchema=infer)
    if infer:
        schema = reader.csv(path).schema
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    if not line_breaks:
        return reader.schema(schema).csv(path)
    # The parser's line is the whole record; the header is a record of its own.
    row = F.from_csv("record", F.lit(schema.simpleString()), {**options, "mode": "PERMISSIVE"})
    return read_records(spark, path).select(row.alias("__row")).select("__row.*")


_AT = "file string, block long"


def _counter():
    """Number of quotes of each split in a task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, int], int] = {}
        for batch in batches:
            n = pc.count_substring(batch.column(2), '"').to_pylist()
            for file, block, quotes in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), n, strict=True):
                counts[file, block] = counts.get((file, block), 0) + (quotes or 0)
        columns = [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.int64()), pa.array(list(counts.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["file", "block", "quotes"])

    return count


def _cutter(open_splits, header: bool):
    """Records of each split; ``open_splits`` is a broadcast set of the splits that begin inside a quoted text.

    What belongs to a record of an earlier split comes as a ``head`` (the record ends here) or as
    ``through`` (it does not), what goes on in the next split as a ``tail``.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple[str, int] | None = None
        inside, held, first = False, [], False
        rows: list[tuple[str, int, str, str]] = []

        def close() -> None:
            if held and now:
                rows.append((*now, "through" if first == "head" else "tail", "\n".join(held)))
                held.clear()

        def flush() -> pa.RecordBatch:
            columns = [list(c) for c in zip(*rows, strict=True)] if rows else [[], [], [], []]
            rows.clear()
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "block", "part", "record"])

        for batch in batches:
            odd = pc.bit_wise_and(pc.count_substring(batch.column(2), '"'), 1).to_pylist()
            for file, block, line, turns in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), odd, strict=True):
                if (file, block) != now:
                    close()
                    now, inside = (file, block), (file, block) in open_splits.value
                    first = "head" if inside else "header" if header and block == 0 else ""
                inside ^= bool(turns)
                held.append(line)
                if inside:
                    continue
                record = "\n".join(held)
                held.clear()
                if first != "header" and (record.rstrip("\r") or first == "head"):
                    rows.append((file, block, first, record))
                first = ""
            yield flush()
        close()
        yield flush()

    return cut


def read_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """(record): the records of delimited files whose quoted texts may hold line breaks, each file in many tasks.

    A first pass counts the quotes of each split: an odd number before a split says that it begins
    inside a quoted text. The second pass cuts every split into records; only what crosses
    a split's end, two pieces a split at most, is shuffled and joined. The driver holds the splits that
    begin inside a quoted text. Quotes stand around texts only, doubled inside them.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))
    counted = lines.mapInArrow(_counter(), _AT + ", quotes long").groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins_open = counted.withColumn("open", F.sum("quotes").over(before) % 2 == 1).filter("open").select("file", "block").collect()
    found = spark.sparkContext.broadcast({(r["file"], r["block"]) for r in begins_open})
    cut = lines.mapInArrow(_cutter(found, header), _AT + ", part string, record string")
    if not begins_open:
        return cut.select("record")
    # Pieces of a record follow each other: a tail opens it, a head ends it; inside a split the head stands first.
    order = F.when(F.col("part") == "tail", 1).otherwise(0)
    nth = F.sum(order).over(Window.partitionBy("file").orderBy("block", order).rowsBetween(Window.unboundedPreceding, 0))
    pieces = cut.filter("part != ''").withColumns({"nth": nth, "at": order})
    joined = pieces.groupBy("file", "nth").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "at", "record"))), lambda p: p["record"]), "\n").alias("record"))
    return cut.filter("part = ''").select("record").unionAll(joined.select("record"))


def read_parquet(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_table(spark: SparkSession, path: str, schema: str | T.StructType | None = None) -> DataFrame:
    """Survey-style input: CSV or Parquet by file name."""
    if path.endswith(".csv"):
        if schema is None:
            raise ValueError("a CSV table needs a schema")
        return read_csv(spark, path, schema)
    return read_parquet(spark, path, schema)
