"""Wide <-> long operators, list operators and coordinate tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.sources.scratch import materialise


def unpivot(df: DataFrame, index: Sequence[str], on: Sequence[str], variable: str, value: str) -> DataFrame:
    return df.unpivot(list(index), list(on), variable, value)


def list_get(col: str, i: int) -> Column:
    """List element, null past the end."""
    return F.get(F.col(col), i)


def collect_ordered(df: DataFrame, key: str, value: str, order: Sequence[str], name: str) -> DataFrame:
    """Values per key as a list in key order.

    Meant for groups with a small natural bound (an applicant's places, a row's
    own tokens): the list of a group is one value of one row.
    """
    items = F.sort_array(F.collect_list(F.struct(*order, F.col(value).alias("__value"))))
    return df.groupBy(key).agg(F.transform(items, lambda x: x["__value"]).alias(name))


def to_wide(
    df: DataFrame, assignments: DataFrame, required: str, id_out: str = "ID"
) -> DataFrame:
    """One row per id with its first two courses; ids without one keep nulls."""
    courses = collect_ordered(assignments, "id", "course", ["wave", "pref_order"], "courses")
    return df.select("id", required).join(courses, "id", "left").select(
        F.col("id").alias(id_out),
        list_get("courses", 0).alias("course1"),
        list_get("courses", 1).alias("course2"),
        required,
    )


def finalize_result(wide: DataFrame, required: str) -> DataFrame:
    """Labels for slots: "???" = unfilled, "-" = not required."""
    return wide.select(
        "ID",
        F.coalesce("course1", F.lit("???")).alias("course1"),
        F.when(F.col(required) == 1, "-").otherwise(F.coalesce("course2", F.lit("???"))).alias("course2"),
    )


def to_arrays(coords: DataFrame, key: str, size: int, name: str = "features") -> DataFrame:
    """(key, col, value) coordinates -> one dense array of ``size`` per key.

    Equal coordinates must already be summed, so a key has at most ``size`` rows.
    """
    cell = F.struct(F.col("col").cast("int").alias("col"), F.col("value").cast("double").alias("value"))
    end = F.struct(F.lit(size).alias("col"), F.lit(0.0).alias("value"))
    sorted_cells = F.concat(F.array_sort(F.collect_list(cell)), F.array(end))

    def gap_and_cell(c: Column, i: Column) -> Column:
        """Zeros since the cell before, then the cell; one pass, whatever the width."""
        before = F.coalesce(F.get("__cells", i - 1)["col"], F.lit(-1))
        return F.concat(F.array_repeat(F.lit(0.0), c["col"] - before - 1), F.array(c["value"]))

    dense = F.slice(F.flatten(F.transform("__cells", gap_and_cell)), 1, size)
    return coords.groupBy(key).agg(sorted_cells.alias("__cells")).select(key, dense.alias(name))


def sparse_rows(coords: DataFrame, key: str, size: int, name: str = "features", rows: DataFrame | None = None) -> DataFrame:
    """(key, col, value) coordinates -> the parts of one sparse vector of ``size`` per key.

    One grouped aggregate: a key's row holds its own cells and nothing of the
    width. With ``rows`` every key of theirs has a row, empty where it has no
    coordinates, beside their other columns. Equal coordinates must already be summed.
    """
    cell = F.struct(F.col("col").cast("int").alias("col"), F.col("value").cast("double").alias("value"))
    cells = coords.groupBy(key).agg(F.sort_array(F.collect_list(cell)).alias("__cells"))
    if rows is not None:
        cells = rows.join(cells, key, "left")
    known = F.coalesce("__cells", F.array().cast("array<struct<col:int,value:double>>"))
    parts = F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).cast("int").alias("size"),
        F.transform(known, lambda x: x["col"]).alias("indices"), F.transform(known, lambda x: x["value"]).alias("values"),
    )
    return cells.select(*[c for c in cells.columns if c != "__cells"], parts.alias(name))


def as_vectors(df: DataFrame, name: str = "features") -> DataFrame:
    """The written table with the parts that ``sparse_rows`` gives read as Spark ML vectors.

    Parquet stores a vector as these parts, so reading under the vector's type is
    all the conversion there is: no function runs over the rows.
    """
    fields = [T.StructField(f.name, VectorUDT() if f.name == name else f.dataType) for f in df.schema.fields]
    return materialise(df, T.StructType(fields))


def to_vectors(coords: DataFrame, key: str, size: int, name: str = "features", rows: DataFrame | None = None) -> DataFrame:
    """``sparse_rows`` as a column of sparse vectors."""
    return as_vectors(sparse_rows(coords, key, size, name, rows), name)


def combine_blocks(keyed: DataFrame, blocks: Sequence[str], out: str = "features") -> DataFrame:
    """Join several vector / numeric columns of a keyed table into one vector."""
    if not blocks:
        raise ValueError("no feature block was given")
    return VectorAssembler(inputCols=list(blocks), outputCol=out, handleInvalid="error").transform(keyed)
