"""Written tables that cut lineage and pin results which must be read twice.

The area is the shared folder the cluster names in ``spark.checkpoint.dir``, so
a table written here outlives any executor. Written tables are preferred to
``DataFrame.checkpoint()`` because later readers keep column pruning, filter
pushdown and real sizes, which AQE needs to choose a join.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_CONF = "spark.checkpoint.dir"
_written: list[str] = []
_tables: dict[str, str] = {}
_local_root: tempfile.TemporaryDirectory | None = None


def scratch_root(spark: SparkSession) -> str:
    """Folder for written tables; a temporary one only when the master is local."""
    global _local_root
    root = spark.conf.get(_CONF, None) or spark.sparkContext.getConf().get(_CONF)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CONF} to a folder that every executor can reach")
    if _local_root is None:
        _local_root = tempfile.TemporaryDirectory(prefix="gridloom-")
    return _local_root.name


def scratch_path(spark: SparkSession, name: str = "table") -> str:
    """A new path in the scratch area that ``clear_scratch`` will delete."""
    path = f"{scratch_root(spark)}/gridloom-{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialise(df: DataFrame, schema: StructType | None = None, by: str | None = None) -> DataFrame:
    """Write ``df`` once to the scratch area and return a reader of that copy, under ``schema`` if given.

    Each value of ``by`` gets a folder of its own, so a filter on it reads no other.

    The size of the copy is known from its files, so a small fitted table joins
    by broadcast straight away, and a large one does not.
    """
    path = scratch_path(df.sparkSession)
    df.write.parquet(path, partitionBy=by)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


def materialise_by(df: DataFrame, column: str) -> DataFrame:
    """``materialise`` with all rows of a value of ``column`` in one bucket.

    A later grouping or window by that column, alone or with others, reads the buckets
    as they lie and shuffles nothing. The copy is a table of the session's catalog;
    ``discard`` drops it with its files.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    name = "gridloom_" + path.rsplit("-", 1)[1]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").option("path", path).bucketBy(buckets, column).saveAsTable(name)
    _tables[path] = name
    return spark.table(name)


def written_paths() -> list[str]:
    """What this process has written and not deleted, oldest first."""
    return list(_written)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete written tables that no later read needs."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for name in paths:
        if name in _tables:
            spark.sql(f"DROP TABLE IF EXISTS {_tables.pop(name)}")
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
        if name in _written:
            _written.remove(name)


def clear_scratch(spark: SparkSession) -> int:
    """Delete what this process has written; returns how many paths."""
    paths = written_paths()
    discard(spark, paths)
    return len(paths)
