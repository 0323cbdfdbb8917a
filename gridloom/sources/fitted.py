"""Fitted objects of this library as folders: one JSON line of numbers, and a Parquet table for each table they hold."""

from __future__ import annotations

import json
from dataclasses import fields, is_dataclass
from importlib import import_module

import numpy as np
from pyspark.sql import DataFrame, SparkSession

_PACKAGE = __name__.split(".")[0]


def save_fitted(fitted, path: str, spark: SparkSession) -> None:
    """Write a dataclass of this library; what is at ``path`` already is an error."""
    tables: dict[str, DataFrame] = {}
    line = json.dumps(_packed(fitted, tables))
    for name, table in tables.items():
        table.write.parquet(f"{path}/{name}")
    # The settings come last: a folder that has them is whole.
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.text(f"{path}/settings")


def load_fitted(path: str, spark: SparkSession):
    line = spark.read.text(f"{path}/settings", wholetext=True).first()[0]
    return _unpacked(json.loads(line), path, spark)


def _packed(value, tables: dict[str, DataFrame]):
    if isinstance(value, DataFrame):
        name = f"table{len(tables)}"
        tables[name] = value
        return {"table": name}
    if isinstance(value, np.ndarray):
        return {"array": value.tolist(), "type": value.dtype.str}
    if is_dataclass(value):
        kind = type(value)
        if kind.__module__.split(".")[0] != _PACKAGE:
            raise TypeError(f"{kind.__name__} is not a class of this library")
        return {"class": [kind.__module__, kind.__name__], "fields": {f.name: _packed(getattr(value, f.name), tables) for f in fields(value)}}
    if isinstance(value, (tuple, list)):
        return {type(value).__name__: [_packed(v, tables) for v in value]}
    if value is None or isinstance(value, (bool, int, float, str)):
        return {"value": value}
    raise TypeError(f"a {type(value).__name__} cannot be saved")


def _unpacked(packed: dict, path: str, spark: SparkSession):
    if "table" in packed:
        return spark.read.parquet(f"{path}/{packed['table']}")
    if "array" in packed:
        return np.array(packed["array"], packed["type"])
    if "class" in packed:
        module, name = packed["class"]
        if module.split(".")[0] != _PACKAGE:
            raise TypeError(f"{module}.{name} is not a class of this library")
        return getattr(import_module(module), name)(**{k: _unpacked(v, path, spark) for k, v in packed["fields"].items()})
    for kind in (tuple, list):
        if kind.__name__ in packed:
            return kind(_unpacked(v, path, spark) for v in packed[kind.__name__])
    return packed["value"]
