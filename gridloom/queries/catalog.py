"""Name -> (query, check) registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from gridloom.queries.inputs import Tables, sql

MODULES = ("relational", "shaping", "learning")


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    check: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


_found: dict[str, Query] = {}


def query(name: str, check: str | None = None) -> Callable:
    """Register a query with the SQL that must give the same rows."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in _found:
            raise ValueError(f"query {name} is registered twice")
        _found[name] = Query(build, sql(check) if check else None)
        return build

    return register


@lru_cache(maxsize=1)
def all_queries() -> dict[str, Query]:
    for module in MODULES:
        import_module(f"gridloom.queries.{module}")
    return dict(_found)
