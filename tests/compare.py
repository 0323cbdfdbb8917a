"""Compare a Spark result with a DuckDB result, column order and row order aside."""

from __future__ import annotations

import math

import duckdb

from gridloom.queries.inputs import TABLES

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(_value(row[i])) for i in order) for row in rows)


def assert_same(df, con, sql):
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    types = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    assert sorted(types) == sorted(df.columns)
    for f in df.schema.fields:
        assert TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) == types[f.name], f.name
    cur = con.execute(sql)
    want = _rows([c[0] for c in cur.description], cur.fetchall())
    assert len(got) == len(want)
    assert got == want
