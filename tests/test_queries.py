"""Every registered query against its SQL on the smallest supplied data."""

import pytest

import __spark_entry__ as entry_module
from gridloom.queries.catalog import all_queries
from tests.compare import assert_same, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, con, name):
    q = all_queries()[name]
    df = q(spark, FOLDER)
    if q.check is None:
        assert df.count() > 0
    else:
        assert_same(df, con, q.check)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["ID", "course1", "course2"]
    assert df.count() > 0


def test_every_check_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
