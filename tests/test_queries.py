"""Every registered query against its SQL, and the entry points."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from verify import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    outcome, rows = compare(spark, con, QUERIES[name], SQL.get(name), SF)
    assert outcome in ("ok", "rows only") and rows > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_sql_names_registered_queries():
    assert set(SQL) <= set(QUERIES)
