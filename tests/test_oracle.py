"""Every registered query with a DuckDB statement, compared by value on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, duck

ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, sf, con, name):
    assert compare(queries()[name](spark, sf), con, ORACLE[name]).startswith("ok")


def test_every_statement_has_a_query():
    assert set(ORACLE) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
