"""Every registered query runs; those with SQL give the same rows as DuckDB."""

import compare
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.duck(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    rows, problem = compare.compare(spark, con, name, QUERIES[name], SQL.get(name), FOLDER)
    assert problem is None, problem
    assert rows > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
