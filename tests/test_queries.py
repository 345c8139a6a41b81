"""Every registered query with SQL, on the smallest sample, against DuckDB."""

import pytest
from sql_compare import TESTDATA, compare, connect

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_against_sql(spark, con, name):
    got, want = compare(spark, con, FOLDER, queries()[name], oracle_sql()[name])
    assert got == want


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_runs(spark, name):
    queries()[name](spark, FOLDER).collect()


def test_entry(spark):
    assert entry(spark).count() > 0
