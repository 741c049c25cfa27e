"""Every registered query against its SQL in DuckDB."""

import os

import pytest
from compare import connect, difference

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert difference(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_has_rows(spark, name):
    assert queries()[name](spark, SF_DIR).limit(1).count() == 1


def test_entry(spark):
    rows = entry(spark).collect()
    assert rows and rows[0]["total"] >= rows[-1]["total"]
