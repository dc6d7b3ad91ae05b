"""Every registered query against its SQL, or for rows where SQL cannot express it."""

import os

import pytest
from oracle import ORACLES, QUERIES, connect, spark_rows, sql_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", ORACLES)
def test_query_gives_the_rows_of_its_sql(spark, con, name):
    assert spark_rows(spark, name, SF_DIR) == sql_rows(con, name)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_query_without_sql_gives_rows(spark, name):
    assert spark_rows(spark, name, SF_DIR)


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 6_000
