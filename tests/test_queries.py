"""Every registered query against its SQL on the smallest sample."""

import os

import pytest

import __spark_entry__ as contract
from landledger.sample_queries import QUERIES as REGISTERED
from tests.compare import connect, duck_rows, spark_rows

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SQL = contract.oracle_sql()
QUERIES = {name: build for name, build in contract.queries().items() if name in REGISTERED}


@pytest.fixture(scope="module")
def duck():
    con = connect(FOLDER)
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(REGISTERED) and set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, name):
    columns, rows = spark_rows(QUERIES[name](spark, FOLDER))
    expected_columns, expected = duck_rows(duck, SQL[name])
    assert columns == expected_columns
    assert rows == expected


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[:3] == ["zone_name", "plot_number", "company_name"]
    assert df.count() == 855
