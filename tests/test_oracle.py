"""Every registered query against its SQL, on the driver tables."""

import os

import pytest
from harness import connect, difference, oracle_result, spark_result

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    actual = spark_result(entry.queries()[name](spark, SF_DIR))
    assert difference(actual, oracle_result(duck, ORACLES[name])) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
