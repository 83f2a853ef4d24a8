"""Every registered query against its SQL on the smallest supplied data."""

import pytest

import __spark_entry__ as entry
from check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_sql(spark, con, name):
    ok, note = compare(spark, con, name, SF_DIR)
    spark.catalog.clearCache()
    assert ok, note
