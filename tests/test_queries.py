"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from catalog.registry import ORACLE, QUERIES
from tests.compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_sql(spark, con, key):
    df = QUERIES[key](spark, SF_DIR)
    assert difference(df, con, ORACLE[key]) is None


@pytest.mark.parametrize("key", ["q11_strict_timestamps", "q14_keep_latest", "q21_replace_windows"])
def test_session_zone_changes_nothing(spark, con, key):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        test_query_matches_sql(spark, con, key)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_entry(spark):
    out = contract.entry(spark)
    assert out.columns == ["app_id", "attribution_type", "rows", "revenue"]
    assert out.count() == 4
