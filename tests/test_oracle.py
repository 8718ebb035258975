"""Every registered query equals its DuckDB oracle on the sf0.001 tables (the driver's check)."""

import os

import pytest

import __spark_entry__ as entry
from oracle_harness import compare, duck
from starloom.plans import catalog

SF = os.environ.get("STARLOOM_TEST_SF", "/root/testdata/sf0.001")
NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    # The training-data queries that SQL cannot express have tests of their own.
    assert set(catalog.ORACLE) == set(catalog.QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "month", "category", "revenue", "lines", "units"]
    assert df.count() > 0
