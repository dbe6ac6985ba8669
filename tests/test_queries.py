"""Every registered query against its SQL twin, on the smallest tables."""

import os

import pytest

import __spark_entry__ as driver
from linesmith.plans.catalog import all_queries
from .oracle import compare, connect

FOLDER = os.environ.get("LINESMITH_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, con, name):
    out = compare(spark, con, FOLDER, name, all_queries()[name])
    assert out["problem"] == "" and out["rows"] > 0


def test_driver_contract(spark):
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(all_queries()) <= set(driver.oracle_sql())
    df = driver.entry(spark)
    assert df.columns[:5] == ["game_id", "team_id", "season", "week", "rotation"] and df.count() > 0


