"""Every registered query against its DuckDB oracle on the sf0.01 tables."""

import os

import pytest

import __spark_entry__ as entry
from hourglass_oracles import ORACLES
from hourglass_queries import QUERIES
from oracle_compare import compare, duck

SF = os.environ.get("HOURGLASS_TEST_SF", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    problems, _ = compare(QUERIES[name](spark, SF), con, ORACLES[name])
    assert not problems, problems


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test data not present")
def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "Week_PV" in df.columns


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", ["planned_hours", "forecast_hours", "l3_to_l2_rollup", "actuals_cascade", "ledger_live"])
def test_ledger_without_broadcasts_matches_oracle(spark, con, name):
    """With broadcasting disabled the ledger arms join by shuffles. Same results."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        problems, _ = compare(QUERIES[name](spark, SF), con, ORACLES[name])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not problems, problems
