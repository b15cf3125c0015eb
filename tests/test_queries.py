"""Every registered query against its SQL twin on the given tables."""

import os
from pathlib import Path

import pytest

import __spark_entry__ as driver
from tests import oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    assert Path(SF_DIR).exists(), f"no test tables in {SF_DIR}"
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, con, name):
    df = driver.queries()[name](spark, SF_DIR)
    sql = driver.oracle_sql().get(name)
    if sql is None:
        assert not df.isEmpty()
    else:
        assert oracle.differences(df, con, sql) is None


def test_oracles_belong_to_queries():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_results_are_not_trivially_empty(con):
    empty = [name for name, sql in driver.oracle_sql().items() if con.execute(sql).fetchone() is None]
    assert empty == []


def test_entry(spark):
    df = driver.entry(spark)
    assert oracle.differences(df, oracle.connect(driver.SMOKE_DIR), driver.oracle_sql()["mention_leaderboard"]) is None
    assert not df.isEmpty()
