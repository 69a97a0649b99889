"""Driver contract: entry smoke run, and every plan with SQL agrees with
DuckDB on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck

SMALL = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert set(df.columns) >= {"episode_id", "funny_mean", "sad_change"}


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_plan_matches_oracle(spark, con, key):
    r = compare(E.queries()[key](spark, SMALL), con, E.oracle_sql()[key])
    assert r["ok"], r


@pytest.mark.parametrize("key", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only_plans_run(spark, key):
    assert E.queries()[key](spark, SMALL).count() >= 0
