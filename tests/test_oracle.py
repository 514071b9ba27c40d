"""The correctness gate: every registered query against its SQL oracle at
sf0.01 (exact equality of values, order-insensitive)."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import sql_oracle
from conftest import SF_ORACLE, SF_SMALL
from martlane.plans.registry import QUERIES
from oracle_harness import compare, duck

ORACLE = sql_oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    res = compare(spark, con, key, QUERIES[key], ORACLE[key], SF_ORACLE)
    assert res["ok"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].total_orders > 0
    assert SF_SMALL in entry.SMOKE_DIR
