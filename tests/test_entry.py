"""Driver contract: entry runs on sf0.001, every oracle key has a query, names are unique."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_mod

SMOKE = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")
def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "points_allowed_ppr" in df.columns


def test_oracle_keys_subset_of_queries():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 90


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")
@pytest.mark.parametrize("name", ["tier_shares", "asof_nearest", "mart_util_receiving", "lag_gap_capped"])
def test_selected_queries_run_on_smoke_data(spark, name):
    assert entry_mod.queries()[name](spark, SMOKE).count() >= 0
