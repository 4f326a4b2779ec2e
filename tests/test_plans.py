"""Plan checks: no cross products anywhere, pushed filters, partial
window limits, broadcasts only where bounded."""

from __future__ import annotations

import contextlib
import io
import os

import pytest

import __spark_entry__ as entry_mod
from gridmart.operators.quality import profile
from gridmart.plans import driver

SMOKE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="simple")
    return buf.getvalue()


# Queries that expand grids, attach global totals or join small dimensions. The full
# registry is checked the same way by ``scripts/check_no_cross_products.py``.
CROSS_PRODUCT_SUSPECTS = ("grid_fill", "mart_points_allowed", "histogram_bins", "effect_ci", "pos_tier_shares",
                          "share_of_total", "asof_nearest", "best_lineup", "league_by_week", "mart_util_receiving",
                          "policy_classify", "two_sided_unpivot", "tie_break_chain", "drift_union_read")


def test_no_cross_products(spark):
    bad = []
    qs = entry_mod.queries()
    for name in CROSS_PRODUCT_SUSPECTS:
        plan = _plan(qs[name](spark, SMOKE))
        if "CartesianProduct" in plan or "BroadcastNestedLoopJoin" in plan:
            bad.append(name)
    assert bad == []


def test_date_predicate_reaches_the_parquet_scan(spark):
    plan = _plan(entry_mod.queries()["scan_filter_prune"](spark, SMOKE))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_returnflag:string," in plan


def test_top1_windows_are_limited_before_the_shuffle(spark):
    for name in ("dedupe_first", "mode_per_key", "top_n_param"):
        plan = _plan(entry_mod.queries()[name](spark, SMOKE))
        assert "WindowGroupLimit" in plan and "Partial" in plan, name


def test_group_totals_use_aggregates_not_whole_group_windows(spark):
    plan = _plan(entry_mod.queries()["window_conditional_count"](spark, SMOKE))
    assert "Window [" not in plan and "partial_count" in plan


@pytest.mark.parametrize("name,scans", [("mart_points_allowed", 1), ("mart_player_week", 1), ("mart_util_receiving", 1),
                                        ("mart_util_rushing", 1), ("mart_util_wr", 1), ("mart_util_rb", 1),
                                        ("mart_util_all", 2)])
def test_marts_scan_the_lines_once(spark, name, scans):
    """Roles of one aggregate, and readers that reuse its exchange: counted in the executed plan."""
    df = entry_mod.queries()[name](spark, SMOKE)
    df.collect()
    executed = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert executed.count("FileScan parquet [l_") == scans


def _large(spark, name: str) -> str:
    """The plan of ``name`` where only the suppliers are small enough for a broadcast."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in before:
            spark.conf.set(k, "6000")
        return _plan(entry_mod.queries()[name](spark, "/root/testdata/sf0.01"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["league_by_class", "league_by_week", "league_per_game", "season_trends", "environment_splits"])
def test_games_are_grouped_where_their_plays_lie(spark, name):
    """The join by game is the last exchange of the plays."""
    exchanges = [line for line in _large(spark, name).splitlines() if "Exchange hashpartitioning(" in line]
    assert any("hashpartitioning(game_id" in line for line in exchanges)
    assert not [line for line in exchanges if "game_id" in line and "hashpartitioning(game_id" not in line]
    assert not [line for line in exchanges if "l_suppkey" in line or "o_custkey" in line and "l_" in line]


@pytest.mark.parametrize("name", ["calendar_effects", "team_context", "pos_tier_shares", "reconcile_names",
                                  "mart_util_player_week", "mart_util_wr_routes"])
def test_lines_are_not_shuffled_for_suppliers_or_team_weeks(spark, name):
    """Small sides come to the lines and to the players' rows."""
    shuffles = [line for line in _large(spark, name).splitlines() if "Exchange hashpartitioning(" in line]
    assert shuffles and not [line for line in shuffles if "l_suppkey" in line]
    assert name == "calendar_effects" or not [line for line in shuffles if "coalesce(team" in line]


def test_methods_too_large_for_the_jvm_are_not_fused(spark):
    """Stages above the compiler's 8000 bytes run operator by operator."""
    entry_mod.queries()["mart_player_week"](spark, SMOKE)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def _scans(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("FileScan parquet [l_")


def test_profile_reads_the_lines_once(spark):
    """rows, ends and keys are one aggregate; a key's duplicates and nulls count as before."""
    df = entry_mod.queries()["profile_partitions"](spark, SMOKE)
    df.collect()
    assert _scans(df) == 1
    rows = spark.createDataFrame([(2000, 1, 5), (2000, 1, 7), (2000, None, 6), (None, 1, 1)], "season int, id int, week int")
    got = profile(rows, ["id"], ["season"]).collect()
    assert [tuple(r) for r in got] == [(2000, 3, 5, 7, 2, 1, 1, 3, 1 / 3)]


@pytest.mark.parametrize("name", ["profile_partitions", "league_by_class", "environment_splits"])
def test_more_lines_get_more_partitions(spark, monkeypatch, name):
    """Many lines a core are dealt by their number, with the same rows."""
    build = entry_mod.queries()[name]
    few = build(spark, SMOKE)
    assert "REPARTITION_BY_NUM" not in _plan(few)
    monkeypatch.setattr(driver, "ORDER_LINES", 10)
    many = build(spark, SMOKE)
    assert "REPARTITION_BY_NUM" in _plan(many)
    assert sorted(map(str, many.collect())) == sorted(map(str, few.collect()))


def test_one_reader_computes_only_what_it_reads(spark):
    """the measures that no class row needs are pruned before the plays are grouped."""
    plan = _plan(entry_mod.queries()["league_by_class"](spark, SMOKE))
    assert "plays_pg" in plan and "neutral_xpass_sum" not in plan


UTILIZATION = ["player_season_utilization", "mart_util_player_week_flags", "mart_util_player_week", "mart_util_all"]


@pytest.mark.parametrize("name", UTILIZATION)
def test_players_are_grouped_and_joined_where_their_lines_lie(spark, name):
    """The lines move to their orders and to their players; nothing made of them by player moves again."""
    exchanges = [line for line in _large(spark, name).splitlines() if "Exchange hashpartitioning(" in line]
    assert any("hashpartitioning(concat(P, cast(l_partkey" in line for line in exchanges)
    assert not [line for line in exchanges if "player_id" in line or "__who" in line or "hashpartitioning(l_partkey" in line]


@pytest.mark.parametrize("name,scans", [("player_season_utilization", 1), ("mart_util_player_week", 2),
                                        ("mart_util_player_week_flags", 2)])
def test_views_of_one_query_share_the_lines(spark, name, scans):
    """Plays, stat lines, snaps and routes read one exchange (snaps of D65 / D71 their own)."""
    df = entry_mod.queries()[name](spark, SMOKE)
    df.collect()
    assert _scans(df) == scans


@pytest.mark.parametrize("name", UTILIZATION)
def test_lines_dealt_by_number_give_the_same_players(spark, monkeypatch, name):
    """Many lines a core are dealt by their number, with the same rows."""
    build = entry_mod.queries()[name]
    few = sorted(map(str, build(spark, SMOKE).collect()))
    monkeypatch.setattr(driver, "ORDER_LINES", 1000)
    many = build(spark, SMOKE)
    assert "REPARTITION_BY_NUM" in _plan(many)
    assert sorted(map(str, many.collect())) == few


def test_joins_are_shuffled_by_all_keys_again_for_the_next_query(spark):
    entry_mod.queries()["player_season_utilization"](spark, SMOKE)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "false"
    entry_mod.queries()["mart_util_rb"](spark, SMOKE)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
