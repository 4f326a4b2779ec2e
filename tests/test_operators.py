"""Operator unit tests on literal frames (reference fixtures from FIXTURES.md where given)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridmart.functions.classify import ROOF_POLICIES, policy_classify
from gridmart.functions.columns import mmss_to_seconds, share, share0
from gridmart.operators.asof import asof_nearest
from gridmart.operators.dedupe import dedupe_first, mode_per_key
from gridmart.operators.grid import expand, grid_fill
from gridmart.operators.lineup import best_lineup, tie_break_chain
from gridmart.operators.periods import full_reconcile, next_period
from gridmart.operators.quality import key_fingerprint, profile
from gridmart.operators.stats import effect_ci, histogram


def test_nearest_game_week(spark):
    # FIXTURES: schedule (BUF, 2024-09-07, week 1); events on 09-01 and 09-08 -> weeks [1, 1]
    sched = spark.createDataFrame([("BUF", dt.datetime(2024, 9, 7), 1)], "team STRING, game_date TIMESTAMP, week INT")
    ev = spark.createDataFrame([(1, "BUF", dt.datetime(2024, 9, 1, 17)), (2, "BUF", dt.datetime(2024, 9, 8, 17))],
                               "id INT, team STRING, dt TIMESTAMP")
    out = asof_nearest(ev, sched, ["team"], "dt", "game_date", 6 * 86400).orderBy("id")
    assert [r.week for r in out.collect()] == [1, 1]


def test_asof_tie_prefers_earlier_and_tolerance(spark):
    right = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 10)), ("a", dt.datetime(2024, 1, 1, 14))],
                                  "k STRING, rt TIMESTAMP").withColumn("tag", F.hour("rt"))
    left = spark.createDataFrame([(1, "a", dt.datetime(2024, 1, 1, 12)), (2, "a", dt.datetime(2024, 1, 3, 12))],
                                 "id INT, k STRING, lt TIMESTAMP")
    out = {r.id: r.tag for r in asof_nearest(left, right, ["k"], "lt", "rt", 3 * 3600).collect()}
    assert out == {1: 10, 2: None}


def test_dedupe_nulls_last(spark):
    df = spark.createDataFrame([(1, None, 5), (1, "nflverse", 7)], "k INT, source STRING, v INT")
    assert dedupe_first(df, ["k"], "source").first().v == 7


def test_mode_ties_smallest(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, None)], "k INT, name STRING")
    assert [(r.k, r.name) for r in mode_per_key(df, ["k"], "name").collect()] == [(1, "a")]


def test_grid_fill_zero(spark):
    spine = spark.createDataFrame([("NYJ",), ("DAL",)], "team STRING")
    facts = spark.createDataFrame([("NYJ", "WR", 25.0)], "team STRING, position STRING, pts DOUBLE")
    grid = expand(spine, "position", ["WR", "RB"])
    out = {(r.team, r.position): r.pts for r in grid_fill(grid, facts, ["team", "position"], {"pts": 0.0}).collect()}
    assert out == {("NYJ", "WR"): 25.0, ("NYJ", "RB"): 0.0, ("DAL", "WR"): 0.0, ("DAL", "RB"): 0.0}


def test_share_helpers(spark):
    df = spark.createDataFrame([(1, 0), (1, 2), (None, 2)], "n INT, d INT")
    got = [(r.a, r.b) for r in df.select(share("n", "d").alias("a"), share0("n", "d").alias("b")).collect()]
    assert got == [(None, 0.0), (0.5, 0.5), (None, 0.0)]


def test_mmss(spark):
    df = spark.createDataFrame([("2:35",), ("bad",)], "t STRING")
    assert [r.s for r in df.select(mmss_to_seconds("t").alias("s")).collect()] == [155.0, None]


def test_roof_policies(spark):
    df = spark.createDataFrame([("open",), ("dome",)], "roof STRING")
    a = [r.c for r in df.select(policy_classify("roof", ROOF_POLICIES, "open_is_outdoor").alias("c")).collect()]
    b = [r.c for r in df.select(policy_classify("roof", ROOF_POLICIES, "open_is_retractable").alias("c")).collect()]
    assert a == ["OUTDOOR", "INDOOR"] and b == ["RETRACTABLE", "INDOOR"]


def test_next_period_and_reconcile(spark):
    s = spark.createDataFrame([("A", 2020, 300), ("A", 2021, 250), ("B", 2021, 10)], "p STRING, season INT, carries INT")
    out = {(r.p, r.season): r.carries_next for r in next_period(s, ["p"], "season", ["carries"]).collect()}
    assert out == {("A", 2020): 250, ("A", 2021): None, ("B", 2021): None}
    a = spark.createDataFrame([("x", 10), ("y", 5)], "k STRING, a INT")
    b = spark.createDataFrame([("x", 7), ("z", 1)], "k STRING, b INT")
    diffs = {r.k: r.diff for r in full_reconcile(a, b, ["k"], "a", "b").collect()}
    assert diffs == {"x": 3, "y": 5, "z": -1}


def test_profile_null_keys(spark):
    # FIXTURES: (2024,A,1),(NULL,NULL,2) -> key nulls 1, unique 2, duplicate 0
    df = spark.createDataFrame([(2024, "A", 1), (None, None, 2)], "season INT, player_id STRING, v INT")
    r = profile(df, ["season", "player_id"]).first()
    assert (r.rows, r.key_unique_rows, r.key_duplicate_rows, r.key_null_rows) == (2, 2, 0, 1)
    df2 = spark.createDataFrame([(2023, "A", 10.0), (2023, "A", 5.0), (2024, "B", None)],
                                "season INT, player_id STRING, value DOUBLE")
    r2 = profile(df2, ["season", "player_id"]).first()
    assert (r2.rows, r2.key_unique_rows, r2.key_duplicate_rows) == (3, 2, 1)
    assert r2.key_duplicate_ratio == pytest.approx(1 / 3)


def test_fingerprint_order_independent(spark):
    df = spark.createDataFrame([(i, f"k{i}") for i in range(50)], "i INT, k STRING")
    a = key_fingerprint(df, ["k"]).first()
    b = key_fingerprint(df.repartition(7).orderBy(F.desc("i")), ["k"]).first()
    assert a == b


def test_effect_ci_and_histogram(spark):
    df = spark.createDataFrame([(1, 0, 2.0), (1, 1, 4.0), (0, 1, 6.0)], "a INT, b INT, y DOUBLE")
    out = {r.event: r for r in effect_ci(df, [], ["a", "b"], "y").collect()}
    assert out["a"].n == 2 and out["a"].mean_effect == 3.0
    assert out["a"].ci_lo == pytest.approx(3.0 - 1.96 * (2 ** 0.5) / (2 ** 0.5))
    h = histogram(spark.createDataFrame([(float(x),) for x in range(10)], "x DOUBLE"), "x", 5)
    assert sorted((r.bin, r.n) for r in h.collect()) == [(0, 2), (1, 2), (2, 2), (3, 2), (4, 2)]


def test_best_lineup_and_chain(spark):
    rows = [(1, "q1", "QB", 20.0), (1, "q2", "QB", 10.0), (1, "r1", "RB", 15.0), (1, "r2", "RB", 12.0),
            (1, "r3", "RB", 11.0), (1, "w1", "WR", 9.0), (1, "t1", "TE", 5.0), (1, "t2", "TE", 4.0)]
    c = spark.createDataFrame(rows, "entry INT, player STRING, pos STRING, pts DOUBLE")
    lu = {r.slot: r.player for r in best_lineup(c, ["entry"], "player", "pos", "pts").collect()}
    assert lu == {"QB1": "q1", "RB1": "r1", "RB2": "r2", "WR1": "w1", "TE1": "t1", "FLEX": "r3"}
    s = spark.createDataFrame([("A", 1, 10.0), ("A", 2, 5.0), ("B", 1, 8.0), ("B", 2, 7.0)],
                              "entry STRING, week INT, score DOUBLE")
    placed = {r.entry: r.place for r in tie_break_chain(s, [], "entry", "score").collect()}
    assert placed == {"A": 1, "B": 2}  # equal totals; A's best week is higher
