"""Football marts on literal fixtures, scoring spot checks and invariants."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from gridmart.functions import scoring
from gridmart.operators.scoring import score_by_rules, score_with_rules
from gridmart.plans import adapters as ad
from gridmart.plans import marts as m
from gridmart.sources.rules import RULE_METRICS, rules_frame, rules_rows

SMOKE = "/root/testdata/sf0.001"

WEEKLY = ("season INT, week INT, season_type STRING, team STRING, player_id STRING, source STRING, "
          "player_name STRING, position STRING, passing_yards DOUBLE, passing_tds BIGINT, interceptions DOUBLE, "
          "rushing_yards DOUBLE, rushing_tds BIGINT, receiving_yards DOUBLE, receiving_tds BIGINT, "
          "receptions BIGINT, rushing_fumbles_lost DOUBLE, receiving_fumbles_lost DOUBLE, sack_fumbles_lost BIGINT, "
          "special_teams_tds DOUBLE, passing_2pt_conversions BIGINT, rushing_2pt_conversions BIGINT, "
          "receiving_2pt_conversions BIGINT, targets BIGINT")


def _weekly(spark):
    rows = [
        # QB with 310 passing yards: DK bonus applies
        (2024, 1, "REG", "BUF", "Q1", "feed", "Q One", "QB", 310.0, 3, 1.0, 20.0, 0, 0.0, 0, 0, 0.0, 0.0, 1, 0.0, 1, 0, 0, 0),
        # same key, NULL source: the dedupe keeps the row with a source
        (2024, 1, "REG", "BUF", "Q1", None, "Q One", "QB", 999.0, 9, 0.0, 0.0, 0, 0.0, 0, 0, 0.0, 0.0, 0, 0.0, 0, 0, 0, 0),
        (2024, 1, "REG", "BUF", "W1", "feed", "W One", "WR", 0.0, 0, 0.0, 0.0, 0, 105.0, 1, 7, 0.0, 1.0, 0, 0.0, 0, 0, 1, 9),
        (2024, 1, "REG", "BUF", "W2", "feed", "W Two", "WR", 0.0, 0, 0.0, 0.0, 0, 40.0, 0, 3, 0.0, 0.0, 0, 0.0, 0, 0, 0, 4),
    ]
    return spark.createDataFrame(rows, WEEKLY)


PBP = ("year INT, season INT, week INT, season_type STRING, game_id STRING, posteam STRING, pass DOUBLE, "
       "rush DOUBLE, rush_attempt DOUBLE, receiver_player_id STRING, rusher_player_id STRING, air_yards DOUBLE, "
       "yardline_100 BIGINT, down INT, ydstogo INT, half_seconds_remaining INT, shotgun DOUBLE, no_huddle DOUBLE, "
       "offense_personnel STRING")


def _pbp(spark):
    rows = [
        (2024, 2024, 1, "REG", "g", "BUF", 1.0, 0.0, 0.0, "W1", None, 12.0, 8, 3, 6, 100, 1.0, 0.0, "11"),
        (2024, 2024, 1, "REG", "g", "BUF", 1.0, 0.0, 0.0, "W1", None, 30.0, 25, 1, 10, 900, 0.0, 0.0, "12"),
        (2024, 2024, 1, "REG", "g", "BUF", 1.0, 0.0, 0.0, "W2", None, None, 50, 2, 1, 1000, 1.0, 1.0, "11"),
        (2024, 2024, 1, "REG", "g", "BUF", 1.0, 0.0, 0.0, None, None, None, 50, 2, 1, 1000, 0.0, 0.0, "11"),
        (2024, 2024, 1, "REG", "g", "BUF", 0.0, 1.0, 1.0, None, "Q1", None, 4, 1, 10, 800, 0.0, 0.0, "21"),
    ]
    return spark.createDataFrame(rows, PBP)


def test_scoring_spot_values(spark):
    w = m.dedupe_weekly(_weekly(spark))
    got = {r.player_id: r for r in w.select("player_id", scoring.ppr().alias("ppr"),
                                              scoring.dk_ppr().alias("dk")).collect()}
    # QB: .04*310 + 4*3 - 2*1 + .1*20 - 2*1 fumble = 22.4 PPR
    assert got["Q1"].ppr == pytest.approx(22.4)
    # DK: .04*310 + 12 - 1 + 2 - 1 + 2 (2pt) + 3 (300+ bonus) = 29.4
    assert got["Q1"].dk == pytest.approx(29.4)
    # WR1: 10.5 + 6 + 7 - 1 + 2 + 3 (100+ receiving) = 27.5
    assert got["W1"].dk == pytest.approx(27.5)


def test_rules_scoring_equals_formula(spark):
    w = m.dedupe_weekly(_weekly(spark))
    metrics = sorted({c for cols in RULE_METRICS.values() for c in cols})
    by_rules = {r.player_id: r.points for r in score_by_rules(w, m.WEEK_KEY, rules_frame(spark), metrics).collect()}
    by_code = {r.player_id: r.dk for r in w.select("player_id", scoring.dk_ppr().alias("dk")).collect()}
    compiled = {r.player_id: r.points for r in score_with_rules(w, rules_rows()).collect()}
    assert by_rules.keys() == by_code.keys() == compiled.keys()
    for k in by_code:
        assert by_rules[k] == pytest.approx(by_code[k])
        assert compiled[k] == pytest.approx(by_code[k])


def test_receiving_utilization_shares(spark):
    out = {r.player_id: r for r in m.receiving_utilization(_weekly(spark), _pbp(spark)).collect()}
    w1 = out["W1"]
    assert w1.targets == 2 and w1.target_share == pytest.approx(2 / 3)
    assert w1.rz20_targets == 1 and w1.end_zone_targets == 2   # 8 - 12 <= 0 and 25 - 30 <= 0
    assert w1.adot == pytest.approx(21.0)
    assert out["W2"].adot is None                                # no air yards on its target
    assert out["Q1"].targets == 0 and out["Q1"].target_share == 0.0
    assert w1.shotgun_target_share == pytest.approx(0.5)


def test_rushing_utilization(spark):
    out = {r.player_id: r for r in m.rushing_utilization(_weekly(spark), _pbp(spark)).collect()}
    assert out["Q1"].carries == 1 and out["Q1"].carry_share == 1.0 and out["Q1"].rz5_carry_share == 1.0
    assert out["W1"].carries == 0 and out["W1"].carry_share == 0.0


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")
def test_target_shares_sum_to_one(spark):
    util = m.receiving_utilization(ad.weekly_view(spark, SMOKE), ad.plays_view(spark, SMOKE))
    sums = util.groupBy("season", "week", "team").agg(F.sum("target_share").alias("s")).filter(F.col("s").isNotNull())
    bad = sums.filter(F.abs(F.col("s") - 1) > 1e-3).count()
    # Each team-week's weekly roster covers every targeted player, so the shares sum to 1.
    assert bad == 0


def test_rate_over_expected_gives_seasons_and_their_weeks(spark):
    """the season's rates of true plays beside every week's dropbacks outside the last two minutes."""
    from gridmart.plans.league import rate_over_expected

    rows = [(2024, 1, "A", 1.0, 0.0, 0.5, 50.0, 900.0), (2024, 1, "A", 0.0, 1.0, 0.25, -25.0, 900.0),
            (2024, 2, "A", 1.0, 0.0, 0.75, 25.0, 600.0), (2024, 2, "A", 1.0, 0.0, 0.75, 25.0, 100.0),
            (2024, 1, "B", 1.0, 0.0, 0.5, 50.0, 60.0)]
    pbp = spark.createDataFrame(rows, "season int, week int, posteam string, pass double, rush_attempt double, xpass double, "
                                      "pass_oe double, half_seconds_remaining double").selectExpr(
        "*", "1.0D AS play", "0.0D AS aborted_play", "0.0D AS qb_spike", "0.0D AS qb_kneel", "0.0D AS play_deleted")
    got = {(r["team"], r["week"]): r for r in rate_over_expected(pbp).collect()}
    assert set(got) == {("A", 1), ("A", 2), ("B", None)}
    first = got["A", 1]
    assert (first["pass_rate"], first["proe"], first["plays"], first["week_proe"], first["sec_per_play_proxy"]) == (
        0.75, 18.75, 2, 0.125, 900.0)
    assert got["A", 2]["plays"] == 1 and got["B", None]["plays"] is None and got["B", None]["pass_rate"] == 1.0


LINES = ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, "
         "l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP")


def _tables(spark, at: str) -> str:
    """Small driver tables with null keys and flags, a repeated part, order and line, and keys that meet nothing."""
    flags, states = ("N", "R", "A", None), ("O", "F", None)
    lines = [(o or None, p, o % 3 + 1, n, float((7 * o + n) % 50 + 1), 9.0, (o % 11) / 100, (n % 9) / 100, flags[(o + n) % 4],
              states[(o * n) % 3], None)
             for o in (1, 2, 3, 4, 5, 0, 99) for n, p in enumerate((10, 11, 12, 10, None, 77, -5), 1)]
    lines += [(1, 10, None, 1, None, 9.0, None, None, "N", "O", None), lines[0], lines[9]]
    write = {
        "lineitem": (lines, LINES),
        "orders": ([(1, 1, "1994-01-03"), (2, 2, "1994-01-09"), (2, 2, "1994-02-09"), (3, 3, "1995-07-01"), (4, 1, None),
                    (5, 8, "1994-01-20"), (None, 1, "1994-01-20")],
                   "o_orderkey BIGINT, o_custkey BIGINT, day STRING"),
        "customer": ([(1, 1), (2, 2), (3, None), (None, 1)], "c_custkey BIGINT, c_nationkey INT"),
        "supplier": ([(1, 1), (2, 2), (3, 3), (None, 2)], "s_suppkey BIGINT, s_nationkey INT"),
        "nation": ([(1, "ASH"), (2, None), (3, "OAK"), (None, "ELM")], "n_nationkey INT, n_name STRING"),
        "part": ([(10, "ten", "MEDIUM"), (11, "eleven", "LARGE"), (11, "again", "LARGE"), (12, None, None), (-5, "minus", "ECONOMY"),
                  (None, "none", "LARGE")], "p_partkey BIGINT, p_name STRING, p_type STRING")}
    for name, (rows, schema) in write.items():
        df = spark.createDataFrame(rows, schema)
        if name == "orders":
            df = df.select("o_orderkey", "o_custkey", F.lit("F").alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"),
                           F.col("day").cast("timestamp").alias("o_orderdate"), F.lit("2-HIGH").alias("o_orderpriority"))
        df.coalesce(1).write.parquet(f"{at}/{name}.parquet")
    return at


def _bag(df, columns=None):
    return sorted(map(str, df.select(*(columns or df.columns)).collect()))


def test_views_of_lines_by_player_are_the_views(spark, tmp_dir):
    """The same rows from lines dealt by their player, with null and repeated keys."""
    sf = _tables(spark, tmp_dir)
    own, met = ad.player_lines(spark, sf), ad.player_lines(spark, sf, opponent=True)
    assert _bag(ad.weekly_view(spark, sf, met)) == _bag(ad.weekly_view(spark, sf)) != []
    assert _bag(ad.snap_counts_view(spark, sf, ad.player_lines(spark, sf, []))) == _bag(ad.snap_counts_view(spark, sf)) != []
    assert _bag(ad.ngs_receiving_view(spark, sf, own)) == _bag(ad.ngs_receiving_view(spark, sf)) != []
    plays = ad.plays_view(spark, sf, met)
    there = [c for c in plays.columns if c != "player_id"]
    assert {"game_id", "posteam", "xpass", "drive_time_of_possession", "receiver_player_id"} <= {*there}
    assert _bag(plays, there) == _bag(ad.plays_view(spark, sf), there) != []
    rows, usual = (ad.player_rows(spark, sf, m.ALL_COLUMNS, m.MEASURES["all"], lines=x) for x in (own, None))
    assert _bag(rows, usual.columns) == _bag(usual) != []
    for context in ("attempts", "flags"):
        found = [m.player_week_utilization(ad.weekly_view(spark, sf, x), ad.plays_view(spark, sf, x),
                                           ad.snap_counts_view(spark, sf), context=context) for x in (met, None)]
        assert _bag(found[0]) == _bag(found[1]) != []


def test_lines_by_player_have_no_opponent_rows_or_drives(spark, tmp_dir):
    lines = ad.player_lines(spark, _tables(spark, tmp_dir))
    with pytest.raises(ValueError, match="no opponents and no drives"):
        ad.player_rows(spark, tmp_dir, ["opponent_team"], m.MEASURES["all"], lines=lines)
