"""Gold commits, contracts, contest rules and scoring variants on small tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gridmart.functions import scoring
from gridmart.operators.contracts import ColumnRule, Contract, check_partitions, contract_rules, passing_partitions
from gridmart.operators.crosswalk import enrich_names, resolve_ids
from gridmart.operators.override import override_join
from gridmart.operators.scoring import contest_points, step_points
from gridmart.plans.environment import team_roof_games, team_roof_games_by_week
from gridmart.plans.lake import promote
from gridmart.sources.gold import PartitionExists, manifest, read_gold, write_gold
from gridmart.sources.lake import read_drifting_dataset
from gridmart.sources.rules import CLASSIC, DST_SCORING, SHOWDOWN
from gridmart.sources.specs import DatasetSpec

GOLD = "season INT, week INT, team STRING, n INT"


def _rows(df):
    return sorted(((r.season, r.week, r.team, r.n) for r in df.collect()), key=str)


def test_gold_second_run_replaces_its_partitions_only(spark, tmp_dir):
    first = [(2040, 1, "A", 1), (2040, 1, "B", 2), (2040, 2, "A", 3), (None, 9, "A", 4)]
    log = write_gold(spark.createDataFrame(first, GOLD), tmp_dir, "m", "r1", ["team"])
    assert sorted((r.week, r.row_count) for r in log.collect()) == [(1, 2), (2, 1), (9, 1)]
    write_gold(spark.createDataFrame([(2040, 1, "C", 7), (None, 9, "B", 8)], GOLD), tmp_dir, "m", "r2", ["team"])
    assert _rows(read_gold(spark, tmp_dir, "m")) == sorted([(2040, 1, "C", 7), (2040, 2, "A", 3), (None, 9, "B", 8)], key=str)
    assert _rows(read_gold(spark, tmp_dir, "m", {"week": [2]})) == [(2040, 2, "A", 3)]


def test_gold_refuses_committed_partitions(spark, tmp_dir):
    write_gold(spark.createDataFrame([(2040, 1, "A", 1)], GOLD), tmp_dir, "m", "r1", ["team"], replace=False)
    write_gold(spark.createDataFrame([(2040, 2, "A", 2)], GOLD), tmp_dir, "m", "r2", ["team"], replace=False)
    with pytest.raises(PartitionExists, match="'week': 2"):
        write_gold(spark.createDataFrame([(2040, 2, "A", 9), (2040, 3, "A", 9)], GOLD), tmp_dir, "m", "r3", ["team"],
                   replace=False)
    assert _rows(read_gold(spark, tmp_dir, "m")) == [(2040, 1, "A", 1), (2040, 2, "A", 2)]


def test_gold_failed_run_leaves_the_table(spark, tmp_dir):
    write_gold(spark.createDataFrame([(2040, 1, "A", 1)], GOLD), tmp_dir, "m", "r1", ["team"])
    broken = spark.createDataFrame([(2040, 1, "A", 2), (2040, 2, "A", 0)], GOLD).withColumn(
        "n", F.when(F.col("n") > 0, F.col("n")).otherwise(F.raise_error(F.lit("lost"))).cast("int"))
    with pytest.raises(Exception, match="lost"):
        write_gold(broken, tmp_dir, "m", "r2", ["team"])
    assert _rows(read_gold(spark, tmp_dir, "m")) == [(2040, 1, "A", 1)]
    # Data without a manifest row, as a run that died before its commit leaves it.
    spark.createDataFrame([(2040, 5, "Z", 1)], GOLD).write.partitionBy("season", "week").parquet(f"{tmp_dir}/gold/m/data/run=r9")
    assert _rows(read_gold(spark, tmp_dir, "m")) == [(2040, 1, "A", 1)]
    with pytest.raises(Exception, match="(?i)exists"):
        write_gold(spark.createDataFrame([(2040, 1, "A", 3)], GOLD), tmp_dir, "m", "r1", ["team"])


def test_gold_empty_batch(spark, tmp_dir):
    write_gold(spark.createDataFrame([(2040, 1, "A", 1)], GOLD), tmp_dir, "m", "r1", ["team"])
    write_gold(spark.createDataFrame([], GOLD), tmp_dir, "m", "r2", ["team"])
    assert manifest(spark, tmp_dir, "m").count() == 1 and _rows(read_gold(spark, tmp_dir, "m")) == [(2040, 1, "A", 1)]
    with pytest.raises(FileNotFoundError):
        read_gold(spark, tmp_dir, "other")


def test_contract_counts_by_partition(spark):
    rows = [(1, "g", "7"), (1, None, "8"), (2, "h", "x"), (2, "i", "2.5"), (2, "i", "0"), (3, "j", "4"), (3, "k", None),
            (None, "l", "9")]
    df = spark.createDataFrame(rows, "year INT, game_id STRING, play_id STRING")
    contract = Contract({"game_id": ColumnRule("string", nullable=False), "play_id": ColumnRule("bigint", least=1)})
    rules = contract_rules(df, contract)
    report = check_partitions(df, rules, ["year"])
    got = {r.year: (r.row_count, r.violations, r.failed) for r in report.collect()}
    assert got == {1: (2, 1, {"game_id_not_null": 1}), 2: (3, 3, {"play_id_bigint": 2, "play_id_ge_1": 2}),
                   3: (2, 1, {"play_id_ge_1": 1}), None: (1, 0, {})}
    assert [r.game_id for r in passing_partitions(df, report, ["year"]).collect()] == ["l"]
    missing = contract_rules(df.drop("play_id"), contract)
    assert check_partitions(df, missing, ["year"]).agg(F.sum("violations")).first()[0] == len(rows)


PLAYS = DatasetSpec("pbp", ("year",), ("game_id", "play_id"))


def test_promotion_skips_and_records_failing_partitions(spark, tmp_dir):
    cols = "year INT, game_id STRING, play_id INT, epa FLOAT"
    promote(spark, tmp_dir, spark.createDataFrame([(2040, "g", 1, 0.5), (2041, "h", 1, 0.5)], cols), PLAYS)
    late = spark.createDataFrame([(2040, "g", 2, 1.5), (2041, "h", 0, 2.5), (2042, "i", 3, 2.5)],
                                 cols.replace("FLOAT", "DOUBLE"))
    log = {r.year: r for r in promote(spark, tmp_dir, late, PLAYS, on_violation="skip").collect()}
    assert {y: (r.status, r.row_count, r.rows_seen, r.violations) for y, r in log.items()} == {
        2040: ("ok", 2, 2, 0), 2041: ("skipped", 0, 2, 1), 2042: ("ok", 1, 1, 0)}
    assert log[2041].failed == {"play_id_ge_1": 1}
    # 2041 keeps its first silver (FLOAT), the others are DOUBLE: read together.
    silver = read_drifting_dataset(spark, tmp_dir, "silver", "pbp")
    assert sorted((r.year, r.play_id, r.epa) for r in silver.collect()) == [
        (2040, 1, 0.5), (2040, 2, 1.5), (2041, 1, 0.5), (2042, 3, 2.5)]


def test_override_join(spark):
    base = spark.createDataFrame([(1, "grass"), (2, None), (3, "clay"), (None, "turf")], "k INT, own STRING")
    better = spark.createDataFrame([(1, "b"), (1, "c"), (2, None), (4, "x"), (None, "y")], "k INT, v STRING")
    got = override_join(base, better, ["k"], {"s": (F.max("v"), "own")}, "schedule", "plays")
    assert sorted(((r.k, r.s, r.s_source) for r in got.collect()), key=str) == sorted(
        [(1, "c", "plays"), (2, None, None), (3, "clay", "schedule"), (None, "turf", "schedule")], key=str)


def test_roof_games(spark):
    games = spark.createDataFrame(
        [(2024, 1, "REG", "g1", "A", "B", "open"), (2025, 1, "REG", "g2", "A", "B", "open"),
         (2025, 1, "REG", "g3", "B", "A", "outdoors"), (2025, 2, "POST", "g4", "A", "B", "dome")],
        "season INT, week INT, game_type STRING, game_id STRING, home_team STRING, away_team STRING, roof STRING")
    plays = spark.createDataFrame(
        [(2024, 1, "REG", "g1", "dome", 0.0), (2025, 1, "REG", "g3", None, 1.0)],
        "season INT, week INT, season_type STRING, game_id STRING, roof STRING, play DOUBLE")
    weeks = {(r.season, r.team, r.side): (r.roof_class, r.games, r.games_from_plays)
             for r in team_roof_games_by_week(plays, games).collect()}
    # g1's only row is no play; g3's plays name no roof, which overrides the schedule.
    assert weeks == {(2024, "A", "HOME"): ("RETRACTABLE", 1, 0), (2024, "B", "AWAY"): ("RETRACTABLE", 1, 0),
                     (2025, "A", "HOME"): ("INDOOR", 1, 0), (2025, "B", "AWAY"): ("INDOOR", 1, 0),
                     (2025, "B", "HOME"): ("UNKNOWN", 1, 1), (2025, "A", "AWAY"): ("UNKNOWN", 1, 1)}
    seasons = {(r.season, r.team, r.roof_class): r.games for r in team_roof_games(plays, games).collect()}
    assert seasons[2025, "A", "RETRACTABLE"] == 1 and seasons[2025, "A", "UNKNOWN"] == 1


def test_steps_and_contests(spark):
    df = spark.createDataFrame([(x,) for x in (-3, 0, 1, 6, 7, 13, 20, 27, 28, 34, 35, 90, None)], "x INT")
    got = [r.p for r in df.select(step_points(F.col("x"), DST_SCORING["points_allowed"]).alias("p")).collect()]
    assert got == [10, 10, 7, 7, 4, 4, 1, 0, -1, -1, -4, -4, 0]
    offense = ["passing_tds", "passing_yards", "interceptions", "rushing_tds", "rushing_yards", "receiving_tds",
               "receiving_yards", "receptions", "special_teams_tds", "rushing_fumbles_lost", "receiving_fumbles_lost",
               "sack_fumbles_lost", "passing_2pt_conversions", "rushing_2pt_conversions", "receiving_2pt_conversions"]
    own = [f"kicker_{k}" for k in SHOWDOWN["scoring"]["kicker"]] + [f"dst_{k}" for k in DST_SCORING]
    blank = {c: 0 for c in offense + own}
    stats = spark.createDataFrame([
        {"id": "qb", "position": "QB", **blank, "passing_yards": 300, "passing_tds": 2},
        {"id": "k", "position": "K", **blank, "kicker_fg_50_plus": 2, "kicker_pat": 3},
        {"id": "d", "position": "DST", **blank, "dst_sack": 4, "dst_points_allowed": 3}])
    points = {(r.contest, r.id, r.slot): r.points
              for n, doc in (("c", CLASSIC), ("s", SHOWDOWN)) for r in contest_points(stats, ["id"], doc, n).collect()}
    assert points == {("c", "qb", None): 23.0, ("c", "d", None): 11.0, ("s", "qb", "CPT"): 34.5, ("s", "qb", "FLEX"): 23.0,
                      ("s", "k", "CPT"): 19.5, ("s", "k", "FLEX"): 13.0, ("s", "d", "CPT"): 16.5, ("s", "d", "FLEX"): 11.0}


def test_passer_rating_clamps_and_return_touchdowns(spark):
    rows = [(30, 30, 600, 8, 0), (0, 30, 0, 0, 30), (20, 30, 225, 2, 1), (0, 0, 0, 0, 0)]
    df = spark.createDataFrame(rows, "c INT, a INT, y INT, t INT, i INT")
    got = [r.r for r in df.select(scoring.passer_rating("c", "a", "y", "t", "i").alias("r")).collect()]
    assert got[0] == pytest.approx(158.3333333) and got[1] == 0.0 and got[3] is None
    assert got[2] == pytest.approx(((20 / 30 - 0.3) * 5 + (7.5 - 3) * 0.25 + 2 / 30 * 20 + 2.375 - 25 / 30) / 6 * 100)
    lines = spark.createDataFrame([(1, 2, 1, 100)], "kick_return_tds INT, punt_return_tds INT, fumbles_lost INT, rushing_yards INT")
    assert lines.select(scoring.dk_returns(lines.columns).alias("p")).first().p == pytest.approx(18 - 1 + 10 + 3)


def test_names_are_enriched_in_promotion(spark, tmp_dir):
    batch = spark.createDataFrame([(2040, 1, "a", "T", None), (2040, 1, "b", "T", "own"), (2040, 1, "c", "T", None)],
                                  "season INT, week INT, player_id STRING, team STRING, player_name STRING")
    rosters = spark.createDataFrame([("a", "Zed"), ("a", "Abe"), ("b", "No")], "id STRING, n STRING")
    players = spark.createDataFrame([("a", "Late"), ("c", "Cee"), ("c", None)], "id STRING, n STRING")
    spec = DatasetSpec("weekly", ("season",), ("season", "week", "player_id", "team"))
    promote(spark, tmp_dir, batch, spec, enrich=lambda df: enrich_names(
        df, "player_id", [("rosters", rosters, "id", "n"), ("players", players, "id", "n")], source="name_source"))
    got = {r.player_id: (r.player_name, r.name_source) for r in read_drifting_dataset(spark, tmp_dir, "silver", "weekly").collect()}
    assert got == {"a": ("Abe", "rosters"), "b": ("own", None), "c": ("Cee", "players")}


def test_crosswalk_says_what_resolved(spark):
    rows = spark.createDataFrame([("g1", "p1"), (" ", "p1"), (None, "p9")], "gsis STRING, pfr STRING")
    lookup = spark.createDataFrame([("g7", "p1"), ("g8", "p1")], "gsis_id STRING, pfr_id STRING")
    got = resolve_ids(rows, lookup, [("gsis", "gsis_id"), ("pfr", "pfr_id")], source="by").collect()
    assert sorted(((r.resolved_id, r.by) for r in got), key=str) == sorted([("g1", "gsis"), ("g7", "pfr"), (None, None)], key=str)
