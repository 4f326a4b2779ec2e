"""Lake maintenance on temp directories."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.operators.schema import common_type, normalise_common, union_harmonised
from gridmart.plans.lake import (apply_silver_rule, bronze_batch, dedupe_silver, lineage_latest, promote,
                                 stamp)
from gridmart.sources.lake import list_partitions, read_dataset, read_drifting, write_partitions
from gridmart.sources.specs import CATALOG, DatasetSpec

WEEKLY_TEST = DatasetSpec("weekly", ("season", "week"), ("season", "week", "player_id"))
SCHEMA = "season INT, week INT, player_id STRING, recent_team STRING, team STRING, targets INT, ingested_at STRING"


def _batch(spark, *rows):
    """Rows (week, player, targets, day of September 2035)."""
    return spark.createDataFrame([(2035, w, p, "ASH", "ASH", t, f"2035-09-{day:02d} 12:00:00") for w, p, t, day in rows],
                                 SCHEMA).withColumn("ingested_at", F.to_timestamp("ingested_at"))


def test_promote_newer_row_wins_and_only_touched_partitions_change(spark, tmp_dir):
    root = os.path.join(tmp_dir, "lake")
    promote(spark, root, _batch(spark, (3, "m1", 6, 10), (3, "m2", 2, 10), (4, "m1", 7, 17)), WEEKLY_TEST)
    stats = promote(spark, root, _batch(spark, (3, "m1", 11, 12), (3, "m2", 99, 8), (3, "m3", 1, 12)), WEEKLY_TEST)
    silver = read_dataset(spark, root, "silver", "weekly")
    rows = {(r.week, r.player_id): r.targets for r in silver.collect()}
    # m2's second row is older than the one in silver.
    assert rows == {(3, "m1"): 11, (3, "m2"): 2, (3, "m3"): 1, (4, "m1"): 7}
    assert [(r.season, r.week, r.row_count) for r in stats.collect()] == [(2035, 3, 3)]


def test_promote_twice_is_idempotent(spark, tmp_dir):
    root = os.path.join(tmp_dir, "lake")
    b = _batch(spark, (3, "m1", 6, 10), (5, "m1", 8, 24))
    promote(spark, root, b, WEEKLY_TEST)
    before = sorted(map(str, read_dataset(spark, root, "silver", "weekly").collect()))
    promote(spark, root, b, WEEKLY_TEST)
    assert sorted(map(str, read_dataset(spark, root, "silver", "weekly").collect())) == before


def test_promote_raises_on_violation(spark, tmp_dir):
    bad = spark.createDataFrame([(2024, 1, None, "BUF", "BUF", 1, "2024-09-01T00:00:00Z")], SCHEMA)
    spec = DatasetSpec("pbp", ("season",), ("game_id", "play_id"))
    rows = bad.select("season", F.lit("g1").alias("game_id"), F.lit(0).alias("play_id"))
    with pytest.raises(ValueError, match="play_id_ge_1"):
        promote(spark, os.path.join(tmp_dir, "lake"), rows, spec, on_violation="raise")


def test_bronze_counts_and_changed_partitions(spark):
    rows = [(2024, 1, "A", "BUF", "BUF", 1, None), (2024, 1, "B", "BUF", "BUF", 2, None)]
    stamped, counts = bronze_batch(spark.createDataFrame(rows, SCHEMA), WEEKLY_TEST, "test", "r1",
                                   "2024-09-01 00:00:00")
    assert [tuple(r) for r in counts.collect()] == [(2024, 1, 2)]
    assert set(stamped.columns) >= {"source", "pipeline_version", "run_id", "ingested_at"}
    parts = list_partitions(spark.createDataFrame([(2024, 1), (2024, 2)], "season INT, week INT"),
                            ["season", "week"])
    assert sorted(r.partition for r in parts.collect()) == ["season=2024/week=1", "season=2024/week=2"]


def test_weekly_rule_renames_and_keeps_newest(spark):
    rows = [(2033, 6, "m7", "OAK", 4, "2033-10-03 09:00:00"), (2033, 6, "m7", "OAK", 9, "2033-10-05 09:00:00"),
            (2033, 6, "m7", "ELM", 1, "2033-10-09 09:00:00"), (2033, 6, "m7", "OAK", 5, None)]
    df = spark.createDataFrame(rows, "season INT, week INT, player_id STRING, recent_team STRING, targets INT, "
                                     "ingested_at STRING").withColumn("ingested_at", F.to_timestamp("ingested_at"))
    spec = CATALOG["weekly"]
    out = dedupe_silver(apply_silver_rule(df, spec), spec)
    assert {(r.team, r.targets) for r in out.collect()} == {("OAK", 9), ("ELM", 1)} and "recent_team" not in out.columns


def test_null_key_dropped_team_optional(spark):
    rows = [(2024, 1, None, "BUF"), (2024, 1, "A", "BUF"), (2024, 1, "B", None)]
    df = spark.createDataFrame(rows, "season INT, week INT, player_id STRING, team STRING")
    out = apply_silver_rule(df, CATALOG["rosters"]).collect()
    assert sorted(r.player_id for r in out) == ["A", "B"]


def test_void_column_becomes_string(spark):
    df = spark.createDataFrame([(1,)], "x INT").withColumn("notes", F.lit(None))
    assert dict(normalise_common(df).dtypes)["notes"] == "string"


def test_common_type_lattice():
    assert common_type(T.FloatType(), T.DoubleType()) == T.DoubleType()
    assert common_type(T.IntegerType(), T.LongType()) == T.LongType()
    assert common_type(T.BooleanType(), T.StringType()) == T.StringType()
    assert common_type(T.NullType(), T.DoubleType()) == T.DoubleType()
    assert common_type(T.BooleanType(), T.DoubleType()) == T.StringType()


def test_drifting_files_read_together(spark, tmp_dir):
    base = os.path.join(tmp_dir, "pbp")
    a = spark.createDataFrame([(1, 0.5, True)], "play_id BIGINT, epa FLOAT, was_pressure BOOLEAN")
    b = spark.createDataFrame([(2, 0.25, "yes")], "play_id BIGINT, epa DOUBLE, was_pressure STRING")
    a.write.parquet(os.path.join(base, "year=1999"))
    b.write.parquet(os.path.join(base, "year=2024"))
    out = read_drifting(spark, [os.path.join(base, "year=1999"), os.path.join(base, "year=2024")], base)
    assert dict(out.dtypes) == {"play_id": "bigint", "epa": "double", "was_pressure": "string", "year": "int"}
    assert sorted((r.year, r.was_pressure) for r in out.collect()) == [(1999, "true"), (2024, "yes")]


def test_dynamic_overwrite_keeps_other_partitions_and_null_partition_skip(spark, tmp_dir):
    spec = DatasetSpec("schedules", ("season",), ("game_id",))
    root = os.path.join(tmp_dir, "lake")
    df = spark.createDataFrame([(2023, "g1"), (2024, "g2"), (None, "g0")], "season INT, game_id STRING")
    write_partitions(df, root, "silver", spec)
    write_partitions(spark.createDataFrame([(2024, "g3")], "season INT, game_id STRING"), root, "silver", spec)
    got = {(r.season, r.game_id) for r in read_dataset(spark, root, "silver", "schedules").collect()}
    assert got == {(2023, "g1"), (2024, "g3"), (None, "g0")}
    kept = read_dataset(spark, root, "silver", "schedules", skip_null_partitions=["season"])
    assert kept.count() == 2


def test_union_harmonised_missing_columns(spark):
    a = spark.createDataFrame([(1, 1.5)], "k INT, v FLOAT")
    b = spark.createDataFrame([(2, "x")], "k BIGINT, w STRING")
    out = union_harmonised([a, b])
    assert dict(out.dtypes) == {"k": "bigint", "v": "float", "w": "string"}
    assert out.count() == 2


def test_lineage_latest_and_stamp(spark):
    log = spark.createDataFrame(
        [("weekly", "season=2024", 1, "r1", "2024-01-01 00:00:00"), ("weekly", "season=2024", 2, "r2", "2024-02-01 00:00:00")],
        "dataset STRING, partition STRING, row_count INT, run_id STRING, run_ts STRING"
    ).withColumn("run_ts", F.to_timestamp("run_ts"))
    assert [r.row_count for r in lineage_latest(log).collect()] == [2]
    s = stamp(spark.createDataFrame([(1,)], "x INT"), "src", "r1", "2024-01-01 00:00:00")
    assert s.first().source == "src"


def test_promotion_keeps_null_partitions_and_ignores_input_order(spark, tmp_dir):
    from gridmart.plans.lake import dedupe_silver, merge_for_promotion
    from gridmart.sources.specs import CATALOG

    spec = CATALOG["schedules"]
    cols = "season int, game_id string, week int"
    old = spark.createDataFrame([(None, "g0", 1), (None, "g1", 2), (2024, "g2", 3)], cols)
    new = spark.createDataFrame([(None, "g9", 4)], cols)
    got = {r.game_id for r in merge_for_promotion(old, new, spec).collect()}
    assert {"g0", "g1", "g9"} <= got and "g2" not in got
    rows = [(2024, "g2", 8, "2024-01-01"), (2024, "g2", 10, "2024-01-01")]
    stamped = cols + ", ingested_at string"
    kept = [dedupe_silver(spark.createDataFrame(r, stamped).coalesce(1), spec).collect()[0].week
            for r in (rows, rows[::-1])]
    assert kept[0] == kept[1]
