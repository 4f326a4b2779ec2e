"""Pinned decisions on the reference's quirks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gridmart.functions import scoring
from gridmart.functions.classify import ROOF_POLICIES, policy_classify, roof_by_season
from gridmart.plans.lake import dedupe_silver, merge_for_promotion, stamp
from gridmart.plans.marts import tier_shares
from gridmart.sources.specs import CATALOG, DatasetSpec


def test_q1_tiers_are_groups_of_twelve(spark):
    from gridmart.plans.marts import STAT_COLS
    base = "season INT, week INT, season_type STRING, team STRING, player_id STRING, source STRING, " \
           "player_name STRING, position STRING, "
    schema = base + ", ".join(f"{c} DOUBLE" for c in STAT_COLS)
    rows = []
    for i in range(30):
        stats = {c: 0.0 for c in STAT_COLS}
        stats["receiving_yards"] = float(100 - i)
        rows.append((2024, 1, "REG", "T", f"P{i:02d}", "feed", "n", "WR", *[stats[c] for c in STAT_COLS]))
    out = {r.tier: r for r in tier_shares(spark.createDataFrame(rows, schema), ("WR",)).collect()}
    assert sorted(out) == [1, 2, 3]                     # 12 + 12 + 6, not 30 fractional tiers
    assert out[1].top12_flag == 1 and out[3].top36_flag == 1 and out[3].top12_flag == 0


def test_q2_newest_wins_and_ties_go_to_the_new_batch(spark):
    spec = DatasetSpec("weekly", ("season",), ("season", "player_id"))
    old = spark.createDataFrame([(2024, "A", 1)], "season INT, player_id STRING, v INT")
    new = spark.createDataFrame([(2024, "A", 2)], "season INT, player_id STRING, v INT")
    ts = "2024-09-01 00:00:00"
    merged = merge_for_promotion(stamp(old, "s", "r1", ts), stamp(new, "s", "r1", ts), spec)
    assert [r.v for r in merged.collect()] == [2]


def test_q3_unlisted_dataset_dedupes_on_catalog_key(spark):
    spec = CATALOG["rosters_seasonal"]
    df = spark.createDataFrame([(2024, "A", "x"), (2024, "A", "y")], "season INT, player_id STRING, full_name STRING")
    assert dedupe_silver(df, spec).count() == 1


def test_q5_named_roof_policies_differ_on_open(spark):
    df = spark.createDataFrame([("open",)], "roof STRING")
    got = {p: df.select(policy_classify("roof", ROOF_POLICIES, p).alias("c")).first().c for p in ROOF_POLICIES}
    assert got == {"open_is_outdoor": "OUTDOOR", "open_is_retractable": "RETRACTABLE",
                   "retractable_is_indoor": "INDOOR"}


def test_q9_grouped_dk_is_zero_when_any_sum_is_null(spark):
    cols = ["receiving_tds", "receiving_yards", "rushing_tds", "rushing_yards", "passing_tds", "passing_yards",
            "receptions", "interceptions", "fumbles_lost", "return_tds", "two_pt_conversions"]
    rows = [("A", 1.0, 120.0, 0.0, 0.0, 0.0, 0.0, 5.0, 0.0, 0.0, None, 0.0)]
    df = spark.createDataFrame(rows, "player_id STRING, " + ", ".join(f"{c} DOUBLE" for c in cols))
    assert df.groupBy("player_id").agg(scoring.dk_grouped().alias("p")).first().p == 0.0
    filled = df.fillna(0.0)
    assert filled.groupBy("player_id").agg(scoring.dk_grouped().alias("p")).first().p == pytest.approx(26.0)


def test_q18_fingerprint_ignores_order_and_partitioning(spark):
    from gridmart.operators.quality import key_fingerprint
    df = spark.createDataFrame([(i, f"g{i % 3}") for i in range(100)], "i INT, g STRING")
    a = {r.g: r.fingerprint for r in key_fingerprint(df, ["i"], ["g"]).collect()}
    b = {r.g: r.fingerprint for r in key_fingerprint(df.repartition(5, "i").orderBy(F.rand(7)), ["i"], ["g"]).collect()}
    assert a == b


def test_portable_round_matches_spark_rule(spark):
    import duckdb

    from gridmart.functions.columns import round_half_up
    from gridmart.plans.registry import portable_round
    values = [0.0015625, 0.0484375, 105.9140625, 2.5, -2.5, 1 / 3, 0.1546875, 123456.0000005]
    sdf = spark.createDataFrame([(v,) for v in values], "x DOUBLE")
    got_spark = [r.y for r in sdf.select(round_half_up("x", 6).alias("y")).collect()]
    sql = portable_round("SELECT round(x, 6) AS y FROM t ORDER BY i")
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    got_duck = [r[0] for r in con.sql(sql).fetchall()]
    assert got_spark == got_duck


def test_roof_rule_of_2025(spark):
    df = spark.createDataFrame([("open", 2024), ("open", 2025), ("retractable_closed", 2024), ("outdoors", 2025),
                                (None, 2025)], "roof string, season int")
    got = [r.c for r in df.select(roof_by_season("roof", "season").alias("c")).collect()]
    assert got == ["RETRACTABLE", "INDOOR", "INDOOR", "OUTDOOR", "UNKNOWN"]


def test_exact_sum_past_the_range_of_bigint(spark):
    from decimal import Decimal

    from pyspark.sql import functions as F

    from gridmart.plans.driver import exact_sum
    units = [2**62, 2**62 + 1, 2**62 + 3, -5, None]
    df = spark.createDataFrame([(u,) for u in units], "u bigint")
    assert df.select(exact_sum(F.col("u")).alias("s")).first().s == Decimal(3 * 2**62 - 1)
    assert df.filter("u is null").select(exact_sum(F.col("u")).alias("s")).first().s is None
