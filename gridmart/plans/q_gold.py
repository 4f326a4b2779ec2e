"""Registered driver queries: writes that are read back (gold commits, promotion) and contracts."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.functions import scoring
from gridmart.functions.columns import r6
from gridmart.operators.contracts import ColumnRule, Contract, check_partitions, contract_rules, recorded
from gridmart.operators.scoring import contest_points
from gridmart.plans import adapters as ad
from gridmart.plans import driver as d
from gridmart.plans.lake import promote
from gridmart.plans.q_lake import _MERGE_SQL, ORDERS_SPEC, _merge_inputs
from gridmart.plans.registry import register
from gridmart.session import checkpoint_dir
from gridmart.sources.gold import read_gold, write_gold
from gridmart.sources.lake import read_drifting_dataset
from gridmart.sources.rules import CLASSIC, SHOWDOWN


def _scratch(spark: SparkSession, name: str) -> str:
    """A folder of this call's own under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


@register("gold_commit", d.with_sql(*d.SQL_BASE, """
g AS (SELECT season, week, team, COUNT(*) AS plays, CAST(SUM(l_quantity) AS DOUBLE) AS yards FROM lines_team GROUP BY ALL)
SELECT season, week, team, plays, CASE WHEN week <= 3 THEN yards + plays ELSE yards END AS yards,
       CASE WHEN week <= 3 THEN 'corrected' ELSE 'first' END AS source FROM g"""))
def gold_commit(spark: SparkSession, sf: str) -> DataFrame:
    """K2: a gold table by (season, week), written, then corrected for three weeks by a second
    run, and read back through its manifest."""
    root = _scratch(spark, "gold")
    g = d.lines_team(spark, sf).groupBy("season", "week", "team").agg(
        F.count(F.lit(1)).alias("plays"), F.sum("l_quantity").alias("yards"))
    write_gold(g.withColumn("source", F.lit("first")), root, "team_weeks", "r1", ["team"])
    late = g.filter("week <= 3").withColumns({"yards": F.col("yards") + F.col("plays"), "source": F.lit("corrected")})
    write_gold(late, root, "team_weeks", "r2", ["team"])
    return read_gold(spark, root, "team_weeks").select("season", "week", "team", "plays", "yards", "source")


@register("promote_written", _MERGE_SQL + """
SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_totalprice, season FROM r WHERE rn = 1
UNION ALL SELECT o_orderkey, CAST(o_custkey AS BIGINT), o_totalprice, season FROM old
WHERE season NOT IN (SELECT season FROM new)
""")
def promote_written(spark: SparkSession, sf: str) -> DataFrame:
    """M14 with its write: a first batch promoted to silver, a corrected one merged into the
    seasons that it touches, and the whole silver table read back."""
    root = _scratch(spark, "silver")
    old, new = _merge_inputs(spark, sf)
    promote(spark, root, old, ORDERS_SPEC)
    promote(spark, root, new, ORDERS_SPEC, on_violation="skip")
    silver = read_drifting_dataset(spark, root, "silver", "orders")
    return silver.select("o_orderkey", F.col("o_custkey").cast("bigint").alias("o_custkey"),
                         F.col("o_totalprice").cast("double").alias("o_totalprice"), F.col("season").cast("bigint").alias("season"))


_LINES_CONTRACT = Contract({
    "l_orderkey": ColumnRule("bigint", nullable=False, least=0), "quantity": ColumnRule("bigint"),
    "supplier": ColumnRule("string", nullable=False), "l_tax": ColumnRule("double", least=0.0)})


@register("contract_check", d.with_sql(d.SQL_LINES, """
v AS (
  SELECT season, week, CASE WHEN l_discount = 0.01 AND season = 1996 THEN l_quantity + 0.5 ELSE l_quantity END AS quantity,
         CASE WHEN l_returnflag = 'R' AND week = 7 THEN NULL ELSE l_suppkey END AS supplier FROM lines),
c AS (SELECT season, week, COUNT(*) AS rows_seen, COUNT(*) FILTER (quantity <> floor(quantity)) AS bad_quantity,
             COUNT(*) FILTER (supplier IS NULL) AS bad_supplier,
             COUNT(*) FILTER (supplier IS NULL OR quantity <> floor(quantity)) AS violations FROM v GROUP BY ALL)
SELECT season, week, rows_seen, CASE WHEN violations > 0 THEN 0 ELSE rows_seen END AS row_count, violations, bad_quantity,
       bad_supplier, CASE WHEN violations > 0 THEN 'skipped' ELSE 'ok' END AS status FROM c"""))
def contract_check(spark: SparkSession, sf: str) -> DataFrame:
    """M11 + M12: a declared contract checked for every (season, week) in one pass: 1996 holds
    fractions in an integer column, week 7 misses key parts; failing partitions are recorded
    with zero rows."""
    li = d.lines(spark, sf)
    landed = li.select(
        "season", "week", "l_orderkey", "l_tax",
        F.when((F.col("l_discount") == 0.01) & (F.col("season") == 1996), F.col("l_quantity") + 0.5)
        .otherwise(F.col("l_quantity")).alias("quantity"),
        F.when(~((F.col("l_returnflag") == "R") & (F.col("week") == 7)), F.col("l_suppkey").cast("string")).alias("supplier"))
    out = recorded(check_partitions(landed, contract_rules(landed, _LINES_CONTRACT), ["season", "week"]))

    def failed(rule: str) -> F.Column:
        return F.coalesce(F.element_at("failed", rule), F.lit(0).cast("bigint"))

    return out.select("season", "week", "rows_seen", "row_count", "violations", failed("quantity_bigint").alias("bad_quantity"),
                      failed("supplier_not_null").alias("bad_supplier"), "status")


# A contest's stat lines: kickers and defenses take their own columns from the weekly ones.
_KICKS = {"fg_0_39": "completions", "fg_40_49": "passing_tds", "fg_50_plus": "rushing_tds", "pat": "attempts"}
_DEFENSE = {"sack": "sack_fumbles_lost", "interception": "completions", "fumble_recovery": "receptions", "safety": "rushing_tds",
            "defensive_td": "receiving_tds", "blocked_kick": "passing_tds", "kick_punt_return_td": "passing_2pt_conversions",
            "two_point_return": "rushing_2pt_conversions", "points_allowed": "passing_yards"}
_CONTEST_SQL = d.with_sql(*ad.SQL_FOOTBALL, ad.SQL_WEEKLY, """
s AS (
  SELECT season, week, team, player_id, COALESCE(source, '') AS source, position, CASE
    WHEN position = 'K' THEN 3 * completions + 4 * passing_tds + 5 * rushing_tds + attempts
    WHEN position = 'DST' THEN sack_fumbles_lost + 2 * completions + 2 * receptions + 2 * rushing_tds + 6 * receiving_tds
      + 2 * passing_tds + 6 * passing_2pt_conversions + 2 * rushing_2pt_conversions
      + CASE WHEN passing_yards <= 0 THEN 10 WHEN passing_yards <= 6 THEN 7 WHEN passing_yards <= 13 THEN 4
             WHEN passing_yards <= 20 THEN 1 WHEN passing_yards <= 27 THEN 0 WHEN passing_yards <= 34 THEN -1 ELSE -4 END
    ELSE 0.04 * passing_yards + 4 * passing_tds - interceptions + 0.1 * rushing_yards + 6 * rushing_tds
      + 0.1 * receiving_yards + 6 * receiving_tds + receptions + 6 * special_teams_tds
      - (rushing_fumbles_lost + receiving_fumbles_lost + sack_fumbles_lost)
      + 2 * (passing_2pt_conversions + rushing_2pt_conversions + receiving_2pt_conversions)
      + CASE WHEN passing_yards >= 300 THEN 3 ELSE 0 END + CASE WHEN rushing_yards >= 100 THEN 3 ELSE 0 END
      + CASE WHEN receiving_yards >= 100 THEN 3 ELSE 0 END END::DOUBLE AS points
  FROM weekly)
SELECT season, week, team, player_id, source, position, 'classic' AS contest, NULL AS slot, round(points, 6) AS points
FROM s WHERE position <> 'K'
UNION ALL SELECT season, week, team, player_id, source, position, 'showdown', slot, round(points * f, 6)
FROM s, (VALUES ('CPT', 1.5::DOUBLE), ('FLEX', 1.0::DOUBLE)) v(slot, f)""")


@register("rules_contests", _CONTEST_SQL)
def rules_contests(spark: SparkSession, sf: str) -> DataFrame:
    """Every stat line under the Classic and Showdown documents: offense rules, kicker
    bands, points-allowed steps of defenses, and the captain's multiplier."""
    w = ad.weekly_view(spark, sf)
    key = ["season", "week", "team", "player_id", "source", "position"]
    stats = w.withColumns({
        "source": F.coalesce("source", F.lit("")),
        **{f"kicker_{k}": F.when(F.col("position") == "K", F.col(c)) for k, c in _KICKS.items()},
        **{f"dst_{k}": F.when(F.col("position") == "DST", F.col(c)) for k, c in _DEFENSE.items()}})
    out = [contest_points(stats, key, doc, name).withColumn("points", r6("points"))
           for name, doc in (("classic", CLASSIC), ("showdown", SHOWDOWN))]
    return out[0].unionByName(out[1])


@register("score_variants", d.with_sql(*ad.SQL_FOOTBALL, ad.SQL_WEEKLY, """
r AS (SELECT *, attempts + 5 AS att FROM weekly)
SELECT season, week, team, player_id, COALESCE(source, '') AS source,
  round(0.04::DOUBLE * passing_yards + 4 * passing_tds - interceptions + 0.1::DOUBLE * (rushing_yards + receiving_yards)
    + 6 * (rushing_tds + receiving_tds) + receptions + 6 * special_teams_tds - rushing_fumbles_lost
    + 2 * passing_2pt_conversions + 6 * rushing_2pt_conversions + CASE WHEN passing_yards >= 300 THEN 3 ELSE 0 END
    + CASE WHEN rushing_yards >= 100 THEN 3 ELSE 0 END + CASE WHEN receiving_yards >= 100 THEN 3 ELSE 0 END, 6) AS dk_points,
  round((greatest(0, least(2.375, (completions::DOUBLE / att - 0.3) * 5)) + greatest(0, least(2.375, (passing_yards / att - 3) * 0.25))
    + greatest(0, least(2.375, passing_tds::DOUBLE / att * 20)) + greatest(0, least(2.375, 2.375 - interceptions / att * 25)))
    / 6 * 100, 6) AS passer_rating,
  round(0.1::DOUBLE * rushing_yards + 6 * rushing_tds + receptions + 0.1::DOUBLE * receiving_yards + 6 * receiving_tds, 6) AS rb_points
FROM r"""))
def score_variants(spark: SparkSession, sf: str) -> DataFrame:
    """F5 (return touchdowns by kind, offensive fumble recoveries), F6 and the clamped passer rating."""
    w = ad.weekly_view(spark, sf).withColumns({
        "att": F.col("attempts") + 5, "punt_return_tds": F.col("special_teams_tds"), "fumbles_lost": F.col("rushing_fumbles_lost"),
        "two_point_conversions": F.col("passing_2pt_conversions"),
        "offensive_fumble_recovery_tds": F.col("rushing_2pt_conversions")})
    return w.select(
        "season", "week", "team", "player_id", F.coalesce("source", F.lit("")).alias("source"),
        r6(scoring.dk_returns(w.columns)).alias("dk_points"),
        r6(scoring.passer_rating("completions", "att", "passing_yards", "passing_tds", "interceptions")).alias("passer_rating"),
        r6(scoring.rb_season()).alias("rb_points"))
