"""Registered driver queries: lake maintenance and sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart import __version__
from gridmart.operators.dedupe import dedupe_latest
from gridmart.operators.quality import partition_stats, profile, validate
from gridmart.functions.columns import round_half_up
from gridmart.operators.schema import normalise_common, union_harmonised
from gridmart.plans import driver as d
from gridmart.plans.lake import (apply_silver_rule, bronze_batch, lineage_latest, merge_for_promotion,
                                 normalise_partition_types)
from gridmart.plans.registry import register
from gridmart.sources.lake import list_partitions
from gridmart.sources.specs import DatasetSpec
from gridmart.sources.tables import table

ORDERS_SPEC = DatasetSpec("orders", ("season",), ("o_orderkey",), ("season", "o_orderkey"))
LINES_SPEC = DatasetSpec("lines", ("season",), ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
WEEKLY_SPEC = DatasetSpec("weekly", ("season",), ("season", "week", "player_id", "team"))


def _orders_slices(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two landed slices of orders whose column types drift: before 1998 price is FLOAT and
    the customer key a number; from 1998 price is DOUBLE and the key text."""
    o = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus",
              "o_orderpriority", "o_orderdate")
    cut = F.lit("1998-01-01").cast("timestamp")
    a = o.filter(F.col("o_orderdate") < cut).select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").cast("float").alias("o_totalprice"), "o_orderstatus")
    b = o.filter(F.col("o_orderdate") >= cut).select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey"), "o_totalprice", "o_orderpriority")
    return a, b


@register("drift_union_read", """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS o_totalprice, o_orderstatus,
       CAST(NULL AS VARCHAR) AS o_orderpriority
FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
UNION ALL
SELECT o_orderkey, CAST(o_custkey AS VARCHAR), o_totalprice, CAST(NULL AS VARCHAR), o_orderpriority
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
""")
def drift_union_read(spark: SparkSession, sf: str) -> DataFrame:
    """FLOAT u DOUBLE -> DOUBLE, BIGINT u STRING -> STRING, missing columns NULL."""
    a, b = _orders_slices(spark, sf)
    return union_harmonised([a, b])


_MERGE_SQL = """
WITH old AS (
  SELECT o_orderkey, o_custkey, CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS o_totalprice,
         CAST(year(o_orderdate) AS BIGINT) AS season, o_orderdate AS ingested_at, 0 AS b
  FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'
),
new AS (
  SELECT o_orderkey, o_custkey, o_totalprice + 1 AS o_totalprice, CAST(year(o_orderdate) AS BIGINT) AS season,
         o_orderdate + INTERVAL 1 DAY AS ingested_at, 1 AS b
  FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'
),
u AS (SELECT * FROM old WHERE season IN (SELECT season FROM new) UNION ALL SELECT * FROM new),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY ingested_at DESC, b DESC) AS rn FROM u)
"""


def _merge_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    old = o.filter(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp")).select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").cast("float").alias("o_totalprice"),
        F.year("o_orderdate").alias("season"), F.col("o_orderdate").cast("timestamp").alias("ingested_at"))
    new = o.filter(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp")).select(
        "o_orderkey", "o_custkey", (F.col("o_totalprice") + 1).alias("o_totalprice"),
        F.year("o_orderdate").alias("season"),
        (F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 1 DAY")).alias("ingested_at"))
    return old, new


@register("merge_harmonised", _MERGE_SQL + """
SELECT o_orderkey, o_custkey, o_totalprice, season FROM r WHERE rn = 1
""")
def merge_harmonised(spark: SparkSession, sf: str) -> DataFrame:
    """Silver slice (FLOAT price) merged with a corrected batch (DOUBLE price,
    later ingest time) for the touched seasons; the correction wins."""
    old, new = _merge_inputs(spark, sf)
    return merge_for_promotion(old, new, ORDERS_SPEC).select("o_orderkey", "o_custkey", "o_totalprice", "season")


@register("promote_incremental", _MERGE_SQL + """,
k AS (SELECT * FROM r WHERE rn = 1 AND o_orderkey IS NOT NULL)
SELECT season, COUNT(*) AS row_count,
       CAST(SUM(CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT)) AS BIGINT) AS fingerprint,
       MIN(ingested_at) AS min_ingested_at, MAX(ingested_at) AS max_ingested_at
FROM k GROUP BY ALL
""")
def promote_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """M14 + M13 (without the write): merge, validate (skip policy), partition stats.
    ``plans.lake.promote`` adds the dynamic-overwrite write (tests cover it)."""
    old, new = _merge_inputs(spark, sf)
    merged = merge_for_promotion(old, new, ORDERS_SPEC)
    merged = merged.filter(F.col("o_orderkey").isNotNull())
    return partition_stats(merged, ["season"], ["o_orderkey"])


@register("bronze_stamp_counts", d.with_sql(d.SQL_LINES, f"""
s AS (SELECT CAST(season AS BIGINT) AS season, 'tpch' AS source, '{__version__}' AS pipeline_version,
             'run-1' AS run_id FROM lines)
SELECT season, source, pipeline_version, run_id, COUNT(*) AS row_count FROM s GROUP BY ALL
"""))
def bronze_stamp_counts(spark: SparkSession, sf: str) -> DataFrame:
    """K5 + M1 + M2: stamp a landed batch and count rows per partition."""
    stamped, _ = bronze_batch(d.lines(spark, sf), LINES_SPEC, "tpch", "run-1", "2024-01-01 00:00:00")
    return stamped.groupBy("season", "source", "pipeline_version", "run_id").agg(
        F.count(F.lit(1)).alias("row_count"))


@register("partition_type_normalise", """
SELECT CAST(CAST(CAST(year(o_orderdate) AS DOUBLE) AS VARCHAR) AS DOUBLE)::BIGINT AS season, COUNT(*) AS n
FROM orders GROUP BY ALL
""")
def partition_type_normalise(spark: SparkSession, sf: str) -> DataFrame:
    """M2: a partition column landed as text like ``1997.0`` becomes BIGINT ``1997``."""
    o = table(spark, sf, "orders", "o_orderdate")
    landed = o.select(F.year("o_orderdate").cast("double").cast("string").alias("season"))
    return normalise_partition_types(landed, ["season"]).groupBy("season").agg(F.count(F.lit(1)).alias("n"))


@register("changed_partitions", d.with_sql(d.SQL_LINES, """
p AS (SELECT DISTINCT season, week FROM lines)
SELECT season, week, 'season=' || CAST(season AS VARCHAR) || '/week=' || CAST(week AS VARCHAR) AS partition FROM p
"""))
def changed_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """M3 / M4: distinct partitions touched by a batch, with their path strings."""
    return list_partitions(d.lines(spark, sf), ["season", "week"])


@register("silver_normalise", """
SELECT CAST(l_orderkey AS VARCHAR) AS game_id, CAST(round(l_linenumber + 0.4) AS BIGINT) AS play_id,
       CAST(l_suppkey AS VARCHAR) AS supplier_id, CAST(year(l_shipdate) AS BIGINT) AS season,
       CAST(NULL AS VARCHAR) AS notes
FROM lineitem
""")
def silver_normalise(spark: SparkSession, sf: str) -> DataFrame:
    """M7: ids to text, ``play_id`` double -> round -> BIGINT, season BIGINT, void -> text."""
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    raw = li.select(F.col("l_orderkey").alias("game_id"), (F.col("l_linenumber") + 0.4).alias("play_id"),
                    F.col("l_suppkey").alias("supplier_id"), F.year("l_shipdate").alias("season"),
                    F.lit(None).alias("notes"))
    return normalise_common(raw)


def _weekly_landed(spark: SparkSession, sf: str, verified_only: bool = False) -> DataFrame:
    """A landed "weekly" batch: player = part, recent_team = supplier nation."""
    lt = d.lines_team(spark, sf)
    pid = F.concat(F.lit("P"), F.col("l_partkey").cast("string"))
    if verified_only:
        sup = table(spark, sf, "supplier", "s_suppkey", "s_acctbal")
        lt = lt.join(sup, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        pid = F.when(F.col("s_acctbal") >= 0, pid)
    return lt.select("season", "week", pid.alias("player_id"), F.col("team").alias("recent_team"),
                     F.col("l_quantity").alias("targets"), F.col("l_shipdate").cast("timestamp").alias("ingested_at"),
                     "l_orderkey", "l_linenumber", "l_suppkey")


_WEEKLY_SQL = d.with_sql(*d.SQL_BASE, """
w AS (SELECT CAST(season AS BIGINT) AS season, week, 'P' || CAST(l_partkey AS VARCHAR) AS player_id,
             team, l_quantity AS targets, l_shipdate AS ingested_at, l_orderkey, l_linenumber, l_suppkey
      FROM lines_team)""")


@register("silver_rules", _WEEKLY_SQL + """
SELECT season, week, player_id, team, targets FROM (
  SELECT *, row_number() OVER (PARTITION BY season, week, player_id, team
      ORDER BY ingested_at DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC) AS rn FROM w)
WHERE rn = 1
""")
def silver_rules(spark: SparkSession, sf: str) -> DataFrame:
    """M8 + M10: the weekly rule (``recent_team`` -> ``team``, key, newest wins)."""
    silver = apply_silver_rule(_weekly_landed(spark, sf), WEEKLY_SPEC)
    out = dedupe_latest(silver, list(WEEKLY_SPEC.key), "ingested_at", ["l_orderkey", "l_linenumber", "l_suppkey"])
    return out.select("season", "week", "player_id", "team", "targets")


@register("drop_missing_keys", d.with_sql(*d.SQL_BASE, """
w AS (SELECT li.season, CASE WHEN s.s_acctbal >= 0 THEN 'P' || CAST(li.l_partkey AS VARCHAR) END AS player_id
      FROM lines li JOIN supplier s ON s.s_suppkey = li.l_suppkey)
SELECT CAST(season AS BIGINT) AS season, COUNT(*) AS n_kept FROM w WHERE player_id IS NOT NULL GROUP BY ALL
"""))
def drop_missing_keys(spark: SparkSession, sf: str) -> DataFrame:
    """M9: rows without a required key part (player id of an unverified supplier) dropped;
    the optional ``team`` part may stay NULL."""
    silver = apply_silver_rule(_weekly_landed(spark, sf, verified_only=True), WEEKLY_SPEC)
    return silver.groupBy("season").agg(F.count(F.lit(1)).alias("n_kept"))


@register("validate_rules", d.with_sql(d.SQL_LINES, """
v AS (
  SELECT season, COUNT(*) AS rows,
         COUNT(*) FILTER (WHERE NOT COALESCE(l_quantity >= 1, false)) AS qty_ge_1,
         COUNT(*) FILTER (WHERE NOT COALESCE(l_discount BETWEEN 0 AND 0.1, false)) AS discount_in_range,
         COUNT(*) FILTER (WHERE NOT COALESCE(l_shipdate >= o_orderdate, false)) AS ship_after_order,
         COUNT(*) FILTER (WHERE NOT COALESCE(l_tax < 0.08, false)) AS tax_below_8pct
  FROM lines GROUP BY ALL
)
UNPIVOT v ON qty_ge_1, discount_in_range, ship_after_order, tax_below_8pct INTO NAME rule VALUE violations
"""))
def validate_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Violations per rule and partition in one pass."""
    rules = {
        "qty_ge_1": F.col("l_quantity") >= 1,
        "discount_in_range": F.col("l_discount").between(0, 0.1),
        "ship_after_order": F.col("l_shipdate") >= F.col("o_orderdate"),
        "tax_below_8pct": F.col("l_tax") < 0.08,
    }
    return validate(d.lines(spark, sf), rules, ["season"])


@register("partition_stats", d.with_sql(d.SQL_LINES, """
k AS (SELECT season, l_shipdate, CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) || '|' ||
             CAST(l_partkey AS VARCHAR) || '|' || CAST(l_suppkey AS VARCHAR) AS key FROM lines)
SELECT season, COUNT(*) AS row_count,
       CAST(SUM(CAST('0x' || substr(md5(key), 1, 8) AS BIGINT)) AS BIGINT) AS fingerprint,
       MIN(l_shipdate) AS min_ingested_at, MAX(l_shipdate) AS max_ingested_at
FROM k GROUP BY ALL
"""))
def partition_stats_q(spark: SparkSession, sf: str) -> DataFrame:
    """Row count, fingerprint, min/max ingest time for all partitions in one pass."""
    li = d.lines(spark, sf).withColumn("ingested_at", F.col("l_shipdate"))
    return partition_stats(li, ["season"], list(LINES_SPEC.key))


@register("profile_partitions", d.with_sql(d.SQL_LINES, """
k AS (SELECT season, l_orderkey, l_linenumber, COUNT(*) AS c FROM lines GROUP BY ALL),
kk AS (SELECT season, COUNT(*) AS key_unique_rows, CAST(SUM(c - 1) AS BIGINT) AS key_duplicate_rows,
              CAST(SUM(CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN c ELSE 0 END) AS BIGINT) AS key_null_rows
       FROM k GROUP BY ALL),
b AS (SELECT season, COUNT(*) AS rows, MIN(week) AS min_week, MAX(week) AS max_week FROM lines GROUP BY ALL)
SELECT b.season, b.rows, b.min_week, b.max_week, kk.key_unique_rows, kk.key_duplicate_rows, kk.key_null_rows,
       18 AS columns, round(kk.key_duplicate_rows / b.rows, 9) AS key_duplicate_ratio
FROM b JOIN kk USING (season)
"""))
def profile_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Per-partition profile with key uniqueness (the non-unique line key)."""
    out = profile(d.lines(spark, sf), ["l_orderkey", "l_linenumber"], ["season"])
    return out.withColumn("key_duplicate_ratio", round_half_up("key_duplicate_ratio", 9))


@register("landing_cleanup", """
SELECT CAST(c_custkey AS VARCHAR) AS player_id, c_name AS player_name,
       TRY_CAST(CAST(c_acctbal AS VARCHAR) AS DOUBLE) AS acctbal, 'basic' AS stat_type,
       upper(substr(c_mktsegment, 1, 3)) AS position
FROM customer
""")
def landing_cleanup(spark: SparkSession, sf: str) -> DataFrame:
    """M16 + M17: ids to text, a rename, numeric coercion of text, a constant
    ``stat_type`` column and a derived position code."""
    from gridmart.sources import landing

    c = table(spark, sf, "customer", "c_custkey", "c_name", "c_acctbal", "c_mktsegment").select(
        F.col("c_custkey").alias("player_id"), F.col("c_name").alias("player_name"),
        F.col("c_acctbal").cast("string").alias("acctbal"), F.lit(None).cast("string").alias("stat_type"),
        F.upper(F.substring("c_mktsegment", 1, 3)).alias("pos_abb"))
    out = landing.with_constant(landing.coerce_numeric(landing.ids_as_text(c), ["acctbal"]), "stat_type", "basic")
    return landing.depth_chart_position(out).drop("pos_abb")


@register("lineage_latest", """
WITH runs AS (
  SELECT 'orders' AS dataset, 'season=' || CAST(year(o_orderdate) AS VARCHAR) AS partition, COUNT(*) AS row_count,
         'run-1' AS run_id, TIMESTAMP '2024-01-01' AS run_ts
  FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' GROUP BY ALL
  UNION ALL
  SELECT 'orders', 'season=' || CAST(year(o_orderdate) AS VARCHAR), COUNT(*), 'run-2', TIMESTAMP '2024-02-01'
  FROM orders GROUP BY ALL
)
SELECT dataset, partition, row_count, run_id FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset, partition ORDER BY run_ts DESC, run_id DESC) AS rn FROM runs)
WHERE rn = 1
""")
def lineage_latest_q(spark: SparkSession, sf: str) -> DataFrame:
    """K8: append-only lineage log of two runs; the current record per partition."""
    o = table(spark, sf, "orders", "o_orderdate")
    part = F.concat(F.lit("season="), F.year("o_orderdate").cast("string")).alias("partition")

    def run(df: DataFrame, run_id: str, ts: str) -> DataFrame:
        return df.groupBy(part).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit("orders").alias("dataset"), "partition", "row_count", F.lit(run_id).alias("run_id"),
            F.lit(ts).cast("timestamp").alias("run_ts"))

    log = run(o.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp")), "run-1", "2024-01-01") \
        .unionByName(run(o, "run-2", "2024-02-01"))
    return lineage_latest(log).select("dataset", "partition", "row_count", "run_id")


@register("null_partition_skip", d.with_sql(d.SQL_LINES, """
p AS (SELECT s.s_nationkey AS nation FROM lines li
      LEFT JOIN (SELECT s_suppkey, CASE WHEN s_acctbal >= 0 THEN s_nationkey END AS s_nationkey
                 FROM supplier) s ON s.s_suppkey = li.l_suppkey)
SELECT nation, COUNT(*) AS n_lines FROM p WHERE nation IS NOT NULL GROUP BY ALL
"""))
def null_partition_skip(spark: SparkSession, sf: str) -> DataFrame:
    """S3: rows whose partition value is NULL (the default partition) are skipped."""
    sup = (table(spark, sf, "supplier", "s_suppkey", "s_nationkey", "s_acctbal")
           .withColumn("s_nationkey", F.when(F.col("s_acctbal") >= 0, F.col("s_nationkey"))))
    p = d.lines(spark, sf).join(sup, F.col("l_suppkey") == F.col("s_suppkey"), "left") \
        .select(F.col("s_nationkey").alias("nation"))
    return p.filter(F.col("nation").isNotNull()).groupBy("nation").agg(F.count(F.lit(1)).alias("n_lines"))


def player_week(spark: SparkSession, sf: str) -> DataFrame:
    """A gold-like player-week table: part x (season, week) with its name and type."""
    p = table(spark, sf, "part", "p_partkey", "p_name", "p_type")
    li = d.lines(spark, sf).join(p, F.col("l_partkey") == F.col("p_partkey"))
    return li.groupBy("season", "week", F.col("l_partkey").alias("player_id"), F.col("p_name").alias("player_name"),
                      F.col("p_type").alias("position")).agg(
        F.count(F.lit(1)).alias("receptions"), F.sum("l_quantity").alias("yards"))


@register("filtered_gold_read", d.with_sql(d.SQL_LINES, """
pw AS (SELECT li.season, li.week, li.l_partkey AS player_id, p.p_name AS player_name, p.p_type AS position,
              COUNT(*) AS receptions, CAST(SUM(li.l_quantity) AS DOUBLE) AS yards
       FROM lines li JOIN part p ON p.p_partkey = li.l_partkey GROUP BY ALL)
SELECT * FROM pw
WHERE season IN (1996, 1997) AND position IN ('MEDIUM', 'LARGE') AND lower(player_name) LIKE '%ring%'
ORDER BY yards DESC, player_id, season, week LIMIT 200
"""))
def filtered_gold_read(spark: SparkSession, sf: str, seasons=(1996, 1997), positions=("MEDIUM", "LARGE"),
                       search: str | None = "ring", limit: int | None = 200) -> DataFrame:
    """Optional ``isin`` filters, case-insensitive name search, ordered limit."""
    df = player_week(spark, sf)
    if seasons:
        df = df.filter(F.col("season").isin(list(seasons)))
    if positions:
        df = df.filter(F.col("position").isin(list(positions)))
    if search:
        df = df.filter(F.lower("player_name").contains(search.lower()))
    df = df.orderBy(F.col("yards").desc(), "player_id", "season", "week")
    return df.limit(limit) if limit else df


@register("backfill_from_events", d.with_sql(d.SQL_BASE[0], d.SQL_BASE[1], d.SQL_BASE[2], """
ev AS (SELECT season, week, 'P' || CAST(l_partkey AS VARCHAR) AS player_id, team, l_quantity, l_returnflag,
              l_partkey FROM lines_team)
SELECT ev.season, ev.week, ev.player_id, ev.team, p.p_name AS player_name, COUNT(*) AS receptions,
       CAST(SUM(ev.l_quantity) AS DOUBLE) AS receiving_yards,
       COUNT(*) FILTER (WHERE ev.l_returnflag = 'R') AS receiving_tds
FROM ev LEFT JOIN part p ON p.p_partkey = ev.l_partkey GROUP BY ALL
"""))
def backfill_from_events(spark: SparkSession, sf: str) -> DataFrame:
    """A minimal weekly table built from events plus roster names."""
    lt = d.lines_team(spark, sf)
    p = table(spark, sf, "part", "p_partkey", "p_name")
    ev = lt.select("season", "week", F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("player_id"),
                   "team", "l_quantity", "l_returnflag", "l_partkey")
    agg = ev.groupBy("season", "week", "player_id", "team", "l_partkey").agg(
        F.count(F.lit(1)).alias("receptions"), F.sum("l_quantity").alias("receiving_yards"),
        F.count_if(F.col("l_returnflag") == "R").alias("receiving_tds"))
    out = agg.join(p, F.col("l_partkey") == F.col("p_partkey"), "left")
    return out.select("season", "week", "player_id", "team", F.col("p_name").alias("player_name"),
                      "receptions", "receiving_yards", "receiving_tds")
