"""Registered driver queries: scans, predicates, aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.functions.classify import (DISTANCE_BUCKETS, buckets, category_map, ilike_any,
                                         matches_any, policy_classify, round_of_week)
from gridmart.functions.columns import cavg, csum, r6, share
from gridmart.operators.dedupe import mode_per_key
from gridmart.operators.quantiles import with_median
from gridmart.operators.stats import correlation
from gridmart.operators.shares import share_of_total, with_group_totals
from gridmart.plans import driver as d
from gridmart.plans.registry import register
from gridmart.sources.tables import table


def _dbl_sum(c) -> F.Column:
    """Exact decimal sum reported as DOUBLE."""
    return F.sum(c).cast("double")


# --- S1 scan + pushed filter ---------------------------------------------------------

@register("scan_filter_prune", """
SELECT l_returnflag, l_linestatus, COUNT(*) AS n_lines,
       CAST(SUM(l_quantity) AS DOUBLE) AS sum_qty,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price
FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1999-01-01'
GROUP BY ALL
""")
def scan_filter_prune(spark: SparkSession, sf: str) -> DataFrame:
    """One year of lines: the date predicate reaches the Parquet scan (PushedFilters) and
    only four columns are read."""
    li = table(spark, sf, "lineitem")
    return (li.filter((F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp"))
                      & (F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp")))
            .groupBy("l_returnflag", "l_linestatus")
            .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("sum_qty"),
                 _dbl_sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("sum_price")))


# --- P1 / P2 / P4 parameters -----------------------------------------------------------

def orders_for_seasons(spark: SparkSession, sf: str, season: int | None = None,
                       season_range: tuple[int, int] | None = None,
                       statuses: list[str] | None = None,
                       priority: str | None = None) -> DataFrame:
    """Orders filtered by optional typed parameters; ``None`` means no predicate.

    Season parameters become date-range predicates on the raw column so that Parquet
    row-group statistics (and partition pruning on a partitioned lake) apply.
    """
    o = table(spark, sf, "orders")
    if season is not None:
        season_range = (season, season)
    if season_range is not None:
        lo, hi = season_range
        o = o.filter((F.col("o_orderdate") >= F.lit(f"{lo}-01-01").cast("timestamp"))
                     & (F.col("o_orderdate") < F.lit(f"{hi + 1}-01-01").cast("timestamp")))
    if statuses is not None:
        o = o.filter(F.col("o_orderstatus").isin(statuses))
    if priority is not None and priority != "ALL":
        o = o.filter(F.col("o_orderpriority") == priority)
    return o


@register("param_filter", """
SELECT o_orderpriority, COUNT(*) AS n_orders,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
GROUP BY ALL
""")
def param_filter(spark: SparkSession, sf: str) -> DataFrame:
    """A season parameter (1997) as a literal predicate."""
    o = orders_for_seasons(spark, sf, season=1997)
    return o.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_orders"),
        _dbl_sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total_price"))


@register("param_range_filter", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS season, COUNT(*) AS n_orders
FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'
GROUP BY ALL
""")
def param_range_filter(spark: SparkSession, sf: str) -> DataFrame:
    """``season BETWEEN 1996 AND 1999``."""
    o = orders_for_seasons(spark, sf, season_range=(1996, 1999))
    return o.groupBy(F.year("o_orderdate").alias("season")).agg(F.count(F.lit(1)).alias("n_orders"))


@register("optional_filters", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
       CAST(year(o_orderdate) AS INTEGER) AS season
FROM orders WHERE o_orderstatus IN ('F', 'O')
""")
def optional_filters(spark: SparkSession, sf: str) -> DataFrame:
    """Statuses given, season and priority left as "all" (None / 'ALL')."""
    o = orders_for_seasons(spark, sf, season=None, statuses=["F", "O"], priority="ALL")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
                    F.year("o_orderdate").alias("season"))


# --- P6 / P8 / P9 / P10 / P11 / P12 / P13 / P18 / P21 ------------------------------------

def is_qualifying_line() -> F.Column:
    """Qualifying line: a sale or return (not 'A'), more than one unit, not the top discount."""
    return (F.col("l_returnflag").isin("N", "R") & (F.col("l_quantity") > 1)
            & (F.col("l_discount") < 0.10))


@register("qualifying_filter", d.with_sql(*d.SQL_BASE[:1], """
q AS (SELECT * FROM lines
      WHERE l_returnflag IN ('N','R') AND l_quantity > 1 AND l_discount < 0.10)
SELECT season, COUNT(*) AS n_qualifying, CAST(SUM(l_quantity) AS DOUBLE) AS qty
FROM q GROUP BY ALL
"""))
def qualifying_filter(spark: SparkSession, sf: str) -> DataFrame:
    li = d.lines(spark, sf).filter(is_qualifying_line())
    return li.groupBy("season").agg(F.count(F.lit(1)).alias("n_qualifying"), F.sum("l_quantity").alias("qty"))


@register("neutral_flag", d.with_sql(*d.SQL_BASE[:1], """
f AS (
  SELECT season, CASE WHEN l_discount BETWEEN 0.03 AND 0.07 AND l_quantity BETWEEN 10 AND 40
                       AND l_tax <= 0.06 THEN 1 ELSE 0 END AS neutral
  FROM lines
)
SELECT season, COUNT(*) AS n_lines, CAST(SUM(neutral) AS BIGINT) AS n_neutral,
       round(SUM(neutral) / COUNT(*), 6) AS neutral_rate
FROM f GROUP BY ALL
"""))
def neutral_flag(spark: SparkSession, sf: str) -> DataFrame:
    """A 0/1 flag from several range conditions, then its rate per season."""
    neutral = F.when(F.col("l_discount").between(0.03, 0.07) & F.col("l_quantity").between(10, 40)
                     & (F.col("l_tax") <= 0.06), 1).otherwise(0)
    li = d.lines(spark, sf).withColumn("neutral", neutral)
    return li.groupBy("season").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("neutral").alias("n_neutral"),
        r6(share(F.sum("neutral"), F.count(F.lit(1)))).alias("neutral_rate"))


@register("distance_buckets", d.with_sql(*d.SQL_BASE[:1], """
b AS (
  SELECT CASE WHEN l_quantity BETWEEN 1 AND 2 THEN '1-2' WHEN l_quantity BETWEEN 3 AND 5 THEN '3-5'
              WHEN l_quantity BETWEEN 6 AND 8 THEN '6-8' WHEN l_quantity BETWEEN 9 AND 12 THEN '9-12'
              WHEN l_quantity >= 13 THEN '13+' END AS bucket,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS converted
  FROM lines
)
SELECT bucket, COUNT(*) AS attempts, CAST(SUM(converted) AS BIGINT) AS conversions,
       round(SUM(converted) / COUNT(*), 6) AS conversion_rate
FROM b GROUP BY ALL
"""))
def distance_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """P9 + P16: conversion (returned line) rate by quantity bucket."""
    li = d.lines(spark, sf).withColumn("bucket", buckets("l_quantity", DISTANCE_BUCKETS))
    agg = li.groupBy("bucket").agg(F.count(F.lit(1)).alias("attempts"),
                                   csum(F.col("l_returnflag") == "R").alias("conversions"))
    return agg.withColumn("conversion_rate", r6(share("conversions", "attempts")))


# Brand groups used as the "unit" mapping on the driver tables.
BRAND_GROUPS = {
    "G1": ("Brand#1", "Brand#2", "Brand#3"), "G2": ("Brand#4", "Brand#5", "Brand#6"),
    "G3": ("Brand#7", "Brand#8"), "G4": ("Brand#9", "Brand#10", "Brand#11"),
    "G5": ("Brand#12", "Brand#13"), "G6": ("Brand#14", "Brand#15", "Brand#16"),
    "G7": ("Brand#17", "Brand#18"), "G8": ("Brand#19", "Brand#20"),
    "G9": ("Brand#21", "Brand#22"),
}


def _brand_group_sql() -> str:
    parts = " ".join(f"WHEN p_brand IN ({', '.join(repr(m) for m in ms)}) THEN '{g}'"
                     for g, ms in BRAND_GROUPS.items())
    return f"CASE {parts} ELSE 'OTHER' END"


@register("category_grouping", f"""
SELECT {_brand_group_sql()} AS unit, COUNT(DISTINCT p_partkey) AS n_parts,
       COUNT(DISTINCT p_type) AS n_types
FROM part GROUP BY ALL
""")
def category_grouping(spark: SparkSession, sf: str) -> DataFrame:
    """P10 + A5: value -> group map (10 groups incl. OTHER), distinct members per group."""
    p = table(spark, sf, "part", "p_partkey", "p_brand", "p_type")
    return (p.withColumn("unit", category_map("p_brand", BRAND_GROUPS))
            .groupBy("unit").agg(F.countDistinct("p_partkey").alias("n_parts"),
                                 F.countDistinct("p_type").alias("n_types")))


# Three named policies over order priorities (the roof-policy pattern).
PRIORITY_POLICIES = {
    "strict": {"URGENT": ("1-URGENT",), "NORMAL": ("2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")},
    "medium_is_urgent": {"URGENT": ("1-URGENT", "2-HIGH", "3-MEDIUM"), "NORMAL": ("4-NOT SPECIFIED", "5-LOW")},
    "three_way": {"URGENT": ("1-URGENT", "2-HIGH"), "MIXED": ("3-MEDIUM",), "NORMAL": ("4-NOT SPECIFIED", "5-LOW")},
}


def _policy_sql(policy: str) -> str:
    parts = " ".join(f"WHEN upper(o_orderpriority) IN ({', '.join(repr(m) for m in ms)}) THEN '{g}'"
                     for g, ms in PRIORITY_POLICIES[policy].items())
    return f"CASE {parts} ELSE 'UNKNOWN' END"


@register("policy_classify", "\nUNION ALL\n".join(f"""
SELECT '{p}' AS policy, CAST(year(o_orderdate) AS INTEGER) AS season, {_policy_sql(p)} AS class,
       COUNT(*) AS n_orders
FROM orders GROUP BY ALL""" for p in PRIORITY_POLICIES))
def policy_classify_q(spark: SparkSession, sf: str) -> DataFrame:
    """One classifier, several named policies; counts per policy x season x class.

    The policies are unpivoted with ``explode`` so the table is scanned once.
    """
    o = table(spark, sf, "orders", "o_orderdate", "o_orderpriority")
    classes = F.array(*[F.struct(F.lit(p).alias("policy"),
                                 policy_classify("o_orderpriority", PRIORITY_POLICIES, p).alias("class"))
                        for p in PRIORITY_POLICIES])
    long = o.select(F.year("o_orderdate").alias("season"), F.explode(classes).alias("c"))
    return (long.groupBy(F.col("c.policy").alias("policy"), "season", F.col("c.class").alias("class"))
            .agg(F.count(F.lit(1)).alias("n_orders")))


@register("pattern_classify", d.with_sql(*d.SQL_BASE[:1], """
c AS (
  SELECT li.season, CASE WHEN p.p_name ILIKE '%ring%' THEN 'RING' ELSE 'OTHER' END AS shape,
         CASE WHEN p.p_type ILIKE '%large%' OR p.p_type ILIKE '%medium%' THEN 'BIG' ELSE 'SMALL' END AS size_class,
         li.l_quantity
  FROM lines li JOIN part p ON li.l_partkey = p.p_partkey
)
SELECT season, shape, size_class, COUNT(*) AS n_lines, CAST(SUM(l_quantity) AS DOUBLE) AS qty
FROM c GROUP BY ALL
"""))
def pattern_classify(spark: SparkSession, sf: str) -> DataFrame:
    """P12 (D24 shape): two ILIKE classifications crossed per season."""
    p = table(spark, sf, "part", "p_partkey", "p_name", "p_type")
    li = d.lines(spark, sf).join(p, F.col("l_partkey") == F.col("p_partkey"))
    li = li.withColumns({
        "shape": F.when(ilike_any("p_name", ["%ring%"]), "RING").otherwise("OTHER"),
        "size_class": F.when(ilike_any("p_type", ["%large%", "%medium%"]), "BIG").otherwise("SMALL"),
    })
    return li.groupBy("season", "shape", "size_class").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("qty"))


# Word list for the any-match predicate.
MATCH_WORDS = ("BOLT", "NUT", "WIDGET")


@register("pattern_any_match", """
SELECT CASE WHEN regexp_matches(upper(p_name), 'BOLT|NUT|WIDGET') THEN 1 ELSE 0 END AS matched,
       COUNT(*) AS n_parts
FROM part GROUP BY ALL
""")
def pattern_any_match(spark: SparkSession, sf: str) -> DataFrame:
    """Upper-cased text against a word list as one regex."""
    p = table(spark, sf, "part", "p_name")
    return (p.groupBy(matches_any("p_name", MATCH_WORDS).cast("int").alias("matched"))
            .agg(F.count(F.lit(1)).alias("n_parts")))


@register("safe_cast", """
SELECT event_type, CAST(SUM(TRY_CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k,
       COUNT(*) - COUNT(TRY_CAST(event_type AS BIGINT)) AS n_not_numeric
FROM events GROUP BY ALL
""")
def safe_cast(spark: SparkSession, sf: str) -> DataFrame:
    """``try_cast`` on text (numbers inside JSON, and text that is not a number)."""
    e = table(spark, sf, "events", "event_type", "props")
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return e.groupBy("event_type").agg(
        F.sum(k).alias("sum_k"),
        (F.count(F.lit(1)) - F.count(F.col("event_type").try_cast("bigint"))).alias("n_not_numeric"))


@register("round_mapping", d.with_sql(*d.SQL_BASE[:1], """
r AS (
  SELECT season, CASE WHEN week BETWEEN 1 AND 9 THEN 1 WHEN week = 10 THEN 2 WHEN week = 11 THEN 3
                      WHEN week = 12 THEN 4 END AS round, l_partkey, """ + d.SQL_REVENUE + """ AS pts
  FROM lines
)
SELECT season, round, l_partkey, COUNT(*) AS n_lines, CAST(SUM(pts) AS DOUBLE) AS points
FROM r GROUP BY ALL
"""))
def round_mapping(spark: SparkSession, sf: str) -> DataFrame:
    """P21 + D86: week -> round (1-9 -> 1, then 10, 11, 12 -> 2, 3, 4) and player-round sums."""
    li = d.lines(spark, sf).withColumn("round", round_of_week("week", 9, (10, 11, 12)))
    return li.groupBy("season", "round", "l_partkey").agg(
        F.count(F.lit(1)).alias("n_lines"), d.revenue_sum().alias("points"))


# --- P16 / P17 HAVING with aliases -----------------------------------------------------

@register("having_alias_rates", d.with_sql(*d.SQL_BASE[:1], """
a AS (
  SELECT season, l_suppkey, COUNT(*) AS attempts,
         SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returns,
         SUM(CASE WHEN l_quantity >= 40 THEN 1 ELSE 0 END) AS big
  FROM lines GROUP BY ALL
)
SELECT season, l_suppkey, attempts, CAST(returns AS BIGINT) AS returns, CAST(big AS BIGINT) AS big,
       round(returns / attempts, 6) AS return_rate, round(big / attempts, 6) AS big_rate
FROM a WHERE returns / attempts >= 0.3
"""))
def having_alias_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Rates defined from aggregates, then filtered on the rate alias."""
    li = d.lines(spark, sf)
    agg = li.groupBy("season", "l_suppkey").agg(
        F.count(F.lit(1)).alias("attempts"),
        csum(F.col("l_returnflag") == "R").alias("returns"),
        csum(F.col("l_quantity") >= 40).alias("big"))
    agg = agg.withColumns({"return_rate": share("returns", "attempts"), "big_rate": share("big", "attempts")})
    return (agg.filter(F.col("return_rate") >= 0.3)
            .withColumns({"return_rate": r6("return_rate"), "big_rate": r6("big_rate")}))


@register("having_threshold", d.with_sql(*d.SQL_BASE[:1], """
a AS (
  SELECT season, l_suppkey, COUNT(*) AS dropbacks,
         CAST(SUM(CAST(l_discount AS DECIMAL(3,2))) AS DOUBLE) AS disc_sum,
         AVG(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS avg_qty_returned
  FROM lines GROUP BY ALL
)
SELECT season, l_suppkey, dropbacks, round(disc_sum / dropbacks, 6) AS disc_per_line,
       round(avg_qty_returned, 6) AS avg_qty_returned
FROM a WHERE dropbacks >= 80
"""))
def having_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """P17 + A3: per supplier-season, kept only with at least 80 lines."""
    li = d.lines(spark, sf)
    agg = li.groupBy("season", "l_suppkey").agg(
        F.count(F.lit(1)).alias("dropbacks"),
        _dbl_sum(F.col("l_discount").cast("decimal(3,2)")).alias("disc_sum"),
        cavg(F.col("l_returnflag") == "R", "l_quantity").alias("avg_qty_returned"))
    return agg.filter(F.col("dropbacks") >= 80).select(
        "season", "l_suppkey", "dropbacks", r6(share("disc_sum", "dropbacks")).alias("disc_per_line"),
        r6("avg_qty_returned").alias("avg_qty_returned"))


# --- A1 .. A13 aggregates ------------------------------------------------------------

@register("agg_basic", d.with_sql(*d.SQL_BASE[:1], """
SELECT season, week, COUNT(*) AS n_lines, CAST(SUM(l_quantity) AS DOUBLE) AS sum_qty,
       CAST(SUM(""" + d.SQL_REVENUE + """) AS DOUBLE) AS revenue,
       round(CAST(SUM(CAST(l_discount AS DECIMAL(3,2))) AS DOUBLE) / COUNT(*), 6) AS avg_discount,
       MIN(l_extendedprice) AS min_price, MAX(l_extendedprice) AS max_price
FROM lines GROUP BY ALL
"""))
def agg_basic(spark: SparkSession, sf: str) -> DataFrame:
    """A1: SUM / AVG / COUNT / MIN / MAX by (season, week)."""
    li = d.lines(spark, sf)
    return li.groupBy("season", "week").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("sum_qty"),
        d.revenue_sum().alias("revenue"),
        r6(_dbl_sum(F.col("l_discount").cast("decimal(3,2)")) / F.count(F.lit(1))).alias("avg_discount"),
        F.min("l_extendedprice").alias("min_price"), F.max("l_extendedprice").alias("max_price"))


@register("agg_conditional", d.with_sql(*d.SQL_BASE[:1], """
SELECT season, l_suppkey, COUNT(*) AS n_lines,
       CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned,
       CAST(SUM(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS open_lines,
       CAST(SUM(CASE WHEN l_quantity >= 40 THEN 1 ELSE 0 END) AS BIGINT) AS big_lines,
       CAST(SUM(CASE WHEN l_discount >= 0.08 THEN l_quantity ELSE 0 END) AS DOUBLE) AS qty_high_disc,
       round(AVG(CASE WHEN l_returnflag = 'R' THEN l_quantity END), 6) AS avg_qty_returned
FROM lines GROUP BY ALL
"""))
def agg_conditional(spark: SparkSession, sf: str) -> DataFrame:
    """A2 + A3: conditional counts, a conditional sum and a conditional average."""
    li = d.lines(spark, sf)
    return li.groupBy("season", "l_suppkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        csum(F.col("l_returnflag") == "R").alias("returned"),
        csum(F.col("l_linestatus") == "O").alias("open_lines"),
        csum(F.col("l_quantity") >= 40).alias("big_lines"),
        F.sum(F.when(F.col("l_discount") >= 0.08, F.col("l_quantity")).otherwise(0.0)).alias("qty_high_disc"),
        r6(cavg(F.col("l_returnflag") == "R", "l_quantity")).alias("avg_qty_returned"))


@register("agg_filter", d.with_sql(*d.SQL_BASE[:1], """
SELECT o_orderpriority, COUNT(*) FILTER (WHERE l_returnflag = 'R') AS n_returned,
       round(AVG(l_quantity) FILTER (WHERE l_linestatus = 'O'), 6) AS avg_qty_open,
       MAX(l_extendedprice) FILTER (WHERE l_discount = 0) AS max_price_no_disc,
       CAST(MEDIAN(l_quantity) FILTER (WHERE l_returnflag = 'A') AS DOUBLE) AS median_qty_a
FROM lines GROUP BY ALL
"""))
def agg_filter(spark: SparkSession, sf: str) -> DataFrame:
    """A4: aggregate ``FILTER (WHERE ...)`` on COUNT, AVG, MAX and MEDIAN."""
    li = d.lines(spark, sf)
    return li.groupBy("o_orderpriority").agg(
        F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("n_returned"),
        r6(F.avg(F.when(F.col("l_linestatus") == "O", F.col("l_quantity")))).alias("avg_qty_open"),
        F.max(F.when(F.col("l_discount") == 0, F.col("l_extendedprice"))).alias("max_price_no_disc"),
        F.median(F.when(F.col("l_returnflag") == "A", F.col("l_quantity"))).alias("median_qty_a"))


@register("agg_count_distinct", d.with_sql(*d.SQL_BASE[:1], """
SELECT o_custkey, MIN(season) AS first_season, MAX(season) AS last_season,
       COUNT(DISTINCT season) AS n_seasons,
       COUNT(DISTINCT CAST(season AS VARCHAR) || '-' || CAST(week AS VARCHAR)) AS n_weeks,
       COUNT(DISTINCT l_suppkey) AS n_suppliers
FROM lines GROUP BY ALL
"""))
def agg_count_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """A5 (D57): first/last season, distinct seasons, distinct composed season-week keys."""
    li = d.lines(spark, sf)
    return li.groupBy("o_custkey").agg(
        F.min("season").alias("first_season"), F.max("season").alias("last_season"),
        F.countDistinct("season").alias("n_seasons"),
        F.countDistinct(F.concat_ws("-", "season", "week")).alias("n_weeks"),
        F.countDistinct("l_suppkey").alias("n_suppliers"))


@register("distinct_rows", d.with_sql(*d.SQL_BASE[:1], """
SELECT DISTINCT season, o_orderpriority, l_returnflag FROM lines
"""))
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A6."""
    return d.lines(spark, sf).select("season", "o_orderpriority", "l_returnflag").distinct()


def order_totals(spark: SparkSession, sf: str) -> DataFrame:
    """Game grain: one row per order with exact revenue, line count and quantity."""
    li = d.lines(spark, sf)
    return li.groupBy("l_orderkey", "season", "week").agg(
        d.revenue_sum().alias("order_revenue"), F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("qty"), F.max("l_quantity").alias("max_qty"),
        F.max("l_linenumber").alias("max_line"))


SQL_ORDER_TOTALS = """
order_totals AS (
  SELECT l_orderkey, season, week, CAST(SUM(""" + d.SQL_REVENUE + """) AS DOUBLE) AS order_revenue,
         COUNT(*) AS n_lines, CAST(SUM(l_quantity) AS DOUBLE) AS qty, MAX(l_quantity) AS max_qty,
         MAX(l_linenumber) AS max_line
  FROM lines GROUP BY ALL
)"""


@register("agg_median", d.with_sql(d.SQL_LINES, SQL_ORDER_TOTALS, """
SELECT season, COUNT(*) AS n_orders, round(AVG(order_revenue), 6) AS mean_revenue,
       round(MEDIAN(order_revenue), 6) AS median_revenue, CAST(MEDIAN(n_lines) AS DOUBLE) AS median_lines
FROM order_totals GROUP BY ALL
"""))
def agg_median(spark: SparkSession, sf: str) -> DataFrame:
    """A8 (D22): per-game totals, then per-season mean and continuous median, selected by rank
    over range slices (no season is gathered in one buffer)."""
    g = order_totals(spark, sf)
    out = g.groupBy("season").agg(
        F.count(F.lit(1)).alias("n_orders"), r6(F.avg("order_revenue")).alias("mean_revenue"))
    out = with_median(out, g, ["season"], "order_revenue", "median_revenue")
    out = with_median(out, g, ["season"], "n_lines", "median_lines")
    return out.withColumn("median_revenue", r6("median_revenue"))


_CORR = """COUNT(*) AS n, round(covar_pop(y, x), 6) AS covar_pop,
       round(CASE WHEN COUNT(*) > 1 THEN covar_samp(y, x) END, 6) AS covar_samp,
       round(CASE WHEN MIN(x) < MAX(x) AND MIN(y) < MAX(y) THEN corr(y, x) END, 6) AS corr"""


@register("agg_correlation", d.with_sql(d.SQL_LINES, f"""
a AS (SELECT 'lines of a supplier and month' AS grain, season, week, l_suppkey AS id, l_quantity AS x, l_extendedprice AS y
      FROM lines),
b AS (SELECT 'line numbers' AS grain, season, 0 AS week, l_linenumber AS id, CAST(l_linenumber AS DOUBLE) AS x,
             l_quantity AS y FROM lines),
c AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT grain, season, week, id, {_CORR} FROM c GROUP BY grain, season, week, id"""))
def agg_correlation(spark: SparkSession, sf: str) -> DataFrame:
    """Covariance and guarded correlation per group: suppliers' months (many of a single
    line) and line numbers (a constant input, so NULL)."""
    li = d.lines(spark, sf)
    a = li.select(F.lit("lines of a supplier and month").alias("grain"), "season", "week",
                  F.col("l_suppkey").cast("bigint").alias("id"), F.col("l_quantity").alias("x"),
                  F.col("l_extendedprice").alias("y"))
    b = li.select(F.lit("line numbers").alias("grain"), "season", F.lit(0).alias("week"),
                  F.col("l_linenumber").cast("bigint").alias("id"), F.col("l_linenumber").cast("double").alias("x"),
                  F.col("l_quantity").alias("y"))
    out = correlation(a.unionByName(b), ["grain", "season", "week", "id"], "x", "y")
    return out.withColumns({c: r6(c) for c in ("covar_pop", "covar_samp", "corr")})


@register("agg_quantile_iqr", d.with_sql(d.SQL_LINES, SQL_ORDER_TOTALS, """
SELECT season, CAST(quantile_disc(qty, 0.5) AS DOUBLE) AS median_qty,
       CAST(MIN(qty) AS DOUBLE) AS min_qty,
       CAST(quantile_disc(qty, 0.75) - quantile_disc(qty, 0.25) AS DOUBLE) AS iqr_qty
FROM order_totals GROUP BY ALL
"""))
def agg_quantile_iqr(spark: SparkSession, sf: str) -> DataFrame:
    """Discrete quantiles (``percentile_disc``): median, min and IQR."""
    g = order_totals(spark, sf)

    def q(p: float) -> F.Column:
        return F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY qty)")

    return g.groupBy("season").agg(
        q(0.5).alias("median_qty"), F.min("qty").alias("min_qty"),
        (q(0.75) - q(0.25)).alias("iqr_qty"))


@register("agg_stddev", """
SELECT c_nationkey, c_mktsegment, COUNT(*) AS n,
       round(STDDEV_POP(c_acctbal), 6) AS sd_pop, round(STDDEV_SAMP(c_acctbal), 6) AS sd_samp
FROM customer GROUP BY ALL
""")
def agg_stddev(spark: SparkSession, sf: str) -> DataFrame:
    """A10: population and sample standard deviation (NULL sample sd for one-row groups)."""
    c = table(spark, sf, "customer", "c_nationkey", "c_mktsegment", "c_acctbal")
    return c.groupBy("c_nationkey", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), r6(F.stddev_pop("c_acctbal")).alias("sd_pop"),
        r6(F.stddev_samp("c_acctbal")).alias("sd_samp"))


@register("agg_two_level", d.with_sql(d.SQL_LINES, SQL_ORDER_TOTALS, """
SELECT season, COUNT(*) AS n_games, round(AVG(n_lines), 6) AS lines_per_game,
       round(AVG(qty), 6) AS qty_per_game, round(SUM(CASE WHEN n_lines >= 5 THEN 1 ELSE 0 END) / COUNT(*), 6) AS long_game_rate
FROM order_totals GROUP BY ALL
"""))
def agg_two_level(spark: SparkSession, sf: str) -> DataFrame:
    """A12 (D25): game-level aggregate, then season-level aggregate over games."""
    g = order_totals(spark, sf)
    return g.groupBy("season").agg(
        F.count(F.lit(1)).alias("n_games"), r6(F.avg("n_lines")).alias("lines_per_game"),
        r6(F.avg("qty")).alias("qty_per_game"),
        r6(share(csum(F.col("n_lines") >= 5), F.count(F.lit(1)))).alias("long_game_rate"))


@register("agg_game_points", d.with_sql(d.SQL_LINES, SQL_ORDER_TOTALS, """
SELECT season, week, round(AVG(max_qty + max_line), 6) AS avg_game_points
FROM order_totals GROUP BY ALL
"""))
def agg_game_points(spark: SparkSession, sf: str) -> DataFrame:
    """Per-game ``MAX(home) + MAX(away)``, averaged per week."""
    g = order_totals(spark, sf)
    return g.groupBy("season", "week").agg(r6(F.avg(F.col("max_qty") + F.col("max_line"))).alias("avg_game_points"))


# --- A14 / A21 / W8 shares -----------------------------------------------------------------

@register("share_of_total", d.with_sql(*d.SQL_BASE, """
s AS (
  SELECT season, team, l_suppkey, CAST(SUM(""" + d.SQL_REVENUE + """) AS DOUBLE) AS revenue
  FROM lines_team GROUP BY ALL
),
t AS (SELECT season, team, SUM(revenue) AS team_revenue FROM s GROUP BY ALL)
SELECT s.season, s.team, s.l_suppkey, round(s.revenue, 6) AS revenue,
       round(t.team_revenue, 6) AS team_revenue, round(s.revenue / t.team_revenue, 6) AS revenue_share
FROM s JOIN t USING (season, team)
"""))
def share_of_total_q(spark: SparkSession, sf: str) -> DataFrame:
    """A14 (D45/D48): each supplier's share of its nation's revenue per season."""
    li = d.lines_team(spark, sf)
    s = li.groupBy("season", "team", "l_suppkey").agg(d.revenue_sum().alias("revenue"))
    out = share_of_total(s, ["season", "team"], "revenue", "team_revenue", "revenue_share")
    return out.select("season", "team", "l_suppkey", r6("revenue").alias("revenue"),
                      r6("team_revenue").alias("team_revenue"), r6("revenue_share").alias("revenue_share"))


@register("pct_of_group", d.with_sql(*d.SQL_BASE, """
SELECT team, o_orderpriority, COUNT(*) AS n_lines,
       round(100.0 * COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY team), 6) AS pct_of_team
FROM lines_team GROUP BY team, o_orderpriority
"""))
def pct_of_group(spark: SparkSession, sf: str) -> DataFrame:
    """A21 / W10 (D35): usage percent within team, an aggregate over an aggregate."""
    li = d.lines_team(spark, sf)
    c = li.groupBy("team", "o_orderpriority").agg(F.count(F.lit(1)).alias("n_lines"))
    c = with_group_totals(c, ["team"], {"__team_n": F.sum("n_lines")})
    return c.select("team", "o_orderpriority", "n_lines",
                    r6(share(F.col("n_lines") * 100.0, "__team_n")).alias("pct_of_team"))


@register("share_window_pct", d.with_sql(*d.SQL_BASE[:1], """
p AS (SELECT season, week, l_suppkey, CAST(SUM(l_quantity) AS DOUBLE) AS qty FROM lines GROUP BY ALL)
SELECT season, week, l_suppkey, qty, SUM(qty) OVER (PARTITION BY season, week) AS week_qty,
       round(100.0 * qty / SUM(qty) OVER (PARTITION BY season, week), 6) AS pct
FROM p
"""))
def share_window_pct(spark: SparkSession, sf: str) -> DataFrame:
    """W8 (D83): group total attached to each row and percent share."""
    p = d.lines(spark, sf).groupBy("season", "week", "l_suppkey").agg(F.sum("l_quantity").alias("qty"))
    p = with_group_totals(p, ["season", "week"], {"week_qty": F.sum("qty")})
    return p.withColumn("pct", r6(share(F.col("qty") * 100.0, "week_qty")))


@register("share_sum_check", d.with_sql(*d.SQL_BASE, """
s AS (SELECT season, team, l_suppkey, SUM(l_quantity) AS qty FROM lines_team GROUP BY ALL),
sh AS (SELECT season, team, qty / SUM(qty) OVER (PARTITION BY season, team) AS sh FROM s)
SELECT season, team, COUNT(*) AS n_members, round(SUM(sh), 6) AS share_sum,
       abs(SUM(sh) - 1) <= 0.001 AS sums_to_one
FROM sh GROUP BY ALL
"""))
def share_sum_check(spark: SparkSession, sf: str) -> DataFrame:
    """Shares within a group sum to 1 (tolerance 0.001, the reference's criterion)."""
    s = d.lines_team(spark, sf).groupBy("season", "team", "l_suppkey").agg(F.sum("l_quantity").alias("qty"))
    s = share_of_total(s, ["season", "team"], "qty", "__tot", "sh")
    return s.groupBy("season", "team").agg(
        F.count(F.lit(1)).alias("n_members"), r6(F.sum("sh")).alias("share_sum"),
        (F.abs(F.sum("sh") - 1) <= 0.001).alias("sums_to_one"))


# --- A16 mode, A17 bucket weights, A19 fingerprint ---------------------------------------

@register("mode_per_key", """
WITH c AS (SELECT user_id, event_type, COUNT(*) AS n FROM events GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS rn FROM c)
SELECT user_id, event_type, n FROM r WHERE rn = 1
""")
def mode_per_key_q(spark: SparkSession, sf: str) -> DataFrame:
    """Most frequent event type per user, ties to the smallest type."""
    e = table(spark, sf, "events", "user_id", "event_type")
    return mode_per_key(e, ["user_id"], "event_type")


@register("bucket_weight_score", d.with_sql(*d.SQL_BASE[:1], """
SELECT season, l_suppkey,
       CAST(SUM(CASE WHEN l_quantity >= 40 THEN 80 WHEN l_quantity >= 25 THEN 50
                     WHEN l_quantity >= 10 THEN 30 ELSE 15 END) AS DOUBLE) / 100 AS expected_points,
       CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 60 ELSE 40 END) AS DOUBLE) / 100 AS weighted_flags
FROM lines GROUP BY ALL
"""))
def bucket_weight_score(spark: SparkSession, sf: str) -> DataFrame:
    """A17 (D77): weighted expected score by buckets (0.8/0.5/0.3/0.15 and 0.6/0.4).

    Weights are summed as integer hundredths and divided once, so the result is exact.
    """
    li = d.lines(spark, sf)
    q = F.col("l_quantity")
    w1 = F.when(q >= 40, 80).when(q >= 25, 50).when(q >= 10, 30).otherwise(15)
    w2 = F.when(F.col("l_returnflag") == "R", 60).otherwise(40)
    return li.groupBy("season", "l_suppkey").agg(
        (F.sum(w1).cast("double") / 100).alias("expected_points"),
        (F.sum(w2).cast("double") / 100).alias("weighted_flags"))
