"""Registered driver queries: windows, ranking, dedupe and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.functions.columns import r6, round_half_up, share
from gridmart.operators.dedupe import dedupe_first, dedupe_latest, dedupe_most_complete
from gridmart.operators.periods import next_period
from gridmart.operators.quality import key_fingerprint
from gridmart.operators.ranking import previous_in_groups, row_number_in_groups, top_n, top_n_per_group
from gridmart.operators.shares import with_group_totals
from gridmart.operators.stats import delta_summary, effect_ci, histogram, median_band, pivot_diff
from gridmart.plans import driver as d
from gridmart.plans.registry import register
from gridmart.sources.tables import table

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"]


# --- A18 dedupe ----------------------------------------------------------------------------

@register("dedupe_first", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_returnflag NULLS LAST, l_partkey, l_suppkey) AS rn
  FROM lineitem) WHERE rn = 1
""")
def dedupe_first_q(spark: SparkSession, sf: str) -> DataFrame:
    """One row per (order, line number); first by flag (NULLS LAST) then parts."""
    li = table(spark, sf, "lineitem", *LINE_COLS)
    return dedupe_first(li, LINE_KEY, "l_returnflag", ["l_partkey", "l_suppkey"])


@register("dedupe_latest", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC) AS rn
  FROM lineitem) WHERE rn = 1
""")
def dedupe_latest_q(spark: SparkSession, sf: str) -> DataFrame:
    """Newest ship date wins per key."""
    li = table(spark, sf, "lineitem", *LINE_COLS, "l_shipdate")
    return dedupe_latest(li, LINE_KEY, "l_shipdate", ["l_partkey", "l_suppkey"]).drop("l_shipdate")


@register("dedupe_most_complete", """
WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, NULLIF(l_discount, 0) AS disc,
                  NULLIF(l_tax, 0) AS tax, NULLIF(l_returnflag, 'N') AS flag FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, disc, tax, flag FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
     ORDER BY (CASE WHEN disc IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN tax IS NOT NULL THEN 1 ELSE 0 END
               + CASE WHEN flag IS NOT NULL THEN 1 ELSE 0 END) DESC, l_partkey, l_suppkey) AS rn
  FROM v) WHERE rn = 1
""")
def dedupe_most_complete_q(spark: SparkSession, sf: str) -> DataFrame:
    """The copy with the most filled columns wins (ids-table policy)."""
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
               "l_discount", "l_tax", "l_returnflag")
    v = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                  F.nullif("l_discount", F.lit(0.0)).alias("disc"), F.nullif("l_tax", F.lit(0.0)).alias("tax"),
                  F.nullif("l_returnflag", F.lit("N")).alias("flag"))
    return dedupe_most_complete(v, LINE_KEY, ["disc", "tax", "flag"], ["l_partkey", "l_suppkey"])


# --- W4 / W5 / W6 ------------------------------------------------------------------------------

@register("window_conditional_count", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       COUNT(*) FILTER (WHERE l_returnflag = 'R') OVER (PARTITION BY l_orderkey) AS n_returned_in_order,
       COUNT(*) OVER (PARTITION BY l_orderkey) AS n_in_order
FROM lineitem
""")
def window_conditional_count(spark: SparkSession, sf: str) -> DataFrame:
    """W4 + W3: conditional and plain counts over the order attached to each line
    (aggregate + join, so a huge order is summed map-side)."""
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    out = with_group_totals(li, ["l_orderkey"], {
        "n_returned_in_order": F.count_if(F.col("l_returnflag") == "R"),
        "n_in_order": F.count(F.lit(1))})
    return out.drop("l_returnflag")


GAP_CAP_SECONDS = 3600  # fixed parameter of the analogue: gaps above one hour count as one hour


@register("lag_gap_capped", f"""
WITH g AS (
  SELECT user_id, date_diff('microsecond', LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts)
           / 1000000.0 AS gap
  FROM events
),
c AS (SELECT user_id, CASE WHEN gap < 0 THEN NULL ELSE least(gap, {GAP_CAP_SECONDS}) END AS gap FROM g)
SELECT user_id, COUNT(gap) AS n_gaps, round(SUM(gap), 6) AS total_gap,
       round(SUM(gap) / COUNT(gap), 6) AS sec_per_event
FROM c GROUP BY ALL
""")
def lag_gap_capped(spark: SparkSession, sf: str) -> DataFrame:
    """Seconds since the user's previous event, negatives NULL, capped, then
    sum/count per user. The LAG runs range-split so a hot user spreads over tasks."""
    e = table(spark, sf, "events", "event_id", "user_id", "ts").withColumn(
        "__us", F.unix_micros(F.col("ts").cast("timestamp")))
    lagged = previous_in_groups(e, ["user_id"], [F.col("ts").asc(), F.col("event_id").asc()],
                                "__us", "__prev", method="range")
    gap = (F.col("__us") - F.col("__prev")) / 1_000_000.0
    capped = F.when(gap < 0, F.lit(None)).otherwise(F.least(gap, F.lit(float(GAP_CAP_SECONDS))))
    g = lagged.select("user_id", capped.alias("gap"))
    return g.groupBy("user_id").agg(
        F.count("gap").alias("n_gaps"), r6(F.sum("gap")).alias("total_gap"),
        r6(F.sum("gap") / F.count("gap")).alias("sec_per_event"))


def customer_orders_with_rest(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with rest days since the customer's previous order and its priority.

    One range-split LAG carries both previous values (a struct), so a customer with a
    huge order history is spread over several tasks."""
    o = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    order = [F.col("o_orderdate").asc(), F.col("o_orderkey").asc()]
    o = o.withColumn("__prev", F.struct("o_orderdate", "o_orderpriority"))
    o = previous_in_groups(o, ["o_custkey"], order, "__prev", "__p", method="range")
    o = o.withColumns({"prev_date": F.col("__p.o_orderdate"), "prev_priority": F.col("__p.o_orderpriority")})
    o = o.drop("__prev", "__p")
    return o.withColumn("rest_days", F.datediff(F.to_date("o_orderdate"), F.to_date("prev_date")))


_REST_SQL = """
r AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority,
         date_diff('day', CAST(LAG(o_orderdate) OVER w AS DATE), CAST(o_orderdate AS DATE)) AS rest_days,
         LAG(o_orderpriority) OVER w AS prev_priority
  FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
)"""


@register("rest_days", "WITH " + _REST_SQL.strip() + """
SELECT CASE WHEN rest_days IS NULL THEN 'first' WHEN rest_days <= 30 THEN 'short'
            WHEN rest_days >= 365 THEN 'long' ELSE 'normal' END AS rest_band,
       COALESCE(prev_priority = '1-URGENT', false) AS prev_urgent, COUNT(*) AS n_orders,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
FROM r GROUP BY ALL
""")
def rest_days(spark: SparkSession, sf: str) -> DataFrame:
    """Rest days (LAG of the date) and the previous order's flag (LAG of a flag)."""
    o = customer_orders_with_rest(spark, sf)
    band = (F.when(F.col("rest_days").isNull(), "first").when(F.col("rest_days") <= 30, "short")
            .when(F.col("rest_days") >= 365, "long").otherwise("normal"))
    return o.groupBy(band.alias("rest_band"),
                     F.coalesce(F.col("prev_priority") == "1-URGENT", F.lit(False)).alias("prev_urgent")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total_price"))


@register("effect_ci", "WITH " + _REST_SQL.strip() + """,
m AS (SELECT o_custkey, AVG(o_totalprice) AS cust_mean FROM orders GROUP BY ALL),
f AS (
  SELECT r.o_custkey, r.o_totalprice - m.cust_mean AS effect,
         CASE WHEN rest_days <= 30 THEN 1 ELSE 0 END AS short_rest,
         CASE WHEN rest_days >= 365 THEN 1 ELSE 0 END AS long_rest,
         CASE WHEN prev_priority = '1-URGENT' THEN 1 ELSE 0 END AS prev_urgent,
         CASE WHEN rest_days IS NULL THEN 1 ELSE 0 END AS first_order
  FROM r JOIN m USING (o_custkey)
),
l AS (SELECT 'short_rest' AS event, effect FROM f WHERE short_rest = 1
      UNION ALL SELECT 'long_rest', effect FROM f WHERE long_rest = 1
      UNION ALL SELECT 'prev_urgent', effect FROM f WHERE prev_urgent = 1
      UNION ALL SELECT 'first_order', effect FROM f WHERE first_order = 1)
SELECT event, COUNT(*) AS n, round(AVG(effect), 4) AS mean_effect, round(STDDEV_SAMP(effect), 4) AS sd_effect,
       round(AVG(effect) - 1.96 * STDDEV_SAMP(effect) / sqrt(COUNT(*)), 4) AS ci_lo,
       round(AVG(effect) + 1.96 * STDDEV_SAMP(effect) / sqrt(COUNT(*)), 4) AS ci_hi
FROM l GROUP BY ALL
""")
def effect_ci_q(spark: SparkSession, sf: str) -> DataFrame:
    """Event-study effects on order value vs the customer's own mean, 95% CI."""
    o = customer_orders_with_rest(spark, sf)
    o = with_group_totals(o, ["o_custkey"], {"cust_mean": F.avg("o_totalprice")})
    f = o.select(
        (F.col("o_totalprice") - F.col("cust_mean")).alias("effect"),
        F.when(F.col("rest_days") <= 30, 1).otherwise(0).alias("short_rest"),
        F.when(F.col("rest_days") >= 365, 1).otherwise(0).alias("long_rest"),
        F.when(F.col("prev_priority") == "1-URGENT", 1).otherwise(0).alias("prev_urgent"),
        F.when(F.col("rest_days").isNull(), 1).otherwise(0).alias("first_order"))
    out = effect_ci(f, [], ["short_rest", "long_rest", "prev_urgent", "first_order"], "effect")
    return out.select("event", "n", *[round_half_up(c, 4).alias(c) for c in ("mean_effect", "sd_effect", "ci_lo", "ci_hi")])


# --- W2 / W3 tiers, T1-T3 ---------------------------------------------------------------------

TIER_SIZE = 12  # fixed value: players per tier


@register("tier_shares", d.with_sql(d.SQL_LINES, f"""
s AS (SELECT li.season, c.c_nationkey, li.o_custkey, CAST(SUM({d.SQL_REVENUE}) AS DOUBLE) AS pts
      FROM lines li JOIN customer c ON c.c_custkey = li.o_custkey GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY season, c_nationkey ORDER BY pts DESC, o_custkey) AS rnk,
             COUNT(*) OVER (PARTITION BY season, c_nationkey) AS group_n,
             SUM(pts) OVER (PARTITION BY season, c_nationkey) AS group_pts FROM s)
SELECT season, c_nationkey, (rnk - 1) // {TIER_SIZE} + 1 AS tier, COUNT(*) AS n_players, MIN(group_n) AS group_n,
       round(SUM(pts), 6) AS tier_points, round(SUM(pts) / MIN(group_pts), 6) AS tier_share,
       round(MIN(pts), 6) AS min_points, round(MAX(pts), 6) AS max_points
FROM r GROUP BY ALL
"""))
def tier_shares(spark: SparkSession, sf: str) -> DataFrame:
    """W2 + W3 + Q1 (D79/D80): customers ranked by spend within nation-season, tiers of 12
    (integer division, the stated intent), tier share of the group's total. The ranking
    runs range-split so one huge nation-season does not land in one task."""
    c = table(spark, sf, "customer", "c_custkey", "c_nationkey")
    s = (d.lines(spark, sf).join(c, F.col("o_custkey") == F.col("c_custkey"))
         .groupBy("season", "c_nationkey", "o_custkey").agg(d.revenue_sum().alias("pts")))
    g = ["season", "c_nationkey"]
    r = row_number_in_groups(s, g, [F.col("pts").desc(), F.col("o_custkey").asc()], "rnk", method="range")
    r = with_group_totals(r, g, {"group_n": F.count(F.lit(1)), "group_pts": F.sum("pts")})
    tier = (F.floor((F.col("rnk") - 1) / TIER_SIZE) + 1).cast("bigint")
    return r.groupBy(*g, tier.alias("tier")).agg(
        F.count(F.lit(1)).alias("n_players"), F.min("group_n").alias("group_n"),
        r6(F.sum("pts")).alias("tier_points"), r6(share(F.sum("pts"), F.min("group_pts"))).alias("tier_share"),
        r6(F.min("pts")).alias("min_points"), r6(F.max("pts")).alias("max_points"))


_SUPPLIER_REV = d.with_sql(d.SQL_LINES, f"""
s AS (SELECT l_suppkey, CAST(SUM({d.SQL_REVENUE}) AS DOUBLE) AS revenue FROM lines GROUP BY ALL)
SELECT l_suppkey, revenue FROM s ORDER BY revenue DESC, l_suppkey LIMIT 50
""")


@register("top_n", _SUPPLIER_REV)
def top_n_q(spark: SparkSession, sf: str) -> DataFrame:
    """T2 (D41/D46/D50/D62 shape): fixed top 50 suppliers by revenue, key tie-break."""
    s = d.lines(spark, sf).groupBy("l_suppkey").agg(d.revenue_sum().alias("revenue"))
    return top_n(s, 50, [F.col("revenue").desc(), F.col("l_suppkey").asc()])


@register("top_n_param", d.with_sql(d.SQL_LINES, f"""
s AS (SELECT season, l_partkey, CAST(SUM({d.SQL_REVENUE}) AS DOUBLE) AS points FROM lines GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY season ORDER BY points DESC, l_partkey) AS rank FROM s)
SELECT season, l_partkey, points, rank FROM r WHERE rank <= 10
"""))
def top_n_param(spark: SparkSession, sf: str, n: int = 10) -> DataFrame:
    """T3 + P3 (D15/D16): top-``n`` parts by points in every season (``n`` typed)."""
    s = d.lines(spark, sf).groupBy("season", "l_partkey").agg(d.revenue_sum().alias("points"))
    out = top_n_per_group(s, ["season"], n, [F.col("points").desc(), F.col("l_partkey").asc()])
    return out.withColumn("rank", F.col("rank").cast("bigint"))


@register("sort_multi", """
SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer
ORDER BY c_nationkey ASC, c_acctbal DESC NULLS LAST, c_custkey
""")
def sort_multi(spark: SparkSession, sf: str) -> DataFrame:
    """Multi-key, mixed-direction sort with explicit NULL placement (a range-partitioned
    global sort, no single-task bottleneck)."""
    c = table(spark, sf, "customer", "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    return c.orderBy(F.col("c_nationkey").asc_nulls_last(), F.col("c_acctbal").desc_nulls_last(),
                     F.col("c_custkey").asc())


# --- A19 fingerprint, A22-A25 -------------------------------------------------------------------

@register("key_fingerprint", d.with_sql(d.SQL_LINES, """
k AS (SELECT season, CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) || '|' ||
                     CAST(l_partkey AS VARCHAR) || '|' || CAST(l_suppkey AS VARCHAR) AS key FROM lines)
SELECT season, COUNT(*) AS row_count,
       CAST(SUM(CAST('0x' || substr(md5(key), 1, 8) AS BIGINT)) AS BIGINT) AS fingerprint
FROM k GROUP BY ALL
"""))
def key_fingerprint_q(spark: SparkSession, sf: str) -> DataFrame:
    """Order-independent key fingerprint per season partition."""
    return key_fingerprint(d.lines(spark, sf), ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], ["season"])


@register("pivot_diff", d.with_sql(d.SQL_LINES, """
a AS (SELECT season, l_returnflag, AVG(l_quantity) AS q FROM lines GROUP BY ALL)
SELECT season,
       round(COALESCE(MAX(q) FILTER (WHERE l_returnflag = 'A'), 0.0), 6) AS A,
       round(COALESCE(MAX(q) FILTER (WHERE l_returnflag = 'N'), 0.0), 6) AS N,
       round(COALESCE(MAX(q) FILTER (WHERE l_returnflag = 'R'), 0.0), 6) AS R,
       round(COALESCE(MAX(q) FILTER (WHERE l_returnflag = 'R'), 0.0)
             - COALESCE(MAX(q) FILTER (WHERE l_returnflag = 'N'), 0.0), 6) AS diff
FROM a GROUP BY ALL
"""))
def pivot_diff_q(spark: SparkSession, sf: str) -> DataFrame:
    """Average quantity per return flag as columns, missing = 0, and R - N."""
    out = pivot_diff(d.lines(spark, sf), ["season"], "l_returnflag", ["A", "N", "R"], "l_quantity", "R", "N")
    return out.select("season", *[r6(c).alias(c) for c in ("A", "N", "R", "diff")])


@register("band_median_std", d.with_sql(d.SQL_LINES, f"""
w AS (SELECT season, week, CAST(SUM({d.SQL_REVENUE}) AS DOUBLE) AS revenue FROM lines GROUP BY ALL)
SELECT season, round(MEDIAN(revenue), 4) AS median, round(STDDEV_SAMP(revenue), 4) AS sd,
       round(MEDIAN(revenue) - STDDEV_SAMP(revenue), 4) AS band_lo,
       round(MEDIAN(revenue) + STDDEV_SAMP(revenue), 4) AS band_hi
FROM w GROUP BY ALL
"""))
def band_median_std(spark: SparkSession, sf: str) -> DataFrame:
    """Season median of weekly revenue +- one sample standard deviation."""
    w = d.lines(spark, sf).groupBy("season", "week").agg(d.revenue_sum().alias("revenue"))
    out = median_band(w, ["season"], "revenue")
    return out.select("season", *[round_half_up(c, 4).alias(c) for c in ("median", "sd", "band_lo", "band_hi")])


@register("delta_summary", d.with_sql(d.SQL_LINES, f"""
s AS (SELECT o_custkey, season, SUM({d.SQL_REVENUE}) AS spend FROM lines GROUP BY ALL),
dd AS (SELECT a.o_custkey, CAST(n.spend - a.spend AS DOUBLE) AS delta
       FROM s a JOIN s n ON n.o_custkey = a.o_custkey AND n.season = a.season + 1)
SELECT c.c_mktsegment, COUNT(*) AS n, round(COUNT(*) FILTER (WHERE delta > 0) / COUNT(*), 6) AS share_improved,
       round(MEDIAN(delta), 6) AS median_delta
FROM dd JOIN customer c ON c.c_custkey = dd.o_custkey GROUP BY ALL
"""))
def delta_summary_q(spark: SparkSession, sf: str) -> DataFrame:
    """Season-over-season spend change summarised per market segment."""
    s = d.lines(spark, sf).groupBy("o_custkey", "season").agg(d.exact_sum(d.revenue_e4()).alias("spend_e4"))
    nx = next_period(s, ["o_custkey"], "season", ["spend_e4"], how="inner")
    nx = nx.select("o_custkey", ((F.col("spend_e4_next") - F.col("spend_e4")) / 1e4).alias("delta"))
    c = table(spark, sf, "customer", "c_custkey", "c_mktsegment")
    out = delta_summary(nx.join(c, F.col("o_custkey") == F.col("c_custkey")), ["c_mktsegment"], "delta")
    return out.select("c_mktsegment", "n", r6("share_improved").alias("share_improved"),
                      r6("median_delta").alias("median_delta"))


@register("histogram_bins", """
WITH t AS (SELECT o_totalprice AS x FROM orders),
mm AS (SELECT MIN(x) AS mn, MAX(x) AS mx FROM t),
b AS (SELECT LEAST(CASE WHEN (mx - mn) / 30 > 0 THEN floor((x - mn) / ((mx - mn) / 30)) ELSE 0 END, 29) AS bin,
             mn, mx FROM t, mm)
SELECT CAST(bin AS INTEGER) AS bin, COUNT(*) AS n, round(MIN(mn) + bin * (MIN(mx) - MIN(mn)) / 30, 4) AS bin_lo,
       round(MIN(mn) + (bin + 1) * (MIN(mx) - MIN(mn)) / 30, 4) AS bin_hi
FROM b GROUP BY bin
""")
def histogram_bins(spark: SparkSession, sf: str) -> DataFrame:
    """Fixed-width histogram of order value with at most 30 bins."""
    o = table(spark, sf, "orders", "o_totalprice")
    h = histogram(o, "o_totalprice", 30)
    return h.select("bin", "n", round_half_up("bin_lo", 4).alias("bin_lo"), round_half_up("bin_hi", 4).alias("bin_hi"))

