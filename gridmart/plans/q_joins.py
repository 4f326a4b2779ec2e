"""Registered driver queries: joins, reshapes and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.functions.columns import csum, r6, share
from gridmart.operators.asof import asof_nearest
from gridmart.operators.crosswalk import enrich_names, fill_id_fallbacks, resolve_ids
from gridmart.operators.dedupe import mode_per_key
from gridmart.operators.grid import expand, grid_fill
from gridmart.operators.lineup import best_lineup, lineup_scores, tie_break_chain
from gridmart.operators.periods import full_reconcile, next_period
from gridmart.operators.unpivot import flags_to_long, sides_to_long
from gridmart.plans import driver as d
from gridmart.plans.registry import register
from gridmart.sources.tables import table

G = (*d.SQL_BASE, d.SQL_GAMES)


def _dbl_sum(c) -> F.Column:
    return F.sum(c).cast("double")


@register("join_inner", d.with_sql(d.SQL_LINES, """
a AS (SELECT season, week, o_orderpriority, COUNT(*) AS n_lines FROM lines GROUP BY ALL),
b AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS season, CAST(month(o_orderdate) AS INTEGER) AS week,
             o_orderpriority, COUNT(*) AS n_orders FROM orders GROUP BY ALL)
SELECT season, week, o_orderpriority, n_lines, n_orders, round(n_lines / n_orders, 6) AS lines_per_order
FROM a JOIN b USING (season, week, o_orderpriority)
"""))
def join_inner(spark: SparkSession, sf: str) -> DataFrame:
    """J1 (D19 shape): two weekly aggregates joined USING three keys."""
    a = d.lines(spark, sf).groupBy("season", "week", "o_orderpriority").agg(F.count(F.lit(1)).alias("n_lines"))
    o = table(spark, sf, "orders", "o_orderdate", "o_orderpriority")
    b = (o.groupBy(F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("week"), "o_orderpriority")
         .agg(F.count(F.lit(1)).alias("n_orders")))
    out = a.join(b, ["season", "week", "o_orderpriority"])
    return out.withColumn("lines_per_order", r6(share("n_lines", "n_orders")))


@register("join_left_multi", d.with_sql(*d.SQL_BASE, """
base AS (SELECT season, week, team, l_suppkey, COUNT(*) AS n_lines FROM lines_team GROUP BY ALL),
ret AS (SELECT season, week, team, l_suppkey, COUNT(*) AS n_returned FROM lines_team
        WHERE l_returnflag = 'R' GROUP BY ALL),
tm AS (SELECT season, week, team, COUNT(*) AS team_lines FROM lines_team GROUP BY ALL)
SELECT b.season, b.week, b.team, b.l_suppkey, b.n_lines, COALESCE(r.n_returned, 0) AS n_returned,
       t.team_lines, round(b.n_lines / t.team_lines, 6) AS line_share
FROM base b
LEFT JOIN ret r ON r.season = b.season AND r.week = b.week AND r.team = b.team AND r.l_suppkey = b.l_suppkey
LEFT JOIN tm t ON t.season = b.season AND t.week = b.week AND t.team = b.team
"""))
def join_left_multi(spark: SparkSession, sf: str) -> DataFrame:
    """Player-week base left-joined to event counts on four keys and to team totals."""
    lt = d.lines_team(spark, sf)
    keys = ["season", "week", "team", "l_suppkey"]
    base = lt.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_lines"))
    ret = lt.filter(F.col("l_returnflag") == "R").groupBy(*keys).agg(F.count(F.lit(1)).alias("n_returned"))
    tm = lt.groupBy("season", "week", "team").agg(F.count(F.lit(1)).alias("team_lines"))
    out = base.join(ret, keys, "left").join(tm, ["season", "week", "team"], "left")
    return out.select(*keys, "n_lines", F.coalesce("n_returned", F.lit(0)).alias("n_returned"),
                      "team_lines", r6(share("n_lines", "team_lines")).alias("line_share"))


@register("join_full_reconcile", d.with_sql(d.SQL_LINES, """
a AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season, CAST(month(o_orderdate) AS INTEGER) AS week,
             SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS ordered FROM orders GROUP BY ALL),
b AS (SELECT o_custkey, CAST(year(l_shipdate) AS INTEGER) AS season, CAST(month(l_shipdate) AS INTEGER) AS week,
             SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS shipped FROM lines GROUP BY ALL)
SELECT o_custkey, season, week, CAST(ordered AS DOUBLE) AS ordered, CAST(shipped AS DOUBLE) AS shipped,
       CAST(COALESCE(ordered, 0) - COALESCE(shipped, 0) AS DOUBLE) AS diff
FROM a FULL OUTER JOIN b USING (o_custkey, season, week)
"""))
def join_full_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """J3 + T4 (D55): ordered value by order month vs shipped value by ship month; months
    present on one side only survive the FULL JOIN."""
    o = table(spark, sf, "orders", "o_custkey", "o_orderdate", "o_totalprice")
    a = (o.groupBy("o_custkey", F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("week"))
         .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("ordered")))
    b = (d.lines(spark, sf).groupBy("o_custkey", F.year("l_shipdate").alias("season"),
                                    F.month("l_shipdate").alias("week"))
         .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("shipped")))
    out = full_reconcile(a, b, ["o_custkey", "season", "week"], "ordered", "shipped")
    return out.select("o_custkey", "season", "week", F.col("ordered").cast("double").alias("ordered"),
                      F.col("shipped").cast("double").alias("shipped"), F.col("diff").cast("double").alias("diff"))


@register("grid_fill", """
WITH spine AS (
  SELECT DISTINCT CAST(year(o.o_orderdate) AS INTEGER) AS season, c.c_nationkey
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
),
facts AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS season, c.c_nationkey,
         CAST(month(o.o_orderdate) AS INTEGER) AS week, COUNT(*) AS urgent_orders
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE o.o_orderpriority = '1-URGENT' GROUP BY ALL
)
SELECT s.season, s.c_nationkey, CAST(w.week AS INTEGER) AS week, COALESCE(f.urgent_orders, 0) AS urgent_orders
FROM spine s CROSS JOIN range(1, 13) w(week)
LEFT JOIN facts f ON f.season = s.season AND f.c_nationkey = s.c_nationkey AND f.week = w.week
""")
def grid_fill_q(spark: SparkSession, sf: str) -> DataFrame:
    """Every (season, nation) x 12 months, urgent-order counts zero-filled."""
    o = table(spark, sf, "orders", "o_custkey", "o_orderdate", "o_orderpriority")
    c = table(spark, sf, "customer", "c_custkey", "c_nationkey")
    oc = o.join(c, o.o_custkey == c.c_custkey).withColumn("season", F.year("o_orderdate"))
    spine = oc.select("season", "c_nationkey").distinct()
    facts = (oc.filter(F.col("o_orderpriority") == "1-URGENT")
             .groupBy("season", "c_nationkey", F.month("o_orderdate").alias("week"))
             .agg(F.count(F.lit(1)).alias("urgent_orders")))
    grid = expand(spine, "week", list(range(1, 13)))
    return grid_fill(grid, facts, ["season", "c_nationkey", "week"], {"urgent_orders": 0})


@register("join_semi", d.with_sql(d.SQL_LINES, """
ret AS (SELECT DISTINCT o_custkey, season FROM lines WHERE l_returnflag = 'R')
SELECT CAST(year(o.o_orderdate) AS INTEGER) AS season, COUNT(*) AS n_orders
FROM orders o
WHERE EXISTS (SELECT 1 FROM ret r WHERE r.o_custkey = o.o_custkey AND r.season = year(o.o_orderdate))
GROUP BY ALL
"""))
def join_semi(spark: SparkSession, sf: str) -> DataFrame:
    """J7 (D18): orders of customers who had a returned line in the same season."""
    ret = (d.lines(spark, sf).filter(F.col("l_returnflag") == "R")
           .select("o_custkey", "season"))
    o = table(spark, sf, "orders", "o_custkey", "o_orderdate").withColumn("season", F.year("o_orderdate"))
    kept = o.join(ret, ["o_custkey", "season"], "left_semi")
    return kept.groupBy("season").agg(F.count(F.lit(1)).alias("n_orders"))


@register("next_period_compare", d.with_sql(d.SQL_LINES, """
s AS (SELECT o_custkey, season, SUM(""" + d.SQL_REVENUE + """) AS spend, COUNT(*) AS n_lines,
             MAX(o_orderpriority) AS any_priority FROM lines GROUP BY o_custkey, season)
SELECT a.o_custkey, a.season, a.any_priority, CAST(a.spend AS DOUBLE) AS spend, a.n_lines,
       CAST(n.spend AS DOUBLE) AS spend_next, n.n_lines AS n_lines_next,
       CAST(n.spend - a.spend AS DOUBLE) AS spend_delta
FROM s a LEFT JOIN s n ON n.o_custkey = a.o_custkey AND n.season = a.season + 1
WHERE a.n_lines >= 10
"""))
def next_period_compare(spark: SparkSession, sf: str, min_lines: int = 10) -> DataFrame:
    """J6 + P3 + A7 (D53): heavy customer-seasons (``min_lines`` parameter) vs the next season; any
    value of a column that varies is its largest, so it does not depend on the row order."""
    s = d.lines(spark, sf).groupBy("o_custkey", "season").agg(
        d.exact_sum(d.revenue_e4()).alias("spend_e4"), F.count(F.lit(1)).alias("n_lines"),
        F.max("o_orderpriority").alias("any_priority"))
    out = next_period(s, ["o_custkey"], "season", ["spend_e4", "n_lines"]).filter(F.col("n_lines") >= min_lines)
    return out.select("o_custkey", "season", "any_priority", (F.col("spend_e4") / 1e4).alias("spend"), "n_lines",
                      (F.col("spend_e4_next") / 1e4).alias("spend_next"), "n_lines_next",
                      ((F.col("spend_e4_next") - F.col("spend_e4")) / 1e4).alias("spend_delta"))


@register("date_lookup", d.with_sql(d.SQL_LINES, """
lk AS (SELECT DISTINCT c.c_nationkey AS team, CAST(o.o_orderdate AS DATE) AS game_date,
              CAST(month(o.o_orderdate) AS INTEGER) AS week
       FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
f AS (SELECT c.c_nationkey AS team, CAST(li.l_shipdate AS DATE) AS game_date
      FROM lines li JOIN customer c ON li.o_custkey = c.c_custkey)
SELECT f.team, CAST(year(f.game_date) AS INTEGER) AS season, lk.week, COUNT(*) AS n_lines
FROM f LEFT JOIN lk ON lk.team = f.team AND lk.game_date = f.game_date
GROUP BY ALL
"""))
def date_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """J9 + M18: exact (team, date) -> week lookup; unmatched dates keep a NULL week.

    The lookup is distinct on (team, date) because a date maps to one month."""
    o = table(spark, sf, "orders", "o_custkey", "o_orderdate")
    c = table(spark, sf, "customer", "c_custkey", "c_nationkey")
    lk = (o.join(c, o.o_custkey == c.c_custkey)
          .select(F.col("c_nationkey").alias("team"), F.to_date("o_orderdate").alias("game_date"),
                  F.month("o_orderdate").alias("week"))
          .dropDuplicates(["team", "game_date"]))
    f = (d.lines(spark, sf).join(c, F.col("o_custkey") == F.col("c_custkey"))
         .select(F.col("c_nationkey").alias("team"), F.to_date("l_shipdate").alias("game_date")))
    out = f.join(lk, ["team", "game_date"], "left")
    return out.groupBy("team", F.year("game_date").alias("season"), "week").agg(F.count(F.lit(1)).alias("n_lines"))


def team_game_rows(g: DataFrame) -> DataFrame:
    """Each game as two team rows (team, opponent, points for / against)."""
    return sides_to_long(g, ["season", "week"], {
        "home": {"team": "home_team", "opponent": "away_team", "pf": "home_score", "pa": "away_score"},
        "away": {"team": "away_team", "opponent": "home_team", "pf": "away_score", "pa": "home_score"},
    })


@register("two_sided_unpivot", d.with_sql(*G, """
tg AS (
  SELECT season, home_team AS team, home_score AS pf, away_score AS pa FROM games
  UNION ALL
  SELECT season, away_team AS team, away_score AS pf, home_score AS pa FROM games
)
SELECT season, team, COUNT(*) AS games,
       CAST(SUM(CASE WHEN pf > pa THEN 1 ELSE 0 END) AS BIGINT) AS wins,
       CAST(SUM(CASE WHEN pf < pa THEN 1 ELSE 0 END) AS BIGINT) AS losses,
       CAST(SUM(CASE WHEN pf = pa THEN 1 ELSE 0 END) AS BIGINT) AS ties,
       CAST(SUM(pf) AS BIGINT) AS points_for, CAST(SUM(pa) AS BIGINT) AS points_against,
       CAST(SUM(pf - pa) AS BIGINT) AS point_diff,
       round((SUM(CASE WHEN pf > pa THEN 1 ELSE 0 END) + 0.5 * SUM(CASE WHEN pf = pa THEN 1 ELSE 0 END)) / COUNT(*), 6) AS win_pct
FROM tg GROUP BY ALL
"""))
def two_sided_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    """U1 (D61): W/L/T, points for/against and win percentage per team-season, with the
    home/away unpivot done in one scan."""
    t = team_game_rows(d.games(spark, sf))
    wins, losses, ties = (csum(F.col("pf") > F.col("pa")), csum(F.col("pf") < F.col("pa")),
                          csum(F.col("pf") == F.col("pa")))
    agg = t.groupBy("season", "team").agg(
        F.count(F.lit(1)).alias("games"), wins.alias("wins"), losses.alias("losses"), ties.alias("ties"),
        F.sum("pf").alias("points_for"), F.sum("pa").alias("points_against"),
        F.sum(F.col("pf") - F.col("pa")).alias("point_diff"))
    return agg.withColumn("win_pct", r6(share(F.col("wins") + 0.5 * F.col("ties"), "games")))


@register("opponent_strength", d.with_sql(*G, """
tg AS (
  SELECT season, home_team AS team, away_team AS opponent, home_score - away_score AS diff FROM games
  UNION ALL
  SELECT season, away_team AS team, home_team AS opponent, away_score - home_score AS diff FROM games
),
pd AS (SELECT season, team, SUM(diff) AS point_diff FROM tg GROUP BY ALL)
SELECT tg.season, tg.team, COUNT(*) AS n_games, round(AVG(pd.point_diff), 6) AS avg_opponent_point_diff
FROM tg JOIN pd ON pd.season = tg.season AND pd.team = tg.opponent
GROUP BY ALL
"""))
def opponent_strength(spark: SparkSession, sf: str) -> DataFrame:
    """J16 (D60): average season point differential of the opponents faced."""
    t = team_game_rows(d.games(spark, sf)).withColumn("diff", F.col("pf") - F.col("pa"))
    pdiff = t.groupBy("season", "team").agg(F.sum("diff").alias("point_diff"))
    opp = pdiff.withColumnRenamed("team", "opponent")
    out = t.join(opp, ["season", "opponent"])
    return out.groupBy("season", "team").agg(
        F.count(F.lit(1)).alias("n_games"), r6(F.avg("point_diff")).alias("avg_opponent_point_diff"))


@register("flags_to_long", d.with_sql(d.SQL_LINES, """
f AS (SELECT season, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned,
             CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS open,
             CASE WHEN l_quantity >= 45 THEN 1 ELSE 0 END AS bulk FROM lines),
l AS (SELECT season, 'returned' AS event FROM f WHERE returned = 1
      UNION ALL SELECT season, 'open' FROM f WHERE open = 1
      UNION ALL SELECT season, 'bulk' FROM f WHERE bulk = 1)
SELECT season, event, COUNT(*) AS n FROM l GROUP BY ALL
"""))
def flags_to_long_q(spark: SparkSession, sf: str) -> DataFrame:
    """0/1 flags unpivoted to long form, kept where set, counted."""
    li = d.lines(spark, sf).select(
        "season", F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("returned"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("open"),
        F.when(F.col("l_quantity") >= 45, 1).otherwise(0).alias("bulk"))
    long = flags_to_long(li, ["season"], ["returned", "open", "bulk"])
    return long.groupBy("season", "event").agg(F.count(F.lit(1)).alias("n"))


@register("asof_nearest", """
WITH err AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'),
pur AS (SELECT event_id AS purchase_id, user_id, ts AS purchase_ts FROM events WHERE event_type = 'purchase'),
c AS (
  SELECT e.event_id, e.user_id, p.purchase_id,
         date_diff('microsecond', e.ts, p.purchase_ts) / 1000000.0 AS gap_seconds,
         row_number() OVER (PARTITION BY e.event_id
                            ORDER BY abs(date_diff('microsecond', e.ts, p.purchase_ts)) NULLS LAST,
                                     p.purchase_ts NULLS LAST, p.purchase_id) AS rn
  FROM err e LEFT JOIN pur p
    ON p.user_id = e.user_id AND abs(date_diff('microsecond', e.ts, p.purchase_ts)) <= 21600000000
)
SELECT event_id, user_id, purchase_id, gap_seconds FROM c WHERE rn = 1
""")
def asof_nearest_q(spark: SparkSession, sf: str) -> DataFrame:
    """Every error event with the same user's nearest purchase within 6 hours (of purchases
    at one time the smallest id)."""
    e = table(spark, sf, "events", "event_id", "user_id", "ts", "event_type")
    err = e.filter(F.col("event_type") == "error").select("event_id", "user_id", "ts")
    pur = e.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("purchase_ts"))
    out = asof_nearest(err, pur, ["user_id"], "ts", "purchase_ts", 6 * 3600)
    gap = (F.unix_micros(F.col("purchase_ts").cast("timestamp"))
           - F.unix_micros(F.col("ts").cast("timestamp"))) / 1_000_000.0
    return out.select("event_id", "user_id", "purchase_id", gap.alias("gap_seconds"))


# --- line-ups (D87 / D88) -------------------------------------------------------------------

_POS_SQL = ("CASE p.p_type WHEN 'ECONOMY' THEN 'QB' WHEN 'STANDARD' THEN 'RB' WHEN 'MEDIUM' THEN 'WR' "
            "WHEN 'LARGE' THEN 'TE' ELSE 'K' END")
# Part type -> position for the line-up analogue.
TYPE_TO_POS = {"ECONOMY": "QB", "STANDARD": "RB", "MEDIUM": "WR", "LARGE": "TE"}


def lineup_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Entry = customer, period = (season, week), player = part, points = line revenue
    summed per part."""
    p = table(spark, sf, "part", "p_partkey", "p_type")
    pos = F.coalesce(*[F.when(F.col("p_type") == t, F.lit(v)) for t, v in TYPE_TO_POS.items()], F.lit("K"))
    li = d.lines(spark, sf).join(p, F.col("l_partkey") == F.col("p_partkey"))
    return (li.groupBy(F.col("o_custkey").alias("entry_id"), "season", "week", F.col("l_partkey").alias("player_id"),
                       pos.alias("pos"))
            .agg(d.revenue_sum().alias("points")))


_LINEUP_SQL = """
cand AS (
  SELECT li.o_custkey AS entry_id, li.season, li.week, li.l_partkey AS player_id, """ + _POS_SQL + """ AS pos,
         CAST(SUM(""" + d.SQL_REVENUE + """) AS DOUBLE) AS points
  FROM lines li JOIN part p ON li.l_partkey = p.p_partkey GROUP BY ALL
),
rk AS (
  SELECT *, row_number() OVER (PARTITION BY entry_id, season, week, pos ORDER BY points DESC, player_id) AS r,
         CASE pos WHEN 'QB' THEN 1 WHEN 'RB' THEN 2 WHEN 'WR' THEN 3 WHEN 'TE' THEN 1 ELSE 0 END AS need
  FROM cand WHERE pos IN ('QB', 'RB', 'WR', 'TE')
),
starters AS (SELECT entry_id, season, week, pos || CAST(r AS VARCHAR) AS slot, player_id, pos, points
             FROM rk WHERE r <= need),
flex AS (
  SELECT entry_id, season, week, 'FLEX' AS slot, player_id, pos, points FROM (
    SELECT *, row_number() OVER (PARTITION BY entry_id, season, week ORDER BY points DESC, player_id) AS f
    FROM rk WHERE r = need + 1 AND pos IN ('RB', 'WR', 'TE')) WHERE f = 1
),
lineup AS (SELECT * FROM starters UNION ALL SELECT * FROM flex),
scores AS (SELECT entry_id, season, week, SUM(points) AS lineup_points, COUNT(*) AS slots_filled
           FROM lineup GROUP BY ALL)"""


@register("best_lineup", d.with_sql(d.SQL_LINES, _LINEUP_SQL + """
SELECT entry_id, season, week, round(lineup_points, 6) AS lineup_points, slots_filled FROM scores
"""))
def best_lineup_q(spark: SparkSession, sf: str) -> DataFrame:
    """QB1 RB2 WR3 TE1 + FLEX per entry-week, and its score."""
    lineup = best_lineup(lineup_candidates(spark, sf), ["entry_id", "season", "week"], "player_id", "pos", "points")
    s = lineup_scores(lineup, ["entry_id", "season", "week"], "points")
    return s.withColumn("lineup_points", r6("lineup_points"))


@register("tie_break_chain", d.with_sql(d.SQL_LINES, _LINEUP_SQL + """,
tot AS (SELECT season, entry_id, SUM(lineup_points) AS total_points,
               list_sort(list(lineup_points), 'DESC') AS chain, COUNT(*) AS n_weeks FROM scores GROUP BY ALL)
SELECT season, entry_id, round(total_points, 6) AS total_points, n_weeks,
       row_number() OVER (PARTITION BY season ORDER BY total_points DESC, chain DESC, entry_id) AS place
FROM tot
"""))
def tie_break_chain_q(spark: SparkSession, sf: str) -> DataFrame:
    """Season standings by total line-up points, ties broken by the sorted weekly chain."""
    lineup = best_lineup(lineup_candidates(spark, sf), ["entry_id", "season", "week"], "player_id", "pos", "points")
    s = lineup_scores(lineup, ["entry_id", "season", "week"], "points")
    ranked = tie_break_chain(s, ["season"], "entry_id", "lineup_points")
    return ranked.select("season", "entry_id", r6("total_points").alias("total_points"),
                         F.size("chain").cast("bigint").alias("n_weeks"), F.col("place").cast("bigint").alias("place"))


# --- id resolution (J10, J11, J13) ---------------------------------------------------------

@register("id_crosswalk", d.with_sql(d.SQL_LINES, """
sup AS (SELECT s_suppkey, CASE WHEN s_acctbal >= 0 THEN s_nationkey END AS s_nationkey FROM supplier),
r AS (
  SELECT COALESCE(s.s_nationkey, c.c_nationkey) AS nation,
         CASE WHEN s.s_nationkey IS NOT NULL THEN 'supplier' ELSE 'customer' END AS resolved_by
  FROM lines li LEFT JOIN sup s ON s.s_suppkey = li.l_suppkey
  LEFT JOIN customer c ON c.c_custkey = li.o_custkey
)
SELECT nation, resolved_by, COUNT(*) AS n_lines FROM r GROUP BY ALL
"""))
def id_crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    """Resolve a line's nation from candidate ids in order (verified supplier first,
    then customer); one left join per candidate on a key-unique lookup, first non-null wins."""
    sup = (table(spark, sf, "supplier", "s_suppkey", "s_nationkey", "s_acctbal").filter(F.col("s_acctbal") >= 0)
           .select(F.col("s_suppkey").alias("supplier"), F.col("s_nationkey").alias("nation")))
    cus = table(spark, sf, "customer", "c_custkey", "c_nationkey").select(
        F.col("c_custkey").alias("customer"), F.col("c_nationkey").alias("nation"))
    lookup = sup.unionByName(cus, allowMissingColumns=True)
    li = d.lines(spark, sf).select("l_suppkey", "o_custkey")
    r = resolve_ids(li, lookup, [("l_suppkey", "supplier"), ("o_custkey", "customer")], "nation", "nation", "by")
    return r.groupBy(F.col("nation").cast(cus.schema["nation"].dataType).alias("nation"),
                     F.when(F.col("by") == "l_suppkey", "supplier").otherwise("customer").alias("resolved_by")).agg(
        F.count(F.lit(1)).alias("n_lines"))


@register("id_fallback", """
SELECT CASE WHEN c_acctbal >= 0 THEN c_name ELSE 'cust_' || CAST(c_custkey AS VARCHAR) END AS player_id,
       c_nationkey FROM customer
""")
def id_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """``coalesce(id, prefix || other_id)`` when the primary id is missing."""
    c = table(spark, sf, "customer", "c_custkey", "c_name", "c_acctbal", "c_nationkey")
    c = c.withColumn("player_id", F.when(F.col("c_acctbal") >= 0, F.col("c_name")))
    return fill_id_fallbacks(c, [("c_custkey", "cust_")]).select("player_id", "c_nationkey")


@register("name_enrich", """
WITH u AS (SELECT DISTINCT user_id FROM events),
c AS (SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name END AS c_name FROM customer),
s AS (SELECT s_suppkey, s_name FROM supplier),
m AS (
  SELECT user_id, 'k' || k AS k_name FROM (
    SELECT user_id, k, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, k) AS rn FROM (
      SELECT user_id, json_extract_string(props, '$.k') AS k, COUNT(*) AS n FROM events GROUP BY ALL))
  WHERE rn = 1
)
SELECT u.user_id, COALESCE(c.c_name, s.s_name, m.k_name) AS display_name,
       CASE WHEN c.c_name IS NOT NULL THEN 'customer' WHEN s.s_name IS NOT NULL THEN 'supplier'
            WHEN m.k_name IS NOT NULL THEN 'mode' END AS name_source
FROM u LEFT JOIN c ON c.c_custkey = u.user_id LEFT JOIN s ON s.s_suppkey = u.user_id
LEFT JOIN m ON m.user_id = u.user_id
""")
def name_enrich(spark: SparkSession, sf: str) -> DataFrame:
    """Three-step name enrichment with deduplicated lookups (no fan-out): a segment's
    customer name, else the supplier name, else the most frequent event tag of the user."""
    e = table(spark, sf, "events", "user_id", "props")
    users = e.select("user_id").distinct()
    c = (table(spark, sf, "customer", "c_custkey", "c_name", "c_mktsegment")
         .select("c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).alias("c_name")))
    s = table(spark, sf, "supplier", "s_suppkey", "s_name")
    tags = e.select("user_id", F.get_json_object("props", "$.k").alias("k"))
    m = mode_per_key(tags, ["user_id"], "k").select("user_id", F.concat(F.lit("k"), "k").alias("k_name"))
    return enrich_names(users, "user_id", [("customer", c, "c_custkey", "c_name"), ("supplier", s, "s_suppkey", "s_name"),
                                           ("mode", m, "user_id", "k_name")], "display_name", "name_source")


@register("drive_pace", d.with_sql(*d.SQL_BASE, """
drives AS (SELECT DISTINCT season, week, team, l_orderkey FROM lines_team),
facts AS (SELECT l_orderkey, COUNT(*) AS drive_plays,
                 date_diff('day', CAST(MIN(o_orderdate) AS DATE), CAST(MAX(l_shipdate) AS DATE)) * 86400 AS drive_seconds
          FROM lines GROUP BY ALL),
plays AS (
  SELECT lt.season, lt.week, lt.team, f.drive_seconds / f.drive_plays AS sec_per_play
  FROM lines_team lt JOIN drives dr USING (season, week, team, l_orderkey)
  LEFT JOIN facts f ON f.l_orderkey = dr.l_orderkey
)
SELECT season, week, team, COUNT(*) AS n_plays, round(AVG(sec_per_play), 6) AS play_weighted_sec_per_play
FROM plays GROUP BY ALL
"""))
def drive_pace(spark: SparkSession, sf: str) -> DataFrame:
    """J15 + X11 (Q4 kept): drive = order; seconds from order to last shipment over the
    drive's plays, averaged over plays (so longer drives weigh more)."""
    lt = d.lines_team(spark, sf)
    drives = lt.select("season", "week", "team", "l_orderkey").distinct()
    facts = d.lines(spark, sf).groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("drive_plays"),
        (F.datediff(F.to_date(F.max("l_shipdate")), F.to_date(F.min("o_orderdate"))) * 86400).alias("drive_seconds"))
    plays = (lt.select("season", "week", "team", "l_orderkey")
             .join(drives, ["season", "week", "team", "l_orderkey"])
             .join(facts, "l_orderkey", "left"))
    return plays.groupBy("season", "week", "team").agg(
        F.count(F.lit(1)).alias("n_plays"),
        r6(F.avg(F.col("drive_seconds") / F.col("drive_plays"))).alias("play_weighted_sec_per_play"))

