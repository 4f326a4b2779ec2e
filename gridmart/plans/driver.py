"""Shared driver-table building blocks for the registered queries.

The football operators run on native TPC-H-like columns:

* a *line* (lineitem joined to its order) is a play / stat line;
* ``season`` = order year, ``week`` = order month;
* the supplier's nation is the "team", the part type is the "position";
* money is summed exactly as DECIMAL(18,2)/(22,4) and converted to DOUBLE once.

Each builder has its SQL twin in :data:`SQL_LINES` so oracle queries share one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.sources.tables import table

# Part types standing in for the four skill positions (a fixed list of the data's values).
SKILL_TYPES = ("ECONOMY", "STANDARD", "MEDIUM", "LARGE")


def revenue() -> Column:
    """Exact ``extendedprice * (1 - discount)`` as DECIMAL."""
    return (F.col("l_extendedprice").cast("decimal(18,2)")
            * (F.lit(1) - F.col("l_discount").cast("decimal(3,2)")))


def revenue_e4() -> Column:
    """Line revenue in units of 1e-4 as BIGINT: cents x (100 - discount %)."""
    cents = F.floor(F.col("l_extendedprice") * 100 + 0.5)
    pct = F.floor(F.col("l_discount") * 100 + 0.5)
    return cents * (F.lit(100) - pct)


def exact_sum(units: Column) -> Column:
    """``SUM`` of a BIGINT as DECIMAL, exact at any size: the high and the low 20 bits are
    summed apart as BIGINT (no BigDecimal per row; no overflow below 2^43 rows) and put
    together once per group."""
    high, low = F.sum(F.shiftright(units, 20)), F.sum(units.bitwiseAND(F.lit((1 << 20) - 1)))
    return high.cast("decimal(19,0)") * F.lit(1 << 20).cast("decimal(7,0)") + low.cast("decimal(19,0)")


def revenue_sum() -> Column:
    """``SUM(revenue)`` as DOUBLE, summed exactly and rounded once."""
    return exact_sum(revenue_e4()).cast("double") / 1e4


def lineitems(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                 "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                 "l_linestatus", "l_shipdate")


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                 "o_orderdate", "o_orderpriority")


# A partition's share of the lines in a join by order: what one task sorts and groups.
ORDER_LINES = 300_000


def deal(spark: SparkSession, sf: str, rows: DataFrame, by: Column) -> DataFrame:
    """``rows`` of lines partitioned by ``by``: a partition for every ``ORDER_LINES`` lines above that many
    a core, so views of one query that are dealt alike are joined and grouped where they lie."""
    n = -(-table(spark, sf, "lineitem").count() // ORDER_LINES)
    return rows.repartition(n, by) if n > spark.sparkContext.defaultParallelism else rows.repartition(by)


def join_orders(spark: SparkSession, sf: str, li: DataFrame, od: DataFrame, line_key: str, order_key: str) -> DataFrame:
    """``li`` joined to ``od``. Above ``ORDER_LINES`` lines a core both sides are dealt over as many
    partitions as the lines need: a task's memory does not grow with the tables, whatever the number of
    shuffle partitions and however few bytes the lines have in a shuffle. Smaller joins are left to Spark."""
    n = -(-table(spark, sf, "lineitem").count() // ORDER_LINES)
    if n > spark.sparkContext.defaultParallelism:
        li, od = li.repartition(n, line_key), od.repartition(n, order_key)
    return li.join(od, F.col(line_key) == F.col(order_key))


def dated(rows: DataFrame) -> DataFrame:
    """``rows`` of orders with season/week derived from the order date."""
    return rows.withColumns({"season": F.year("o_orderdate"), "week": F.month("o_orderdate")})


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lineitem joined to its order with season/week derived from the order date."""
    j = join_orders(spark, sf, lineitems(spark, sf), orders(spark, sf), "l_orderkey", "o_orderkey")
    return dated(j.drop("o_orderkey"))


SQL_LINES = """
lines AS (
  SELECT l.*, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, o.o_orderpriority,
         CAST(year(o.o_orderdate) AS INTEGER) AS season,
         CAST(month(o.o_orderdate) AS INTEGER) AS week
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

SQL_REVENUE = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(3,2)))"


def supplier_nation(spark: SparkSession, sf: str) -> DataFrame:
    """``s_suppkey -> team`` (supplier nation name). The 25-row nation table is broadcast;
    the result carries no hint, so Spark broadcasts it only where its measured size is small."""
    s = table(spark, sf, "supplier", "s_suppkey", "s_nationkey")
    n = table(spark, sf, "nation", "n_nationkey", "n_name")
    return (
        s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).select("s_suppkey", F.col("n_name").alias("team")))


SQL_SUPPLIER_NATION = """
supplier_nation AS (
  SELECT s.s_suppkey, n.n_name AS team
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
)"""


def with_sql(*parts: str) -> str:
    """``WITH`` + shared CTEs; the last part holds the query's own CTEs and its SELECT
    (or only the SELECT)."""
    *ctes, last = [p.strip() for p in parts]
    if last.upper().startswith("SELECT"):
        return "WITH " + ",\n".join(ctes) + "\n" + last
    return "WITH " + ",\n".join([*ctes, last])


def with_team(spark: SparkSession, sf: str, rows: DataFrame) -> DataFrame:
    """``rows`` of lines with ``team`` (supplier nation name). The suppliers are joined before their
    nations: Spark takes a join for as large as the product of its sides, so it would shuffle every
    line to meet a joined supplier table that is small enough for a broadcast."""
    s = table(spark, sf, "supplier", "s_suppkey", "s_nationkey")
    n = table(spark, sf, "nation", "n_nationkey", "n_name").select(
        F.col("n_nationkey").alias("__team_key"), F.col("n_name").alias("team"))
    out = rows.join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(
        F.broadcast(n), F.col("s_nationkey") == F.col("__team_key"))
    return out.drop("s_suppkey", "s_nationkey", "__team_key")


def lines_team(spark: SparkSession, sf: str) -> DataFrame:
    """:func:`lines` plus ``team`` (supplier nation name)."""
    return with_team(spark, sf, lines(spark, sf))


SQL_LINES_TEAM = """
lines_team AS (
  SELECT li.*, sn.team FROM lines li JOIN supplier_nation sn ON li.l_suppkey = sn.s_suppkey
)"""

SQL_BASE = (SQL_LINES, SQL_SUPPLIER_NATION, SQL_LINES_TEAM)


def games(spark: SparkSession, sf: str) -> DataFrame:
    """Two-sided "games": each line is a meeting of the customer's nation (home) and the
    supplier's nation (away); home scores the quantity, away seven points per line number."""
    c = table(spark, sf, "customer", "c_custkey", "c_nationkey")
    n = table(spark, sf, "nation", "n_nationkey", "n_name")
    home = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", F.col("n_name").alias("home_team"))
    li = lines_team(spark, sf).join(home, F.col("o_custkey") == F.col("c_custkey"))
    return li.select("season", "week", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     "home_team", F.col("team").alias("away_team"),
                     F.col("l_quantity").cast("bigint").alias("home_score"),
                     (F.col("l_linenumber") * 7).cast("bigint").alias("away_score"))


SQL_GAMES = """
games AS (
  SELECT lt.season, lt.week, lt.l_orderkey, lt.l_linenumber, lt.l_partkey, lt.l_suppkey,
         n.n_name AS home_team, lt.team AS away_team,
         CAST(lt.l_quantity AS BIGINT) AS home_score, CAST(lt.l_linenumber * 7 AS BIGINT) AS away_score
  FROM lines_team lt JOIN customer c ON lt.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""
