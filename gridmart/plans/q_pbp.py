"""Registered driver queries: play-by-play tables and leader boards, one key per saved query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.functions.columns import r6
from gridmart.plans import adapters as ad
from gridmart.plans import driver as d
from gridmart.plans import pbp
from gridmart.plans.q_league import QUAL, TRUE_PLAY
from gridmart.plans.registry import register


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[r6(f.name).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
                       for f in df.schema.fields])


def _sql(body: str, *ctes: str) -> str:
    return d.with_sql(*ad.SQL_FOOTBALL, ad.SQL_PLAYS, *ctes, body)


def table_sql(spec: pbp.PlayTable) -> str:
    """The table as plain SQL: aggregates with FILTER, then rates, then the board."""
    plays = TRUE_PLAY if spec.plays == pbp.TRUE_PLAYS else QUAL
    keys = ", ".join(f"{e} AS {n}" for n, e in spec.keys.items())
    cols = [f"MAX({e}) AS {n}" for n, e in spec.labels.items()]
    cols += [f"COUNT(*) FILTER (WHERE {c}) AS {n}" for n, c in spec.counts.items()]
    cols += [f"CAST(SUM({e}) AS DOUBLE) AS {n}" for n, e in spec.sums.items()]
    cols += [f"AVG({e}) AS {n}" for n, e in spec.means.items()]
    rates = "".join(f", CAST({a} AS DOUBLE) / NULLIF({b}, 0) AS {n}" for n, (a, b) in spec.rates.items())
    shown = [n for n in (*spec.keys, *spec.labels, *spec.counts, *spec.sums, *spec.means, *spec.rates) if n not in spec.hidden]
    doubles = {*spec.sums, *spec.means, *spec.rates}
    out = ", ".join(f"round({n}, 6) AS {n}" if n in doubles else n for n in shown)
    rank = ""
    if spec.best:
        column, n = spec.best
        out += ", rank"
        rank = (f" QUALIFY row_number() OVER (PARTITION BY season ORDER BY {column} DESC NULLS LAST, "
                f"{', '.join(f'{k} NULLS LAST' for k in spec.keys)}) <= {n}")
        over = f"(PARTITION BY season ORDER BY {column} DESC NULLS LAST, {', '.join(f'{k} NULLS LAST' for k in spec.keys)})"
        rates += f", CAST(row_number() OVER {over} AS INTEGER) AS rank" if spec.having == "true" and column not in spec.rates else ""
        if "AS rank" not in rates:  # ranked over rates or after a threshold: one step later
            inner = f"""
a AS (SELECT season, {keys}, {", ".join(cols)} FROM plays WHERE {plays} AND ({spec.where}) GROUP BY ALL),
b AS (SELECT *{rates} FROM a WHERE {spec.having}),
c AS (SELECT *, CAST(row_number() OVER {over} AS INTEGER) AS rank FROM b)"""
            return _sql(f"SELECT season, {out} FROM c WHERE rank <= {n}", inner)
        rank = f" QUALIFY rank <= {n}"
    inner = f"""
a AS (SELECT season, {keys}, {", ".join(cols)} FROM plays WHERE {plays} AND ({spec.where}) GROUP BY ALL),
b AS (SELECT *{rates} FROM a WHERE {spec.having}{rank})"""
    return _sql(f"SELECT season, {out} FROM b", inner)


def _register(name: str, spec: pbp.PlayTable) -> None:
    @register(name, table_sql(spec))
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return _rounded(pbp.play_table(ad.plays_view(spark, sf), spec))


for _name, _spec in pbp.TABLES.items():
    _register(_name, _spec)


@register("receiver_market_share", _sql(f"""
p AS (SELECT season, posteam AS team, COALESCE(receiver_player_id, receiver_id) AS player_id,
             MAX(COALESCE(receiver_player_name, receiver)) AS player_name, COUNT(*) AS targets,
             SUM(COALESCE(air_yards, 0)) AS air_yards
      FROM plays WHERE {TRUE_PLAY} AND pass_attempt = 1 GROUP BY ALL),
t AS (SELECT season, team, SUM(targets) AS tt, SUM(air_yards) AS ta FROM p GROUP BY ALL),
j AS (SELECT p.*, CAST(targets AS DOUBLE) / tt AS targets_share, air_yards / NULLIF(ta, 0) AS air_yards_share
      FROM p JOIN t USING (season, team) WHERE player_id IS NOT NULL AND targets >= 3),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY season ORDER BY targets_share DESC NULLS LAST, player_id, team) AS INTEGER) AS rank
      FROM j)
SELECT * REPLACE (round(targets_share, 6) AS targets_share, round(air_yards_share, 6) AS air_yards_share,
                  round(air_yards, 6) AS air_yards) FROM r WHERE rank <= 200"""))
def receiver_market_share(spark: SparkSession, sf: str) -> DataFrame:
    """D45 (A14, T2); the tables' players have few plays each, hence a threshold of 3."""
    return _rounded(pbp.receiver_market_share(ad.plays_view(spark, sf), 3))


@register("rb_carry_share", _sql(f"""
p AS (SELECT season, posteam AS team, COALESCE(rusher_player_id, rusher_id) AS player_id,
             MAX(COALESCE(rusher_player_name, rusher)) AS player_name, COUNT(*) FILTER (rush_attempt = 1) AS rush_att
      FROM plays WHERE {TRUE_PLAY} GROUP BY ALL),
t AS (SELECT season, team, SUM(rush_att) AS tt FROM p GROUP BY ALL),
j AS (SELECT p.*, CAST(rush_att AS DOUBLE) / NULLIF(tt, 0) AS rush_att_share
      FROM p JOIN t USING (season, team) WHERE player_id IS NOT NULL AND rush_att >= 3),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY season ORDER BY rush_att_share DESC NULLS LAST, player_id, team) AS INTEGER) AS rank
      FROM j)
SELECT * REPLACE (round(rush_att_share, 6) AS rush_att_share) FROM r WHERE rank <= 200"""))
def rb_carry_share(spark: SparkSession, sf: str) -> DataFrame:
    """D48 (A14), with a threshold of 3."""
    return _rounded(pbp.rb_carry_share(ad.plays_view(spark, sf), 3))


@register("personnel_usage", _sql(f"""
p AS (SELECT season, posteam AS team, offense_personnel, COUNT(*) AS plays
      FROM plays WHERE {TRUE_PLAY} AND offense_personnel IS NOT NULL GROUP BY ALL)
SELECT *, round(100.0::DOUBLE * (CAST(plays AS DOUBLE) / SUM(plays) OVER (PARTITION BY season, team)), 6) AS usage_pct FROM p"""))
def personnel_usage(spark: SparkSession, sf: str) -> DataFrame:
    """D35 (A21)."""
    return _rounded(pbp.personnel_usage(ad.plays_view(spark, sf)))


@register("snap_share_leaders", d.with_sql(*ad.SQL_FOOTBALL, ad.SQL_SNAPS, """
p AS (SELECT season, player_id, MAX(team) AS team, SUM(offense_snaps) AS off_snaps,
             CAST(SUM(CAST(round(offense_pct, 6) AS DECIMAL(24,6))) AS DOUBLE) / COUNT(*) AS pct
      FROM snap_counts WHERE week <= 18 GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY season ORDER BY pct DESC NULLS LAST, player_id) AS INTEGER) AS rank FROM p)
SELECT season, player_id, team, off_snaps, round(pct, 6) AS avg_off_snap_pct, rank FROM r WHERE rank <= 200"""))
def snap_share_leaders(spark: SparkSession, sf: str) -> DataFrame:
    """D62 (A2, T2)."""
    return _rounded(pbp.snap_share_leaders(ad.snap_counts_view(spark, sf)))
