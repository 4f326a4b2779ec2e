"""Registered driver queries: league / team trend marts on the football views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.functions.columns import r6
from gridmart.plans import adapters as ad
from gridmart.plans import calendar as cal
from gridmart.plans import environment as env
from gridmart.plans import driver as d
from gridmart.plans import league as lg
from gridmart.plans.registry import register
from gridmart.sources.tables import table

QUAL = ("((pass = 1 OR rush_attempt = 1) AND qb_spike <> 1 AND qb_kneel <> 1 AND play_deleted <> 1)")
NEUTRAL = ("((CASE WHEN posteam = home_team THEN home_wp ELSE away_wp END) BETWEEN 0.35 AND 0.65 "
           "AND abs(score_differential) <= 7 AND down IN (1, 2) "
           "AND NOT COALESCE(qtr IN (2, 4) AND quarter_seconds_remaining <= 120, false))")
TRUE_PLAY = "(play = 1 AND COALESCE(aborted_play, 0) = 0)"

# Team-games of qualifying plays (g_...), the games' scores, and means at six decimals.
_GAPS = f"""
q AS (SELECT *, {NEUTRAL} AS is_neutral, rush_attempt = 1 AS is_rush, pass = 1 AS is_pass FROM plays WHERE {QUAL}),
gaps AS (SELECT * REPLACE (CASE WHEN gap >= 0 THEN least(gap, 45) END AS gap) FROM (
  SELECT *, lag(game_seconds_remaining) OVER (PARTITION BY season, week, game_id, posteam
             ORDER BY order_sequence, game_seconds_remaining DESC, epa) - game_seconds_remaining AS gap FROM q)),
scores AS (SELECT season, week, game_id, MAX(total_home_score) + MAX(total_away_score) AS points,
                  COUNT(*) FILTER (touchdown = 1) AS tds FROM plays GROUP BY ALL)"""


def _team_games(extra: str = "") -> str:
    return f"""
tg AS (
  SELECT season, week, game_id, posteam{extra}, COUNT(*) AS plays, AVG(epa) AS epa_all,
         AVG(epa) FILTER (is_pass) AS epa_pass, AVG(epa) FILTER (is_rush) AS epa_rush, AVG(no_huddle) AS no_huddle_rate,
         AVG(shotgun) AS shotgun_rate, SUM(gap) / COUNT(gap) AS sec_per_play_all,
         SUM(gap) FILTER (is_neutral) / NULLIF(COUNT(gap) FILTER (is_neutral), 0) AS sec_per_play_neutral,
         AVG(pass) FILTER (is_neutral) - AVG(xpass) FILTER (is_neutral) AS proe,
         COUNT(*) FILTER (is_pass) AS n_pass, COUNT(*) FILTER (is_rush) AS n_rush,
         COUNT(*) FILTER (is_pass AND yards_gained >= 20) AS pass_20,
         COUNT(*) FILTER (is_rush AND yards_gained >= 10) AS rush_10,
         COUNT(*) FILTER (is_rush AND yards_gained >= 15) AS rush_15,
         SUM(epa) FILTER (is_pass AND epa > 0) AS pass_gain, SUM(epa) FILTER (is_rush AND epa > 0) AS rush_gain,
         SUM(epa) FILTER (is_pass AND epa > 0 AND yards_gained >= 20) AS pass_gain_20,
         SUM(epa) FILTER (is_rush AND epa > 0 AND yards_gained >= 10) AS rush_gain_10
  FROM gaps GROUP BY ALL)"""


def _mean6(c: str, alias: str | None = None) -> str:
    return f"round(CAST(SUM(CAST(round({c}, 6) AS DECIMAL(24,6))) AS DOUBLE) / COUNT({c}), 6) AS {alias or c}"


_TEAM_RATES = ", ".join(map(_mean6, lg.TEAM_RATES))
_EXPLOSIVE = ("round(CAST(SUM(pass_20) AS DOUBLE) / NULLIF(SUM(n_pass), 0), 6) AS explosive_pass_rate, "
              "round(CAST(SUM(rush_10) AS DOUBLE) / NULLIF(SUM(n_rush), 0), 6) AS explosive_rush10_rate")
_EXPLOSIVE_15 = "round(CAST(SUM(rush_15) AS DOUBLE) / NULLIF(SUM(n_rush), 0), 6) AS explosive_rush15_rate"


def _sql(body: str) -> str:
    return d.with_sql(*ad.SQL_FOOTBALL, ad.SQL_PLAYS, body)


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[r6(f.name).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
                       for f in df.schema.fields])


@register("league_by_week", _sql(f"""{_GAPS.strip()}, {_team_games()},
a AS (SELECT season, week, round(AVG(plays), 6) AS plays_pg, {_mean6("sec_per_play_neutral")}, {_TEAM_RATES}, {_EXPLOSIVE},
             {_EXPLOSIVE_15}, round(COALESCE(SUM(pass_gain_20), 0) / NULLIF(SUM(pass_gain), 0), 6) AS explosive_epa_share_pass,
             round(COALESCE(SUM(rush_gain_10), 0) / NULLIF(SUM(rush_gain), 0), 6) AS explosive_epa_share_rush,
             {_mean6("proe", "proe_mean")}, round(quantile_disc(proe, 0.75) - quantile_disc(proe, 0.25), 6) AS proe_iqr
      FROM tg GROUP BY ALL),
p AS (SELECT season, week, round(AVG(points), 6) AS ppg, round(AVG(tds), 6) AS tds_pg FROM scores GROUP BY ALL)
SELECT * FROM a JOIN p USING (season, week)
"""))
def league_by_week(spark: SparkSession, sf: str) -> DataFrame:
    """D20 (P6, P8, W5, X12, X13, A9, A12, A13, J1)."""
    return _rounded(lg.league_by_week(ad.plays_view(spark, sf)))


@register("league_yoy", _sql(f"""{_GAPS.strip()}, {_team_games()},
p AS (SELECT season, round(AVG(points), 6) AS ppg FROM (
        SELECT season, game_id, MAX(total_home_score) + MAX(total_away_score) AS points FROM plays GROUP BY ALL) GROUP BY ALL),
e AS (SELECT season, round(AVG(pass), 6) AS pass_rate, round(AVG(epa), 6) AS epa_all,
             round(AVG(epa) FILTER (is_pass), 6) AS epa_pass, round(AVG(epa) FILTER (is_rush), 6) AS epa_rush
      FROM q GROUP BY ALL),
x AS (SELECT season, {_EXPLOSIVE} FROM tg GROUP BY ALL)
SELECT * FROM e JOIN x USING (season) JOIN p USING (season)
"""))
def league_yoy(spark: SparkSession, sf: str) -> DataFrame:
    """D21 (P6, A4, A13, X13)."""
    return _rounded(lg.league_yoy(ad.plays_view(spark, sf)))


_CLASS = ("CASE WHEN upper(roof) IN ('DOME', 'CLOSED') THEN 'INDOOR' WHEN upper(roof) IN ('OUTDOORS', 'OPEN') THEN 'OUTDOOR' "
          "ELSE 'UNKNOWN' END")


@register("league_by_class", _sql(f"""{_GAPS.strip()}, {_team_games(f", {_CLASS} AS roof_class")},
j AS (SELECT tg.*, s.points, s.tds FROM tg JOIN scores s USING (season, week, game_id))
SELECT season, week, roof_class, round(AVG(plays), 6) AS plays_pg, round(AVG(points), 6) AS ppg, round(AVG(tds), 6) AS tds_pg,
       {_TEAM_RATES}, {_EXPLOSIVE}, {_EXPLOSIVE_15}
FROM j GROUP BY ALL
"""))
def league_by_class(spark: SparkSession, sf: str) -> DataFrame:
    """D19 (P11 policy 'open is outdoor', P6, W5, A12, J1)."""
    return _rounded(lg.league_by_class(ad.plays_view(spark, sf), "open_is_outdoor"))


_PER_GAME = ["team_plays", "pass_plays", "explosive_passes", "explosive_rushes", "team_tds", "home_points", "away_points",
             "total_points", "points_dome", "points_outdoor", "pass_rate"]


@register("league_per_game", _sql(f"""
t AS (SELECT season, game_id, posteam, COUNT(*) AS team_plays, COUNT(*) FILTER (pass = 1) AS pass_plays,
             COUNT(*) FILTER (pass = 1 AND yards_gained >= 20) AS explosive_passes,
             COUNT(*) FILTER (rush = 1 AND yards_gained >= 10) AS explosive_rushes, COUNT(*) FILTER (touchdown = 1) AS team_tds
      FROM plays WHERE {TRUE_PLAY} GROUP BY ALL),
g AS (SELECT season, game_id, MAX(total_home_score) AS home_points, MAX(total_away_score) AS away_points,
             lower(MAX(roof)) IN ('dome', 'closed') AS indoor
      FROM plays WHERE {TRUE_PLAY} GROUP BY ALL),
j AS (SELECT t.*, home_points, away_points, home_points + away_points AS total_points,
             CASE WHEN indoor THEN home_points + away_points END AS points_dome,
             CASE WHEN NOT indoor THEN home_points + away_points END AS points_outdoor,
             CAST(pass_plays AS DOUBLE) / team_plays AS pass_rate,
             CAST(explosive_passes AS DOUBLE) / team_plays AS explosive_play_rate,
             CAST(explosive_rushes AS DOUBLE) / team_plays AS explosive_rush_rate
      FROM t JOIN g USING (season, game_id))
SELECT season, {", ".join(_mean6(c, f"avg_{c}") for c in (*_PER_GAME, "explosive_play_rate", "explosive_rush_rate"))},
       {", ".join(f"round(CAST(MEDIAN({c}) AS DOUBLE), 6) AS med_{c}" for c in _PER_GAME)}
FROM j GROUP BY season
"""))
def league_per_game(spark: SparkSession, sf: str) -> DataFrame:
    """D22 (P7, A8, A12, J1): means and exact medians of team-games and games by season."""
    return _rounded(lg.league_per_game(ad.plays_view(spark, sf)))


_RUN = "season_type = 'REG' AND play = 1 AND play_deleted = 0"
_POINTS = """
pt AS (SELECT season, game_id, MAX(total_home_score) + MAX(total_away_score) AS points FROM plays
       WHERE season_type = 'REG' GROUP BY ALL)"""


@register("environment_splits", _sql(f"""
g AS (SELECT season, game_id,
             CASE WHEN surface ILIKE '%turf%' OR surface ILIKE '%artificial%' THEN 'turf' ELSE 'grass' END AS surface_class,
             AVG(CASE WHEN COALESCE(roof, stadium, '') ILIKE '%dome%' OR COALESCE(roof, stadium, '') ILIKE '%closed%' THEN 1 ELSE 0 END)
               AS dome,
             COUNT(*) AS plays, AVG(epa) AS epa_play, AVG(epa) FILTER (pass = 1) AS epa_pass, AVG(epa) FILTER (rush = 1) AS epa_rush,
             AVG(success) AS success_rate, AVG(CASE WHEN yards_gained >= 20 THEN 1 ELSE 0 END) AS explosive_rate
      FROM plays WHERE {_RUN} GROUP BY ALL), {_POINTS.strip()}
SELECT season, CASE WHEN dome >= 0.5 THEN 'dome' ELSE 'outdoor' END AS roof_class, surface_class, COUNT(*) AS games,
       round(AVG(plays), 6) AS plays_per_game, {", ".join(map(_mean6, ("epa_play", "epa_pass", "epa_rush", "success_rate", "explosive_rate")))},
       round(AVG(points), 6) AS points_per_game
FROM g LEFT JOIN pt USING (season, game_id) GROUP BY ALL
"""))
def environment_splits(spark: SparkSession, sf: str) -> DataFrame:
    """D24 (P12, A12)."""
    return _rounded(lg.environment_splits(ad.plays_view(spark, sf)))


@register("season_trends", _sql(f"""
r AS (SELECT *, lag(game_seconds_remaining) OVER (PARTITION BY season, game_id
                  ORDER BY order_sequence, game_seconds_remaining DESC) - game_seconds_remaining AS delta
      FROM plays WHERE {_RUN}),
g AS (SELECT season, game_id, COUNT(*) AS plays, SUM(pass) AS pass_plays, AVG(shotgun) AS shotgun_rate,
             AVG(no_huddle) AS no_huddle_rate, AVG(air_yards) AS air_yards, AVG(epa) AS epa_play,
             AVG(epa) FILTER (pass = 1) AS epa_pass, AVG(epa) FILTER (rush = 1) AS epa_rush, AVG(success) AS success_rate,
             AVG(success) FILTER (pass = 1) AS pass_success, AVG(success) FILTER (rush = 1) AS rush_success,
             AVG(xpass) AS xpass, AVG(pass_oe) AS pass_oe, AVG(CASE WHEN yards_gained >= 20 THEN 1 ELSE 0 END) AS explosive_rate,
             CAST(MEDIAN(delta) FILTER (delta BETWEEN 0 AND 45) AS DOUBLE) AS median_sec_per_play,
             AVG(delta) FILTER (delta BETWEEN 0 AND 45) AS mean_sec_per_play
      FROM r GROUP BY ALL), {_POINTS.strip()}
SELECT season, COUNT(*) AS games, round(AVG(plays), 6) AS avg_plays_per_game, round(SUM(pass_plays) / SUM(plays), 6) AS pass_rate,
       {", ".join(map(_mean6, lg.TREND_RATES))}, round(AVG(points), 6) AS points_per_game
FROM g LEFT JOIN pt USING (season, game_id) GROUP BY season
"""))
def season_trends(spark: SparkSession, sf: str) -> DataFrame:
    """D25 (W5, A4, A12)."""
    return _rounded(lg.season_trends(ad.plays_view(spark, sf)))


@register("rate_over_expected", _sql(f"""
s AS (SELECT season, posteam AS team, round(AVG(pass), 6) AS pass_rate, round(AVG(xpass), 6) AS exp_pass_rate,
             round(AVG(pass_oe), 6) AS proe
      FROM plays WHERE {TRUE_PLAY} GROUP BY ALL),
w AS (SELECT season, week, posteam AS team, COUNT(*) AS plays, AVG(pass) AS pass_rate, AVG(xpass) AS xpass_rate
      FROM plays WHERE {QUAL} AND NOT COALESCE(half_seconds_remaining <= 120, false) GROUP BY ALL)
SELECT COALESCE(s.season, w.season) AS season, COALESCE(s.team, w.team) AS team, s.pass_rate, s.exp_pass_rate, s.proe,
       w.week, w.plays, round(w.pass_rate, 6) AS week_pass_rate, round(w.xpass_rate, 6) AS week_xpass_rate,
       round(w.pass_rate - w.xpass_rate, 6) AS week_proe, round(1800.0 / w.plays, 6) AS sec_per_play_proxy
FROM s FULL JOIN w ON s.season IS NOT DISTINCT FROM w.season AND s.team IS NOT DISTINCT FROM w.team
"""))
def rate_over_expected(spark: SparkSession, sf: str) -> DataFrame:
    """Pass rate over expected per team and season on true plays, with the weeks' rates, PROE
    and pace proxy (X9, X10)."""
    return _rounded(lg.rate_over_expected(ad.plays_view(spark, sf)))


@register("team_proe_and_pace", _sql("""
SELECT season, week, season_type, posteam AS team, round(AVG(pass) - AVG(xpass), 6) AS proe_neutral,
       round(30.0::DOUBLE / COUNT(*) * 60.0, 6) AS sec_per_play_neutral
FROM plays WHERE qb_dropback = 1 AND half_seconds_remaining > 120 GROUP BY ALL
"""))
def team_proe_and_pace(spark: SparkSession, sf: str) -> DataFrame:
    """D75 (X9, X10): dropbacks outside the last two minutes of a half."""
    return _rounded(lg.team_proe_and_pace(ad.plays_view(spark, sf)))


@register("formation_target_shares", _sql("""
p AS (SELECT season, week, season_type, posteam AS team, receiver_player_id AS player_id,
             COUNT(*) FILTER (pass = 1 AND receiver_player_id IS NOT NULL AND shotgun = 1) AS sg,
             COUNT(*) FILTER (pass = 1 AND receiver_player_id IS NOT NULL AND no_huddle = 1) AS nh
      FROM plays GROUP BY ALL)
SELECT season, week, season_type, team, player_id, sg AS shotgun_targets, nh AS no_huddle_targets,
       round(sg / NULLIF(SUM(sg) OVER w, 0), 6) AS shotgun_target_share,
       round(nh / NULLIF(SUM(nh) OVER w, 0), 6) AS no_huddle_target_share
FROM p WINDOW w AS (PARTITION BY season, week, season_type, team)
"""))
def formation_target_shares(spark: SparkSession, sf: str) -> DataFrame:
    """D64 (A14, X6): shotgun and no-huddle target shares."""
    return _rounded(lg.formation_target_shares(ad.plays_view(spark, sf)))


@register("opponent_adjusted", _sql(f"""
q AS (SELECT * FROM plays WHERE {TRUE_PLAY}),
al AS (SELECT season, defteam, CAST(round(AVG(epa), 6) AS DECIMAL(18,6)) AS opp_epa_allowed FROM q GROUP BY ALL)
SELECT q.season, q.posteam, COUNT(*) AS plays, round(AVG(q.epa), 6) AS epa_per_play,
       round(CAST(SUM(CAST(q.epa AS DECIMAL(18,6)) - al.opp_epa_allowed) AS DOUBLE) / COUNT(*), 6) AS adj_epa_per_play
FROM q JOIN al ON al.season = q.season AND al.defteam = q.defteam GROUP BY ALL
"""))
def opponent_adjusted(spark: SparkSession, sf: str) -> DataFrame:
    """D37 (X17): opponent-adjusted EPA per play."""
    return _rounded(lg.opponent_adjusted(ad.plays_view(spark, sf)))


@register("pct_filter_counts", _sql(f"""
SELECT season, season_type, defteam AS team,
       round(AVG(CASE WHEN was_pressure THEN 1.0 ELSE 0.0 END), 6) AS pressure_rate,
       round(100.0 * COUNT(*) FILTER (WHERE defense_man_zone_type ILIKE '%man%') / COUNT(*), 6) AS man_pct,
       round(100.0 * COUNT(*) FILTER (WHERE defense_man_zone_type ILIKE '%zone%') / COUNT(*), 6) AS zone_pct
FROM plays WHERE {TRUE_PLAY} AND pass = 1 GROUP BY ALL
"""))
def pct_filter_counts(spark: SparkSession, sf: str) -> DataFrame:
    """D28 (A4): pressure, man and zone by defense."""
    return _rounded(lg.pct_filter_counts(ad.plays_view(spark, sf)))


@register("agg_coalesced_key", _sql(f"""
SELECT season, season_type, COALESCE(penalty_team, posteam, defteam) AS team, penalty_type,
       COUNT(*) AS penalties, SUM(COALESCE(penalty_yards, 0)) AS penalty_yards
FROM plays WHERE {TRUE_PLAY} AND penalty = 1 GROUP BY ALL
"""))
def agg_coalesced_key(spark: SparkSession, sf: str) -> DataFrame:
    """D34 (P15): grouping on a coalesced key."""
    return lg.penalties_by_team(ad.plays_view(spark, sf))


def _context_sql(passes: str, rushes: str) -> str:
    return d.with_sql(*ad.SQL_FOOTBALL, ad.SQL_PLAYS, ad.SQL_SNAPS, f"""
c AS (SELECT season, week, season_type, posteam AS team, COUNT(*) FILTER (qb_dropback = 1) AS team_dropbacks,
             COUNT(*) FILTER ({passes}) AS team_pass_attempts, COUNT(*) FILTER ({rushes}) AS team_carries
      FROM plays GROUP BY ALL)
SELECT * FROM c LEFT JOIN (SELECT season, week, team, MAX(offense_snaps) AS team_offense_snaps FROM snap_counts GROUP BY ALL)
  USING (season, week, team)""")


@register("team_context", _context_sql("pass_attempt = 1 AND sack = 0", "rush_attempt = 1"))
def team_context(spark: SparkSession, sf: str) -> DataFrame:
    """D66 (X8, J2): team denominators per week with offense snaps."""
    return lg.team_context(ad.plays_view(spark, sf), ad.snap_counts_view(spark, sf))


@register("team_context_flags", _context_sql("pass = 1", "rush = 1"))
def team_context_flags(spark: SparkSession, sf: str) -> DataFrame:
    """As D66 from the plain pass and rush flags."""
    return lg.team_context(ad.plays_view(spark, sf), ad.snap_counts_view(spark, sf), "flags")


@register("share_conditional", _sql("""
p AS (SELECT season, week, season_type, posteam AS team, offense_personnel, receiver_player_id AS player_id,
             CASE WHEN pass = 1 AND receiver_player_id IS NOT NULL THEN 1 ELSE 0 END AS target
      FROM plays WHERE offense_personnel IS NOT NULL),
tm AS (SELECT season, week, season_type, team, offense_personnel, SUM(target) AS team_targets FROM p GROUP BY ALL)
SELECT season, week, season_type, team, offense_personnel, player_id, CAST(SUM(target) AS BIGINT) AS targets,
       round(CAST(SUM(target) AS DOUBLE) / NULLIF(MAX(team_targets), 0), 6) AS target_share_in_personnel
FROM p JOIN tm USING (season, week, season_type, team, offense_personnel) GROUP BY ALL
"""))
def share_conditional(spark: SparkSession, sf: str) -> DataFrame:
    """D67 (A14): target share within the personnel group."""
    return _rounded(lg.personnel_target_shares(ad.plays_view(spark, sf)))


@register("status_counts", """
SELECT CAST(year(o.o_orderdate) AS INTEGER) AS season, c.c_nationkey,
       COUNT(*) FILTER (WHERE lower(o.o_orderpriority) LIKE '%urgent%') AS n_urgent,
       COUNT(*) FILTER (WHERE upper(o.o_orderpriority) LIKE '%HIGH%') AS n_high,
       COUNT(*) FILTER (WHERE o.o_orderpriority ILIKE '%low%') AS n_low
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY ALL
""")
def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Status text counts via LIKE / ILIKE (injury report statuses)."""
    o = table(spark, sf, "orders", "o_custkey", "o_orderdate", "o_orderpriority")
    c = table(spark, sf, "customer", "c_custkey", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return j.groupBy(F.year("o_orderdate").alias("season"), "c_nationkey").agg(
        F.count_if(F.lower("o_orderpriority").like("%urgent%")).alias("n_urgent"),
        F.count_if(F.upper("o_orderpriority").like("%HIGH%")).alias("n_high"),
        F.count_if(F.col("o_orderpriority").ilike("%low%")).alias("n_low"))


@register("filtered_counts", _sql("""
SELECT season, posteam, COUNT(DISTINCT game_id) AS indoor_games
FROM plays WHERE roof IN ('dome', 'closed') AND week BETWEEN 10 AND 12 GROUP BY ALL
"""))
def filtered_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Indoor games per team in the late weeks (filter + distinct count)."""
    p = ad.plays_view(spark, sf)
    return (p.filter(F.col("roof").isin("dome", "closed") & F.col("week").between(10, 12))
            .groupBy("season", "posteam").agg(F.countDistinct("game_id").alias("indoor_games")))


_OUTCOMES = ", ".join(cal.OUTCOMES)
_ABROAD = " OR ".join(f"stadium LIKE '%{w}%'" for w in cal.ABROAD)


@register("calendar_effects", _sql(f"""{_GAPS.strip()},
mt AS (SELECT season, week, game_id, posteam AS team, AVG(epa) AS epa_all, AVG(epa) FILTER (is_pass) AS epa_pass,
              AVG(epa) FILTER (is_rush) AS epa_rush, AVG(pass) - AVG(xpass) AS proe, SUM(gap) / COUNT(gap) AS sec_per_play
       FROM gaps GROUP BY ALL),
gm AS (SELECT season, week, game_id, game_date, home_team, away_team, upper(COALESCE(stadium, '')) AS stadium,
              MAX(CASE WHEN qtr > 4 THEN 1 ELSE 0 END) AS had_ot FROM plays GROUP BY ALL),
sd AS (SELECT *, home_team AS team FROM gm UNION ALL SELECT *, away_team FROM gm),
rs AS (SELECT *, date_diff('day', lag(game_date) OVER w, game_date) AS rest, lag(had_ot) OVER w AS prev_had_ot FROM sd
       WINDOW w AS (PARTITION BY season, team ORDER BY game_date, game_id, stadium)),
ev AS (SELECT season, week, team, game_id, unnest(['post_bye', 'short_week', 'mini_bye', 'prev_ot', 'international']) AS event_type,
              unnest([rest BETWEEN 13 AND 16, rest BETWEEN 3 AND 4, rest BETWEEN 9 AND 11, prev_had_ot = 1, {_ABROAD}]) AS on_
       FROM rs),
bs AS (SELECT season, team, {", ".join(_mean6(c, f"base_{c}") for c in cal.OUTCOMES)} FROM mt GROUP BY ALL),
dl AS (SELECT event_type, {", ".join(f"round({c} - base_{c}, 6) AS {c}" for c in cal.OUTCOMES)}
       FROM ev JOIN mt USING (season, week, team, game_id) JOIN bs USING (season, team) WHERE on_),
lo AS (SELECT event_type, unnest([{", ".join(map(repr, cal.OUTCOMES))}]) AS outcome, unnest([{_OUTCOMES}]) AS delta FROM dl),
ag AS (SELECT event_type, outcome, CAST(SUM(CAST(delta AS DECIMAL(24,6))) AS DOUBLE) / COUNT(delta) AS effect,
              1.96::DOUBLE * stddev_samp(delta) / sqrt(COUNT(*)) AS half, COUNT(*) AS n FROM lo GROUP BY ALL)
SELECT event_type, outcome, round(effect, 6) AS effect, round(effect - half, 6) AS ci_low, round(effect + half, 6) AS ci_high, n
FROM ag"""))
def calendar_effects(spark: SparkSession, sf: str) -> DataFrame:
    """D9 (P6, W5, W6, U1, U2, A12, A15): five events, five outcomes."""
    return _rounded(cal.calendar_effects(ad.plays_view(spark, sf)))


_ROOFS = """
later AS (SELECT * REPLACE (season + 29 AS season) FROM plays WHERE play = 1 AND season_type = 'REG'),
spelled AS (SELECT season, game_id, upper(MAX(COALESCE(roof, ''))) AS roof FROM later GROUP BY ALL),
placed AS (
  SELECT s.season, s.week, s.game_id, s.home_team, s.away_team, p.roof IS NOT NULL AS from_plays,
         CASE WHEN p.roof IS NOT NULL THEN p.roof ELSE upper(COALESCE(s.roof, '')) END AS roof
  FROM schedules s LEFT JOIN spelled p USING (season, game_id)),
sides AS (SELECT *, home_team AS team, 'HOME' AS side FROM placed
          UNION ALL SELECT *, away_team, 'AWAY' FROM placed)"""


def _roof_case(new_rule: bool) -> str:
    from gridmart.functions.classify import ROOF_POLICIES

    def branches(policy: str, season: str) -> str:
        return " ".join(f"WHEN {season} AND roof IN ({', '.join(map(repr, members))}) THEN '{name}'"
                        for name, members in ROOF_POLICIES[policy].items())

    later = branches("retractable_is_indoor", "season >= 2025") if new_rule else ""
    return f"CASE {later} {branches('open_is_retractable', 'season < 2025' if new_rule else 'true')} ELSE 'UNKNOWN' END"


def _seasons_later(p: DataFrame) -> DataFrame:
    return p.withColumn("season", F.col("season") + 29)


@register("team_roof_games", d.with_sql(*ad.SQL_FOOTBALL, ad.SQL_PLAYS, ad.SQL_SCHEDULES, _ROOFS, f"""
SELECT season, team, roof_class, COUNT(DISTINCT game_id) AS games
FROM (SELECT season, team, game_id, {_roof_case(False)} AS roof_class FROM sides) GROUP BY ALL"""))
def team_roof_games(spark: SparkSession, sf: str) -> DataFrame:
    """D26 (J14, U1, P11): roof games of a team, the plays' roof before the schedule's."""
    return env.team_roof_games(_seasons_later(ad.plays_view(spark, sf)), ad.schedules_view(spark, sf))


@register("team_roof_games_by_week", d.with_sql(*ad.SQL_FOOTBALL, ad.SQL_PLAYS, ad.SQL_SCHEDULES, _ROOFS, f"""
SELECT season, week, team, side, roof_class, COUNT(DISTINCT game_id) AS games,
       COUNT(DISTINCT CASE WHEN from_plays THEN game_id END) AS games_from_plays
FROM (SELECT season, week, team, side, game_id, from_plays, {_roof_case(True)} AS roof_class FROM sides) GROUP BY ALL"""))
def team_roof_games_by_week(spark: SparkSession, sf: str) -> DataFrame:
    """By week and side, with the 2025 rule and how many roofs the plays gave."""
    return env.team_roof_games_by_week(_seasons_later(ad.plays_view(spark, sf)), ad.schedules_view(spark, sf))


_REC_SUMS = ["targets", "end_zone_targets", "rz20_targets", "rz10_targets", "rz5_targets"]
_REC_MEANS = ["target_share", "shotgun_target_share", "p11_target_share", "adot"]


def _rollup_sql() -> str:
    from gridmart.plans import sql_events as se
    from gridmart.plans.q_marts import _usage_sql
    sums = ", ".join(f"CAST(SUM({c}) AS BIGINT) AS {c}" for c in _REC_SUMS)
    means = ", ".join(f"round(CAST(SUM(CAST(round({c}, 6) AS DECIMAL(18,6))) AS DOUBLE) / COUNT({c}), 6) AS {c}"
                      for c in _REC_MEANS)
    unrounded = _usage_sql(se.RECEIVING).replace("round(CASE", "(CASE").replace("END, 6) AS", "END) AS")
    return (f"WITH r AS ({unrounded})\nSELECT season, season_type, player_id, MAX(player_name) AS player_name, "
            f"MAX(position) AS position, MAX(team) AS primary_team, COUNT(*) AS games, {sums}, {means} "
            "FROM r GROUP BY season, season_type, player_id")


def _pa_summary_sql() -> str:
    from gridmart.plans.q_marts import _D1_SQL
    return f"""WITH pa AS ({_D1_SQL}),
per AS (SELECT season, defense_team, COUNT(DISTINCT week) AS weeks, SUM(points_allowed_ppr) AS total,
               AVG(points_allowed_ppr) AS mean FROM pa WHERE position = 'MEDIUM' GROUP BY ALL),
lg AS (SELECT season, AVG(mean) AS league_mean, STDDEV_POP(mean) AS league_sd FROM per GROUP BY ALL)
SELECT per.season, defense_team, weeks, round(total, 6) AS total, round(mean, 6) AS mean,
       round(league_mean, 6) AS league_mean, round(league_sd, 6) AS league_sd,
       round(mean - league_mean, 6) AS diff, round(100.0 * (mean - league_mean) / league_mean, 6) AS pct
FROM per JOIN lg USING (season)"""


@register("rollup_sum_mean", _rollup_sql())
def rollup_sum_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Season roll-up of the receiving mart (sums for counts, means for shares)."""
    from gridmart.plans import marts as m
    util = m.receiving_shares(ad.player_rows(spark, sf, ["player_name", "position"], m.MEASURES["receiving"]))
    return _rounded(lg.season_rollup(util, _REC_SUMS, _REC_MEANS))


@register("mart_points_allowed_summary", _pa_summary_sql())
def mart_points_allowed_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Defense summary for a filter (one position): weeks, total, mean per defense,
    league mean and population sd of the defense means, difference and percent."""
    from gridmart.plans.q_marts import mart_points_allowed
    pa = mart_points_allowed(spark, sf).filter(F.col("position") == "MEDIUM")
    per = pa.groupBy("season", "defense_team").agg(
        F.countDistinct("week").alias("weeks"), F.sum("points_allowed_ppr").alias("total"),
        F.avg("points_allowed_ppr").alias("mean"))
    league = per.groupBy("season").agg(F.avg("mean").alias("league_mean"), F.stddev_pop("mean").alias("league_sd"))
    out = per.join(league, "season").withColumn("diff", F.col("mean") - F.col("league_mean"))
    return _rounded(out.withColumn("pct", 100.0 * F.col("diff") / F.col("league_mean")))


@register("drive_summary", _sql("""
SELECT game_id, drive AS drive_num, MAX(posteam) FILTER (WHERE posteam IS NOT NULL) AS offense,
       round(SUM(epa), 6) AS drive_epa, round(AVG(success), 6) AS success_rate,
       CAST(SUM(CASE WHEN touchdown = 1 THEN 7 WHEN field_goal_attempt = 1 AND field_goal_result = 'good' THEN 3
                     ELSE 0 END) AS BIGINT) AS naive_points
FROM plays WHERE play = 1 AND COALESCE(aborted_play, 0) = 0 GROUP BY game_id, drive
"""))
def drive_summary(spark: SparkSession, sf: str) -> DataFrame:
    """D30 (X16): drive EPA, success rate and naive drive points."""
    return _rounded(lg.drive_summary(ad.plays_view(spark, sf)))


@register("sql_views_params", """
WITH s AS (
  SELECT o.o_custkey, CAST(year(o.o_orderdate) AS INTEGER) AS season,
         CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS spend
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  WHERE year(o.o_orderdate) >= 1996 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY season ORDER BY spend DESC, o_custkey) AS rk FROM s)
SELECT o_custkey, season, spend, CAST(rk AS INTEGER) AS rk FROM r WHERE rk <= 10
""")
def sql_views_params(spark: SparkSession, sf: str, start_season: int = 1996, top: int = 10) -> DataFrame:
    """K9 + P3 + T3 through the SQL API: temp views over the tables and a saved query run
    with typed named parameters (no text substitution)."""
    table(spark, sf, "lineitem", "l_orderkey", "l_extendedprice").createOrReplaceTempView("gm_lineitem")
    table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate").createOrReplaceTempView("gm_orders")
    return spark.sql("""
        WITH s AS (
          SELECT o.o_custkey, year(o.o_orderdate) AS season,
                 CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS spend
          FROM gm_lineitem l JOIN gm_orders o ON l.l_orderkey = o.o_orderkey
          WHERE year(o.o_orderdate) >= :start_season
          GROUP BY o.o_custkey, year(o.o_orderdate)),
        r AS (SELECT *, row_number() OVER (PARTITION BY season ORDER BY spend DESC, o_custkey) AS rk FROM s)
        SELECT o_custkey, season, spend, rk FROM r WHERE rk <= :top
    """, args={"start_season": start_season, "top": top})
