"""DuckDB text of the player-week events behind the utilization marts, written once.

``player_weeks`` holds a deduped weekly row with its receiver's counts (``r_...``), rusher's
counts (``c_...``) and team-week's denominators (``t_...``); the oracles select from it.
"""

from __future__ import annotations

KEYS = "season, week, season_type, team, player_id"
TEAM = "season, week, season_type, team"

# Situations by what a play must satisfy (definitions X3-X6).
ZONES = {f"rz{y}": f"yardline_100 <= {y}" for y in (20, 10, 5)}
SITUATIONS = {
    **ZONES, "third_fourth_down": "down IN (3, 4)", "ldd": "down IN (3, 4) AND ydstogo >= 5",
    "sdd": "down BETWEEN 1 AND 4 AND ydstogo <= 2", "two_minute": "half_seconds_remaining <= 120",
    "four_minute": "half_seconds_remaining <= 240"}
FORMATIONS = {"shotgun": "shotgun = 1", "no_huddle": "no_huddle = 1",
              **{f"p{c}": f"offense_personnel = '{c}'" for c in ("11", "12", "21")}}


def _counts(prefix: str, which: str, conditions: dict[str, str]) -> str:
    return ", ".join(f"COUNT(*) FILTER ({which} AND {cond}) AS {prefix}{name}" for name, cond in conditions.items())


SQL_PLAYER_WEEKS = f"""
tagged AS (
  SELECT *, posteam AS team, pass = 1 AND receiver_player_id IS NOT NULL AS target,
         COALESCE(yardline_100 - air_yards <= 0, false) AS end_zone,
         qb_dropback = 1 AND half_seconds_remaining > 120 AS styled
  FROM plays),
receivers AS (
  SELECT {TEAM}, receiver_player_id AS player_id, COUNT(*) FILTER (target) AS r_all,
         COUNT(*) FILTER (end_zone) AS r_end_zone, {_counts("r_", "target", {**SITUATIONS, **FORMATIONS})},
         SUM(air_yards) FILTER (target) AS r_air, COUNT(air_yards) FILTER (target) AS r_n_air,
         SUM(CASE WHEN pass <> 1 THEN 0.0 WHEN air_yards >= 15 THEN 0.6 ELSE 0.4 END) AS r_xfp
  FROM tagged WHERE receiver_player_id IS NOT NULL GROUP BY ALL),
rushers AS (
  SELECT {TEAM}, rusher_player_id AS player_id, COUNT(*) AS c_all,
         {_counts("c_", "true", {k: SITUATIONS[k] for k in (*ZONES, "third_fourth_down")})},
         SUM(CASE WHEN yardline_100 > 20 THEN 0.15 WHEN yardline_100 > 10 THEN 0.3 WHEN yardline_100 > 5 THEN 0.5
             ELSE 0.8 END) AS c_xfp
  FROM tagged WHERE rush = 1 AND rusher_player_id IS NOT NULL GROUP BY ALL),
teams AS (
  SELECT {TEAM}, COUNT(*) FILTER (target) AS t_all, COUNT(*) FILTER (end_zone) AS t_end_zone,
         {_counts("t_", "target", {**ZONES, **FORMATIONS})},
         COUNT(*) FILTER (pass_attempt = 1 AND sack = 0) AS t_attempts,
         COUNT(*) FILTER (qb_dropback = 1) AS t_dropbacks, COUNT(*) FILTER (rush_attempt = 1) AS t_carries,
         {_counts("t_carries_", "rush_attempt = 1", ZONES)},
         AVG(pass) FILTER (styled) - AVG(xpass) FILTER (styled) AS t_proe, COUNT(*) FILTER (styled) AS t_styled
  FROM tagged GROUP BY ALL),
player_weeks AS (
  SELECT * FROM w LEFT JOIN receivers USING ({KEYS}) LEFT JOIN rushers USING ({KEYS}) LEFT JOIN teams USING ({TEAM}))"""

# Seconds per play of each drive, weighted by its counted dropbacks (X11, Q4).
SQL_PACE = f"""
drives AS (
  SELECT {TEAM}, game_id, drive, COUNT(*) FILTER (styled) AS n, MAX(drive_play_count) AS plays,
         MAX(CAST(split_part(drive_time_of_possession, ':', 1) AS DOUBLE) * 60
             + CAST(split_part(drive_time_of_possession, ':', 2) AS DOUBLE)) AS seconds
  FROM tagged GROUP BY ALL),
pace AS (
  SELECT {TEAM}, CAST(SUM(n * CAST(round(seconds / plays, 6) AS DECIMAL(18,6))) AS DOUBLE) / SUM(n) AS t_pace
  FROM drives WHERE n > 0 AND plays > 0 AND seconds IS NOT NULL GROUP BY ALL)"""

ID = "season, week, season_type, team, player_id, player_name, position"


def n(column: str, alias: str) -> str:
    """A count, 0 without events."""
    return f"CAST(COALESCE({column}, 0) AS BIGINT) AS {alias}"


def over(column: str, denominator: str, alias: str, zero: bool = False) -> str:
    """A share, NULL (or 0.0) without a positive denominator."""
    return f"round(CASE WHEN {denominator} > 0 THEN COALESCE({column}, 0) / {denominator}{' ELSE 0.0' * zero} END, 6) AS {alias}"


def listed(*items: str) -> str:
    return ",\n  ".join(items)


ADOT = "round(CASE WHEN r_n_air > 0 THEN r_air / r_n_air END, 6) AS adot"
PROE = "round(t_proe, 6) AS team_proe_neutral"
PACE_PROXY = "round(CASE WHEN t_styled > 0 THEN 30.0::DOUBLE / t_styled * 60.0 END, 6) AS team_sec_per_play_neutral"
NO_ROUTES = "CAST(NULL AS BIGINT) AS routes_run, " + ", ".join(
    f"CAST(NULL AS DOUBLE) AS {c}" for c in ("route_participation", "yprr", "tprr"))


def routes(attempts: str) -> str:
    """X15 from a joined ``routes`` table."""
    return listed(
        "routes_run", f"round(CASE WHEN {attempts} > 0 THEN routes_run::DOUBLE / {attempts} END, 6) AS route_participation",
        "round(CASE WHEN routes_run > 0 THEN COALESCE(receiving_yards, 0)::DOUBLE / routes_run END, 6) AS yprr",
        "round(CASE WHEN routes_run > 0 THEN COALESCE(r_all, 0)::DOUBLE / routes_run END, 6) AS tprr")


def formations(zero: bool) -> list[str]:
    return [over(f"r_{f}", f"t_{f}", f"{f}_target_share", zero) for f in FORMATIONS]


RECEIVING = listed(
    ID, n("r_all", "targets"), over("r_all", "t_all", "target_share"),
    *[n(f"r_{k}", f"{k}_targets") for k in ("end_zone", *SITUATIONS)], *formations(True), ADOT)

RUSHING = listed(
    ID, n("c_all", "carries"), over("c_all", "t_carries", "carry_share"),
    *[n(f"c_{z}", f"{z}_carries") for z in ZONES],
    *[over(f"c_{z}", f"t_carries_{z}", f"{z}_carry_share", True) for z in ZONES])

RB = listed(
    ID, n("c_all", "carries"), over("c_all", "t_carries", "carry_share"),
    *[n(f"c_{z}", f"{z}_carries") for z in (*ZONES, "third_fourth_down")],
    *[over(f"c_{z}", "t_carries", f"{z}_carry_share") for z in ZONES],
    n("r_all", "targets"), over("r_all", "t_attempts", "target_share"),
    n("r_two_minute", "two_minute_targets"), over("r_two_minute", "t_attempts", "two_minute_target_share"),
    PROE, PACE_PROXY)


def wide(variant: str) -> str:
    situations = (["ldd", "sdd", "third_fourth_down", "two_minute", "four_minute"] if variant == "wr"
                  else ["third_fourth_down", "two_minute"])
    return listed(
        ID, n("r_all", "targets"), over("r_all", "t_all", "target_share"), NO_ROUTES,
        "round(air_yards_share, 6) AS air_yards_share", "round(wopr, 6) AS wopr",
        *[n(f"r_{k}", f"{k}_targets") for k in ("end_zone", *ZONES)],
        *[over(f"r_{k}", f"t_{k}", f"{k}_target_share", True) for k in ("end_zone", *ZONES)],
        *[over(f"r_{k}", "t_attempts", f"{k}_target_share") for k in situations],
        *(["CAST(NULL AS DOUBLE) AS play_action_target_share"] if variant == "wr" else []),
        *formations(True), ADOT, PROE, "round(t_pace, 3) AS team_sec_per_play_neutral")


ALL = listed(
    ID, "round(snap_share, 6) AS snap_share", NO_ROUTES,
    n("r_all", "targets"), over("r_all", "t_attempts", "target_share"),
    "COALESCE(receiving_yards, 0) AS receiving_yards", "COALESCE(receiving_air_yards, 0) AS receiving_air_yards",
    "round(air_yards_share, 6) AS air_yards_share", "round(wopr, 6) AS wopr",
    *[n(f"r_{k}", f"{k}_targets") for k in ("end_zone", *SITUATIONS)],
    *[over(f"r_{k}", "t_attempts", f"{k}_target_share") for k in ("end_zone", *SITUATIONS)], *formations(False),
    n("c_all", "carries"), over("c_all", "t_carries", "carry_share"),
    *[over(f"c_{z}", "t_carries", f"{z}_carry_share") for z in ZONES], ADOT,
    "round(CASE WHEN COALESCE(r_xfp, c_xfp) IS NOT NULL THEN CAST(COALESCE(c_xfp, 0) + COALESCE(r_xfp, 0) AS DOUBLE) END, 6)"
    " AS xfp_lite", PROE, PACE_PROXY, "CASE WHEN t_dropbacks IS NOT NULL THEN team_offense_snaps END AS team_offense_snaps",
    "t_dropbacks AS team_dropbacks", "t_attempts AS team_pass_attempts", "t_carries AS team_carries")
