"""Where games were played: roof classes by team, week and side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.functions import football as fb
from gridmart.functions.classify import ROOF_POLICIES, policy_classify, roof_by_season
from gridmart.operators.override import override_join
from gridmart.operators.unpivot import sides_to_long


def games_with_roof(pbp: DataFrame, schedules: DataFrame, keys: list[str], season_type: str = "REG") -> DataFrame:
    """Scheduled games with ``roof`` (upper case) and ``roof_source``: the plays' spelling where the
    game has any play, else the schedule's. A played game whose plays name no roof has ''
    (unknown), even where the schedule names one."""
    games = schedules.filter(F.col("game_type") == season_type).withColumn(
        "roof_schedule", F.upper(F.coalesce("roof", F.lit("")))).drop("roof")
    plays = pbp.filter((F.col("season_type") == season_type) & fb.flag("play"))
    roof = F.upper(F.max(F.coalesce("roof", F.lit(""))))
    return override_join(games, plays, keys, {"roof": (roof, "roof_schedule")}, "schedule", "plays")


def team_roof_games(pbp: DataFrame, schedules: DataFrame, season_type: str = "REG") -> DataFrame:
    """Games per season, team and roof class (an open retractable roof is its own class)."""
    games = games_with_roof(pbp, schedules, ["season", "game_id"], season_type)
    sides = sides_to_long(games, ["season", "game_id", "roof"], {"home": {"team": "home_team"}, "away": {"team": "away_team"}})
    classed = sides.withColumn("roof_class", policy_classify("roof", ROOF_POLICIES, "open_is_retractable"))
    return classed.select("season", "game_id", "team", "roof_class").distinct().groupBy(
        "season", "team", "roof_class").agg(F.count(F.lit(1)).alias("games"))


def team_roof_games_by_week(pbp: DataFrame, schedules: DataFrame, season_type: str = "REG") -> DataFrame:
    """Games per season, week, team, side and roof class, with how many of them took their
    roof from the plays; from 2025 on every retractable roof is indoor."""
    games = games_with_roof(pbp, schedules, ["season", "week", "game_id"], season_type)
    sides = sides_to_long(games, ["season", "week", "game_id", "roof", "roof_source"],
                          {"HOME": {"team": "home_team"}, "AWAY": {"team": "away_team"}})
    classed = sides.withColumn("roof_class", roof_by_season("roof", "season"))
    key = ["season", "week", "team", "side", "roof_class"]
    # One row per game first: a distinct count without a set per group.
    per_game = classed.groupBy(*key, "game_id").agg(F.max(F.col("roof_source") == "plays").alias("from_plays"))
    return per_game.groupBy(*key).agg(F.count(F.lit(1)).alias("games"),
                                      F.count_if("from_plays").alias("games_from_plays"))
