"""Event study over the calendar (D9): what byes, short weeks, overtime and travel do to a team."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.functions import football as fb
from gridmart.functions.classify import matches_any
from gridmart.functions.columns import round_half_up, share
from gridmart.operators.ranking import previous_by_day
from gridmart.operators.shares import null_safe_join
from gridmart.operators.stats import Z95
from gridmart.operators.unpivot import flags_to_long, sides_to_long
from gridmart.plans.league import mean6, team_games

# Rest days of each kind of week, and words in the names of stadiums abroad.
REST_DAYS = {"post_bye": (13, 16), "short_week": (3, 4), "mini_bye": (9, 11)}
ABROAD = ("WEMBLEY", "TOTTENHAM", "TWICKENHAM", "AZTECA", "MUNICH", "ALLIANZ", "FRANKFURT", "DEUTSCHE BANK")
EVENTS = (*REST_DAYS, "prev_ot", "international")
OUTCOMES = ("epa_all", "epa_pass", "epa_rush", "proe", "sec_per_play")


def team_game_outcomes(pbp: DataFrame) -> DataFrame:
    """The five outcomes of every team-game with a qualifying play (PROE and pace over all of them)."""
    tg = team_games(pbp, "season_type").filter((F.col("plays") > 0) & (F.col("season_type") == "REG"))
    return tg.select(
        "season", "week", "game_id", F.col("posteam").alias("team"), share("epa_sum", "epa_n").alias("epa_all"),
        share("epa_pass_sum", "epa_pass_n").alias("epa_pass"), share("epa_rush_sum", "epa_rush_n").alias("epa_rush"),
        (share("pass_plays", "plays") - share("xpass_sum", "xpass_n")).alias("proe"),
        share("gap_sum", "gap_n").alias("sec_per_play"))


def event_flags(pbp: DataFrame) -> DataFrame:
    """0/1 flags of every team-game: rest since the team's previous game of the season, whether that
    one went to overtime, and a stadium abroad. A team's games of one day are its window; of a day
    only the last game goes on to the next, so a team's season is split over many tasks."""
    p = pbp.filter(F.col("season_type") == "REG")
    games = p.groupBy("season", "week", "game_id", F.to_date("game_date").alias("game_date"), "home_team", "away_team",
                      F.upper(F.coalesce("stadium", F.lit(""))).alias("stadium")).agg(
        F.max(F.when(F.col("qtr") > 4, 1).otherwise(0)).alias("had_ot"))
    sides = sides_to_long(games, ["season", "week", "game_id", "game_date", "stadium", "had_ot"],
                          {"home": {"team": "home_team"}, "away": {"team": "away_team"}}).drop("side")
    sides = sides.withColumn("now", F.struct("game_date", "had_ot"))
    order = [F.col("game_id").asc_nulls_first(), F.col("stadium").asc_nulls_first()]
    seen = previous_by_day(sides, ["season", "team"], "game_date", order, "now", "prev")
    rest = F.datediff("game_date", "prev.game_date")
    flags = {name: rest.between(*days) for name, days in REST_DAYS.items()}
    flags |= {"prev_ot": F.col("prev.had_ot") == 1, "international": matches_any("stadium", ABROAD)}
    return seen.select("season", "week", "team", "game_id",
                       *[F.when(cond, 1).otherwise(0).alias(name) for name, cond in flags.items()])


def calendar_effects(pbp: DataFrame, z: float = Z95, outcomes: Sequence[str] = OUTCOMES) -> DataFrame:
    """Per event and outcome, the mean difference to the team's season average, its confidence
    interval and the number of team-games. Flags and outcomes are each unpivoted once."""
    metrics = team_game_outcomes(pbp)
    base = metrics.groupBy("season", "team").agg(*[mean6(c).alias(f"base_{c}") for c in outcomes])
    events = flags_to_long(event_flags(pbp), ["season", "week", "team", "game_id"], EVENTS, "event_type")
    joined = events.join(metrics, ["season", "week", "team", "game_id"])
    joined = null_safe_join(joined, base, ["season", "team"], "inner")
    deltas = joined.select("event_type", *[round_half_up(F.col(c) - F.col(f"base_{c}"), 6).alias(c) for c in outcomes])
    long = deltas.unpivot(["event_type"], list(outcomes), "outcome", "delta")
    effect = mean6("delta")
    agg = long.groupBy("event_type", "outcome").agg(
        effect.alias("effect"), F.stddev_samp("delta").alias("sd"), F.count(F.lit(1)).alias("n"))
    half = F.lit(z) * F.col("sd") / F.sqrt(F.col("n"))
    return agg.select("event_type", "outcome", "effect", (F.col("effect") - half).alias("ci_low"),
                      (F.col("effect") + half).alias("ci_high"), "n")
