"""Play-level metric definitions over ``pbp`` columns.

Flags are DOUBLE 0/1 in the data; every helper returns a boolean ``Column``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Situational thresholds used by the reference's queries.
NEUTRAL_WP = (0.35, 0.65)        # win probability band of the team with the ball
NEUTRAL_SCORE = 7                # absolute score differential
NEUTRAL_DOWNS = (1, 2)
LATE_QUARTERS, LATE_SECONDS = (2, 4), 120
LATE_DOWNS, LONG_TO_GO, SHORT_TO_GO = (3, 4), 5, 2


def flag(name: str) -> Column:
    """A 0/1 (or boolean) column as a boolean, NULL as false."""
    return F.coalesce(F.col(name).cast("double") == 1, F.lit(False))


def is_true_play() -> Column:
    """``play = 1 AND COALESCE(aborted_play, 0) = 0``."""
    return flag("play") & ~flag("aborted_play")


def is_qualifying() -> Column:
    """A pass or rush attempt that is not a spike, kneel or deleted play."""
    return ((flag("pass") | flag("rush_attempt")) & ~flag("qb_spike") & ~flag("qb_kneel") & ~flag("play_deleted"))


def posteam_wp() -> Column:
    """Win probability of the team with the ball."""
    return F.when(F.col("posteam") == F.col("home_team"), F.col("home_wp")).otherwise(F.col("away_wp"))


def is_neutral() -> Column:
    """Win prob 0.35-0.65, score within 7, downs 1-2, not in the last 120 s of Q2/Q4."""
    late = F.col("qtr").isin(*LATE_QUARTERS) & (F.col("quarter_seconds_remaining") <= LATE_SECONDS)
    return (posteam_wp().between(*NEUTRAL_WP) & (F.abs(F.col("score_differential")) <= NEUTRAL_SCORE)
            & F.col("down").isin(*NEUTRAL_DOWNS) & ~F.coalesce(late, F.lit(False)))


def is_target() -> Column:
    """A pass with a receiver."""
    return flag("pass") & F.col("receiver_player_id").isNotNull()


def is_air_target() -> Column:
    return is_target() & F.col("air_yards").isNotNull()


def is_end_zone_target() -> Column:
    """Air yards reach the end zone. Does not require a target (reference behaviour)."""
    return F.coalesce(F.col("air_yards").isNotNull() & (F.col("yardline_100") - F.col("air_yards") <= 0),
                      F.lit(False))


def in_red_zone(yards: int) -> Column:
    """Ball at or inside the opponent's ``yards`` line."""
    return F.coalesce(F.col("yardline_100") <= yards, F.lit(False))


def late_down() -> Column:
    """Third or fourth down."""
    return F.coalesce(F.col("down").isin(*LATE_DOWNS), F.lit(False))


def long_late_down() -> Column:
    return late_down() & F.coalesce(F.col("ydstogo") >= LONG_TO_GO, F.lit(False))


def short_yardage() -> Column:
    return F.coalesce(F.col("down").isin(1, 2, 3, 4) & (F.col("ydstogo") <= SHORT_TO_GO), F.lit(False))


def within_half_seconds(seconds: int) -> Column:
    """Two-minute (120) and four-minute (240) situations."""
    return F.coalesce(F.col("half_seconds_remaining") <= seconds, F.lit(False))


def personnel(code: str) -> Column:
    """Offensive personnel group such as '11'."""
    return F.coalesce(F.col("offense_personnel") == code, F.lit(False))


def is_pass_attempt_context() -> Column:
    """Pass attempt that is not a sack."""
    return flag("pass_attempt") & ~flag("sack")


def leverage(projection: str, ownership: str) -> Column:
    """``projection * (1 - COALESCE(ownership, 0))`` (documented template)."""
    return F.col(projection) * (F.lit(1.0) - F.coalesce(F.col(ownership), F.lit(0.0)))
