"""Fantasy scoring formulas as Column expressions.

Each policy is its own function because the reference's formulas differ in weights,
bonuses and NULL handling; none is a parameterisation of another.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scoring weights and bonus thresholds of the reference's policies.
PASS_YD, PASS_TD, RUSH_YD, RUSH_TD, REC_YD, REC_TD, RECEPTION = 0.04, 4.0, 0.10, 6.0, 0.10, 6.0, 1.0
PPR_INT, PPR_FUMBLE = -2.0, -2.0
DK_INT, DK_FUMBLE, DK_ST_TD, DK_TWO_PT = -1.0, -1.0, 6.0, 2.0
DK_BONUS, DK_PASS_BONUS_AT, DK_RUSH_BONUS_AT, DK_REC_BONUS_AT = 3.0, 300, 100, 100


def _z(name: str) -> Column:
    """``COALESCE(x, 0)`` as DOUBLE."""
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def _fumbles() -> Column:
    return _z("rushing_fumbles_lost") + _z("receiving_fumbles_lost") + _z("sack_fumbles_lost")


def _two_point() -> Column:
    return _z("passing_2pt_conversions") + _z("rushing_2pt_conversions") + _z("receiving_2pt_conversions")


def _base(int_pts: float) -> Column:
    return (F.lit(PASS_YD) * _z("passing_yards") + F.lit(PASS_TD) * _z("passing_tds")
            + F.lit(int_pts) * _z("interceptions") + F.lit(RUSH_YD) * _z("rushing_yards")
            + F.lit(RUSH_TD) * _z("rushing_tds") + F.lit(REC_YD) * _z("receiving_yards")
            + F.lit(REC_TD) * _z("receiving_tds") + F.lit(RECEPTION) * _z("receptions"))


def ppr() -> Column:
    """standard PPR; interceptions and lost fumbles -2; no bonuses."""
    return _base(PPR_INT) + F.lit(PPR_FUMBLE) * _fumbles()


def dk_no_bonus() -> Column:
    """DraftKings PPR without yardage bonuses (tier marts)."""
    return (_base(DK_INT) + F.lit(DK_ST_TD) * _z("special_teams_tds") + F.lit(DK_FUMBLE) * _fumbles()
            + F.lit(DK_TWO_PT) * _two_point())


def dk_ppr() -> Column:
    """F3 plus a bonus at 300 passing, 100 rushing and 100 receiving yards (per row)."""
    def bonus(col: str, at: float) -> Column:
        return F.when(_z(col) >= at, F.lit(DK_BONUS)).otherwise(F.lit(0.0))

    return (dk_no_bonus() + bonus("passing_yards", DK_PASS_BONUS_AT) + bonus("rushing_yards", DK_RUSH_BONUS_AT)
            + bonus("receiving_yards", DK_REC_BONUS_AT))


def dk_grouped() -> Column:
    """F4 (an aggregate expression): sums per group, bonuses on the group MAX, and the
    whole sum inside one COALESCE, so any NULL sum makes the score 0 (SURVEY Q9)."""
    def s(c: str) -> Column:
        return F.sum(c)

    def bonus(c: str, at: float) -> Column:
        return F.lit(3.0) * F.when(F.max(c) >= at, 1).otherwise(0)

    total = (F.lit(6.0) * s("receiving_tds") + F.lit(0.1) * s("receiving_yards") + bonus("receiving_yards", 100)
             + F.lit(6.0) * s("rushing_tds") + F.lit(0.1) * s("rushing_yards") + bonus("rushing_yards", 100)
             + F.lit(4.0) * s("passing_tds") + F.lit(0.04) * s("passing_yards") + bonus("passing_yards", 300)
             + F.lit(1.0) * s("receptions") - F.lit(1.0) * s("interceptions") - F.lit(1.0) * s("fumbles_lost")
             + F.lit(6.0) * s("return_tds") + F.lit(2.0) * s("two_pt_conversions"))
    return F.coalesce(total, F.lit(0.0))


def rb_season() -> Column:
    """season-level RB points (rushing and receiving only)."""
    return (F.lit(0.1) * _z("rushing_yards") + F.lit(6.0) * _z("rushing_tds") + _z("receptions")
            + F.lit(0.1) * _z("receiving_yards") + F.lit(6.0) * _z("receiving_tds"))


# Touchdowns that F5 counts as returns.
RETURN_TDS = ("kick_return_tds", "punt_return_tds", "field_goal_return_tds")


def dk_returns(columns: Sequence[str]) -> Column:
    """as F2, but return touchdowns by kind, one fumbles column, one two-point column and
    offensive fumble recovery touchdowns; a stat that the table lacks counts as 0."""
    def z(name: str) -> Column:
        return _z(name) if name in columns else F.lit(0.0)

    returns = reduce(add, [z(c) for c in RETURN_TDS])
    bonus = [F.when(z(c) >= at, F.lit(DK_BONUS)).otherwise(F.lit(0.0))
             for c, at in (("passing_yards", DK_PASS_BONUS_AT), ("rushing_yards", DK_RUSH_BONUS_AT),
                           ("receiving_yards", DK_REC_BONUS_AT))]
    return (F.lit(PASS_YD) * z("passing_yards") + F.lit(PASS_TD) * z("passing_tds") + F.lit(DK_INT) * z("interceptions")
            + F.lit(RUSH_YD) * (z("rushing_yards") + z("receiving_yards"))
            + F.lit(RUSH_TD) * (z("rushing_tds") + z("receiving_tds")) + F.lit(RECEPTION) * z("receptions")
            + F.lit(DK_ST_TD) * (returns + z("offensive_fumble_recovery_tds"))
            + F.lit(DK_FUMBLE) * z("fumbles_lost") + F.lit(DK_TWO_PT) * z("two_point_conversions") + reduce(add, bonus))


# The passer rating's four parts, each between 0 and 2.375.
RATING_MAX = 2.375


def passer_rating(completions: str, attempts: str, yards: str, touchdowns: str, interceptions: str) -> Column:
    """The passer rating with its clamps; NULL without an attempt."""
    n = F.nullif(F.col(attempts).cast("double"), F.lit(0.0))

    def clamp(x: Column) -> Column:
        return F.greatest(F.lit(0.0), F.least(F.lit(RATING_MAX), x))

    parts = [clamp((_z(completions) / n - 0.3) * 5), clamp((_z(yards) / n - 3) * 0.25), clamp(_z(touchdowns) / n * 20),
             clamp(F.lit(RATING_MAX) - _z(interceptions) / n * 25)]
    return F.when(n.isNotNull(), reduce(add, parts) / 6 * 100)
