"""Scoring-rules documents as a small ``rules`` DataFrame.

A rules document is nested (sections -> items -> fields). It is flattened on the driver
into rows with sparse columns; list fields become ``ARRAY<STRING>`` / ``ARRAY<INT>``
instead of JSON text. The table is bounded by the document (tens of rows), which is what
makes broadcasting it safe.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

RULES_SCHEMA = ("section STRING, id STRING, metric STRING, points DOUBLE, per_yard DOUBLE, threshold DOUBLE, "
                "bonus_points DOUBLE, types ARRAY<STRING>, modes ARRAY<STRING>, slot STRING, count INT, "
                "eligible_positions ARRAY<STRING>, round INT, weeks ARRAY<INT>, value STRING")

# The Best Ball scoring section (points per unit, yardage rates, bonuses).
BESTBALL_SCORING = {
    "passing_td": {"points": 4},
    "passing_yards": {"points": 1, "per_yard": 0.04},
    "passing_300_bonus": {"bonus_points": 3, "threshold": 300},
    "interception": {"points": -1},
    "rushing_td": {"points": 6},
    "rushing_yards": {"points": 1, "per_yard": 0.1},
    "rushing_100_bonus": {"bonus_points": 3, "threshold": 100},
    "receiving_td": {"points": 6},
    "receiving_yards": {"points": 1, "per_yard": 0.1},
    "receiving_100_bonus": {"bonus_points": 3, "threshold": 100},
    "reception": {"points": 1},
    "return_td": {"points": 6, "types": ["punt", "kickoff", "field_goal"]},
    "fumble_lost": {"points": -1},
    "two_point_conversion": {"points": 2, "modes": ["pass", "run", "catch"]},
    "offensive_fumble_recovery_td": {"points": 6},
}

# Best Ball line-up slots and tournament rounds (weeks per round).
BESTBALL_LINEUP = {"QB": 1, "RB": 2, "WR": 3, "TE": 1, "FLEX": 1}
BESTBALL_ROUNDS = {1: list(range(1, 15)), 2: [15], 3: [16], 4: [17]}

# Which weekly stat column(s) each scoring item reads.
RULE_METRICS = {
    "passing_td": ["passing_tds"], "passing_yards": ["passing_yards"], "passing_300_bonus": ["passing_yards"],
    "interception": ["interceptions"], "rushing_td": ["rushing_tds"], "rushing_yards": ["rushing_yards"],
    "rushing_100_bonus": ["rushing_yards"], "receiving_td": ["receiving_tds"],
    "receiving_yards": ["receiving_yards"], "receiving_100_bonus": ["receiving_yards"],
    "reception": ["receptions"], "return_td": ["special_teams_tds"],
    "fumble_lost": ["rushing_fumbles_lost", "receiving_fumbles_lost", "sack_fumbles_lost"],
    "two_point_conversion": ["passing_2pt_conversions", "rushing_2pt_conversions", "receiving_2pt_conversions"],
    "offensive_fumble_recovery_td": [],
}


def rules_rows(scoring: Mapping[str, Mapping] = BESTBALL_SCORING,
               lineup: Mapping[str, int] = BESTBALL_LINEUP,
               rounds: Mapping[int, list[int]] = BESTBALL_ROUNDS) -> list[tuple]:
    """Flatten the document: one scoring row per (item, stat column), one lineup row per
    slot, one round row per round. ``value`` keeps a text rendering for display."""
    rows: list[tuple] = []
    for item, f in scoring.items():
        for metric in RULE_METRICS.get(item, []) or [None]:
            rows.append(("scoring", item, metric, _f(f.get("points")), _f(f.get("per_yard")),
                         _f(f.get("threshold")), _f(f.get("bonus_points")), f.get("types"), f.get("modes"),
                         None, None, None, None, None, str(f.get("points", f.get("bonus_points")))))
    for slot, n in lineup.items():
        elig = ["RB", "WR", "TE"] if slot == "FLEX" else [slot]
        rows.append(("lineup", slot, None, None, None, None, None, None, None, slot, n, elig, None, None, str(n)))
    for rnd, weeks in rounds.items():
        rows.append(("tournament_rounds", f"round_{rnd}", None, None, None, None, None, None, None, None, None,
                     None, rnd, weeks, ",".join(map(str, weeks))))
    return rows


def _f(v):
    return None if v is None else float(v)


def rules_frame(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.createDataFrame(rules_rows(**kwargs), RULES_SCHEMA)


# Defense and kicker sections and line-ups of the Classic and Showdown documents.
DST_SCORING = {
    "sack": 1, "interception": 2, "fumble_recovery": 2, "safety": 2, "defensive_td": 6, "blocked_kick": 2,
    "kick_punt_return_td": 6, "two_point_return": 2,
    "points_allowed": {"0": 10, "1-6": 7, "7-13": 4, "14-20": 1, "21-27": 0, "28-34": -1, "35+": -4},
}
KICKER_SCORING = {"fg_0_39": 3, "fg_40_49": 4, "fg_50_plus": 5, "pat": 1}
CLASSIC = {
    "scoring": {**BESTBALL_SCORING, "dst": DST_SCORING},
    "lineup": {"salary_cap": 50000, "slots": {"QB": 1, "RB": 2, "WR": 3, "TE": 1, "FLEX": 1, "DST": 1}},
}
SHOWDOWN = {
    "scoring": {**BESTBALL_SCORING, "kicker": KICKER_SCORING, "dst": DST_SCORING},
    "lineup": {"salary_cap": 50000, "captain_multiplier": {"points": 1.5, "salary": 1.5}, "slots": {"CPT": 1, "FLEX": 5}},
}


def band(label: str) -> tuple[float | None, float | None]:
    """(least, most) of a band such as ``7-13``, ``35+`` or ``0`` (which takes in all below)."""
    if label.endswith("+"):
        return float(label[:-1]), None
    low, _, high = label.partition("-")
    return (float(low), float(high)) if high else (None, float(low))
