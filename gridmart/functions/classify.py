"""Classification expressions: numeric buckets, category maps, named policies, patterns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridmart.functions.columns import ColumnOrName, col


def buckets(c: ColumnOrName, edges: Sequence[tuple[float | None, float | None, str]],
            default: str | None = None) -> Column:
    """Chained ``CASE WHEN lo <= c AND c <= hi THEN label``; ``None`` bounds are open."""
    x = col(c)
    expr = None
    for lo, hi, label in edges:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (x >= F.lit(lo))
        if hi is not None:
            cond = cond & (x <= F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if default is not None else expr


# Third-down distance buckets (yards to go).
DISTANCE_BUCKETS = ((1, 2, "1-2"), (3, 5, "3-5"), (6, 8, "6-8"), (9, 12, "9-12"), (13, None, "13+"))


def category_map(c: ColumnOrName, groups: Mapping[str, Sequence[str]],
                 default: str | None = "OTHER") -> Column:
    """Map values to groups by membership lists (``CASE WHEN c IN (...) THEN g``)."""
    x = col(c)
    expr = None
    for label, members in groups.items():
        cond = x.isin(list(members))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


# Roster position -> unit group.
POSITION_GROUPS = {
    "QB": ("QB",), "RB": ("RB", "FB", "HB"), "WR": ("WR",), "TE": ("TE",),
    "OL": ("T", "G", "C", "OT", "OG", "OL"), "DL": ("DE", "DT", "NT", "DL"),
    "LB": ("LB", "ILB", "OLB", "MLB"), "DB": ("CB", "S", "FS", "SS", "DB"),
    "ST": ("K", "P", "LS"),
}


def policy_classify(c: ColumnOrName, policies: Mapping[str, Mapping[str, Sequence[str]]],
                    policy: str, default: str = "UNKNOWN") -> Column:
    """Classify with one of several named mapping policies."""
    if policy not in policies:
        raise ValueError(f"unknown policy {policy!r}; have {sorted(policies)}")
    return category_map(F.upper(col(c)), policies[policy], default)


# Roof spellings per class, in the three mappings that the queries use.
_ROOF_INDOOR = ("INDOORS", "INDOOR", "DOME", "RETRACTABLE-ROOF-CLOSED", "RETRACTABLE_CLOSED", "CLOSED")
_ROOF_RETRACTABLE = ("RETRACTABLE", "RETRACTABLE-ROOF-OPEN", "RETRACTABLE_OPEN")
_ROOF_OUTDOOR = ("OUTDOORS", "OUTDOOR")
ROOF_POLICIES = {
    "open_is_outdoor": {"INDOOR": _ROOF_INDOOR, "RETRACTABLE": _ROOF_RETRACTABLE,
                        "OUTDOOR": (*_ROOF_OUTDOOR, "OPEN")},
    "open_is_retractable": {"INDOOR": _ROOF_INDOOR, "RETRACTABLE": (*_ROOF_RETRACTABLE, "OPEN"),
                            "OUTDOOR": _ROOF_OUTDOOR},
    "retractable_is_indoor": {"INDOOR": (*_ROOF_INDOOR, *_ROOF_RETRACTABLE, "OPEN"), "OUTDOOR": _ROOF_OUTDOOR},
}
ROOF_INDOOR_FROM_SEASON = 2025


def roof_by_season(roof: ColumnOrName, season: ColumnOrName) -> Column:
    """Roof class by team and week: from 2025 on every retractable roof counts as indoor."""
    return (F.when(col(season) >= ROOF_INDOOR_FROM_SEASON,
                   policy_classify(roof, ROOF_POLICIES, "retractable_is_indoor"))
            .otherwise(policy_classify(roof, ROOF_POLICIES, "open_is_retractable")))


def ilike_any(c: ColumnOrName, patterns: Sequence[str]) -> Column:
    """True when ``c ILIKE p`` for any pattern (NULL text gives False)."""
    x = col(c)
    cond = None
    for p in patterns:
        m = x.ilike(p)
        cond = m if cond is None else cond | m
    return F.coalesce(cond, F.lit(False))


def matches_any(c: ColumnOrName, words: Sequence[str]) -> Column:
    """Upper-cased substring match against any word, as one regex (``rlike 'A|B|C'``)."""
    import re
    pattern = "|".join(re.escape(w.upper()) for w in words)
    return F.coalesce(F.upper(col(c)).rlike(pattern), F.lit(False))


def round_of_week(week: ColumnOrName, last_regular: int = 14,
                  playoff_weeks: Sequence[int] = (15, 16, 17)) -> Column:
    """Tournament round: weeks 1..last_regular -> 1, then each playoff week its own round."""
    w = col(week)
    expr = F.when((w >= 1) & (w <= last_regular), F.lit(1))
    for i, pw in enumerate(playoff_weeks, start=2):
        expr = expr.when(w == pw, F.lit(i))
    return expr
