"""Rule-driven scoring (F7): points computed from a ``rules`` table instead of code.

Two plans for the same result:

* :func:`score_with_rules` compiles the rows of the rules document into one column
  expression. Scoring is then a projection: no unpivot, no join, no shuffle of the stats.
* :func:`score_by_rules` keeps the rules as data: stats are unpivoted to
  ``(key, metric, value)``, joined to the broadcast rules and summed per key. It suits
  rule sets that change per row group (e.g. per contest) and is the cross-check of the
  compiled form.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from types import SimpleNamespace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.sources.rules import band, rules_rows


def score_by_rules(stats: DataFrame, key: Sequence[str], rules: DataFrame,
                   metrics: Sequence[str], name: str = "points") -> DataFrame:
    """Sum of rule contributions per ``key``. ``metrics`` are the stat columns the rules
    reference (known from the document, so the unpivot is planned statically)."""
    long = stats.select(*key, *[F.col(m).cast("double").alias(m) for m in metrics]) \
        .unpivot(list(key), list(metrics), "metric", "value")
    r = F.broadcast(rules.filter(F.col("section") == "scoring").filter(F.col("metric").isNotNull())
                    .select("metric", "points", "per_yard", "threshold", "bonus_points"))
    v = F.coalesce(F.col("value"), F.lit(0.0))
    rate = F.coalesce(F.col("per_yard"), F.col("points"), F.lit(0.0))
    linear = F.when(F.col("bonus_points").isNull(), v * rate).otherwise(F.lit(0.0))
    bonus = F.when(F.col("bonus_points").isNotNull() & (v >= F.col("threshold")), F.col("bonus_points")) \
        .otherwise(F.lit(0.0))
    return long.join(r, "metric").groupBy(*key).agg(F.sum(linear + bonus).alias(name))


def score_with_rules(stats: DataFrame, rules: Sequence[tuple], name: str = "points") -> DataFrame:
    """Add ``name`` = sum over scoring rules of ``value * rate`` plus threshold bonuses,
    compiled from the document's rows (``sources.rules.rules_rows``) into one expression."""
    rows = [SimpleNamespace(metric=r[2], points=r[3], per_yard=r[4], threshold=r[5], bonus_points=r[6])
            for r in rules if r[0] == "scoring" and r[2] is not None]
    expr = F.lit(0.0)
    for r in sorted(rows, key=lambda r: (r.metric, r.threshold is None, r.threshold or 0.0)):
        v = F.coalesce(F.col(r.metric).cast("double"), F.lit(0.0))
        if r.bonus_points is not None:
            expr = expr + F.when(v >= F.lit(r.threshold), F.lit(r.bonus_points)).otherwise(F.lit(0.0))
        else:
            rate = r.per_yard if r.per_yard is not None else (r.points or 0.0)
            expr = expr + v * F.lit(rate)
    return stats.withColumn(name, expr)


def step_points(value: F.Column, bands: Mapping[str, float]) -> F.Column:
    """Points of the band that ``value`` falls into (``0``, ``1-6``, ..., ``35+``), 0 for NULL."""
    expr = None
    for label, points in bands.items():
        low, high = band(label)
        cond = F.lit(True)
        if low is not None:
            cond = cond & (value >= low)
        if high is not None:
            cond = cond & (value <= high)
        expr = F.when(cond, F.lit(float(points))) if expr is None else expr.when(cond, F.lit(float(points)))
    return F.coalesce(expr, F.lit(0.0))


def section_points(section: Mapping[str, object], prefix: str) -> F.Column:
    """A document section compiled into one expression over ``<prefix>_<item>`` columns: numbers
    are points per unit, nested maps are step functions."""
    total = F.lit(0.0)
    for item, rule in section.items():
        value = F.col(f"{prefix}_{item}").cast("double")
        total = total + (step_points(value, rule) if isinstance(rule, Mapping)
                         else F.coalesce(value, F.lit(0.0)) * F.lit(float(rule)))
    return total


def contest_points(stats: DataFrame, key: Sequence[str], document: Mapping, contest: str) -> DataFrame:
    """``key``, contest, slot and points of every stat line whose position the contest scores:
    kickers and defenses by their sections, others by the offense rules. With a captain
    multiplier a line has one row per slot (``CPT``, ``FLEX``). A projection; no rules join."""
    scoring, lineup = document["scoring"], document["lineup"]
    own = {"K": "kicker", "DST": "dst"}
    offense = {k: v for k, v in scoring.items() if k not in own.values()}
    out = score_with_rules(stats, rules_rows(offense, {}, {}), "__offense")
    points = F.col("__offense")
    for position, section in own.items():
        if section in scoring:
            points = F.when(F.col("position") == position, section_points(scoring[section], section)).otherwise(points)
        else:
            out = out.filter(F.coalesce(F.col("position") != position, F.lit(True)))
    captain = lineup.get("captain_multiplier")
    slots = [("CPT", float(captain["points"])), ("FLEX", 1.0)] if captain else [(None, 1.0)]
    each = F.explode(F.array(*[F.struct(F.lit(s).cast("string").alias("slot"), F.lit(f).alias("factor")) for s, f in slots]))
    return out.select(*key, F.lit(contest).alias("contest"), points.alias("__p"), each.alias("__s")).select(
        *key, "contest", "__s.slot", (F.col("__p") * F.col("__s.factor")).alias("points"))
