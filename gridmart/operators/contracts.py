"""Declared type contracts checked per partition.

One pass counts, for every partition, the rows and each violation; partitions that fail are
left out whole and recorded with zero rows, so nothing disappears without a trace.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.operators.shares import null_safe_join


@dataclass(frozen=True)
class ColumnRule:
    """``type``: values must cast to it; ``nullable``; ``least``: smallest value; ``required``: the
    column must be there."""

    type: str
    nullable: bool = True
    least: float | None = None
    required: bool = True


@dataclass(frozen=True)
class Contract:
    columns: Mapping[str, ColumnRule] = field(default_factory=dict)


_KEYED = {"rosters": ("season", "week", "player_id", "team"), "injuries": ("season", "week", "team", "player_id"),
          "depth_charts": ("season", "week", "team", "position", "player_id"),
          "snap_counts": ("season", "week", "team", "player_id"), "dk_bestball": ("section", "id"),
          "ngs_weekly": ("season", "week", "stat_type"), "pfr_weekly": ("season", "week", "stat_type"),
          "pfr_seasonal": ("season", "stat_type"), "rosters_seasonal": ("season", "player_id")}

# The declared silver contracts; the other datasets only name columns that must exist.
SILVER_CONTRACTS: dict[str, Contract] = {
    "pbp": Contract({"game_id": ColumnRule("string", nullable=False), "play_id": ColumnRule("bigint", False, 1),
                     "year": ColumnRule("bigint", nullable=False)}),
    "schedules": Contract({"game_id": ColumnRule("string", nullable=False)}),
    "weekly": Contract({"season": ColumnRule("bigint", nullable=False), "week": ColumnRule("bigint", nullable=False),
                        "player_id": ColumnRule("string", nullable=False), "team": ColumnRule("string")}),
    **{name: Contract({c: ColumnRule("any") for c in columns}) for name, columns in _KEYED.items()},
}
# Bronze contracts, where every column may be NULL and only the types count.
BRONZE_CONTRACTS: dict[str, Contract] = {
    "pbp": Contract({"game_id": ColumnRule("string"), "play_id": ColumnRule("bigint"), "year": ColumnRule("bigint")}),
    "schedules": Contract({"game_id": ColumnRule("string")}),
    "weekly": Contract({"season": ColumnRule("bigint"), "week": ColumnRule("bigint"), "player_id": ColumnRule("string")}),
}


def contract_rules(df: DataFrame, contract: Contract) -> dict[str, Column]:
    """Rule name -> condition that a row must satisfy; a missing required column fails every row."""
    rules: dict[str, Column] = {}
    there = set(df.columns)
    for name, rule in contract.columns.items():
        if name not in there:
            if rule.required:
                rules[f"{name}_present"] = F.lit(False)
            continue
        value = F.col(f"`{name}`")
        if rule.type != "any":
            cast = value.try_cast(rule.type)
            if rule.type == "bigint":  # a fraction is not an integer
                cast = F.when(value.try_cast("double") == F.floor(value.try_cast("double")), value.try_cast("double").try_cast("bigint"))
            rules[f"{name}_{rule.type}"] = value.isNull() | cast.isNotNull()
        if not rule.nullable:
            rules[f"{name}_not_null"] = value.isNotNull()
        if rule.least is not None:
            rules[f"{name}_ge_{rule.least:g}"] = F.coalesce(value.try_cast("double") >= rule.least, F.lit(False))
    return rules


def check_partitions(df: DataFrame, rules: Mapping[str, Column], partitions: Sequence[str]) -> DataFrame:
    """One row per partition: ``row_count``, ``violations`` (rows failing any rule) and a map of the
    failing rules with their counts; one aggregate for all partitions and rules."""
    bad = {name: ~F.coalesce(cond, F.lit(False)) for name, cond in rules.items()}
    any_bad = F.lit(False)
    for cond in bad.values():
        any_bad = any_bad | cond
    counts = F.map_from_arrays(F.array(*[F.lit(n) for n in bad]),
                               F.array(*[F.count_if(c) for c in bad.values()])) if bad else F.create_map()
    return df.groupBy(*partitions).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(any_bad).alias("violations"),
        counts.cast("map<string,bigint>").alias("__c")).select(
        *partitions, "row_count", "violations", F.map_filter("__c", lambda _, n: n > 0).alias("failed"))


def passing_partitions(df: DataFrame, report: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """The rows of partitions without a violation (NULL partition values are values here)."""
    ok = report.filter("violations = 0").select(*partitions)
    return null_safe_join(df, ok, partitions, "left_semi") if partitions else df


def recorded(report: DataFrame) -> DataFrame:
    """``report`` for the log: failing partitions with zero rows kept, ``status`` ok or skipped."""
    fails = F.col("violations") > 0
    return report.withColumns({"status": F.when(fails, "skipped").otherwise("ok"),
                               "rows_seen": F.col("row_count"),
                               "row_count": F.when(fails, F.lit(0).cast("bigint")).otherwise(F.col("row_count"))})
