"""Dataset catalog and per-dataset silver rules."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class DatasetSpec:
    """A named table with its partition columns, key, sort order and file row cap."""

    name: str
    partitions: tuple[str, ...]
    key: tuple[str, ...]
    sort_by: tuple[str, ...] = ()
    max_rows_per_file: int = 1_000_000
    enabled: bool = True

    def __post_init__(self) -> None:
        if not self.key:
            raise ValueError(f"dataset {self.name!r} needs a non-empty key")


@dataclass(frozen=True)
class SilverRule:
    """How one dataset is made silver: renames, casts, key and required key columns.

    ``required`` defaults to the key parts among season/week/player_id, else the whole
    key (the reference's rule). ``dedupe`` is ``latest`` (newest ``ingested_at`` wins)
    or ``most_complete`` (row with most non-null columns wins).
    """

    renames: dict[str, str] = field(default_factory=dict)
    casts: dict[str, str] = field(default_factory=dict)
    required: tuple[str, ...] | None = None
    dedupe: str = "latest"


# The reference catalog (partitions, keys, sort order, file row caps).
CATALOG: dict[str, DatasetSpec] = {s.name: s for s in [
    DatasetSpec("pbp", ("year",), ("game_id", "play_id"), ("year", "game_id", "play_id"), 5_000_000),
    DatasetSpec("schedules", ("season",), ("game_id",), ("season", "game_id"), 1_000_000),
    DatasetSpec("weekly", ("season",), ("season", "week", "player_id", "team"),
                ("season", "week", "player_id", "team"), 2_000_000),
    DatasetSpec("rosters", ("season",), ("season", "week", "player_id", "team"),
                ("season", "week", "player_id", "team"), 1_000_000),
    DatasetSpec("rosters_seasonal", ("season",), ("season", "player_id"), ("season", "player_id"), 1_000_000),
    DatasetSpec("injuries", ("season",), ("season", "week", "team", "player_id"),
                ("season", "week", "team", "player_id"), 1_000_000),
    DatasetSpec("depth_charts", ("season",), ("season", "week", "team", "position", "player_id"),
                ("season", "week", "team", "position", "player_id"), 1_000_000),
    DatasetSpec("snap_counts", ("season",), ("season", "week", "team", "player_id"),
                ("season", "week", "team", "player_id"), 1_000_000),
    DatasetSpec("officials", ("season",), ("game_id", "official_id"), enabled=False),
    DatasetSpec("win_totals", ("season",), ("season", "team"), enabled=False),
    DatasetSpec("scoring_lines", ("season",), ("season", "game_id"), enabled=False),
    DatasetSpec("draft_picks", ("season",), ("season", "overall", "team"), enabled=False),
    DatasetSpec("combine", ("season",), ("season", "player_id"), enabled=False),
    DatasetSpec("dk_bestball", ("section",), ("section", "id")),
    DatasetSpec("ngs_weekly", ("season", "stat_type"), ("season", "week", "player_id", "stat_type")),
    DatasetSpec("pfr_weekly", ("season", "stat_type"), ("season", "week", "player_id", "stat_type"), enabled=False),
    DatasetSpec("pfr_seasonal", ("season", "stat_type"), ("season", "player_id", "stat_type"), enabled=False),
    DatasetSpec("ids", (), ("gsis_id", "pfr_id")),
    DatasetSpec("players", (), ("gsis_id",)),
]}

# Per-dataset silver rules, keyed by catalog name.
SILVER_RULES: dict[str, SilverRule] = {
    "weekly": SilverRule(renames={"recent_team": "team"}),
    "rosters": SilverRule(renames={"recent_team": "team"}),
    "injuries": SilverRule(renames={"gsis_id": "player_id"}, casts={"week": "bigint"}),
    "depth_charts": SilverRule(renames={"gsis_id": "player_id"}),
    "snap_counts": SilverRule(renames={"gsis_id": "player_id"}),
    "ngs_weekly": SilverRule(casts={"player_id": "string"}),
    "pfr_weekly": SilverRule(casts={"player_id": "string"}),
    "pfr_seasonal": SilverRule(casts={"player_id": "string"}),
    "rosters_seasonal": SilverRule(casts={"player_id": "string", "full_name": "string",
                                          "first_name": "string", "last_name": "string"}),
    "ids": SilverRule(dedupe="most_complete"),
}


def rule_for(name: str) -> SilverRule:
    """Rule for a dataset; datasets without an entry get the default (dedupe on key)."""
    return SILVER_RULES.get(name, SilverRule())


def required_keys(spec: DatasetSpec, rule: SilverRule, columns: list[str]) -> list[str]:
    if rule.required is not None:
        return [c for c in rule.required if c in columns]
    key = [c for c in spec.key if c in columns]
    return [c for c in key if c in ("season", "week", "player_id")] or key
