"""One pass over events for measures at several grains (receiver, rusher, drive, team, ...).

An event counts for several parties. Instead of one scan and one aggregate per party, every
event becomes one row per distinct member that it has (a player who is two of its parties is one
row), and one aggregate on (keys, member) sums every role's measures where the member holds
that role. Measures of the group itself are summed on an event's first row; ``group_totals``
adds them up over the group's members, from the same aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.operators.once import pinned


@dataclass(frozen=True)
class Role:
    """``member``: whose measures these are (text, NULL: the event has no such role); ``sums`` /
    ``maxima``: measure -> value per event."""

    member: Column
    sums: Mapping[str, Column] = field(default_factory=dict)
    maxima: Mapping[str, Column] = field(default_factory=dict)


def role_aggregate(events: DataFrame, keys: Sequence[str], roles: Mapping[str, Role],
                   group_sums: Mapping[str, Column], member: str = "member", one: str | None = None) -> DataFrame:
    """One row per (``keys``, ``member``) with its measures (NULL for roles that it never held)
    and its part of ``group_sums``; events without any member land in a NULL member's row.

    Roles without a measure are left out. The aggregate combines on the map side, so a member or
    group with a third of all events costs a row per map task. The result is pinned: members and
    groups may be read apart without a second pass.

    ``one``: a column with the only member that an event can have; an event without any counts for
    it with no measures. Such events are not exploded, and where they lie by that column they are
    grouped without an exchange (and not pinned: a reader computes what it reads).
    """
    roles = {name: r for name, r in roles.items() if r.sums or r.maxima}
    # The members stand beside the event before it is exploded, so each is computed once.
    ids = {name: f"__id_{name}" for name in roles}
    named = events.withColumns({ids[n]: r.member for n, r in roles.items()})
    if one:
        long, first = named.withColumn("__who", F.col(one)), F.lit(True)
    else:
        who = F.array_distinct(F.array_compact(F.array(*[F.col(c) for c in ids.values()])))
        long = named.select("*", F.posexplode_outer(who).alias("__pos", "__who"))
        first = F.coalesce(F.col("__pos") == 0, F.lit(True))
    aggs = []
    for name, r in roles.items():
        mine = F.col("__who") == F.col(ids[name])
        aggs += [F.sum(F.when(mine, v)).alias(m) for m, v in r.sums.items()]
        aggs += [F.max(F.when(mine, v)).alias(m) for m, v in r.maxima.items()]
    aggs += [F.sum(F.when(first, v)).alias(m) for m, v in group_sums.items()]
    out = long.groupBy(*keys, F.col("__who").alias(member)).agg(*aggs)
    return out if one else pinned(out)


def group_totals(rows: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """``group_sums`` of whole groups, from :func:`role_aggregate`'s rows."""
    return rows.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
