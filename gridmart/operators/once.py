"""One computation, several readers, in one lazy plan.

Spark computes a DataFrame that two branches of a plan read once only if both branches plan
the same exchange; as soon as they need different columns, or filter on a grouping key, their
plans differ below it and everything is scanned again. ``pinned`` keeps every column of a
grouped result in every branch, so each of them plans the same aggregate and all but the
first reuse its exchange. Nothing is cached or written, no job runs while the plan is built,
the result may be read any number of times, and a lost executor costs its tasks only.

Use ``pinned`` on aggregates, which are small against their input; filter readers on aggregated
columns, not on grouping keys (such filters would move below the exchange).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.operators.shares import null_safe_join

_LEAST = -(1 << 63)


def pinned(df: DataFrame) -> DataFrame:
    """``df`` with a condition on all its columns that every row satisfies and that the
    optimizer cannot decide, so no column is pruned below it."""
    return df.filter(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) >= F.lit(_LEAST))


def held(df: DataFrame) -> DataFrame:
    """``df`` with a condition on all its columns that every row satisfies and that may not be moved:
    no column is pruned and no reader's filter gets below it. On rows that were dealt over partitions
    every reader plans the same exchange, whatever it filters or joins, and prunes above it."""
    every = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]) >= F.lit(_LEAST)
    return df.filter(every | (F.spark_partition_id() < 0))


def left_join_pinned(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``left.join(right, keys, "left")`` (NULL keys match nothing), written so that the optimizer
    infers no ``IS NOT NULL`` filter that would move below the exchange of a pinned ``right``."""
    there = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(there[f"__r_{k}"]) & left[k].isNotNull()
    return left.join(there, cond, "left").drop(*[f"__r_{k}" for k in keys])


def with_rollup(df: DataFrame, group: Sequence[str], totals: Mapping[str, Column]) -> DataFrame:
    """Attach the aggregates ``totals`` over ``group`` to every row of the grouped result
    ``df``, which is computed once (NULL group values match each other)."""
    rows = pinned(df)
    return null_safe_join(rows, rows.groupBy(*group).agg(*[c.alias(n) for n, c in totals.items()]), group, "left")
