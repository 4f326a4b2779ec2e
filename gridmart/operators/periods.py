"""Period-over-period comparison (J6) and full-outer reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def next_period(df: DataFrame, key: Sequence[str], period: str, measures: Sequence[str],
                suffix: str = "_next", how: str = "left") -> DataFrame:
    """Join each (key, period) row to the same key's row at ``period + 1``.

    ``df`` must be unique on (key, period): an equi-join on the shifted period, so each
    row meets at most one partner.
    """
    nxt = df.select(*key, (F.col(period) - 1).alias(period),
                    *[F.col(m).alias(m + suffix) for m in measures])
    return df.join(nxt, [*key, period], how)


def full_reconcile(left: DataFrame, right: DataFrame, key: Sequence[str], left_value: str,
                   right_value: str, diff: str = "diff") -> DataFrame:
    """FULL OUTER JOIN on ``key`` (keys coalesced by USING semantics); ``diff`` treats a
    missing side as 0. Keys with NULL parts never match, as in SQL. The largest differences
    come first (T4: by ``ABS(diff)``, then by key; a range sort, split over all tasks)."""
    out = left.join(right, list(key), "full")
    out = out.withColumn(diff, F.coalesce(F.col(left_value), F.lit(0)) - F.coalesce(F.col(right_value), F.lit(0)))
    return out.orderBy(F.abs(diff).desc_nulls_last(), *[F.col(k).asc_nulls_first() for k in key])
