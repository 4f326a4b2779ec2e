"""Group totals attached to rows and shares of a total.

Totals are computed with a grouped aggregate (map-side partial sums, so a hot group
costs one partial row per map task) and joined back on the group key. That join is a
key-unique dimension: AQE broadcasts it when small and splits skewed partitions of the
big side when not. A ``sum() OVER (PARTITION BY g)`` window would instead sort the whole
of a hot group inside one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmart.functions.columns import share


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (``IS NOT DISTINCT FROM``)."""
    if not keys:
        raise ValueError("null_safe_join needs at least one key")
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__r_{k}")
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"__r_{k}"])
        cond = c if cond is None else cond & c
    out = left.join(renamed, cond, how)
    return out.drop(*[f"__r_{k}" for k in keys])


def with_group_totals(df: DataFrame, group: Sequence[str],
                      totals: Mapping[str, Column]) -> DataFrame:
    """Attach one aggregate per name in ``totals`` computed over ``group`` to every row."""
    agg = df.groupBy(*group).agg(*[expr.alias(name) for name, expr in totals.items()])
    if not group:
        # A global aggregate is exactly one row of a few numbers: compute it first and
        # attach it as literals (no join, so no cross product in the plan).
        row = agg.first()
        types = {f.name: f.dataType for f in agg.schema.fields}
        return df.withColumns({n: F.lit(row[n]).cast(types[n]) for n in totals})
    return null_safe_join(df, agg, group, "left")


def share_of_total(df: DataFrame, group: Sequence[str], value: str,
                   total_name: str, share_name: str) -> DataFrame:
    """``value / SUM(value) OVER (PARTITION BY group)`` computed as aggregate + join."""
    out = with_group_totals(df, group, {total_name: F.sum(value)})
    return out.withColumn(share_name, share(value, total_name))
