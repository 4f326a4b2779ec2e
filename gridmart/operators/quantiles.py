"""Exact medians and quantiles by distributed selection.

``percentile`` keeps a group's distinct values in one buffer of one task. Here equal values are
first counted on the map side; the counted values are range-split, so one group spreads over
many slices; each slice reports its group's weight, prefix sums of these say which slice holds
a wanted position, and only that slice's rows are numbered to pick the value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmart.operators.ranking import _PID, _slices
from gridmart.operators.shares import null_safe_join


def exact_quantiles(df: DataFrame, group: Sequence[str], value: str, quantiles: Mapping[str, float],
                    partitions: int | None = None) -> DataFrame:
    """``group`` and one DOUBLE per name: the continuous quantile of the group's non-null
    ``value`` (linear interpolation between the two middle positions, as ``median``). Groups
    are compared NULL-safely; a group without values has no row. NaN sorts last."""
    x = F.col(value).cast("double")
    counts = (df.select(*group, x.alias("__x")).filter(F.col("__x").isNotNull())
              .groupBy(*group, "__x").agg(F.count(F.lit(1)).alias("__w")))
    sliced = _slices(counts, group, [F.col("__x").asc()], partitions)
    weight = sliced.groupBy(_PID, *group).agg(F.sum("__w").alias("__n"))
    earlier = Window.partitionBy(*group).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    weight = weight.withColumn("__off", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    total = weight.groupBy(*group).agg(F.sum("__n").alias("__total"))
    # Positions 0 .. total - 1: the ones below and above (total - 1) * q.
    spots = F.array(*[F.struct(F.lit(name).alias("q"), F.floor((F.col("__total") - 1) * F.lit(q)).alias("lo"),
                               ((F.col("__total") - 1) * F.lit(q)).alias("at"))
                      for name, q in quantiles.items()])
    wanted = total.select(*group, F.explode(spots).alias("__s")).select(
        *group, "__s.q", "__s.at", F.explode(F.array("__s.lo", F.col("__s.lo") + 1)).alias("pos"))
    wanted = null_safe_join(wanted, weight, group, "inner").filter(
        (F.col("pos") >= F.col("__off")) & (F.col("pos") < F.col("__off") + F.col("__n")))
    targets = wanted.select(_PID, *group, "q", "at", "pos", (F.col("pos") - F.col("__off")).alias("__local"))
    hit = null_safe_join(sliced, targets.select(_PID, *group).distinct(), [_PID, *group], "inner")
    within = Window.partitionBy(_PID, *group).orderBy("__x")
    ranked = hit.withColumn("__to", F.sum("__w").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    found = null_safe_join(ranked, targets, [_PID, *group], "inner").filter(
        (F.col("__local") < F.col("__to")) & (F.col("__local") >= F.col("__to") - F.col("__w")))
    low = F.col("pos") == F.floor("at")
    picked = found.groupBy(*group, "q", "at").agg(F.max(F.when(low, F.col("__x"))).alias("lo"),
                                                  F.max(F.when(~low, F.col("__x"))).alias("hi"))
    part = F.col("at") - F.floor("at")
    answer = F.when(part > 0, F.col("lo") + (F.col("hi") - F.col("lo")) * part).otherwise(F.col("lo"))
    return picked.groupBy(*group).agg(*[F.max(F.when(F.col("q") == name, answer)).alias(name) for name in quantiles])


def with_median(aggregated: DataFrame, df: DataFrame, group: Sequence[str], value: str, name: str) -> DataFrame:
    """``aggregated`` (one row per group) with the exact median of ``df``'s ``value``."""
    return null_safe_join(aggregated, exact_quantiles(df, group, value, {name: 0.5}), group, "left")
