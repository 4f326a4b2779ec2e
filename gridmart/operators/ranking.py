"""Ranks and previous values inside groups that may be huge.

``row_number() OVER (PARTITION BY g ORDER BY o)`` puts every row of a group into one
task. When one group may hold a third of the data that task is the whole job, so the
functions here also offer ``method="range"``:

1. ``repartitionByRange`` on ``(g, o)`` splits even a single group over many tasks,
   each holding a contiguous slice of the group's order;
2. each slice numbers its rows locally (window over ``(slice, g)``, bounded by slice size);
3. per-(slice, g) row counts are prefix-summed over slices in order (a table with one
   row per slice and group) and added as offsets.

The same split gives a skew-safe ``lag``: a slice's first row takes the last row of the
previous slice of the same group. The tagged slices are checkpointed once so every
branch of the plan sees the same slice numbers (see ``_slices``). ``order`` must be a total order inside a group (end it
with unique columns) so the result does not depend on input order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmart.operators.shares import null_safe_join, with_group_totals

_PID = "__slice"


def _slices(df: DataFrame, group: Sequence[str], order: Sequence[Column],
            partitions: int | None) -> DataFrame:
    """Range-partition and tag each row with its slice number, materialised once.

    The slice number comes from ``spark_partition_id()`` after a range shuffle whose
    bounds are sampled at run time. Two plan branches (local numbering and the per-slice
    summary) would otherwise each run their own range shuffle and may sample different
    bounds, so the tagged rows are checkpointed (reliably, under the shared
    ``spark.checkpoint.dir``) and both branches read the same slices; a lost executor
    re-reads the checkpoint instead of re-sampling.
    """
    from gridmart.session import checkpoint_dir

    checkpoint_dir(df.sparkSession)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (df.repartitionByRange(n, *[F.col(g).asc_nulls_first() for g in group], *order)
            .withColumn(_PID, F.spark_partition_id())
            .checkpoint(eager=True))


def row_number_in_groups(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                         name: str = "rank", method: str = "window",
                         partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based position of the row inside its group under ``order``."""
    if method == "window":
        w = Window.partitionBy(*group).orderBy(*order)
        return df.withColumn(name, F.row_number().over(w))
    if method != "range":
        raise ValueError(f"bad method {method!r}")
    sliced = _slices(df, group, order, partitions)
    local = sliced.withColumn("__local", F.row_number().over(
        Window.partitionBy(_PID, *group).orderBy(*order)))
    counts = local.groupBy(_PID, *group).agg(F.max("__local").alias("__n"))
    w = (Window.partitionBy(*group).orderBy(_PID)
         .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(w), F.lit(0))).drop("__n")
    out = null_safe_join(local, offsets, [_PID, *group], "inner")
    return out.withColumn(name, (F.col("__local") + F.col("__off")).cast("int")).drop(_PID, "__local", "__off")


def group_sizes(df: DataFrame, group: Sequence[str], name: str = "group_n") -> DataFrame:
    """``COUNT(*) OVER (PARTITION BY group)`` as a partial aggregate joined back."""
    return with_group_totals(df, group, {name: F.count(F.lit(1))})


def previous_in_groups(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                       value: str, name: str, method: str = "window",
                       partitions: int | None = None) -> DataFrame:
    """Add ``name`` = ``LAG(value)`` inside the group under ``order``."""
    if method == "window":
        w = Window.partitionBy(*group).orderBy(*order)
        return df.withColumn(name, F.lag(value).over(w))
    if method != "range":
        raise ValueError(f"bad method {method!r}")
    sliced = _slices(df, group, order, partitions)
    wl = Window.partitionBy(_PID, *group).orderBy(*order)
    local = (sliced.withColumn("__lag", F.lag(value).over(wl))
             .withColumn("__pos", F.row_number().over(wl)))
    # last value of each slice of a group, then the previous slice's last value
    last = local.withColumn("__last_pos", F.max("__pos").over(Window.partitionBy(_PID, *group))) \
        .filter(F.col("__pos") == F.col("__last_pos")).select(_PID, *group, F.col(value).alias("__last"))
    prev = last.withColumn("__prevslice", F.lag("__last").over(Window.partitionBy(*group).orderBy(_PID))) \
        .select(_PID, *group, "__prevslice")
    out = null_safe_join(local, prev, [_PID, *group], "left")
    filled = F.when(F.col("__pos") == 1, F.col("__prevslice")).otherwise(F.col("__lag"))
    return out.withColumn(name, filled).drop(_PID, "__lag", "__pos", "__prevslice")


def previous_by_day(df: DataFrame, group: Sequence[str], day: str, order: Sequence[Column], value: str,
                    name: str) -> DataFrame:
    """Add ``name`` = ``LAG(value)`` inside the group under (``day`` NULLS FIRST, ``order``), with one
    shuffle by group and day and nothing written: the rows of a day see each other, and a day's
    first row takes the last value of the group's day before from the small table of days."""
    days = [*group, day]
    within = Window.partitionBy(*days).orderBy(*order)
    local = df.withColumns({"__lag": F.lag(value).over(within), "__pos": F.row_number().over(within),
                            "__next": F.lead(F.lit(1)).over(within)})
    last = local.filter(F.col("__next").isNull()).select(*days, F.col(value).alias("__last"))
    prev = last.withColumn("__before", F.lag("__last").over(
        Window.partitionBy(*group).orderBy(F.col(day).asc_nulls_first()))).drop("__last")
    first = null_safe_join(local.filter(F.col("__pos") == 1), prev, days, "left").withColumn("__lag", F.col("__before"))
    out = local.filter(F.col("__pos") > 1).unionByName(first.drop("__before"))
    return out.withColumnRenamed("__lag", name).drop("__pos", "__next")


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """Global top-N (``ORDER BY ... LIMIT n``): planned as ``TakeOrderedAndProject``, each
    task keeps its own top n and the driver merges n x tasks rows. Add a unique key to
    ``order`` so ties are stable."""
    return df.orderBy(*order).limit(n)


def top_n_per_group(df: DataFrame, group: Sequence[str], n: int, order: Sequence[Column],
                    name: str = "rank") -> DataFrame:
    """Top-N inside each group. ``row_number() <= n`` is limited per group on the map side
    (partial ``WindowGroupLimit``), so a hot group ships at most n rows per map task."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
