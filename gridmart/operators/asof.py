"""As-of join: nearest right row per left row within a tolerance (J8), in linear work.

Both sides become one stream per (``by``, time slice), sorted by time: a running "last right
row so far" gives the candidate before each left row, the same in descending order the one
after it. No left row is ever paired with more than those two, so a dense slice costs its
rows, not their product.

A slice is ``tolerance / slices`` wide, so a key's rows spread over many tasks, and a match lies
at most ``slices`` slices away. The last and first right row of every slice (one grouped row
each) are carried into that many following and preceding slices, where they stand for all the
rows behind them. Right rows at one time are first reduced to the smallest (by their columns'
order), so ties do not depend on input order; this aggregate is computed once for the stream
and for the carried rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmart.operators.once import pinned


def _micros(c: str) -> F.Column:
    return F.unix_micros(F.col(f"`{c}`").cast("timestamp"))


def asof_nearest(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str,
                 tolerance_seconds: float, direction: str = "nearest", slices: int = 4) -> DataFrame:
    """Attach to every ``left`` row the columns of the nearest ``right`` row with the same
    ``by`` values and ``|right_time - left_time| <= tolerance``.

    * ``direction``: ``nearest`` (at equal distance the earlier right row, like pandas),
      ``backward`` (right_time <= left_time) or ``forward`` (right_time >= left_time).
    * Of right rows at one time the one with the smallest columns is taken.
    * Left rows without a candidate, with a NULL key or a NULL time are kept with NULL right
      columns; repeated left rows are matched one by one.
    * Right columns other than ``by`` must not clash with left column names.
    """
    if direction not in ("nearest", "backward", "forward"):
        raise ValueError(f"bad direction {direction!r}")
    tolerance = int(tolerance_seconds * 1_000_000)
    if tolerance <= 0:
        raise ValueError("tolerance must be positive")
    width = -(-tolerance // slices)
    keys = [f"__k{i}" for i in range(len(by))]
    names = [c for c in right.columns if c not in by]

    def keyed(df: DataFrame, time: str, *more: F.Column) -> DataFrame:
        return df.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(by, keys, strict=True)],
                         _micros(time).alias("__t"), *more)

    known = F.col("__t").isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    points = keyed(right, right_time, F.struct(*[F.col(f"`{c}`") for c in names]).alias("__r")).filter(known)
    points = pinned(points.groupBy(*keys, "__t").agg(F.min("__r").alias("__r")))
    slice_no = F.floor(F.col("__t") / width)
    seen = F.struct(F.col("__t").alias("t"), F.col("__r").alias("r")).alias("__seen")
    own = points.select(*keys, slice_no.alias("__slice"), "__t", seen)
    edges = points.groupBy(*keys, slice_no.alias("__slice")).agg(
        F.max(F.struct("__t", "__r")).alias("last"), F.min(F.struct("__t", "__r")).alias("first"))
    away = F.array(*[F.lit(k) for k in range(-slices, slices + 1) if k])
    edge = F.when(F.col("__away") > 0, F.col("last")).otherwise(F.col("first"))
    carried = edges.withColumn("__away", F.explode(away)).select(
        *keys, (F.col("__slice") + F.col("__away")).alias("__slice"), edge["__t"].alias("__t"),
        F.struct(edge["__t"].alias("t"), edge["__r"].alias("r")).alias("__seen"))
    rows = keyed(left, left_time, F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("__l")).select(
        *keys, F.when(known, slice_no).alias("__slice"), "__t", "__l")
    stream = rows.unionByName(own.unionByName(carried), allowMissingColumns=True)

    group = Window.partitionBy(*keys, "__slice")
    so_far = (Window.unboundedPreceding, Window.currentRow)
    # At one time the right row comes first in either direction, so both candidates include it.
    right_first = F.col("__seen").isNull()
    before = F.last("__seen", ignorenulls=True).over(
        group.orderBy(F.col("__t"), right_first).rowsBetween(*so_far))
    after = F.last("__seen", ignorenulls=True).over(
        group.orderBy(F.col("__t").desc(), right_first).rowsBetween(*so_far))
    found = stream.withColumn("__before", before).withColumn("__after", after).filter(F.col("__l").isNotNull())

    back, ahead = F.col("__t") - F.col("__before.t"), F.col("__after.t") - F.col("__t")
    # ``back`` and ``ahead`` are NULL without a candidate, and so is a test on them.
    back_ok, ahead_ok = (F.coalesce(known & (gap <= tolerance), F.lit(False)) for gap in (back, ahead))
    pick = {"backward": F.when(back_ok, F.col("__before.r")), "forward": F.when(ahead_ok, F.col("__after.r")),
            "nearest": F.when(back_ok & (~ahead_ok | (back <= ahead)), F.col("__before.r"))
            .when(ahead_ok, F.col("__after.r"))}[direction]
    return found.select("__l.*", pick.alias("__r")).select(
        *[F.col(f"`{c}`") for c in left.columns], *[F.col("__r").getField(c).alias(c) for c in names])
