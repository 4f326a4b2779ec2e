"""Complete grids with zero fill.

The reference builds ``games CROSS JOIN positions`` and left-joins the facts. Here the
bounded dimension is a literal list expanded with ``explode`` (a per-row generator, no
cross-join operator), optionally restricted to the values that actually occur by a
semi-join against a bounded distinct set, then the facts are left-joined on the full key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def expand(spine: DataFrame, name: str, values: Sequence, present: DataFrame | None = None) -> DataFrame:
    """Repeat each spine row once per value of a bounded dimension ``values``.

    ``present`` (one column ``name``) limits the expansion to values seen in the data,
    as ``CROSS JOIN (SELECT DISTINCT dim FROM facts)`` does. It holds at most
    ``len(values)`` rows, so broadcasting it is size-safe.
    """
    out = spine.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    if present is not None:
        out = out.join(F.broadcast(present.select(name).distinct()), name, "left_semi")
    return out


def grid_fill(spine: DataFrame, facts: DataFrame, on: Sequence[str],
              fill: Mapping[str, object]) -> DataFrame:
    """Left-join ``facts`` to the grid ``spine`` on ``on`` and fill missing measures."""
    return spine.join(facts, list(on), "left").fillna(dict(fill))
