"""Override join with provenance (J14): attributes of a base table that a second table corrects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def override_join(base: DataFrame, better: DataFrame, keys: Sequence[str], attributes: Mapping[str, tuple[Column, str]],
                  base_name: str = "base", better_name: str = "override") -> DataFrame:
    """Every row of ``base`` with ``attribute`` (name -> (aggregate over ``better``, base column))
    and ``<attribute>_source``, the table it comes from.

    ``better`` is reduced to one row per key on the map side, so the join never multiplies base
    rows and a key with a third of its rows costs one row per map task. A non-NULL aggregate
    wins; else the base column, whose source is NULL where it is NULL too. Rows with a NULL key
    keep their own value.
    """
    best = better.groupBy(*keys).agg(*[agg.alias(f"__{name}") for name, (agg, _) in attributes.items()])
    out = base.join(best, list(keys), "left")
    new = {}
    for name, (_, own) in attributes.items():
        win = F.col(f"__{name}")
        new[name] = F.coalesce(win, F.col(own))
        new[f"{name}_source"] = F.when(win.isNotNull(), F.lit(better_name)).when(F.col(own).isNotNull(), F.lit(base_name))
    return out.withColumns(new).drop(*[f"__{name}" for name in attributes])
