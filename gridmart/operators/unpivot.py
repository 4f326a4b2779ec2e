"""Wide-to-long reshapes done in one pass.

``UNION ALL`` of the home side and the away side scans the source twice; one
``explode(array(struct(...)))`` (or ``stack`` via ``unpivot``) does it in one scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sides_to_long(df: DataFrame, keep: Sequence[str],
                  sides: Mapping[str, Mapping[str, Column | str]]) -> DataFrame:
    """Emit one row per side. ``sides`` maps a side label to {output column: expression}.

    Every side must produce the same output column names. The side label lands in ``side``.
    """
    structs = []
    names: list[str] | None = None
    for label, cols in sides.items():
        if names is None:
            names = list(cols)
        elif list(cols) != names:
            raise ValueError("every side must produce the same columns in the same order")
        fields = [F.lit(label).alias("side")]
        fields += [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in cols.items()]
        structs.append(F.struct(*fields))
    return (df.select(*keep, F.explode(F.array(*structs)).alias("__s"))
            .select(*keep, "__s.*"))


def flags_to_long(df: DataFrame, keep: Sequence[str], flags: Sequence[str],
                  name: str = "event") -> DataFrame:
    """Long form of 0/1 flag columns, keeping only the rows whose flag is set."""
    long = df.unpivot(list(keep), list(flags), name, "__flag")
    return long.filter(F.col("__flag") == 1).drop("__flag")
