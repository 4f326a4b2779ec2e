"""One row per key (A18, W1, M10) and most-frequent value per key.

All of these are ``row_number() = 1`` filters over a window partitioned by the key.
Spark (>= 3.5) plans such a filter with a *partial* ``WindowGroupLimit`` before the
shuffle, so every map task already keeps one row per key: a key holding a third of
the data reaches the final window as one row per map task, not as a third of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmart.functions.columns import count_not_null

_RN = "__rn"


def whole_row(df: DataFrame) -> Column:
    """A hash of all columns: the last sort key that makes an order total (rows it cannot
    tell apart are equal)."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each ``key`` group under ``order``.

    ``order`` must be a total order inside a key (end it with unique columns), otherwise
    the kept row depends on input order (SURVEY H2).
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def dedupe_first(df: DataFrame, key: Sequence[str], by: str,
                 tiebreak: Sequence[str] = ()) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY key ORDER BY by NULLS LAST, tiebreak) = 1``."""
    return first_per_key(df, key, [F.col(by).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tiebreak],
                                   whole_row(df)])


def dedupe_latest(df: DataFrame, key: Sequence[str], ts: str = "ingested_at",
                  tiebreak: Sequence[str] = ()) -> DataFrame:
    """Newest ``ts`` wins (NULL timestamps lose); ties broken by ``tiebreak`` descending."""
    return first_per_key(df, key, [F.col(ts).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in tiebreak],
                                   whole_row(df)])


def dedupe_most_complete(df: DataFrame, key: Sequence[str], value_cols: Sequence[str],
                         tiebreak: Sequence[str] = ()) -> DataFrame:
    """The row with the most non-null ``value_cols`` wins (ids table policy)."""
    filled = count_not_null(*value_cols)
    return first_per_key(df, key, [filled.desc(), *[F.col(c).asc_nulls_last() for c in tiebreak], whole_row(df)])


def mode_per_key(df: DataFrame, key: Sequence[str], value: str,
                 count_name: str = "n") -> DataFrame:
    """Most frequent non-null ``value`` per key; ties go to the smallest value.

    Counting is a partial (map-side combined) aggregate; the pick is a top-1 window.
    """
    counts = (df.filter(F.col(value).isNotNull())
              .groupBy(*key, value).agg(F.count(F.lit(1)).alias(count_name)))
    return first_per_key(counts, key, [F.col(count_name).desc(), F.col(value).asc()])
