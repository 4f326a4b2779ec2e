"""Data-quality operators: key fingerprints (A19), partition stats (M13), profiles (M15),
rule validation (M11). Each is one grouped aggregate over all partitions at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_string(key: Sequence[str]) -> Column:
    """``k1|k2|...`` with NULL parts as empty text (a NULL key still hashes)."""
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])


def key_hash32(key: Sequence[str]) -> Column:
    """First 8 hex digits of ``md5(k1|k2|...)`` as a non-negative BIGINT."""
    return F.conv(F.substring(F.md5(key_string(key)), 1, 8), 16, 10).cast("bigint")


def key_fingerprint(df: DataFrame, key: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Order-independent fingerprint per group: row count and the sum of 32-bit key hashes.

    Replaces a sha256 over rows in file order (SURVEY Q18): the sum is a partial
    aggregate, so it is the same for any partitioning or row order, and it is cheap to
    recompute in any engine that has md5.
    """
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias("row_count"),
                                  F.sum(key_hash32(key)).alias("fingerprint"))


def partition_stats(df: DataFrame, partitions: Sequence[str], key: Sequence[str],
                    ts: str | None = "ingested_at") -> DataFrame:
    """Row count, fingerprint and min/max ingest time for every partition in one pass."""
    aggs = [F.count(F.lit(1)).alias("row_count"), F.sum(key_hash32(key)).alias("fingerprint")]
    if ts and ts in df.columns:
        aggs += [F.min(ts).alias("min_ingested_at"), F.max(ts).alias("max_ingested_at")]
    return df.groupBy(*partitions).agg(*aggs)


def profile(df: DataFrame, key: Sequence[str], partitions: Sequence[str] = (),
            range_cols: Sequence[str] = ("season", "year", "week")) -> DataFrame:
    """Per partition: rows, columns, key-null rows, unique and duplicate key rows, ratio,
    min/max of season/year/week. A NULL composite key counts as one value (as in the
    reference's tests). Everything is one two-level aggregate (count and ends per key, then
    sums), so the rows are read once and it distributes; no key set is collected."""
    present = [c for c in range_cols if c in df.columns and c not in partitions]
    ends = [(f, c, f"{n}_{c}") for c in present for f, n in ((F.min, "min"), (F.max, "max"))]
    per_key = df.groupBy(*partitions, *key).agg(
        F.count(F.lit(1)).alias("__c"), *[f(c).alias(f"__{name}") for f, c, name in ends])
    any_null = F.lit(False)
    for k in key:
        any_null = any_null | F.col(k).isNull()
    for p in partitions:  # rows without a partition belong to none
        per_key = per_key.filter(F.col(p).isNotNull())
    out = per_key.groupBy(*partitions).agg(
        F.coalesce(F.sum("__c"), F.lit(0)).alias("rows"), *[f(f"__{name}").alias(name) for f, _, name in ends],
        F.count(F.lit(1)).alias("key_unique_rows"),
        F.sum(F.col("__c") - 1).alias("key_duplicate_rows"),
        F.sum(F.when(any_null, F.col("__c")).otherwise(0)).alias("key_null_rows"))
    return out.withColumns({
        "columns": F.lit(len(df.columns)),
        "key_duplicate_ratio": F.try_divide(F.col("key_duplicate_rows").cast("double"), F.col("rows").cast("double")),
    })


def validate(df: DataFrame, rules: Mapping[str, Column], group: Sequence[str] = ()) -> DataFrame:
    """Count rule violations (``rule`` is a boolean that must hold) in one pass.

    Returns one row per group and rule with the number of failing rows (NULL = fail).
    """
    aggs = [F.count_if(~F.coalesce(cond, F.lit(False))).alias(name) for name, cond in rules.items()]
    wide = df.groupBy(*group).agg(F.count(F.lit(1)).alias("rows"), *aggs)
    return wide.unpivot([*group, "rows"], list(rules), "rule", "violations")
