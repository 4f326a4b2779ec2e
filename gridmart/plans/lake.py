"""Lake maintenance: bronze stamping, silver rules, validation and incremental promotion
(M1-M14, K5, K8, SURVEY 3.1).

The reference promotes one partition at a time in a Python loop. Here a promotion is
one lazy plan over *all* changed partitions:

    (existing silver LEFT SEMI JOIN changed partitions) UNION new batch
      -> harmonise types -> silver rule (renames, casts, required keys)
      -> newest-wins dedupe on the key -> dynamic partition overwrite

Distribution is by the partition and key columns; there is no driver-side loop over
partitions or rows.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart import __version__
from gridmart.operators.contracts import (SILVER_CONTRACTS, Contract, check_partitions, contract_rules,
                                           passing_partitions, recorded)
from gridmart.operators.dedupe import dedupe_latest, dedupe_most_complete, first_per_key, whole_row
from gridmart.operators.quality import partition_stats
from gridmart.operators.shares import null_safe_join
from gridmart.operators.schema import normalise_common, union_harmonised
from gridmart.sources.lake import list_partitions, read_drifting_dataset, write_partitions
from gridmart.sources.specs import DatasetSpec, SilverRule, required_keys, rule_for

STAMP_COLUMNS = ("source", "pipeline_version", "run_id", "ingested_at")


def stamp(df: DataFrame, source: str, run_id: str, ingested_at: _dt.datetime | str | None = None,
          pipeline_version: str = __version__) -> DataFrame:
    """M1: add ``source``, ``pipeline_version``, ``run_id``, ``ingested_at`` when absent.

    ``ingested_at`` is always set (SURVEY Q2): a batch without it would lose to older rows.
    """
    ts = ingested_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    values = {"source": F.lit(source), "pipeline_version": F.lit(pipeline_version),
              "run_id": F.lit(run_id), "ingested_at": F.lit(ts).cast("timestamp")}
    return df.withColumns({k: v for k, v in values.items() if k not in df.columns})


def normalise_partition_types(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """M2: a partition column whose values are all integral numbers becomes BIGINT (so
    ``2009.0`` and ``2009`` are one partition), otherwise text. The check is one
    aggregate over the batch (``count(try_cast) == count(col)``)."""
    if not partitions:
        return df
    checks = []
    for p in partitions:
        as_dbl = F.col(p).cast("string").try_cast("double")
        integral = F.when(as_dbl.isNotNull() & (as_dbl == F.floor(as_dbl)), 1)
        checks += [F.count(integral).alias(f"{p}__ok"), F.count(p).alias(f"{p}__n")]
    row = df.agg(*checks).first()  # one row of 2 x len(partitions) counters
    cols = {}
    for p in partitions:
        numeric = row[f"{p}__ok"] == row[f"{p}__n"]
        cols[p] = (F.col(p).cast("string").try_cast("double").cast("bigint") if numeric
                   else F.col(p).cast("string"))
    return df.withColumns(cols)


def bronze_batch(df: DataFrame, spec: DatasetSpec, source: str, run_id: str,
                 ingested_at: _dt.datetime | str | None = None) -> tuple[DataFrame, DataFrame]:
    """K5: stamped batch plus per-partition row counts (NULL partition values kept)."""
    stamped = normalise_partition_types(stamp(df, source, run_id, ingested_at), list(spec.partitions))
    counts = stamped.groupBy(*spec.partitions).agg(F.count(F.lit(1)).alias("row_count"))
    return stamped, counts


def apply_silver_rule(df: DataFrame, spec: DatasetSpec, rule: SilverRule | None = None) -> DataFrame:
    """M7 + M8 + M9: normalise, rename, cast, drop rows missing required keys."""
    rule = rule or rule_for(spec.name)
    out = normalise_common(df)
    for old, new in rule.renames.items():
        if old in out.columns and new not in out.columns:
            out = out.withColumnRenamed(old, new)
    casts = {c: F.col(c).try_cast(t) for c, t in rule.casts.items() if c in out.columns}
    if casts:
        out = out.withColumns(casts)
    req = required_keys(spec, rule, out.columns)
    return out.dropna(subset=req) if req else out


def dedupe_silver(df: DataFrame, spec: DatasetSpec, rule: SilverRule | None = None,
                  batch_col: str | None = None) -> DataFrame:
    """One row per key; newest ``ingested_at`` wins, ties go to the newer batch
    (``batch_col`` larger wins), then to the larger run id, then by a hash of the whole row,
    so the kept row never depends on the input order; ``most_complete`` for ids."""
    rule = rule or rule_for(spec.name)
    key = [k for k in spec.key if k in df.columns]
    if rule.dedupe == "most_complete":
        values = [c for c in df.columns if c not in key]
        return dedupe_most_complete(df, key, values, values)
    if "ingested_at" in df.columns:
        tie = [c for c in (batch_col, "run_id") if c and c in df.columns]
        return dedupe_latest(df, key, "ingested_at", tie)
    return first_per_key(df, key, [whole_row(df)])


def validate_rows(df: DataFrame, spec: DatasetSpec) -> dict[str, Column]:
    """M11 rules: required columns present (checked on the schema), key parts not null,
    ``play_id >= 1`` for play data."""
    missing = [k for k in spec.key if k not in df.columns]
    if missing:
        raise ValueError(f"{spec.name}: missing key columns {missing}")
    rules = {f"{k}_not_null": F.col(k).isNotNull() for k in spec.key}
    if "play_id" in df.columns:
        rules["play_id_ge_1"] = F.col("play_id") >= 1
    return rules


def merge_for_promotion(existing: DataFrame | None, batch: DataFrame, spec: DatasetSpec,
                        rule: SilverRule | None = None) -> DataFrame:
    """U5 + M6 + M10: rows of the touched partitions after merging ``batch`` into silver.

    Only partitions that occur in ``batch`` are read back from ``existing`` (a semi-join
    on the partition columns, which prunes at the scan when the partition list is small
    and is a shuffle join otherwise).
    """
    b = batch.withColumn("__batch", F.lit(1))
    parts = [p for p in spec.partitions if p in batch.columns]
    frames = [b]
    if existing is not None:
        old = existing
        if parts:
            # Null-safe: rows of a NULL partition are read back too, or the write would lose them.
            touched = batch.select(*[F.col(p).alias(f"__touched_{p}") for p in parts]).distinct()
            same = [old[p].eqNullSafe(touched[f"__touched_{p}"]) for p in parts]
            old = old.join(touched, reduce(and_, same), "left_semi")
        frames.insert(0, old.withColumn("__batch", F.lit(0)))
    merged = union_harmonised(frames)
    silver = apply_silver_rule(merged, spec, rule)
    return dedupe_silver(silver, spec, rule, batch_col="__batch").drop("__batch")


def promote(spark: SparkSession, root: str, batch: DataFrame, spec: DatasetSpec, on_violation: str = "raise",
            enrich: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Merge a landed batch into ``silver`` and rewrite only the touched partitions.

    Returns the per-partition record of what was written (M13) with ``status``, ``violations`` and
    the failing rules, for the lineage log. ``on_violation`` (SURVEY Q11): ``raise``, or ``skip``:
    a partition with a violating row is not written, so its silver stays as it was, and it is
    recorded with zero rows (M12). ``enrich`` is applied to the merged rows before the checks, such
    as :func:`gridmart.operators.crosswalk.enrich_names` with the rosters (J13).
    """
    from gridmart.session import checkpoint_dir

    checkpoint_dir(spark)
    try:
        existing = read_drifting_dataset(spark, root, "silver", spec.name)
    except FileNotFoundError:
        existing = None
    merged = merge_for_promotion(existing, batch, spec)
    if enrich is not None:
        merged = enrich(merged)
    # Contract columns that are neither key nor partition of the spec need not be there.
    needed = {*spec.key, *spec.partitions, *merged.columns}
    contract = Contract({c: r for c, r in SILVER_CONTRACTS.get(spec.name, Contract()).columns.items() if c in needed})
    rules = {**validate_rows(merged, spec), **contract_rules(merged, contract)}
    # Materialise the merged rows once under the shared checkpoint folder: the checks and the
    # write read them, the write replaces what it reads, and the record describes what was written.
    merged = merged.checkpoint(eager=True)
    parts = [p for p in spec.partitions if p in merged.columns]
    report = check_partitions(merged, rules, parts)
    if on_violation == "raise":
        bad = report.filter("violations > 0").limit(1).collect()
        if bad:
            raise ValueError(f"{spec.name}: rules {sorted(bad[0]['failed'])} violated")
    passing = passing_partitions(merged, report, parts) if parts else (
        merged if report.filter("violations > 0").isEmpty() else merged.limit(0))
    write_partitions(passing, root, "silver", spec)
    stats = partition_stats(merged, parts, [k for k in spec.key if k in merged.columns]).drop("row_count")
    log = recorded(report)
    return null_safe_join(log, stats, parts, "left") if parts else log.withColumns(
        {f.name: F.lit(v).cast(f.dataType) for f, v in zip(stats.schema.fields, stats.first(), strict=True)})


def lineage_latest(log: DataFrame) -> DataFrame:
    """K8: the lineage log is append-only; the current record per (dataset, partition) is
    the newest ``run_ts`` (ties: larger run id)."""
    return first_per_key(log, ["dataset", "partition"],
                         [F.col("run_ts").desc_nulls_last(), F.col("run_id").desc_nulls_last()])


def lineage_records(stats: DataFrame, spec: DatasetSpec, run_id: str, run_ts: str) -> DataFrame:
    """Turn M13 stats into lineage rows ready to append."""
    parts = list_partitions(stats, list(spec.partitions)).select(*spec.partitions, "partition") \
        if spec.partitions else stats.select(F.lit("").alias("partition"))
    out = stats.join(parts, list(spec.partitions)) if spec.partitions else stats.withColumn("partition", F.lit(""))
    return out.select(F.lit(spec.name).alias("dataset"), "partition", "row_count", "fingerprint",
                      F.lit(run_id).alias("run_id"), F.lit(run_ts).cast("timestamp").alias("run_ts"))
