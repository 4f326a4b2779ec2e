"""Report drivers (D89, K6, K7): run a set of marts and save each one.

Each mart is a separate Spark job writing its own output; nothing is collected to the
driver. ``save_dual`` writes Parquet plus one CSV file per report (reports are small
aggregates; the CSV coalesce is safe for them, not for row-level marts).
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from gridmart.sources.lake import save_dual

MartFn = Callable[[SparkSession, str], DataFrame]


def run_reports(spark: SparkSession, sf_dir: str, out_dir: str, marts: Mapping[str, MartFn]) -> list[str]:
    """Run every mart and save it under ``out_dir/name`` (Parquet + CSV)."""
    written = []
    for name, fn in marts.items():
        save_dual(fn(spark, sf_dir), os.path.join(out_dir, name))
        written.append(name)
    return written


def macro_report(spark: SparkSession, sf_dir: str, out_dir: str) -> list[str]:
    """The league macro report: season trends, weekly league metrics, environment splits,
    pace/PROE, drive summaries."""
    from gridmart.plans import q_core, q_league

    return run_reports(spark, sf_dir, out_dir, {
        "league_yoy": q_league.league_yoy,
        "league_by_week": q_league.league_by_week,
        "league_by_class": q_league.league_by_class,
        "rate_over_expected": q_league.rate_over_expected,
        "pattern_classify": q_core.pattern_classify,
    })


def write_quality(profile: DataFrame, path: str, partition_col: str = "dataset") -> None:
    """K7: quality records as JSON, one directory per dataset, replacing only the
    datasets present."""
    (profile.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).json(path))
