"""Gold tables with staged commits (K2, K3).

Layout: ``{root}/gold/{mart}/data/run=R/season=S/week=W/part-*`` and an append-only manifest
``{root}/gold/{mart}/manifest``, one row per committed (partition, run). A run writes its data
into a folder of its own; only when all of it is there does one small write append its manifest
rows, and readers see the newest run of each partition that the manifest names. A run that
fails before that leaves the table as it was, and its data is never read.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridmart.operators.quality import partition_stats
from gridmart.operators.shares import null_safe_join
from gridmart.sources.lake import _exists

PARTITIONS = ("season", "week")


class PartitionExists(ValueError):
    """A gold partition is there already and the writer may not replace it (K3)."""


def _paths(root: str, mart: str) -> tuple[str, str]:
    base = os.path.join(root, "gold", mart)
    return os.path.join(base, "data"), os.path.join(base, "manifest")


def manifest(spark: SparkSession, root: str, mart: str, partitions: Sequence[str] = PARTITIONS) -> DataFrame | None:
    """The newest commit of every partition (the later ``commit``, a running number)."""
    path = _paths(root, mart)[1]
    if not _exists(spark, path):
        return None
    newest = Window.partitionBy(*partitions).orderBy(F.col("commit").desc())
    return spark.read.parquet(path).withColumn("__n", F.row_number().over(newest)).filter("__n = 1").drop("__n")


def write_gold(df: DataFrame, root: str, mart: str, run_id: str, key: Sequence[str], replace: bool = True,
               partitions: Sequence[str] = PARTITIONS) -> DataFrame:
    """Commit ``df``'s partitions and return their manifest rows (rows, key fingerprint).

    ``replace=False`` (K3) refuses, before anything is written, a batch that holds a committed
    partition. A run id is used once. Rows are range-split inside a partition, so a huge one is
    written by several tasks; an empty ``df`` commits nothing.
    """
    spark = df.sparkSession
    data, log = _paths(root, mart)
    old = manifest(spark, root, mart, partitions)
    if old is not None and not replace:
        touched = null_safe_join(df.select(*partitions).distinct(), old.select(*partitions), partitions, "left_semi")
        if (clash := touched.limit(1).collect()):
            raise PartitionExists(f"{mart}: partition {clash[0].asDict()} is committed")
    order = [F.col(c) for c in (*partitions, *[k for k in key if k not in partitions])]
    target = os.path.join(data, f"run={run_id}")
    (df.repartitionByRange(*order).sortWithinPartitions(*order)
     .write.mode("errorifexists").option("compression", "zstd").partitionBy(*partitions).parquet(target))
    if not _exists(spark, target):  # no row, no file
        return df.sparkSession.createDataFrame([], "season int, week int, row_count long, fingerprint long")
    # What was written is what is recorded, and the commit is this one append.
    types = {f.name: f.dataType for f in df.schema.fields}
    written = spark.read.option("basePath", target).parquet(target)
    written = written.withColumns({p: F.col(p).cast(types[p]) for p in partitions})
    last = spark.read.parquet(log).agg(F.max("commit")).first()[0] if old is not None else 0
    rows = partition_stats(written, partitions, key, ts=None).withColumns(
        {"run": F.lit(run_id), "commit": F.lit((last or 0) + 1).cast("long")})
    rows.write.mode("append").parquet(log)
    return spark.read.parquet(log).filter((F.col("run") == run_id)).drop("run", "commit")


def read_gold(spark: SparkSession, root: str, mart: str, where: Mapping[str, object] | None = None,
              partitions: Sequence[str] = PARTITIONS) -> DataFrame:
    """The committed table: every partition from its newest run. ``where`` holds literal partition
    values, which prune folders; the join with the manifest prunes the runs."""
    current = manifest(spark, root, mart, partitions)
    if current is None:
        raise FileNotFoundError(f"no gold table {mart!r} under {root}")
    df = spark.read.option("basePath", _paths(root, mart)[0]).option("mergeSchema", "true").parquet(_paths(root, mart)[0])
    df = df.withColumn("run", F.col("run").cast("string"))
    for c, v in (where or {}).items():
        df = df.filter(F.col(c).isin(list(v)) if isinstance(v, (list, tuple, set)) else F.col(c) == v)
    return null_safe_join(df, current.select(*partitions, "run"), [*partitions, "run"], "left_semi").drop("run")
