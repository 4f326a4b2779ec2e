"""Layered Parquet lake: hive-partitioned reads and partition-replacing writes
(S1-S5, S9, S11, K1-K4, K6, M4).

Layout: ``{root}/{layer}/{dataset}/{p1}=v1/{p2}=v2/part-*.parquet``.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.operators.schema import union_harmonised
from gridmart.sources.specs import DatasetSpec

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def dataset_path(root: str, layer: str, dataset: str) -> str:
    return os.path.join(root, layer, dataset)


def _missing(exc: Exception) -> bool:
    return isinstance(exc, AnalysisException) and "PATH_NOT_FOUND" in str(exc)


def _exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """True when ``path`` can be opened as ``fmt`` (file listing only, no data read)."""
    try:
        spark.read.format(fmt).load(path)
        return True
    except AnalysisException as exc:
        if _missing(exc) or "UNABLE_TO_INFER_SCHEMA" in str(exc):
            return False
        raise


def read_dataset(spark: SparkSession, root: str, layer: str, dataset: str,
                 schema: T.StructType | None = None, where: dict[str, object] | None = None,
                 skip_null_partitions: Sequence[str] = ()) -> DataFrame:
    """Read a whole dataset with partition discovery.

    ``where`` holds literal partition predicates (value or list) that prune directories;
    ``skip_null_partitions`` names partition columns whose ``__HIVE_DEFAULT_PARTITION__``
    directories are skipped (S3): Spark reads them as NULL, so this prunes them. A missing dataset gives an empty frame when ``schema`` is given (S9).
    """
    path = dataset_path(root, layer, dataset)
    if not _exists(spark, path):
        if schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", path)
    df = reader.schema(schema).parquet(path) if schema is not None else reader.parquet(path)
    for col, val in (where or {}).items():
        df = df.filter(F.col(col).isin(list(val)) if isinstance(val, (list, tuple, set)) else F.col(col) == val)
    for p in skip_null_partitions:
        df = df.filter(F.col(p).isNotNull())
    return df


def partition_dir(spec_partitions: Sequence[str], values: Sequence[object]) -> str:
    return "/".join(f"{p}={NULL_PARTITION if v is None else v}" for p, v in zip(spec_partitions, values))


def read_partition(spark: SparkSession, root: str, layer: str, dataset: str,
                   partitions: Sequence[str], values: Sequence[object]) -> DataFrame:
    """One partition directory with its partition columns kept (``basePath``, S4/Q7)."""
    base = dataset_path(root, layer, dataset)
    return spark.read.option("basePath", base).parquet(os.path.join(base, partition_dir(partitions, values)))


def read_drifting(spark: SparkSession, paths: Iterable[str], base_path: str | None = None) -> DataFrame:
    """Read files whose column types drift (FLOAT vs DOUBLE, BOOLEAN vs STRING).

    Paths are grouped by their physical schema (footers only, no data read); each group
    is read in one scan, cast to the common type lattice and unioned by name. The number
    of unions is the number of distinct schemas, not the number of files.
    """
    groups: dict[str, list[str]] = {}
    schemas: dict[str, T.StructType] = {}
    for p in paths:
        r = spark.read.option("basePath", base_path) if base_path else spark.read
        s = r.parquet(p).schema
        groups.setdefault(s.json(), []).append(p)
        schemas[s.json()] = s
    frames = []
    for key, ps in groups.items():
        r = spark.read.option("basePath", base_path) if base_path else spark.read
        frames.append(r.schema(schemas[key]).parquet(*ps))
    return union_harmonised(frames)


def read_drifting_dataset(spark: SparkSession, root: str, layer: str, dataset: str) -> DataFrame:
    """S2 for a layer whose partitions were written at different times: one schema a partition
    folder (its files come from one write), folders of one schema read together."""
    base = dataset_path(root, layer, dataset)
    if not _exists(spark, base):
        raise FileNotFoundError(base)
    folders = sorted({os.path.dirname(f) for f in spark.read.option("basePath", base).parquet(base).inputFiles()})
    return read_drifting(spark, folders, base)


def list_partitions(df: DataFrame, partitions: Sequence[str], first_level: object | None = None) -> DataFrame:
    """M4 / M3: distinct partition values (and the ``p=v/...`` path string) of a frame."""
    out = df.select(*partitions).distinct()
    if first_level is not None and partitions:
        out = out.filter(F.col(partitions[0]) == first_level)
    parts = [F.concat(F.lit(f"{p}="), F.coalesce(F.col(p).cast("string"), F.lit(NULL_PARTITION)))
             for p in partitions]
    return out.withColumn("partition", F.concat_ws("/", *parts))


def write_partitions(df: DataFrame, root: str, layer: str, spec: DatasetSpec,
                     compression: str = "zstd") -> str:
    """K1/K2/K4: replace exactly the partitions present in ``df``.

    * ``partitionOverwriteMode=dynamic`` is set on the write itself, so other partitions
      survive and a job may read and rewrite the same dataset (SURVEY H4);
    * rows are range-partitioned by (partition columns, sort order): a partition value is
      written by few tasks (no small-file explosion), yet a huge partition value is split
      over several tasks by its sort order instead of landing in one; files come out
      sorted so Parquet min/max statistics prune row groups;
    * ``maxRecordsPerFile`` caps file size; zstd compression.
    Unpartitioned datasets are written to a sibling path and swapped by the caller.
    """
    path = dataset_path(root, layer, spec.name)
    parts = [p for p in spec.partitions if p in df.columns]
    sort_cols = [c for c in (spec.sort_by or spec.key) if c in df.columns and c not in parts]
    order = [*parts, *sort_cols]
    out = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order) if order else df
    writer = (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .option("compression", compression).option("maxRecordsPerFile", spec.max_rows_per_file))
    if parts:
        writer = writer.partitionBy(*parts)
    writer.parquet(path)
    return path


def read_precomputed(spark: SparkSession, path_without_ext: str) -> DataFrame:
    """Load a saved table, Parquet preferred over CSV."""
    if _exists(spark, path_without_ext + ".parquet"):
        return spark.read.parquet(path_without_ext + ".parquet")
    return spark.read.option("header", True).option("inferSchema", True).csv(path_without_ext + ".csv")


def save_dual(df: DataFrame, path_without_ext: str) -> None:
    """K6: Parquet for machines and a CSV folder for people, written from the Parquet (the mart is
    computed once) by as many tasks as it has files."""
    df.write.mode("overwrite").parquet(path_without_ext + ".parquet")
    saved = df.sparkSession.read.schema(df.schema).parquet(path_without_ext + ".parquet")
    saved.write.mode("overwrite").option("header", True).csv(path_without_ext + ".csv")
