"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Where it is unset a local session (tests)
    gets a temporary folder; a cluster must name one."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="gridmart-llm-")
        spark.sparkContext.setCheckpointDir(path)
    return path


BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches by bytes: ten thousand whole texts in one batch are too much for a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_OPEN: list[list[str]] = []


@contextmanager
def temporary(spark: SparkSession, keep: int = 1) -> Iterator[None]:
    """Tables that ``written`` makes inside are deleted at the end, but for the last ``keep``: the
    caller reads only those from then on."""
    _OPEN.append([])
    try:
        yield
    finally:
        paths = _OPEN.pop()
        gone, kept = (paths[:-keep], paths[-keep:]) if keep else (paths, [])
        for path in gone:
            _delete(spark, path)
        if _OPEN:
            _OPEN[-1].extend(kept)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder for an intermediate table."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back (cuts the lineage;
    a lost executor costs only the tasks that read the files)."""
    spark = df.sparkSession
    path = shared_path(spark, f"{name}-{uuid.uuid4().hex}")
    schema = df.schema
    df.write.parquet(path, compression=compression)
    return spark.read.schema(schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete a table that ``written`` returned and that no later step reads."""
    for file in df.inputFiles()[:1]:
        _delete(df.sparkSession, file.rpartition("/")[0])


def collected(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of plans that are gone."""
    spark._jvm.System.gc()
