"""SparkSession construction with the settings every gridmart job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library depends on for correct results; the last one for time at scale.
REQUIRED_CONF = {
    # Oracle comparisons and date arithmetic are done in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Gold and silver writes replace only the partitions a job touches.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The JVM leaves methods above 8000 bytes of bytecode uncompiled, so a fused stage of a mart's
    # dozens of measures runs interpreted; Spark's own limit (65535) lets it. Above this, Spark
    # runs the stage's operators one by one, each in methods that are compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Spark's own default, set again for every query: see join_where_dealt.
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
}


def join_where_dealt(spark: SparkSession) -> None:
    """Let joins leave rows where they are if both sides are dealt by a part of their keys (a player's
    rows joined by player and week). Spark shuffles them again by all keys otherwise, against skew. It
    holds until the next query is prepared; a query planned without it gives the same rows."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")

# Settings for scale: runtime re-planning, skew splitting, partition coalescing.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A shuffled join side whose *measured* size is below this becomes a broadcast at
    # runtime; bigger sides keep the sort-merge join. This is the size check for every
    # join side whose size depends on the data.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Recording the Python call site of every column costs more than planning a mart.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "gridmart",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Return a session with gridmart's settings applied.

    On a cluster, pass ``master=None`` and let spark-submit decide; ``shuffle_partitions``
    should then be sized so one shuffle partition holds ~128-256 MB.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {**SCALE_CONF, **REQUIRED_CONF}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local session that leaves it unset (tests) gets a scratch folder; on a cluster
    executors would each write to their own disk, so an unset folder is an error there.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="gridmart-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # noqa: BLE001 - some deployments lock core settings at runtime
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for an intermediate written table."""
    return os.path.join(checkpoint_dir(spark), name)
