"""Streaming promotion: two landed files, one correcting the other, give one silver row."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from gridmart.sources.lake import read_dataset
from gridmart.sources.specs import DatasetSpec
from gridmart.streaming.promote_stream import promote_stream

SPEC = DatasetSpec("weekly", ("season",), ("season", "week", "player_id"))
SCHEMA = "season INT, week INT, player_id STRING, targets INT, ingested_at TIMESTAMP"


def test_available_now_stream_promotes_all_landed_files(spark, tmp_dir):
    landing = os.path.join(tmp_dir, "landing")
    rows1 = [(2024, 1, "A", 8, "2024-09-01 00:00:00"), (2024, 1, "B", 3, "2024-09-01 00:00:00")]
    rows2 = [(2024, 1, "A", 10, "2024-09-02 00:00:00")]
    for i, rows in enumerate([rows1, rows2]):
        df = spark.createDataFrame(rows, SCHEMA.replace("TIMESTAMP", "STRING")).withColumn(
            "ingested_at", F.to_timestamp("ingested_at"))
        df.write.mode("append").parquet(os.path.join(landing, f"batch={i}"))
    schema = spark.read.parquet(os.path.join(landing, "batch=0")).schema
    q = promote_stream(spark, os.path.join(landing, "*"), schema, os.path.join(tmp_dir, "lake"), SPEC,
                       checkpoint=os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination(120)
    out = {r.player_id: r.targets for r in read_dataset(spark, os.path.join(tmp_dir, "lake"), "silver", "weekly").collect()}
    assert out == {"A": 10, "B": 3}
