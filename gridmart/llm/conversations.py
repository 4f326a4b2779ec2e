"""Shared steps of the conversation operators: a conversation's rows, in order, in one stream.

Rows are shuffled by conversation and sorted inside the partition (Spark's sort spills), and
Python reads them as a stream: no conversation is gathered, however long it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.textops import small_batches


def ordered(rows: DataFrame, *after: str) -> DataFrame:
    """All rows of a conversation in one partition, by conv_id and ``after`` (nulls first)."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(parts, "conv_id")
            .sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in ("conv_id", *after)]))


def stream(batches, *columns: str, text: str = "text") -> Iterator[tuple]:
    """The rows of a partition as tuples, a few MB of ``text`` at a time."""
    for b in small_batches(batches, text):
        yield from zip(*(b[c].to_pylist() for c in columns), strict=True)


def flushed(rows: Iterator[dict], schema: pa.Schema, weight, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches of dict rows, cut when ``weight(row)`` adds up to ``limit``; at least one."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if size >= limit:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    yield pa.RecordBatch.from_pylist(held, schema)
