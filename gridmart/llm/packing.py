"""Operator 10, best-fit packing: best-fit decreasing into sequences of 4096 tokens.

Documents of one length are interchangeable, so the packing needs only how many pieces
have each length (at most 4096 counts). The driver runs best-fit decreasing over those
counts with a segment tree over remaining capacities: the tightest open capacity that
holds a length is found in logarithmic time, and a run of equal bins is filled at once.
The result is a list of slots (length, ordinals from .. to, sequences from .. to, offset);
Spark numbers the pieces of each length (salted, so that one length may hold most rows)
and each piece looks its slot up. The sequence count is that of best-fit decreasing over
all pieces one by one.

Defined cases: a null or empty text is its end id alone (one token). Rows are packed one
by one, so repeated rows and equal doc_ids each get a place; a null doc_id keeps its row.
An empty table gives no piece.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gridmart.llm.scratch import written
from gridmart.llm.token_ids import load_vocabulary, map_ids

CAPACITY = 4096
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


class CapacityTree:
    """Segment tree over remaining capacities 0..n: which have open bins."""

    def __init__(self, n: int):
        self.leaves = 1 << max(1, n.bit_length())
        self.used = [False] * (2 * self.leaves)

    def mark(self, capacity: int, present: bool) -> None:
        at = self.leaves + capacity
        self.used[at] = present
        while at > 1:
            at //= 2
            self.used[at] = self.used[2 * at] or self.used[2 * at + 1]

    def tightest(self, size: int) -> int | None:
        """The smallest marked capacity that is at least ``size``."""
        at = self.leaves + size
        if at >= 2 * self.leaves:
            return None
        if self.used[at]:
            return size
        while at > 1:
            if at % 2 == 0 and self.used[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.used[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


def plan_slots(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over ``{length: pieces}``: slots (length, first ordinal, pieces,
    first sequence, offset); piece k of a slot goes to sequence first + k at the offset."""
    tree = CapacityTree(capacity)
    open_bins: dict[int, list[list[int]]] = {}
    slots, sequences = [], 0

    def put_back(left: int, first: int, n: int) -> None:
        if left and n:
            open_bins.setdefault(left, []).append([first, n])
            tree.mark(left, True)

    for size in sorted(counts, reverse=True):
        ordinal, todo = 0, counts[size]
        while todo:
            left = tree.tightest(size)
            if left is None:
                left, first, n = capacity, sequences, max(1, todo // (capacity // size))
                sequences += n
            else:
                first, n = open_bins[left].pop()
                if not open_bins[left]:
                    tree.mark(left, False)
            each = min(left // size, todo)  # best fit keeps filling the bin it has just made tighter
            bins = min(n, todo // each)
            for k in range(each):
                slots.append((size, ordinal, bins, first, capacity - left + k * size))
                ordinal += bins
            todo -= bins * each
            put_back(left - each * size, first, bins)
            put_back(left, first + bins, n - bins)
    return slots


def pieces(docs: DataFrame, vocabulary_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: documents cut only above ``capacity`` tokens."""

    def rows(doc_id, ids, offsets):
        n = np.diff(offsets)
        parts = -(-n // capacity)
        doc = np.repeat(np.arange(len(n)), parts)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
        start = piece * capacity
        length = np.minimum(n[doc] - start, capacity)
        raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
        begin = 4 * (offsets[:-1][doc] + start)
        crc = [zlib.crc32(raw[a:a + b]) for a, b in zip(begin.tolist(), (4 * length).tolist(), strict=True)]
        return {"doc_id": doc_id.take(pa.array(doc)), "piece": piece.astype(np.int32), "start": start,
                "length": length, "ids_crc32": pa.array(crc, pa.int64())}

    return map_ids(docs, load_vocabulary(docs.sparkSession, vocabulary_path), rows, PIECE)


def place(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``items`` (column ``length`` 1..capacity, doc_id, piece, ids_crc32) with sequence_id and
    offset. ``items`` must be a written table: it is read more than once."""
    spark = items.sparkSession
    salts = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keyed = items.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    counts = keyed.groupBy("length", "salt").agg(F.count("*").alias("n"))
    total = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = np.array(sorted(plan_slots(total, capacity)), np.int64).reshape(-1, 5)
    shift = 1 << 45
    slot_key = slots[:, 0] * shift + slots[:, 1]
    before = W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)
    base = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    rank = F.row_number().over(W.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))
    numbered = (keyed.withColumn("rank", rank).join(base, ["length", "salt"])
                .select(*items.columns, (F.col("base") + F.col("rank") - 1).alias("ordinal")))

    names = items.columns

    def run(batches):
        for b in batches:
            length, ordinal = (b[c].to_numpy(zero_copy_only=False) for c in ("length", "ordinal"))
            at = np.searchsorted(slot_key, length * shift + ordinal, side="right") - 1
            out = {c: b[c] for c in names}
            out["sequence_id"] = slots[at, 3] + ordinal - slots[at, 1]
            out["offset"] = slots[at, 4]
            yield pa.RecordBatch.from_pydict(out)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema)
    return numbered.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """All pieces of ``docs`` with their place."""
    return place(written(pieces(docs, vocabulary_path, capacity), "pieces"), capacity)
