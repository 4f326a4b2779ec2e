"""Operator 9, token-ID output: frequency-ranked ids in byte-aligned variable-length code.

Ids are replaced by their rank in the corpus (0 = most frequent) and a rank takes one to
four bytes; the two-bit lengths of four ranks share one control byte, and control and data
bytes are separate streams. A file row is a block: control and data streams, the doc_ids
and token counts of its documents, and how many tokens its shard holds before it. Shards
are ranges of doc_id, so shard, then block order is ascending doc_id. The files are Parquet
rows with binary columns written by Spark's committed writer, so a lost task leaves no
partial block; ``ranks`` holds the rank table. Decoding looks lengths up per control byte.

Defined cases: a null or empty text is its end id alone; a null doc_id comes first; equal
doc_ids follow each other in order of their ids' checksum; an empty table gives no block.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmart.llm.scratch import shared_dir, written
from gridmart.llm.textops import binary_parts, ids_or_last, one_array
from gridmart.llm.token_ids import load_vocabulary, map_ids

BLOCK_TOKENS = 1 << 19
BLOCK = ("shard int, block long, tokens_before long, n_tokens long, doc_ids binary, null_ids binary, "
         "lengths binary, control binary, data binary")
_LENGTHS = np.array([[1 + ((c >> (2 * k)) & 3) for k in range(4)] for c in range(256)], np.uint8)
_KEEP = np.array([0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) streams of uint32 values."""
    ranks = np.ascontiguousarray(ranks, np.uint32)
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    raw = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)
    data = raw[np.arange(4) < size[:, None]]
    code = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    code[:len(ranks)] = size - 1
    code = code.reshape(-1, 4)
    control = code[:, 0] | (code[:, 1] << 2) | (code[:, 2] << 4) | (code[:, 3] << 6)
    return control.astype(np.uint8).tobytes(), data.tobytes()


def unpack_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of a pair of streams, by table lookup."""
    if not n:
        return np.zeros(0, np.uint32)
    size = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    at = np.cumsum(size, dtype=np.int64) - size
    padded = np.frombuffer(bytes(data) + b"\0\0\0\0", np.uint8)
    loads = np.ndarray((len(padded) - 3,), "<u4", padded.data, strides=(1,))
    return loads[at] & _KEEP[size - 1]


def _checksums(ids: np.ndarray, offsets: np.ndarray) -> list[int]:
    raw = memoryview(ids.astype("<u4")).cast("B")
    return [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def token_table(docs: DataFrame, vocabulary) -> DataFrame:
    """doc_id, crc, ids (little-endian, two bytes an id) per document, in the shared folder."""

    def rows(doc_id, ids, offsets):
        if len(ids) and int(ids.max()) > 0xFFFF:
            raise ValueError("the vocabulary has ids over 65535")
        packed = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(offsets) - 1,
            [None, pa.py_buffer(2 * offsets), pa.py_buffer(np.ascontiguousarray(ids, "<u2"))])
        return {"doc_id": doc_id, "crc": pa.array(_checksums(ids, offsets), pa.int64()),
                "ids": packed.cast(pa.binary())}

    return written(map_ids(docs, vocabulary, rows, "doc_id long, crc long, ids binary"), "token-ids")


def rank_table(tokens: DataFrame) -> DataFrame:
    """id, n over all documents, most frequent first (at most as many rows as the vocabulary)."""

    def count(batches):
        total = np.zeros(1 << 16, np.int64)
        for b in batches:
            total += np.bincount(binary_parts(b["ids"])[0].view("<u2"), minlength=1 << 16)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": seen.astype(np.int64), "n": total[seen]})

    counts = tokens.select("ids").mapInArrow(count, "id long, n long")
    return counts.groupBy("id").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "id")


def _blocks(rank_of: np.ndarray):
    def run(batches):
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            raw, off = binary_parts(b["ids"])
            ids, off = raw.view("<u2"), off // 2
            doc_id = one_array(b["doc_id"], pa.int64())
            null = np.asarray(doc_id.is_null())
            values = ids_or_last(doc_id)
            at = 0
            while at < len(off) - 1:
                end = max(at + 1, int(np.searchsorted(off, off[at] + BLOCK_TOKENS, side="right")) - 1)
                end = min(end, len(off) - 1)
                part = rank_of[ids[off[at]:off[end]]]
                control, data = pack_ranks(part)
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([shard], pa.int32()), "block": [block], "tokens_before": [before],
                    "n_tokens": [len(part)], "doc_ids": [values[at:end].astype("<i8").tobytes()],
                    "null_ids": [null[at:end].tobytes()],
                    "lengths": [np.diff(off[at:end + 1]).astype("<i8").tobytes()],
                    "control": [control], "data": [data]})
                block, before, at = block + 1, before + len(part), end

    return run


def write_token_files(docs: DataFrame, path: str, vocabulary_path: str | None = None) -> None:
    """Write ``docs`` under ``path``: ``ranks`` and ``blocks`` (see the module's text)."""
    spark = docs.sparkSession
    tokens = token_table(docs, load_vocabulary(spark, vocabulary_path))
    ranks = rank_table(tokens)
    by_rank = np.array([r.id for r in ranks.collect()], np.int64)  # at most the vocabulary's size
    rank_of = np.zeros(1 << 16, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    table = pa.table({"rank": np.arange(len(by_rank), dtype=np.int64), "id": by_rank})
    spark.createDataFrame(table.to_pandas(), "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")
    ordered = tokens.repartitionByRange("doc_id", "crc").sortWithinPartitions("doc_id", "crc")
    ordered.mapInArrow(_blocks(rank_of), BLOCK).write.parquet(f"{path}/blocks")


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids, little-endian 32-bit) from the files."""
    blocks = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    ranks = spark.read.schema("rank long, id long").parquet(f"{path}/ranks").collect()
    by_rank = np.zeros(max(1, len(ranks)), np.uint32)
    for r in ranks:
        by_rank[r.rank] = r.id
    # One row per shard, as many as the shuffle had partitions.
    totals = sorted(blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect())
    base, at = {}, 0
    for shard, n in totals:
        base[shard], at = at, at + n

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch[c][k].as_py() for c in batch.schema.names}
                ids = by_rank[unpack_ranks(row["control"], row["data"], row["n_tokens"])]
                size = np.frombuffer(row["lengths"], "<i8")
                off = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
                null = np.frombuffer(row["null_ids"], bool)
                out = {"doc_id": pa.array(np.frombuffer(row["doc_ids"], "<i8"), pa.int64(), mask=null),
                       "start": pa.array(base[row["shard"]] + row["tokens_before"] + off[:-1], pa.int64()),
                       "n_tokens": pa.array(size, pa.int64()),
                       "ids_crc32": pa.array(_checksums(ids, off), pa.int64())}
                if with_ids:
                    raw = ids.astype("<u4").tobytes()
                    out["ids"] = pa.array([raw[4 * a:4 * b] for a, b in zip(off[:-1], off[1:], strict=True)],
                                          pa.binary())
                yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return blocks.mapInArrow(run, schema)


def token_file_digest(docs: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """Write ``docs`` to a new folder under the shared one and read the files back."""
    spark = docs.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    write_token_files(docs, path, vocabulary_path)
    return read_token_files(spark, path)
