"""Corpus-wide lookups by 64-bit key, two shuffles and no per-key rows.

Documents are dealt into groups of a few MB of text. Each group sends every distinct key
once, with one value, as packed arrays to the key's bucket; a bucket combines the entries
of a key from all groups and answers those groups that need it; the group then finishes
its own documents. A key of a third of all documents costs one entry per group, so no
task gathers the rows of a hot key.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.textops import binary_parts

GROUP_BYTES = 2 << 20
PACKED = "bucket int, grp int, keys binary, vals binary"
ANSWER = "grp int, keys binary, vals binary"


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts (one aggregate over the whole column)."""
    return int(docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0)


def grouped(docs: DataFrame, n_groups: int) -> DataFrame:
    """``docs`` with column ``grp``: the same row always lands in the same group."""
    return docs.withColumn("grp", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_groups)).cast("int"))


def plan_sizes(docs: DataFrame, group_bytes: int = GROUP_BYTES, least: int = 64) -> tuple[int, int]:
    """(groups, buckets) for the input's size: a group holds about ``group_bytes`` of text
    and a bucket about as many entries as two groups; ``least`` groups."""
    n_groups = max(least, -(-text_bytes(docs) // group_bytes))
    bits = max(8, int(np.ceil(np.log2(n_groups / 2))))
    return n_groups, 1 << min(bits, 30)


def _packed(columns: list[np.ndarray], cuts: np.ndarray) -> list[pa.Array]:
    """One binary value per slice of 8-byte numbers, byte planes apart: the high bytes of
    sorted keys and of small values are alike, so Spark's shuffle compresses them away."""
    bounds = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
    out = []
    for col in columns:
        raw = np.ascontiguousarray(col).view(np.uint8).reshape(-1, 8)
        out.append(pa.array([raw[a:b].T.tobytes() for a, b in bounds], pa.binary()))
    return out


def _unpacked(column, kind) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, how many each row had) of a packed column."""
    raw, off = binary_parts(column)
    size = np.diff(off) // 8
    out = np.empty((len(raw) // 8, 8), np.uint8)
    at = 0
    for a, n in zip(off[:-1].tolist(), size.tolist(), strict=True):
        out[at:at + n] = raw[a:a + 8 * n].reshape(8, n).T
        at += n
    return out.reshape(-1).view(kind), size


def scatter(docs: DataFrame, n_buckets: int,
            emit: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """``emit(group) -> (keys, values)``: distinct uint64 keys, ascending, with an int64 each."""
    shift = np.uint64(64 - int(np.log2(n_buckets)))

    def send(key, table):
        keys, vals = emit(table)
        bucket = (keys >> shift).astype(np.int64)
        cuts = np.concatenate([np.flatnonzero(np.diff(bucket, prepend=-1)), [len(keys)]]).astype(np.int64)
        at = bucket[cuts[:-1]].astype(np.int32) if len(keys) else np.zeros(0, np.int32)
        if not len(keys):
            cuts = np.zeros(1, np.int64)
        k, v = _packed([keys, vals.astype(np.int64)], cuts)
        grp = np.full(len(at), key[0].as_py(), np.int32)
        return pa.table({"bucket": at, "grp": grp, "keys": k, "vals": v})

    return docs.groupBy("grp").applyInArrow(send, PACKED)


def combine(sent: DataFrame, answer: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]],
            stats: Callable | None = None) -> DataFrame:
    """``answer(keys, values, run_start) -> (mask, reply)`` over a bucket's entries sorted by
    key; masked entries go back to the group that sent them. ``stats`` (same arguments) adds
    a row of group -1 per bucket with its (keys, values)."""

    def reduce(key, table):
        keys, size = _unpacked(table["keys"], np.uint64)
        vals, _ = _unpacked(table["vals"], np.int64)
        grp = np.repeat(table["grp"].to_numpy(), size)
        order = np.argsort(keys, kind="stable")
        keys, vals, grp = keys[order], vals[order], grp[order]
        start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        extra = stats(keys, vals, start) if stats and len(keys) else None
        mask, reply = answer(keys, vals, start)
        keys, reply, grp = keys[mask], reply[mask], grp[mask]
        order = np.argsort(grp, kind="stable")
        keys, reply, grp = keys[order], reply[order], grp[order]
        cuts = np.concatenate([np.flatnonzero(np.diff(grp, prepend=-1)), [len(grp)]]).astype(np.int64)
        if not len(grp):
            cuts = np.zeros(1, np.int64)
        k, v = _packed([keys, reply.astype(np.int64)], cuts)
        out = pa.table({"grp": grp[cuts[:-1]].astype(np.int32), "keys": k, "vals": v})
        if extra:
            k, v = _packed(list(extra), np.array([0, len(extra[0])]))
            out = pa.concat_tables([out, pa.table({"grp": np.array([-1], np.int32), "keys": k, "vals": v})])
        return out

    return sent.groupBy("bucket").applyInArrow(reduce, ANSWER)


def finish(docs: DataFrame, answers: DataFrame,
           fn: Callable[[pa.Table, np.ndarray, np.ndarray], pa.Table], schema) -> DataFrame:
    """``fn(group, keys, values)`` with the group's answers, keys ascending and distinct."""

    def close(key, left, right):
        keys, _ = _unpacked(right["keys"], np.uint64)
        vals, _ = _unpacked(right["vals"], np.int64)
        order = np.argsort(keys, kind="stable")
        return fn(left, keys[order], vals[order])

    return docs.groupBy("grp").cogroup(answers.groupBy("grp")).applyInArrow(close, schema)


def lookup(own: np.ndarray, values: np.ndarray, keys: np.ndarray, answers: np.ndarray) -> np.ndarray:
    """``values`` of the ascending keys ``own``, replaced by the answer where there is one."""
    if not len(keys):
        return values
    at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
    return np.where(keys[at] == own, answers[at], values)


def totals(keys, vals, start):
    """For ``combine``: the sum of a key's values, sent where it differs from the own one."""
    total = np.repeat(np.add.reduceat(vals, start), np.diff(np.append(start, len(keys))))
    return total != vals, total
