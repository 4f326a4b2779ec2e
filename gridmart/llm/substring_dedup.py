"""Operator 1, substring dedup: Rabin-Karp hashes of every 13-word window.

Every document group hashes all its windows, sends each distinct hash once with the
smallest doc_id that has it, and learns from the hash's bucket whether a smaller doc_id
elsewhere has the window too (``exchange``). Windows whose sequence also starts in a
document with a smaller doc_id are removed; overlapping ones merge into maximal intervals.

Defined cases: a null or empty text has no words and its kept text is empty. A null doc_id
counts as larger than every id; rows of equal doc_id never remove each other's windows.
Hashes have 64 bits: among N windows a false match has probability below N^2 / 2^65.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmart.llm.exchange import combine, finish, grouped, plan_sizes, scatter
from gridmart.llm.textops import Words, ids_or_last, rolling_hashes, runs, window_index

WINDOW = 13


def _windows(table: pa.Table, width: int):
    """Words, window starts, hashes, doc ids and the sort order by (hash, doc_id)."""
    words = Words(table["text"])
    at = window_index(words, width)
    hashes = rolling_hashes(words.hashes(), width)[at] if len(at) else np.zeros(0, np.uint64)
    n = np.maximum(words.count - width + 1, 0)
    ids = np.repeat(ids_or_last(table["doc_id"]), n)
    by_id = np.argsort(ids, kind="stable")
    order = by_id[np.argsort(hashes[by_id], kind="stable")]
    return words, at, hashes, ids, order


def _first_owner(keys, vals, start):
    """Answer every entry whose hash has a smaller doc_id in another group."""
    low = np.repeat(np.minimum.reduceat(vals, start), np.diff(np.append(start, len(keys))))
    return vals > low, low


def _removed_words(table: pa.Table, keys: np.ndarray, low: np.ndarray, width: int):
    """Boolean per word of the group: covered by a window that a smaller doc_id has too."""
    words, at, hashes, ids, order = _windows(table, width)
    removed = np.zeros(len(words.start) + 1, np.int64)
    if len(order):
        h, owner = hashes[order], ids[order]
        start = runs(h)
        first = owner[start]
        if len(keys):
            where = np.minimum(np.searchsorted(keys, h[start]), len(keys) - 1)
            first = np.where(keys[where] == h[start], np.minimum(first, low[where]), first)
        gone = at[order[owner > np.repeat(first, np.diff(np.append(start, len(h))))]]
        np.add.at(removed, gone, 1)
        np.add.at(removed, gone + width, -1)
    return words, np.cumsum(removed[:-1]) > 0


def _intervals(mask: np.ndarray) -> np.ndarray:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return edge.reshape(-1, 2)


def _cut(words: Words, d: int, mask: np.ndarray) -> str:
    """Document d without its removed words and the white space after them."""
    if not mask.any():
        return words.doc_bytes(d).decode()
    begin, end = words.offsets[d], words.offsets[d + 1]
    start = words.start[words.first[d]:words.first[d + 1]]
    out, at = [], begin
    for a, b in _intervals(mask):
        out.append(words.data[at:start[a]].tobytes())
        at = start[b] if b < len(start) else end
    out.append(words.data[at:end].tobytes())
    return b"".join(out).decode()


def _run(docs: DataFrame, width: int, close, schema) -> DataFrame:
    n_groups, n_buckets = plan_sizes(docs)
    dealt = grouped(docs, n_groups)

    def emit(table: pa.Table):
        _, _, hashes, ids, order = _windows(table, width)
        h = hashes[order]
        start = runs(h)
        return h[start], ids[order][start]

    answers = combine(scatter(dealt.select("doc_id", "text", "grp"), n_buckets, emit), _first_owner)
    return finish(dealt, answers, close, schema)


def repeated_spans(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and ``intervals`` (removed word positions,
    end exclusive) per row of ``docs``."""

    def close(table: pa.Table, keys, low) -> pa.Table:
        words, gone = _removed_words(table, keys, low, width)
        n_removed, digest, spans = [], [], []
        for d in range(words.n_docs):
            mask = gone[words.first[d]:words.first[d + 1]]
            parts = words.doc_bytes(d).split()
            n_removed.append(int(mask.sum()))
            kept = compress(parts, ~mask) if n_removed[-1] else parts
            digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            spans.append([{"start": int(a), "end": int(b)} for a, b in _intervals(mask)])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({"doc_id": table["doc_id"], "n_words": words.count, "n_removed": pa.array(n_removed, pa.int64()),
                         "kept_sha256": pa.array(digest, pa.string()), "intervals": pa.array(spans, kind)})

    schema = ("doc_id long, n_words long, n_removed long, kept_sha256 string, "
              "intervals array<struct<start: long, end: long>>")
    return _run(docs.select("doc_id", "text"), width, close, schema)


def remove_repeats(docs: DataFrame, width: int = WINDOW) -> DataFrame:
    """``docs`` with the repeated words (and the white space after each) cut from ``text``;
    all other columns unchanged, a null text stays null."""
    names = docs.columns
    # Further columns travel under names of their own: none can meet a column of the exchange.
    own = {c: c if c in ("doc_id", "text") else f"__column_{k}" for k, c in enumerate(names)}
    docs = docs.select(*[F.col(f"`{c}`").alias(own[c]) for c in names])
    schema, inner = docs.schema, docs.columns

    def close(table: pa.Table, keys, low) -> pa.Table:
        words, gone = _removed_words(table, keys, low, width)
        null = table["text"].is_null().to_pylist()
        texts = [None if null[d] else _cut(words, d, gone[words.first[d]:words.first[d + 1]])
                 for d in range(words.n_docs)]
        return pa.table([pa.array(texts, pa.string()) if c == "text" else table[c] for c in inner], names=inner)

    out = _run(docs, width, close, T.StructType([T.StructField(f.name, f.dataType) for f in schema]))
    return out.select(*[F.col(own[c]).alias(c) for c in names])
