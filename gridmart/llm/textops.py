"""Numpy helpers over the UTF-8 bytes of an Arrow string column (no per-character Python).

A word is a maximal run of bytes outside ``\\x20`` and ``\\x09-\\x0D``; a null text has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MASK = np.array([0] + [(1 << (8 * k)) - 1 for k in range(1, 9)], dtype=U64)
NO_ID = np.int64(2**63 - 1)


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def one_array(column, kind=None) -> pa.Array:
    """A column as one contiguous array."""
    out = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(out, pa.ChunkedArray):
        out = pa.concat_arrays(out.chunks) if out.num_chunks else pa.array([], out.type)
    return out.cast(kind) if kind is not None else out


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text counts as empty."""
    arr = pc.fill_null(one_array(column, pa.large_string()), "")
    return binary_parts(arr)


def binary_parts(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary or string column without nulls."""
    arr = one_array(column)
    kind = pa.large_binary() if not pa.types.is_large_string(arr.type) else arr.type
    arr = arr.cast(kind)
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = arr.buffers()
    offsets = np.frombuffer(off, np.int64)[arr.offset:arr.offset + len(arr) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def ids_or_last(column) -> np.ndarray:
    """doc_id values; a null id counts as larger than every other id."""
    return pc.fill_null(one_array(column, pa.int64()), int(NO_ID)).to_numpy(zero_copy_only=False)


class Words:
    """The words of a batch of texts, flat and in document order.

    ``start``/``end`` are byte positions, ``first[d]:first[d + 1]`` are document d's words.
    """

    def __init__(self, column):
        self.data, self.offsets = utf8(column)
        self.n_docs = len(self.offsets) - 1
        n = len(self.data)
        inside = ~_SPACE[self.data]
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[0], before[1:] = False, inside[:-1]
            after[-1], after[:-1] = False, inside[1:]
            at = self.offsets[:-1][self.offsets[:-1] < n]
            before[at] = False
            at = self.offsets[1:][self.offsets[1:] > 0]
            after[at - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, self.offsets).astype(np.int64)
        self.count = np.diff(self.first)

    def doc(self) -> np.ndarray:
        """Document index of every word."""
        return np.repeat(np.arange(self.n_docs), self.count)

    def hashes(self, fold_case: bool = False) -> np.ndarray:
        """A 64-bit hash of every word, eight bytes a step (``fold_case``: A-Z as a-z)."""
        data = self.data
        if fold_case:
            data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        return span_hashes(data, self.start, self.end)

    def array(self) -> pa.Array:
        """The words as one Arrow string column."""
        offsets = np.concatenate([[0], np.cumsum(self.end - self.start)]).astype(np.int64)
        kept = self.data[~_SPACE[self.data]]
        return pa.Array.from_buffers(pa.large_string(), len(self.start), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])

    def doc_bytes(self, d: int) -> bytes:
        return self.data[self.offsets[d]:self.offsets[d + 1]].tobytes()


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, by: int = 0xD6E8FEB86659FD93, shift: int = 32
                ) -> np.ndarray:
    """A 64-bit hash of each byte span; another odd ``by`` and ``shift`` give another hash."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    loads = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
    length = end - start
    h = length.astype(U64) * U64(0x9E3779B97F4A7C15)
    todo, at = np.arange(len(start)), start
    left = length
    while len(todo):
        part = loads[at] & _MASK[np.minimum(left, 8)]
        step = (h[todo] ^ part) * U64(by)
        h[todo] = step ^ (step >> U64(shift))
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    return mix64(h)


def inverse_mod64(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def rolling_hashes(values: np.ndarray, width: int, base: int = 0x5851F42D4C957F2D) -> np.ndarray:
    """Rabin-Karp hashes (polynomial in ``base`` mod 2^64, prefix-sum form) of every run of
    ``width`` consecutive values; entry i covers values i .. i + width - 1."""
    n = len(values)
    if n < width:
        return np.zeros(0, U64)
    power = np.full(n, base, U64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    prefix = np.concatenate([np.zeros(1, U64), np.cumsum(values * power, dtype=U64)])
    back = np.full(n, inverse_mod64(base), U64)
    back[0] = 1
    back = np.multiply.accumulate(back)
    return mix64((prefix[width:] - prefix[:-width]) * back[:n - width + 1])


def window_index(words: Words, width: int) -> np.ndarray:
    """Start positions (word index) of the windows that stay inside one document."""
    n = np.maximum(words.count - width + 1, 0)
    total = int(n.sum())
    if not total:
        return np.zeros(0, np.int64)
    begin = np.repeat(words.first[:-1], n)
    within = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
    return begin + within


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Start index of each run of equal values."""
    if not len(sorted_values):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))


def small_batches(batches, column: str = "text", limit: int = 4 << 20):
    """Split Arrow batches so that each part holds about ``limit`` bytes of ``column`` at
    most (one longer text still comes whole, alone)."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(one_array(batch[column])), 0).to_numpy(zero_copy_only=False)
        offsets = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end
