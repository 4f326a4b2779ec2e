"""Token ids of whole texts with the ``tokenizers`` library, one call per distinct word.

The vocabulary ``word_bpe_49k.json`` drops white space and never joins characters across
it, so a text's ids are the ids of its white-space separated words in order. Each Python
worker keeps a bounded cache word -> ids, and ids of a batch are gathered from it by numpy.
The cache tells words apart by 128 bits of hash.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from tokenizers import Tokenizer

from gridmart.llm.scratch import bounded_batches
from gridmart.llm.textops import Words, binary_parts, small_batches, span_hashes

END_ID = 1
SECOND = 0xA0761D6478BD642F, 29  # multiplier and shift of the second hash of a word


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def load_vocabulary(spark: SparkSession, path: str | None = None):
    """The vocabulary file's text (a few MB, fixed by the tokenizer) as a broadcast."""
    with open(path or default_vocabulary(), encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def _byte_letters() -> list[str]:
    """Byte-level alphabet: printable bytes stand for themselves, others for 256, 257, ..."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else spare))
        spare += b not in plain
    return out


class _Index(dict):
    """key -> dense number; unseen keys are numbered and noted in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list = []

    def __missing__(self, key):
        n = self[key] = len(self)
        self.new.append(key)
        return n


class _Table:
    """Ragged id lists in one growing array."""

    def __init__(self):
        self.ids = np.zeros(1 << 16, np.uint32)
        self.start = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int32)
        self.rows = self.used = 0

    def add(self, lists: list) -> np.ndarray:
        """Append ``lists``; the numbers of their rows."""
        n = np.fromiter(map(len, lists), np.int64, len(lists))
        total, rows = int(n.sum()), self.rows + len(lists)
        self.ids = _grown(self.ids, self.used + total)
        self.start, self.size = _grown(self.start, rows), _grown(self.size, rows)
        self.ids[self.used:self.used + total] = np.fromiter(chain.from_iterable(lists), np.uint32, total)
        self.size[self.rows:rows], self.start[self.rows:rows] = n, self.used + np.cumsum(n) - n
        out = np.arange(self.rows, rows)
        self.rows, self.used = rows, self.used + total
        return out


    def taken(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of ``rows`` one after the other, and their offsets."""
        offsets = np.append(self.start[:self.rows], self.used)
        lists = pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(self.ids[:self.used]))
        out = lists.take(pa.array(rows))
        return out.flatten().to_numpy(), out.offsets.to_numpy()


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    """``array`` with room for ``size`` values."""
    if size <= len(array):
        return array
    out = np.zeros(max(size, len(array) + (len(array) >> 1)), array.dtype)
    out[:len(array)] = array
    return out


class WordEncoder:
    """Batch encoder with a cache of at most ``max_words`` words between batches.

    Arrow finds the distinct words of a batch; the cache is a sorted array of their 64-bit
    hashes with a second 64-bit hash beside each, so a cached word takes some fifty bytes."""

    def __init__(self, vocabulary: str, max_words: int = 1_200_000):
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.max_words = max_words
        self.letters = {b: x for b, x in enumerate(_byte_letters()) if x != chr(b)}
        self.marks = {m: self.tokenizer.encode(m, add_special_tokens=False).ids for m in ".,"}
        self.clear()

    def clear(self) -> None:
        self.keys, self.checks, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.table = _Table()
        self.table.add([[END_ID]])  # row 0

    def _cores(self, cores: list[str]) -> np.ndarray:
        """Rows of runs of Latin letters: each is one piece for the pre-tokenizer, so the model's
        merges apply to its bytes directly."""
        model, letters = self.tokenizer.model, self.letters
        texts = (c if c.isascii() else c.encode().decode("latin-1").translate(letters) for c in cores)
        return self.table.add([[t.id for t in model.tokenize(x)] for x in texts])

    def _learn(self, words: list[str]) -> np.ndarray:
        """The table's rows of new distinct words; a word takes its ids from its run of letters,
        which is cached in lower case."""
        rows, cores, of_core, marked, other = np.zeros(len(words), np.int64), {}, [], [], []
        for k, word in enumerate(words):
            mark = self.marks.get(word[-1])
            low = (word[:-1] if mark else word).lower()
            if low.isalpha() and (low.isascii() or max(low) < "ɐ"):
                of_core.append((k, cores.setdefault(low, len(cores))))
                if mark:
                    marked.append((k, mark))
            else:
                other.append(k)
        if cores:
            at, core = np.array(of_core).T
            rows[at] = self._rows(pa.array(list(cores), pa.large_string()), self._cores)[core]
        if marked:
            ids, start, size = self.table.ids, self.table.start, self.table.size
            at = np.array([k for k, _ in marked])
            first = start[rows[at]].tolist()
            last = (start[rows[at]] + size[rows[at]]).tolist()
            rows[at] = self.table.add([ids[a:b].tolist() + mark for a, b, (_, mark) in zip(first, last, marked, strict=True)])
        if other:
            found = self.tokenizer.encode_batch_fast([words[k] for k in other], add_special_tokens=False)
            rows[other] = self.table.add([e.ids for e in found])
        return rows

    def _found(self, keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where each key belongs, whether it is there); ``keys`` ascend."""
        at = np.searchsorted(self.keys, keys)
        if not len(self.keys):
            return at, np.zeros(len(keys), bool)
        here = np.minimum(at, len(self.keys) - 1)
        return at, (self.keys[here] == keys) & (self.checks[here] == checks)

    def _rows(self, distinct: pa.Array, learn: Callable[[list[str]], np.ndarray]) -> np.ndarray:
        """The table's row of each of the ``distinct`` words."""
        raw, off = binary_parts(distinct)
        keys, checks = span_hashes(raw, off[:-1], off[1:]), span_hashes(raw, off[:-1], off[1:], *SECOND)
        order = np.argsort(keys)
        keys, checks = keys[order], checks[order]
        at, known = self._found(keys, checks)
        rows, new = np.zeros(len(keys), np.int64), order[~known]
        rows[order[known]] = self.rows[at[known]]
        if len(new):
            rows[new] = learn(distinct.take(pa.array(new)).to_pylist())
            keys, checks = keys[~known], checks[~known]
            at, known = self._found(keys, checks)  # learning adds runs of letters
            at, fresh = at[~known], (keys[~known], checks[~known], rows[new[~known]])
            self.keys, self.checks, self.rows = (
                np.insert(old, at, x) for old, x in zip((self.keys, self.checks, self.rows), fresh, strict=True))
        return rows

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): document d has ``ids[offsets[d]:offsets[d + 1]]``, its end id
        included. A null text counts as empty and has the end id alone."""
        if len(self.keys) > self.max_words:
            self.clear()
        words = Words(texts)
        coded = words.array().dictionary_encode()
        row = np.zeros(len(coded) + words.n_docs, np.int64)
        row[np.arange(len(coded)) + words.doc()] = self._rows(coded.dictionary, self._learn)[coded.indices.to_numpy()]
        ids, ends = self.table.taken(row)
        last = np.cumsum(words.count + 1)
        return ids, ends[np.concatenate([[0], last])]


_ENCODERS: dict[int, WordEncoder] = {}


def encoder(vocabulary: str) -> WordEncoder:
    """The worker's encoder for a vocabulary (kept between tasks of the same worker)."""
    key = hash(vocabulary)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(vocabulary)
    return _ENCODERS[key]


def map_ids(docs: DataFrame, vocabulary, rows: Callable[[object, np.ndarray, np.ndarray], dict], schema: str
            ) -> DataFrame:
    """``rows(doc_id column, ids, offsets) -> columns`` over batches of a few MB of text."""
    def run(batches):
        enc = encoder(vocabulary.value)
        for b in small_batches(batches, limit=2 << 20):
            ids, offsets = enc.encode(b["text"])
            yield pa.RecordBatch.from_pydict(rows(b["doc_id"], ids, offsets))

    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, schema)
