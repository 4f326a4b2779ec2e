"""Operator 12, cross-tokenizer alignment: byte-level BPE (A) against SentencePiece BPE (B).

A text is read as one byte string, ``space + text`` (B adds that space itself). Byte offsets
at which a token of A and a token of B both end cut the two token lists into groups; the last
tokens of a group are linked.

*Diagonal run skipping* (``diagonal_groups``) finds the cuts: with pointers i, j into the two
lists of end offsets, the lists are compared from (i, j) along the current shift j - i in
slices of doubling size, so a stretch of one-to-one tokens is jumped in a few comparisons; the
first slice that differs is halved down to the first difference, the irregular group there is
resolved by advancing the smaller end, and the shift is updated.

Neither tokenizer joins bytes across certain places (``unit_cuts``), so a text is cut into
units there, and a worker encodes and aligns each distinct unit once: all new units of a batch
are laid end to end and aligned in one pass, and documents are put together from their units.

Corpus counts: documents are taken in batches of a few MB. A batch sends each distinct
(A id, B id) pair once with its number of links; Spark sums them, finds the highest count per
B id, and answers each batch's pairs; the batch's documents, which keep their own distinct
pairs as packed numbers, then add up their answers. A pair that every document holds costs a
row per batch.

Defined cases: a null or empty text, and a text whose joined A or B bytes differ from
space + text (such as one that holds U+2581), has no tokens: zeros and '' as its digest. A
very long text is a batch of its own. Repeated rows and equal doc_ids are aligned row by row
and each counts; a null doc_id keeps its row. Equal counts of a B id are all best. An empty
table gives no row. Further columns of the input are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.scratch import written
from gridmart.llm.textops import binary_parts, one_array, small_batches, utf8

BATCH_BYTES = 4 << 20
#: Distinct units that a worker keeps between batches, and how many it encodes at a time (the
#: tokenizers' results are large objects).
MAX_UNITS, CHUNK = 300_000, 8192

CODED = ("grp long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
         "links binary, pairs array<long>, counts array<long>")
RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string")


def diagonal_groups(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(last A index, last B index) of each group of two ascending lists of end offsets that
    end in the same value."""
    runs_a, runs_b, runs_n = [], [], []
    i = j = 0
    n = len(a)
    while i < n:
        start_i, start_j, step = i, j, 1
        while i < n and a[i:i + step] == b[j:j + step]:  # probe: 1, 2, 4, ... along the shift
            i, j, step = min(i + step, n), j + step, 2 * step
        if i < n:
            step //= 2
            while step:  # the first difference lies within the slice that failed
                if a[i:i + step] == b[j:j + step]:
                    i, j = i + step, j + step
                step //= 2
        if i > start_i:
            runs_a.append(start_i)
            runs_b.append(start_j)
            runs_n.append(i - start_i)
        if i < n:  # irregular group, up to the next common end
            x, y = a[i], b[j]
            while x != y:
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
            runs_a.append(i)
            runs_b.append(j)
            runs_n.append(1)
            i, j = i + 1, j + 1
    count = np.array(runs_n, np.int64)
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return (np.repeat(np.array(runs_a, np.int64), count) + within,
            np.repeat(np.array(runs_b, np.int64), count) + within)


def _classes() -> tuple[np.ndarray, ...]:
    letter = np.zeros(256, bool)
    letter[[*range(65, 91), *range(97, 123)]] = True
    black = np.zeros(256, bool)
    black[0x21:0x7F] = True
    return letter, black


_LETTER, _BLACK = _classes()


def unit_cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Start positions of the units of texts laid end to end (each begins with a space).

    A unit starts with every text, before a space or line feed after a visible character, before
    '.' or ',' after a letter, and after a single line feed before a visible character: the
    byte-level pre-tokenizer always cuts there, and no SentencePiece piece holds these
    neighbours (``Aligner`` checks that against the vocabulary). Visible: ASCII 0x21-0x7E and
    the letters U+00C0-U+00FF; other characters are left inside a unit.
    """
    n = len(data)
    latin = np.zeros(n, bool)  # last byte of a letter U+00C0-U+00FF
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    letter = _LETTER[data] | latin
    shown = _BLACK[data] | latin
    blank = (data == 0x20) | (data == 0x0A)
    cut = np.zeros(n, bool)
    cut[1:] = shown[:-1] & blank[1:]
    cut[1:] |= letter[:-1] & ((data[1:] == 0x2E) | (data[1:] == 0x2C))
    lead = _BLACK[data] | ((data == 0xC3) & np.append(latin[1:], False))
    cut[2:] |= shown[:-2] & (data[1:-1] == 0x0A) & lead[2:]
    cut[offsets[:-1][offsets[:-1] < n]] = True
    return np.flatnonzero(cut)


def byte_alphabet() -> list[str]:
    """Byte-level alphabet: printable bytes stand for themselves, others for 256, 257, ..."""
    from gridmart.llm.token_ids import _byte_letters

    return _byte_letters()


class Aligner:
    """Both tokenizers, and the encoded and aligned form of the units met so far.

    Per unit: its A and B token counts, groups, link pairs (A id * 2^32 + B id) and digest
    text; ``ok`` is false where the joined B bytes differ from the unit.
    """

    def __init__(self, a_json: str, b_model: bytes):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b_model)
        letters = {c: i for i, c in enumerate(byte_alphabet())}
        names = self.a.get_vocab()
        self.a_size = np.zeros(max(names.values()) + 1, np.int64)
        for name, i in names.items():
            self.a_size[i] = len(name) if all(c in letters for c in name) else 0
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                   for i, p in enumerate(pieces)]
        self.b_size = np.array([len(p) for p in b_bytes], np.int64)
        self.b_bytes = pa.array(b_bytes, pa.large_binary())
        self.id_texts = pa.array([f"{i}{mark}".encode() for n, marks in ((len(self.a_size), ",|"), (len(pieces), ",;"))
                                  for i in range(n) for mark in marks], pa.large_binary())
        plain = [p for i, p in enumerate(pieces) if not self.b.is_byte(i)]
        if any("▁" in p.lstrip("▁") or "\n" in p
               or any(p[k] in ".," and p[k - 1].isalpha() for k in range(1, len(p))) for p in plain):
            raise ValueError("a piece joins characters across a place where texts are cut into units")
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.n_a, self.n_b, self.n_groups = (np.zeros(0, np.int32) for _ in range(3))
        self.ok = np.zeros(0, bool)
        self.first_digest, self.digest = np.zeros(1, np.int64), np.zeros(0, np.uint8)
        self.first_pair, self.pairs = np.zeros(1, np.int64), np.zeros(0, np.int64)

    def rows(self, units: list[bytes]) -> np.ndarray:
        """The row of every (distinct) unit; new ones are encoded and aligned."""
        if len(self.index) + len(units) > MAX_UNITS:
            self.clear()
        new = [u for u in units if u not in self.index]
        if new:
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
            self._learn(new)
        return np.fromiter(map(self.index.__getitem__, units), np.int64, len(units))

    def digests(self, rows: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """The digest texts of the units one after another, and where each ends."""
        held = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.n_a),
                                                [None, pa.py_buffer(self.first_digest), pa.py_buffer(self.digest)])
        raw, offsets = binary_parts(held.take(pa.array(rows)))
        return memoryview(np.ascontiguousarray(raw)), offsets

    def _learn(self, units: list[bytes]) -> None:
        n = len(units)
        parts = [self._encoded(units[k:k + CHUNK]) for k in range(0, n, CHUNK)]
        flat_a, n_a, flat_b, n_b = (np.concatenate(x) for x in zip(*parts, strict=True))
        ok = self._same_bytes(units, flat_b, n_b)
        flat_a, flat_b = flat_a[np.repeat(ok, n_a)], flat_b[np.repeat(ok, n_b)]
        n_a, n_b = np.where(ok, n_a, 0), np.where(ok, n_b, 0)
        cut_a, cut_b = diagonal_groups(np.cumsum(self.a_size[flat_a]).tolist(), np.cumsum(self.b_size[flat_b]).tolist())
        n_groups = np.diff(np.searchsorted(cut_a, np.concatenate([[0], np.cumsum(n_a)])))
        text, size = self._digest(flat_a, flat_b, cut_a, cut_b, n_a + n_b)
        self.n_a, self.n_b, self.n_groups = (
            np.concatenate([x, y.astype(np.int32)])
            for x, y in ((self.n_a, n_a), (self.n_b, n_b), (self.n_groups, n_groups)))
        self.ok = np.concatenate([self.ok, ok])
        self.digest = np.concatenate([self.digest, text])
        self.first_digest = np.concatenate([self.first_digest, self.first_digest[-1] + np.cumsum(size)])
        self.first_pair = np.concatenate([self.first_pair, self.first_pair[-1] + np.cumsum(n_groups)])
        self.pairs = np.concatenate([self.pairs, (flat_a[cut_a] << 32) | flat_b[cut_b]])

    def _encoded(self, units: list[bytes]) -> tuple[np.ndarray, ...]:
        """Token ids of the units one after another and how many each has, for A and B."""
        texts = [u.decode() for u in units]
        ids_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        # SentencePiece puts a space in front of a text that is not empty; where that does not
        # stand for the unit's own space, a line feed, which no piece joins to anything, stands
        # between, and the two tokens are dropped.
        spaced = [t[0] == " " and len(t) > 1 for t in texts]
        ids_b = self.b.encode([t[1:] if s else "\n" + t for t, s in zip(texts, spaced, strict=True)], num_threads=1)
        ids_b = [x if s else x[2:] for x, s in zip(ids_b, spaced, strict=True)]
        out = []
        for ids in (ids_a, ids_b):
            size = np.fromiter(map(len, ids), np.int64, len(units))
            out += [np.fromiter(chain.from_iterable(ids), np.int64, int(size.sum())), size]
        return tuple(out)

    def _same_bytes(self, units: list[bytes], flat_b: np.ndarray, n_b: np.ndarray) -> np.ndarray:
        """Whether the B tokens of each unit join to the unit."""
        joined, ends = binary_parts(self.b_bytes.take(pa.array(flat_b)))
        ends = ends[np.concatenate([[0], np.cumsum(n_b)])]
        size = np.fromiter(map(len, units), np.int64, len(units))
        if np.array_equal(np.diff(ends), size) and np.array_equal(joined, np.frombuffer(b"".join(units), np.uint8)):
            return np.ones(len(units), bool)
        raw, ends = joined.tobytes(), ends.tolist()
        return np.fromiter((raw[a:b] == u for a, b, u in zip(ends[:-1], ends[1:], units, strict=True)),
                           bool, len(units))

    def _digest(self, flat_a, flat_b, cut_a, cut_b, n_tokens) -> tuple[np.ndarray, np.ndarray]:
        """Every group as ``a1,a2|b1,b2;``: the bytes of all units, and how many each has."""
        last_a, last_b = np.zeros(len(flat_a), np.int64), np.zeros(len(flat_b), np.int64)
        last_a[cut_a], last_b[cut_b] = 1, 1
        before_a = np.cumsum(last_a) - last_a  # the token's group
        before_b = np.cumsum(last_b) - last_b
        order = np.empty(len(flat_a) + len(flat_b), np.int64)
        order[np.arange(len(flat_a)) + np.concatenate([[0], cut_b + 1])[before_a]] = 2 * flat_a + last_a
        order[np.arange(len(flat_b)) + (cut_a + 1)[before_b]] = 2 * (len(self.a_size) + flat_b) + last_b
        raw, ends = binary_parts(self.id_texts.take(pa.array(order)))
        return raw, np.diff(ends[np.concatenate([[0], np.cumsum(n_tokens)])])


def _ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices start[k] .. start[k] + size[k] - 1 for every k."""
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


def _planes(values: np.ndarray) -> bytes:
    """4-byte numbers as byte planes (the high planes are mostly zeros and compress away)."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplaned(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(4, -1).T.copy().view("<u4").reshape(-1).astype(np.int64)


def code_batch(aligner: Aligner, texts) -> dict[str, object]:
    """Counts, digest and packed links of every text; ``pairs``/``counts``: the batch's
    distinct pairs, ascending, with their links. A text's ``links`` are the positions of its
    distinct pairs there (as differences), then how many links it has of each."""
    raw, offsets = utf8(texts)
    size = np.diff(offsets)
    n = len(size)
    full = np.flatnonzero(size)  # empty texts have no unit
    spaced = np.full(len(raw) + len(full), 0x20, np.uint8)
    begin = np.concatenate([[0], np.cumsum(size[full] + 1)]).astype(np.int64)
    spaced[np.delete(np.arange(len(spaced)), begin[:-1])] = raw
    starts = unit_cuts(spaced, begin)
    of_text = np.searchsorted(begin, starts, side="right") - 1
    units = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts),
        [None, pa.py_buffer(np.append(starts, len(spaced)).astype(np.int64)), pa.py_buffer(spaced)])
    coded = units.dictionary_encode()
    row = aligner.rows(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)]
    per_text = np.bincount(of_text, minlength=len(full))
    good = np.bincount(of_text, aligner.ok[row], minlength=len(full)) == per_text
    keep = good[of_text]
    row, of_text = row[keep], of_text[keep]
    sums = {}
    for name, values in (("n_a", aligner.n_a), ("n_b", aligner.n_b), ("n_groups", aligner.n_groups)):
        out = np.zeros(n, np.int64)
        out[full] = np.bincount(of_text, values[row], minlength=len(full))
        sums[name] = out
    digest = [""] * n
    raw, ends = aligner.digests(row)
    ends = ends[np.concatenate([[0], np.cumsum(np.where(good, per_text, 0))])].tolist()
    for k, a, b in zip(full.tolist(), ends[:-1], ends[1:], strict=True):
        if b > a:
            digest[k] = hashlib.sha256(raw[a:b - 1]).hexdigest()
    used = np.unique(row)
    held = _ragged(aligner.first_pair[used], aligner.n_groups[used].astype(np.int64))
    pairs, place = np.unique(aligner.pairs[held], return_inverse=True)
    first = np.zeros(len(aligner.n_groups), np.int64)  # of a unit's places in ``place``
    first[used] = np.cumsum(aligner.n_groups[used]) - aligner.n_groups[used]
    groups = aligner.n_groups[row].astype(np.int64)
    link = place[_ragged(first[row], groups)]
    key = np.repeat(of_text.astype(np.int64), groups) * max(len(pairs), 1) + link
    key, times = np.unique(key, return_counts=True)
    text, link = np.divmod(key, max(len(pairs), 1))
    counts = np.bincount(link, times, minlength=len(pairs)).astype(np.int64)
    bounds = np.searchsorted(text, np.arange(len(full) + 1)).tolist()
    links: list[bytes] = [b""] * n
    for k, a, b in zip(full.tolist(), bounds[:-1], bounds[1:], strict=True):
        if b > a:
            links[k] = _planes(np.concatenate([np.diff(link[a:b], prepend=0), times[a:b]]))
    return sums | {"n_links": sums["n_groups"], "groups_sha256": digest, "links": links,
                   "pairs": pairs, "counts": counts}


def unpack_links(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(places of a text's distinct pairs, links of each)."""
    both = _unplaned(raw)
    half = len(both) // 2
    return np.cumsum(both[:half]), both[half:]


_ALIGNERS: dict[int, Aligner] = {}


def _aligner(a_json: str, b_model: bytes) -> Aligner:
    """The worker's aligner (kept between tasks of the same worker)."""
    key = hash((a_json, b_model))
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(a_json, b_model)
    return _ALIGNERS[key]


def _bundles(batches):
    """Arrow batches of about BATCH_BYTES of text (one longer text comes alone)."""
    held, size = [], 0
    for b in small_batches(batches, limit=BATCH_BYTES // 2):
        new = pc.sum(pc.binary_length(one_array(b["text"]))).as_py() or 0
        if held and size + new > BATCH_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
        held.append(b)
        size += new
    if held:
        yield pa.Table.from_batches(held)


def coded(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """A row per text with its counts and packed links, and a row per batch (``pairs`` not
    null) with the batch's pairs."""
    spark = docs.sparkSession
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        vocabularies = spark.sparkContext.broadcast((a.read(), b.read()))  # files of a few MB

    def run(batches):
        aligner = None
        for number, table in enumerate(_bundles(batches)):
            aligner = aligner or _aligner(*vocabularies.value)
            out = code_batch(aligner, table["text"])
            grp = (TaskContext.get().partitionId() << 32) | number
            n = table.num_rows
            lists = {c: pa.array([None] * n + [out.pop(c)], pa.list_(pa.int64())) for c in ("pairs", "counts")}
            out["links"] = pa.array([*out["links"], None], pa.binary())
            out["groups_sha256"] = pa.array([*out["groups_sha256"], None], pa.string())
            out |= {c: pa.array([*out[c].tolist(), None], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")}
            out["doc_id"] = pa.concat_arrays([one_array(table["doc_id"], pa.int64()), pa.nulls(1, pa.int64())])
            out["grp"] = pa.array(np.full(n + 1, grp), pa.int64())
            order = [c.split()[0] for c in CODED.split(", ")]
            yield pa.RecordBatch.from_pydict({c: out.get(c, lists.get(c)) for c in order})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
                       ).mapInArrow(run, CODED)


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """One row per document: token, group and link counts, the digest of its groups, and its
    links measured against the corpus-wide pair counts."""
    import public_tokenizers

    rows = written(coded(docs, a_path or public_tokenizers.path("byte_bpe_50k.json"),
                         b_path or public_tokenizers.path("piece_bpe_32k.model")), "aligned")
    held = (rows.filter(F.col("pairs").isNotNull())
            .select("grp", F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
            .select("grp", F.col("p.pairs").alias("pair"), F.col("p.counts").alias("n")))
    total = held.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF))
    best = total.groupBy("b").agg(F.max("total").alias("best"))
    total = total.join(best, "b").select("pair", "total", (F.col("total") == F.col("best")).alias("is_best"))
    answers = held.select(F.col("grp").alias("to_grp"), "pair").join(total, "pair")
    texts = rows.filter(F.col("pairs").isNull()).drop("pairs", "counts")

    def close(left: pa.Table, right: pa.Table) -> pa.Table:
        order = np.argsort(right["pair"].to_numpy(), kind="stable")
        total = right["total"].to_numpy()[order]
        is_best = right["is_best"].to_numpy()[order]
        n_best, count_sum = [], []
        raw, off = binary_parts(left["links"])
        for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
            place, times = unpack_links(raw[a:b].tobytes())
            n_best.append(int(times[is_best[place]].sum()))
            count_sum.append(int((times * total[place]).sum()))
        out = {c: left[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        return pa.table(out | {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64()),
                               "groups_sha256": left["groups_sha256"]})

    return texts.groupBy("grp").cogroup(answers.groupBy("to_grp")).applyInArrow(close, RESULT)
