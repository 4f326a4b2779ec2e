"""Operator 3, language-model scoring: a hidden Markov model over the corpus's tokens.

Tokens are the words of a text (A-Z as a-z) and one end. The model has ``STATES`` latent
states that emit words and the end. A state emits a word with the probability (expected
count + 1 / STATES) / (its expected tokens + (words + 1) / STATES): the states share one added
count a word, so that the emissions grow with the vocabulary and the remaining 1 / STATES
stands for an unseen word. Baum-Welch: in each iteration every document group runs scaled
forward-backward over all its training texts (in segments of ``SEGMENT`` tokens) and sends one
expected count per distinct word and state to the word's bucket, which sums them and answers
the groups. Iterations start from each word's count, split by its hash, and go on until the
likelihood gains at most the share ``SETTLED``. Counts are whole units of 1 / ``UNIT``, and
a word's add up to its count exactly. The scaled forward recursion over the whole token
sequence gives a text's exact likelihood.

Defined cases: a null or empty text is the end alone. A null doc_id is in the training
part. Repeated rows count as often as they occur. Without any training text every word and
the end have probability 1.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.exchange import _packed, _unpacked, grouped, plan_sizes
from gridmart.llm.scratch import collected, dropped, shared_path, written
from gridmart.llm.textops import U64, Words, binary_parts, mix64

STATES, SEGMENT = 6, 256
RESCALED = 8  # steps whose probabilities stay within a double together
CLASSES = 1024  # symbols of a start model without a vocabulary
SETTLED = 1e-4
HELD_MOD, HELD_REST = 7, 2
GROUP_BYTES, LEAST_GROUPS, BATCH = 8 << 20, 24, 1 << 19
UNIT = 1 << 12
ENCODED = "grp int, ids array<bigint>, held array<boolean>, size binary, keys binary, rank binary, seq binary, counts binary"
SENT = "bucket int, grp int, keys binary, vals binary, stats binary"
ANSWER = "bucket int, grp int, vals binary, stats binary"


def held_out(mod: int, rest: int):
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(crc % mod == rest, F.lit(False))


class Model:
    """Start, transition and emission probabilities (states x symbols, the end last)."""

    def __init__(self, start, move, emit):
        self.start, self.move, self.emit = start, move, emit

    @staticmethod
    def initial(seed: int = 7) -> Model:
        rng = np.random.default_rng(seed)
        emit = rng.dirichlet(np.full(CLASSES + 1, 2.0), STATES)
        move = rng.dirichlet(np.full(STATES, 1.0), STATES) * 0.3 + np.eye(STATES) * 0.7
        return Model(np.full(STATES, 1 / STATES), move, emit)

    @staticmethod
    def from_counts(counts: np.ndarray) -> Model:
        """Maximum likelihood with a small prior on every cell."""
        k, rest = STATES, counts
        start, rest = rest[:k] + 1e-2, rest[k:]
        move, emit = rest[:k * k].reshape(k, k) + 1e-2, rest[k * k:].reshape(k, -1) + 1e-2
        return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))


def _by_length(classes: np.ndarray, offsets: np.ndarray):
    """(order, symbols step by step, first column of each step), longest sequence first: a step's
    columns are the sequences that reach it."""
    size = np.diff(offsets)
    order = np.argsort(-size, kind="stable")
    size, begin = size[order], offsets[:-1][order]
    steps = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(steps), side="left")
    cols = np.concatenate([[0], np.cumsum(active)]).astype(np.int64)
    step = np.repeat(np.arange(steps), active)
    at = begin[np.arange(cols[-1]) - cols[:-1][step]] + step
    return order, classes[at], cols


def expected_counts(model: Model, classes: np.ndarray, offsets: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """E-step over a batch of sequences; ``opens``: the sequence starts its text."""
    return _expected(model, classes, offsets, opens)[0]


def _expected(model: Model, classes: np.ndarray, offsets: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, float]:
    """``expected_counts`` and the log10 likelihood of the sequences. States are rows and tokens
    columns, so that every step works on long contiguous runs. Columns are scaled to sum 1 in each
    ``RESCALED``-th step and in a sequence's last one."""
    order, x, cols = _by_length(classes, offsets)
    k, cells, last = STATES, model.emit.shape[1], len(cols) - 2
    total = np.zeros(k + k * k + k * cells)
    if last < 0:
        return total, 0.0
    emit, likelihood = _emitted(model, x), 0.0
    alpha = np.empty_like(emit)
    forward, back = np.ascontiguousarray(model.move.T), np.ascontiguousarray(model.move)
    bounds = cols.tolist()
    for t in range(last + 1):
        a, b = bounds[t], bounds[t + 1]
        if t:
            p = bounds[t - 1]
            np.matmul(forward, alpha[:, p:p + b - a], out=alpha[:, a:b])
            alpha[:, a:b] *= emit[:, a:b]
        else:
            np.multiply(model.start[:, None], emit[:, :b], out=alpha[:, :b])
        if t % RESCALED != RESCALED - 1:  # only what ends here
            a += bounds[t + 2] - b if t < last else 0
        if a < b:
            s = np.add.reduce(alpha[:, a:b], axis=0)
            likelihood += float(np.log10(s).sum())
            r = 1 / s
            alpha[:, a:b] *= r
            emit[:, a:b] *= r
    moves, beta = np.zeros((k, k)), np.ones((k, bounds[1]))
    for t in range(last, 0, -1):
        a, b, p = bounds[t], bounds[t + 1], bounds[t - 1]
        after, before = emit[:, a:b], alpha[:, p:p + b - a]
        after *= beta[:, :b - a]
        moves += before @ after.T
        np.matmul(back, after, out=beta[:, :b - a])
        before *= beta[:, :b - a]
    total[:k] = alpha[:, :bounds[1]][:, opens[order]].sum(1)
    total[k:k + k * k] = (moves * model.move).ravel()
    total[k + k * k:] = np.concatenate([np.bincount(x, alpha[s], cells) for s in range(k)])
    return total, likelihood


def _emitted(model: Model, x: np.ndarray) -> np.ndarray:
    """Emission probabilities of the symbols ``x``, a row per state."""
    out = np.empty((STATES, len(x)))
    for s in range(STATES):
        np.take(model.emit[s], x, out=out[s], mode="clip")
    return out


def log10_likelihood(model: Model, classes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """log10 probability of each sequence, by the scaled forward recursion."""
    order, x, cols = _by_length(classes, offsets)
    emit, scale = _emitted(model, x), np.empty(len(x))
    forward = np.ascontiguousarray(model.move.T)
    bounds = cols.tolist()
    alpha = model.start[:, None]
    for t, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        alpha = (forward @ alpha[:, :b - a] if t else alpha) * emit[:, a:b]
        s = np.add.reduce(alpha, axis=0, out=scale[a:b])
        alpha *= 1 / s
    out = np.zeros(len(offsets) - 1)
    column = np.arange(len(x)) - np.repeat(cols[:-1], np.diff(cols))
    out[order] = np.bincount(column, np.log10(scale), len(out))
    return out


def _sequences(words: Words, symbols: np.ndarray, end: int):
    """Symbols with ``end`` after each text, and the texts' offsets."""
    offsets = words.first + np.arange(words.n_docs + 1)
    seq = np.full(len(symbols) + words.n_docs, end, np.int64)
    seq[np.arange(len(symbols)) + words.doc()] = symbols
    return seq, offsets


def _segments(offsets: np.ndarray):
    """Offsets of the pieces of at most SEGMENT tokens, and whether a piece opens its text."""
    n = np.diff(offsets)
    parts = -(-n // SEGMENT)
    doc = np.repeat(np.arange(len(n)), parts)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
    return np.append(offsets[:-1][doc] + k * SEGMENT, offsets[-1]), k == 0


class Sums:
    """Corpus sums of an iteration: openings, moves, end and all tokens per state (in units of
    1 / UNIT), the log10 likelihood (likewise) and the number of distinct training words."""

    SIZE = STATES * (STATES + 3) + 2

    def __init__(self, cells: np.ndarray):
        k = STATES
        self.start, self.move = cells[:k] / UNIT, cells[k:k + k * k].reshape(k, k) / UNIT
        self.end, self.tokens = cells[k + k * k:-2].reshape(2, k)
        self.likelihood, self.words = cells[-2] / UNIT, int(cells[-1])
        self.n_train = int(self.end.sum()) // UNIT
        self.n, self.v = int(self.tokens.sum()) // UNIT, self.words + (self.n_train > 0)

    def model(self, counts: np.ndarray) -> Model:
        """The model of the words with these expected counts (words x states), the end last."""
        start, move = (self.start, self.move) if self.n else (np.ones(STATES), np.ones((STATES, STATES)))
        emit = np.concatenate([counts, self.end[None, :]]) / UNIT + 1 / STATES
        emit /= self.tokens / UNIT + (self.v + 1) / STATES
        start, move = start + 1e-2, move + 1e-2
        return Model(start / start.sum(), move / move.sum(1, keepdims=True), np.ascontiguousarray(emit.T))


def _whole(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Non-negative ``counts`` (words x states) as whole units that add up to each word's total."""
    out = np.floor(counts * UNIT).astype(np.int64)
    at = np.argmax(out, axis=1)
    out[np.arange(len(out)), at] += total * UNIT - out.sum(1)
    return out


def _packed_rows(rows: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Rows of STATES numbers, one binary value per slice: a byte says how many byte planes the
    slice's largest number needs, then these planes, one state after the other."""
    out = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        flat = np.ascontiguousarray(rows[a:b].T).view(np.uint64).reshape(-1)
        planes = max(1, -(-int(flat.max(initial=0)).bit_length() // 8))
        out.append(bytes([planes]) + flat.view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes())
    return pa.array(out, pa.binary())


def _unpacked_rows(column) -> np.ndarray:
    raw, off = binary_parts(column)
    parts = [np.zeros((0, STATES), np.int64)]
    for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        planes = raw[a + 1:b].reshape(raw[a], -1)
        flat = np.zeros((planes.shape[1], 8), np.uint8)
        flat[:, :len(planes)] = planes.T
        parts.append(flat.view(np.int64).reshape(STATES, -1).T)
    return np.concatenate(parts)


def _planes(numbers: np.ndarray) -> pa.Array:
    """One binary value of 4-byte numbers, byte planes apart (see ``exchange._packed``)."""
    return pa.array([np.ascontiguousarray(numbers, "<i4").view(np.uint8).reshape(-1, 4).T.tobytes()], pa.binary())


def _numbers(column) -> np.ndarray:
    raw = np.frombuffer(column.combine_chunks()[0].as_buffer(), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<i4").reshape(-1)


def _group(grp: int, table: pa.Table) -> pa.Table:
    """One row: the texts as numbers of words (the group's most frequent first, the end last) with
    their ids and sizes, the distinct words in the order of their hashes, the number of each, and
    how often each word and the end occur in the training texts."""
    words = Words(table["text"])
    own, symbols = np.unique(words.hashes(fold_case=True), return_inverse=True)
    rank = np.empty(len(own), np.int64)
    rank[np.argsort(-np.bincount(symbols, minlength=len(own)), kind="stable")] = np.arange(len(own))
    seq, offsets = _sequences(words, rank[symbols], len(own))
    size = np.diff(offsets)
    held = table["held_out"].combine_chunks()
    trains = ~np.asarray(held.to_numpy(zero_copy_only=False), bool)
    counts = np.bincount(seq[np.repeat(trains, size)], minlength=len(own) + 1)[np.append(rank, len(own))]
    whole = pa.array([0, table.num_rows], pa.int32())
    one = np.zeros(2, np.int64)
    keys, counts = (_packed([x], one + [0, len(x)])[0] for x in (own, counts))
    return pa.table({
        "grp": pa.array([grp], pa.int32()), "ids": pa.ListArray.from_arrays(whole, table["doc_id"].combine_chunks()),
        "held": pa.ListArray.from_arrays(whole, held), "size": _planes(size), "keys": keys, "rank": _planes(rank),
        "seq": _planes(seq), "counts": counts})


def _encoded(dealt: DataFrame) -> DataFrame:
    return dealt.groupBy("grp").applyInArrow(lambda key, table: _group(key[0].as_py(), table), ENCODED)


def _kept(encoded: DataFrame, n_groups: int) -> DataFrame:
    """``encoded`` as a table in the shared folder, in buckets by group: the answers of every round
    come to the groups, which are not shuffled themselves."""
    spark = encoded.sparkSession
    name = f"hmm_groups_{uuid.uuid4().hex}"
    (encoded.write.option("path", shared_path(spark, name)).option("compression", "zstd")
     .bucketBy(n_groups, "grp").saveAsTable(name))
    kept = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files are outside of the warehouse
    return kept


def _sent(table, counts: np.ndarray, stats: np.ndarray, shift: int) -> pa.Table:
    """A group's expected counts per bucket; its sums go with the first."""
    keys, grp = _unpacked(table["keys"], np.uint64)[0], table["grp"][0].as_py()
    bucket = (keys >> U64(shift)).astype(np.int64) if len(keys) else np.zeros(0, np.int64)
    cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(keys)).astype(np.int64)
    at = bucket[cuts[:-1]]
    if not len(keys):  # the sums of empty texts still count
        at, cuts = np.array([grp % (1 << (64 - shift))]), np.zeros(2, np.int64)
    k, = _packed([keys], cuts)
    return pa.table({"bucket": at.astype(np.int32), "grp": np.full(len(at), grp, np.int32), "keys": k,
                     "vals": _packed_rows(counts, cuts),
                     "stats": pa.array([stats.tobytes()] + [None] * (len(at) - 1), pa.binary())})


def _start(encoded: DataFrame, shift: int) -> DataFrame:
    """Each word's count split over the states by the word's hash."""

    def split(counts, keys):
        noise = [mix64(keys + U64((s + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) >> U64(11) for s in range(STATES)]
        share = 0.5 + np.stack(noise, 1).astype(float) / 2 ** 53
        return _whole(counts[:, None] * (share / share.sum(1, keepdims=True)), counts)

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = pa.Table.from_batches([b.slice(i, 1)])
                keys, counts = _unpacked(row["keys"], np.uint64)[0], _unpacked(row["counts"], np.int64)[0]
                rows = split(counts, np.append(keys, U64(0)))
                stats = np.zeros(Sums.SIZE, np.int64)
                stats[-2 - 2 * STATES:-2] = np.concatenate([rows[-1], rows.sum(0)])
                yield from _sent(row, rows[:-1], stats, shift).to_batches()

    return encoded.mapInArrow(run, SENT)


def _iteration(encoded: DataFrame, answers: DataFrame, sums: Sums, shift: int) -> DataFrame:
    """Expected counts of every group's training texts under the model of ``answers``."""

    def step(key, left, right):
        if not left.num_rows:
            return pa.table({c.split()[0]: [] for c in SENT.split(", ")})
        counts, rank = _unpacked(left["counts"], np.int64)[0], _numbers(left["rank"])
        model, seq, size = _coded(left, right, sums)
        trains = ~np.asarray(left["held"].combine_chunks().flatten().to_numpy(zero_copy_only=False), bool)
        seq = seq[np.repeat(trains, size)]
        cuts, opens = _segments(np.concatenate([[0], np.cumsum(size[trains])]))
        total, likelihood = np.zeros(STATES * (STATES + 1 + len(counts))), 0.0
        parts = np.searchsorted(cuts, np.append(np.arange(0, len(seq), BATCH), len(seq)))
        for a, b in zip(parts[:-1], parts[1:], strict=True):
            part, at = seq[cuts[a]:cuts[b]].astype(np.int64), cuts[a:b + 1] - cuts[a]
            found = _expected(model, part, at, opens[a:b])
            total += found[0]
            likelihood += found[1]
        k = STATES
        rows = _whole(total[k + k * k:].reshape(k, -1).T[np.append(rank, len(rank))], counts)
        small = np.append(total[:k + k * k], likelihood) * UNIT
        stats = np.concatenate([np.round(small[:-1]), rows[-1], rows.sum(0), np.round(small[-1:]), [0]])
        return _sent(left, rows[:-1], stats.astype(np.int64), shift)

    right = answers.filter("grp >= 0").drop("stats").groupBy("grp")
    return encoded.groupBy("grp").cogroup(right).applyInArrow(step, SENT)


def _coded(group: pa.Table, answers: pa.Table, sums: Sums) -> tuple[Model, np.ndarray, np.ndarray]:
    """The model of a group's words by their numbers, its texts as numbers, and their sizes."""
    own, rank = _own(answers), _numbers(group["rank"])
    counts = np.empty_like(own)
    counts[rank] = own
    return sums.model(counts), _numbers(group["seq"]), _numbers(group["size"]).astype(np.int64)


def _own(answers: pa.Table) -> np.ndarray:
    """A group's answers as expected counts of its words, in the order of their hashes."""
    return _unpacked_rows(answers.sort_by("bucket")["vals"])


def _answered(sent: DataFrame) -> DataFrame:
    """Every group's words with their corpus-wide expected counts, and as group -1 the sums."""

    def reduce(key, table):
        keys, size = _unpacked(table["keys"], np.uint64)
        rows = _unpacked_rows(table["vals"])
        order = np.argsort(keys, kind="stable")
        new = np.diff(keys[order], prepend=~keys[order[:1]]) != 0
        total = np.add.reduceat(rows[order], np.flatnonzero(new), axis=0) if len(keys) else rows
        at = np.empty(len(keys), np.int64)
        at[order] = np.cumsum(new) - 1
        cuts = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        stats = np.zeros(Sums.SIZE, np.int64)
        for s in table["stats"].drop_null():
            stats += np.frombuffer(s.as_buffer(), np.int64)
        stats[-1] = np.count_nonzero(total.sum(1))
        bucket = key[0].as_py()
        return pa.table({"bucket": pa.array([bucket] * (len(size) + 1), pa.int32()),
                         "grp": pa.array([*table["grp"].to_pylist(), -1], pa.int32()),
                         "vals": pa.concat_arrays([_packed_rows(total[at], cuts), pa.nulls(1, pa.binary())]),
                         "stats": pa.array([None] * len(size) + [stats.tobytes()], pa.binary())})

    return sent.groupBy("bucket").applyInArrow(reduce, ANSWER)


def _sums(answers: DataFrame) -> Sums:

    def run(batches):
        out = np.zeros(Sums.SIZE, np.int64)
        for b in batches:
            for s in b["stats"]:
                out += np.frombuffer(s.as_buffer(), np.int64)
        yield pa.RecordBatch.from_pydict({"cell": np.arange(Sums.SIZE), "n": out})

    rows = (answers.filter("grp = -1").select("stats").mapInArrow(run, "cell long, n long")
            .groupBy("cell").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(Sums.SIZE, np.int64)
    for r in rows:
        out[r.cell] = r.n
    return Sums(out)


def train(dealt: DataFrame, n_groups: int, n_buckets: int) -> tuple[Sums, DataFrame, DataFrame]:
    """Baum-Welch iterations over all training texts until the likelihood settles: the last
    sums, the coded groups, and every group's words with their expected counts."""
    shift = 64 - int(np.log2(n_buckets))
    encoded = _kept(_encoded(dealt), n_groups)
    collected(encoded.sparkSession)  # the texts' shuffle: from here on only the coded groups are read
    answers = written(_answered(_start(encoded, shift)), "expected-counts", "zstd")
    sums = _sums(answers)
    # The first sums have no moves yet: the next state follows with 0.7, or else any.
    sums.start, sums.move = np.ones(STATES), 0.3 / STATES + np.roll(np.eye(STATES), 1, axis=1) * 0.7
    before = None
    while sums.n:
        collected(encoded.sparkSession)
        last, answers = answers, written(_answered(_iteration(encoded, answers, sums, shift)), "expected-counts", "zstd")
        dropped(last)
        sums = _sums(answers)
        if before is not None and sums.likelihood - before <= SETTLED * abs(before):
            break
        before = sums.likelihood
    return sums, encoded, answers


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per document."""
    docs = docs.select("doc_id", "text").withColumn("held_out", held_out(HELD_MOD, HELD_REST))
    n_groups, n_buckets = plan_sizes(docs, GROUP_BYTES, LEAST_GROUPS)
    sums, encoded, answers = train(grouped(docs, n_groups), n_groups, n_buckets)
    log_base = np.log10(sums.n + sums.v + 1)

    def close(key, left, right):
        model, seq, size = _coded(left, right, sums)
        seq = seq.astype(np.int64)
        c = np.empty(model.emit.shape[1], np.int64)
        c[_numbers(left["rank"])], c[-1] = _own(right).sum(1) // UNIT, sums.n_train
        offsets = np.concatenate([[0], np.cumsum(size)])
        known, logs = ((v[seq]) for v in ((c > 0).astype(np.int64), np.log10(c + 1.0)))
        return pa.table({
            "doc_id": left["ids"].combine_chunks().flatten(), "held_out": left["held"].combine_chunks().flatten(),
            "n_tokens": size, "n_known": np.add.reduceat(known, offsets[:-1]),
            "train_tokens": np.full(len(size), sums.n, np.int64),
            "base_score": np.add.reduceat(logs, offsets[:-1]) - size * log_base,
            "score": log10_likelihood(model, seq, offsets)})

    schema = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
              "base_score double, score double")
    right = answers.filter("grp >= 0").drop("stats").groupBy("grp")
    return encoded.groupBy("grp").cogroup(right).applyInArrow(close, schema)
