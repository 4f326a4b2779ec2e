"""Operator 2, quality classifier: random-indexing word vectors and a two-layer network.

Every word has a sparse random index vector (a few +1/-1 cells fixed by its hash). Over all
documents, each word's context vector is the sum of its neighbours' index vectors; the same
is done for word shapes (runs of capitals, letters, digits and each punctuation sign). Rows
are hashed into tables of ``ROWS`` per channel, so the tables have a fixed size; partitions
add up their own part and Spark sums the parts block by block. A document is the mean of
its words' vectors and of its shapes' vectors with a few pooled figures on repetition and
length. A two-layer numpy network learns ``labels.quality`` from a sample of at most
``MAX_LABELLED`` labelled documents (lowest hash of doc_id); its temperature is calibrated
on a part of the sample that the weights have not seen.

Defined cases: a null or empty text has all features 0 and still gets a score. Labels other
than 0 and 1 are not used; of several labels of one doc_id the largest counts. Without
labels of both kinds every score is the labelled share of 1, or 0.5. A null doc_id is not
held out. Rows are scored one by one, so repeated rows get equal scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.hmm_lm import held_out
from gridmart.llm.textops import U64, Words, mix64, rolling_hashes, runs, small_batches, window_index

ROWS, DIM, NONZERO = 1 << 13, 32, 4
BLOCKS = 32
MAX_LABELLED = 20_000
THRESHOLD = 0.7
HELD_MOD, HELD_REST = 4, 2
_SHAPE = np.arange(256)
_SHAPE[ord("a"):ord("z") + 1] = _SHAPE[0x80:] = ord("a")
_SHAPE[ord("A"):ord("Z") + 1] = ord("A")
_SHAPE[ord("0"):ord("9") + 1] = ord("0")


def _shape_hashes(words: Words) -> np.ndarray:
    """A hash of each word's shape: its byte classes with repeats collapsed."""
    n = len(words.start)
    if not n:
        return np.zeros(0, U64)
    code = _SHAPE[words.data].astype(U64)
    opens = np.zeros(len(code), bool)
    opens[words.start] = True
    keep = opens | (code != np.concatenate([[U64(0)], code[:-1]]))
    # Of each run of a class: the class and the one before it, so that order matters.
    before = np.where(opens, U64(0), np.concatenate([[U64(0)], code[:-1]]))
    term = np.where(keep, mix64(code * U64(257) + before), U64(0))
    total = np.concatenate([np.zeros(1, U64), np.cumsum(term, dtype=U64)])
    return mix64(total[words.end] - total[words.start])


def _channels(words: Words):
    """(row in the table, hash) of every word, for words and for shapes."""
    out = []
    for c, h in enumerate((words.hashes(fold_case=True), _shape_hashes(words))):
        out.append(((h & U64(ROWS - 1)).astype(np.int64) + c * ROWS, h))
    return out


def _add_contexts(total: np.ndarray, words: Words) -> None:
    """Add to every word's row the index vectors of the words before and after it."""
    n = len(words.start)
    if n < 2:
        return
    doc = words.doc()
    pair = np.flatnonzero(doc[1:] == doc[:-1])
    for row, h in _channels(words):
        for k in range(NONZERO):
            bits = mix64(h + U64((k + 1) * 0xA24BAED4963EE407 % (1 << 64)))
            cell = (bits & U64(DIM - 1)).astype(np.int64)
            sign = np.where(bits >> U64(63), 1.0, -1.0)
            for a, b in ((pair, pair + 1), (pair + 1, pair)):
                total += np.bincount(row[a] * DIM + cell[b], sign[b], len(total))


def context_vectors(docs: DataFrame) -> np.ndarray:
    """(2 * ROWS) x DIM context vectors over all documents, centred, of unit length."""
    cells = 2 * ROWS * DIM
    size = cells // BLOCKS

    def part(batches):
        total = np.zeros(cells)
        for b in small_batches(batches):
            _add_contexts(total, Words(b["text"]))
        raw = np.round(total).astype("<i8").reshape(BLOCKS, size)
        salt = TaskContext.get().partitionId() // 64
        yield pa.RecordBatch.from_pydict({"block": np.arange(BLOCKS), "salt": np.full(BLOCKS, salt),
                                          "sums": pa.array([r.tobytes() for r in raw], pa.binary())})

    def add(key, table):
        total = np.zeros(size, np.int64)
        for chunk in table["sums"].chunks:
            for v in chunk:
                total += np.frombuffer(v.as_buffer(), "<i8")
        return pa.table({"block": [key[0].as_py()], "salt": [0], "sums": pa.array([total.tobytes()], pa.binary())})

    schema = "block long, salt long, sums binary"
    parts = docs.select("text").mapInArrow(part, schema)
    sums = parts.groupBy("block", "salt").applyInArrow(add, schema).groupBy("block").applyInArrow(add, schema)
    total = np.zeros((BLOCKS, size))
    for r in sums.collect():  # BLOCKS rows of a fixed size
        total[r.block] = np.frombuffer(r.sums, "<i8")
    vectors = total.reshape(2, ROWS, DIM)
    norm = np.linalg.norm(vectors, axis=2, keepdims=True)
    unit = vectors / np.maximum(norm, 1e-9)
    unit -= (unit.sum(1, keepdims=True) / np.maximum((norm > 0).sum(1, keepdims=True), 1)) * (norm > 0)
    return unit.reshape(2 * ROWS, DIM).astype(np.float32)


def features(texts, vectors: np.ndarray) -> np.ndarray:
    """One row of pooled features per text."""
    words = Words(texts)
    n = np.maximum(words.count, 1)[:, None]
    pooled = []
    for row, _ in _channels(words):
        step = 1 << 18
        total = np.zeros((words.n_docs, DIM))
        for a in range(0, len(row), step):  # bounded memory for very long texts
            part = vectors[row[a:a + step]].astype(np.float64)
            doc = np.searchsorted(words.first, np.arange(a, a + len(part)), side="right") - 1
            start = runs(doc)
            total[doc[start]] += np.add.reduceat(part, start) if len(start) else 0
        pooled.append(total / n)
    h = words.hashes(fold_case=True)
    figures = []
    for width in (1, 3):
        at = window_index(words, width)
        keys = rolling_hashes(h, width)[at] if len(at) else np.zeros(0, U64)
        count = np.maximum(words.count - width + 1, 0)
        doc = np.repeat(np.arange(words.n_docs), count)
        keys = mix64(keys + doc.astype(U64) * U64(0x9E3779B97F4A7C15))
        order = np.argsort(keys)
        distinct = np.bincount(doc[order][runs(keys[order])], minlength=words.n_docs) if len(keys) else 0 * count
        figures.append(distinct / np.maximum(count, 1))
    size = np.diff(words.offsets) / np.maximum(words.count, 1)
    figures += [np.log1p(words.count) / 5, np.minimum(size, 30) / 10]
    return np.hstack([*pooled, np.stack(figures, 1)])


class Network:
    """Two layers: tanh hidden units, one logit, divided by a temperature."""

    def __init__(self, hidden: int = 24, seed: int = 11):
        self.hidden, self.seed, self.temperature, self.constant = hidden, seed, 1.0, None

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 600, batch: int = 512) -> Network:
        if len(y) < 20 or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.5
            return self
        rng = np.random.default_rng(self.seed)
        self.mean, self.std = x.mean(0), x.std(0) + 1e-3
        z = (x - self.mean) / self.std
        y = 0.01 + 0.98 * y  # labels may be wrong; no score is certain
        order = rng.permutation(len(y))
        kept, other = order[len(y) // 5:], order[:len(y) // 5]
        w = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], self.hidden)), np.zeros(self.hidden),
             rng.normal(0, 1 / np.sqrt(self.hidden), self.hidden), np.zeros(1)]
        m, v = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
        for step in range(1, steps + 1):
            pick = rng.choice(kept, min(batch, len(kept)), replace=False)
            a = np.tanh(z[pick] @ w[0] + w[1])
            p = 1 / (1 + np.exp(-(a @ w[2] + w[3])))
            d = (p - y[pick]) / len(pick)
            da = np.outer(d, w[2]) * (1 - a * a)
            grads = [z[pick].T @ da + 1e-4 * w[0], da.sum(0), a.T @ d + 1e-4 * w[2], np.array([d.sum()])]
            rate = 0.01 * min(1, 2 * (1 - step / (steps + 1)))
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        self.weights = w
        logits = self._logits(x[other])
        trials = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
        loss = [np.mean(np.logaddexp(0, logits / t) - y[other] * logits / t) for t in trials]
        self.temperature = float(trials[int(np.argmin(loss))])
        return self

    def _logits(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.tanh(((x - self.mean) / self.std) @ w[0] + w[1]) @ w[2] + w[3]

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self._logits(x) / self.temperature, -60, 60)))


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray) -> Network:
    usable = (labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
              .filter(~held_out(HELD_MOD, HELD_REST))
              .groupBy("doc_id").agg(F.max("quality").alias("y")))
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)

    def rows(batches):
        for b in small_batches(batches):
            f = features(b["text"], vectors)
            yield pa.RecordBatch.from_pydict({"doc_id": b["doc_id"], "y": b["y"],
                                              "f": pa.array([r.tobytes() for r in f], pa.binary())})

    # At most MAX_LABELLED ids, so the broadcast is bounded; of rows that repeat an id the smallest
    # text counts, so as many rows come back.
    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.max("y").cast("int").alias("y"))
    got = sorted(found.mapInArrow(rows, "doc_id long, y int, f binary").collect())
    if not got:
        return Network().fit(np.zeros((0, 1)), np.zeros(0))
    x = np.array([np.frombuffer(r.f) for r in got]).reshape(len(got), -1)
    return Network().fit(x, np.array([r.y for r in got], float))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted per document."""
    vectors = context_vectors(docs)
    network = train(docs, labels, vectors)
    model = docs.sparkSession.sparkContext.broadcast((vectors, network))  # 2 * ROWS * DIM floats

    def run(batches):
        table, net = model.value
        for b in small_batches(batches):
            p = net.probability(features(b["text"], table))
            yield pa.RecordBatch.from_pydict({"doc_id": b["doc_id"], "held_out": b["held_out"], "score": p,
                                              "predicted": (p >= THRESHOLD).astype(np.int32)})

    marked = docs.select("doc_id", "text").withColumn("held_out", held_out(HELD_MOD, HELD_REST))
    return marked.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
