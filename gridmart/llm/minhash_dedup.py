"""Operator 8, MinHash near-dedup: DartMinHash signatures and banded joins.

A document is a weighted set of five-word shingles, the weight is how often it occurs; two
documents are near duplicates when their weighted Jaccard similarity is 0.8 or more. A
document of fewer than five words has its whole word sequence as its only shingle.

DartMinHash: hashing throws darts of unit density into the plane weight x rank above every
element, the same darts whichever document holds it. The darts below an element's weight hit
the document; each has a rank and one of ``COORDINATES`` coordinates, and a coordinate keeps
the dart of lowest rank, so two documents agree in a coordinate with a probability of their
similarity. Rank bands are thrown upwards until the expected number of hits per document is
k ln k + 2 k and every coordinate is filled, so work hardly depends on the length. ``BANDS``
bands of ``BAND_ROWS`` coordinates miss a pair of similarity 0.8 with probability 5e-6.

Equal word sequences form one class before any join. A bucket's leader is the class with the
most bucket mates overall (in a group of copies that is the text they were made from). Every
class meets the leader with the most mates among its buckets; links are verified exactly and
give first components. A class that is not in a bucket's leader's component then meets the classes of other components in its buckets
that can still reach the similarity: with s the occurrences of shingles that some other
candidate has too, the overlap of x and y is at most min(s_x, s_y), so 0.8 needs
min(s_x, s_y) >= 4/9 (|x| + |y|). The join is on the bucket and a size class within that
bound, and on the agreement of the signatures' low bits (a pair of similarity 0.8 falls below
the least agreement with probability 5e-6); a pair meets only in the smallest of its common
buckets. Every pair of different components that shares a bucket is either compared or
excluded by a bound. A group of many near copies costs about one comparison per copy, where
copies that are too far from the original have too many shingles of their own.

Defined cases: null and empty texts, and texts without words, link with nothing. Rows that
share a doc_id but not a text are judged text by text. A null doc_id gets its component from
equal texts, else null, and is only compared by equality. Ties: the smallest doc_id
names the component. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.components import components
from gridmart.llm.exchange import combine, finish, grouped, lookup, plan_sizes, scatter, totals
from gridmart.llm.scratch import temporary, written
from gridmart.llm.textops import U64, Words, mix64, rolling_hashes, runs, small_batches, window_index

SHINGLE, SIMILARITY = 5, 0.8
BANDS, BAND_ROWS = 40, 6
COORDINATES = BANDS * BAND_ROWS
_EDGES = [0.0, 2.0**-6, 2.0**-4, 2.0**-2, *(2.0**k for k in range(-1, 40))]


def occurrences(words: Words, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every shingle occurrence: equal shingles of a document are told
    apart by their number, so weights become unit elements. Sorted by document, hash."""
    h = words.hashes()
    short = np.flatnonzero((words.count > 0) & (words.count < width))
    at = window_index(words, width)
    doc = np.repeat(np.arange(words.n_docs), np.maximum(words.count - width + 1, 0))
    value = rolling_hashes(h, width)[at] if len(at) else np.zeros(0, U64)
    whole = []
    for d in short:
        x = U64(0)
        for w in h[words.first[d]:words.first[d + 1]]:
            x = mix64(np.array([x ^ w], U64))[0]
        whole.append(x)
    doc = np.concatenate([doc, short])
    value = np.concatenate([value, np.array(whole, U64)])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    start = np.flatnonzero(np.concatenate([[True], (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])])
                           ) if len(doc) else np.zeros(0, np.int64)
    number = np.arange(len(doc)) - np.repeat(start, np.diff(np.append(start, len(doc))))
    return doc, mix64(value + number.astype(U64) * U64(0x9E3779B97F4A7C15))


def _uniform(bits: np.ndarray) -> np.ndarray:
    return (bits >> U64(11)).astype(np.float64) * 2.0**-53


@lru_cache
def _poisson_steps(area: float) -> np.ndarray:
    """Cumulative probabilities of 0, 1, 2, ... darts in a cell of this area."""
    top = int(area + 12 * area**0.5 + 20)
    k = np.arange(top + 1)
    logs = k * np.log(area) - area - np.concatenate([[0], np.cumsum(np.log(np.arange(1, top + 1)))])
    return np.cumsum(np.exp(logs))


def dart_signatures(doc: np.ndarray, element: np.ndarray, n_docs: int, k: int = COORDINATES) -> np.ndarray:
    """n_docs x k signature of unit elements; documents without elements have zeros."""
    weight = np.bincount(doc, minlength=n_docs)
    reach = (k * np.log(k) + 2 * k) / np.maximum(weight, 1)
    rank = np.full(n_docs * k, np.inf)
    sign = np.zeros(n_docs * k, U64)
    missing = weight > 0
    for level, (low, high) in enumerate(zip(_EDGES[:-1], _EDGES[1:], strict=True)):
        active = (weight > 0) & ((reach > low) | missing)
        if not active.any():
            break
        here = active[doc]
        who, base = doc[here], mix64(element[here] ^ U64((level + 1) * 0xD1342543DE82EF95 % (1 << 64)))
        n = np.searchsorted(_poisson_steps(high - low), _uniform(mix64(base)), side="left")
        some = np.flatnonzero(n)
        for a in range(0, len(some), 1 << 17):  # bounded memory
            part = some[a:a + (1 << 17)]
            each = n[part]
            which = np.repeat(part, each)
            number = np.arange(len(which)) - np.repeat(np.cumsum(each) - each, each)
            dart = mix64(base[which] + (number.astype(U64) + U64(1)) * U64(0x9E3779B97F4A7C15))
            r = low + (high - low) * _uniform(dart)
            cell = who[which] * k + (mix64(dart) % U64(k)).astype(np.int64)
            np.minimum.at(rank, cell, r)
            won = r == rank[cell]
            sign[cell[won]] = dart[won]
        missing = (weight > 0) & np.isinf(rank.reshape(n_docs, k)).any(1)
    return sign.reshape(n_docs, k)


def _band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    parts = signature.reshape(len(signature), BANDS, BAND_ROWS)
    key = np.tile(np.arange(1, BANDS + 1, dtype=U64), (len(signature), 1))
    for r in range(BAND_ROWS):
        key = mix64(key ^ parts[:, :, r])
    return key.view(np.int64)


def _nibbles(signature: np.ndarray) -> np.ndarray:
    """Four bits of every coordinate, sixteen coordinates in a 64-bit number."""
    # High bits, as the low ones decide the coordinate.
    parts = ((mix64(signature) >> U64(48)) & U64(15)).reshape(len(signature), -1, 16)
    return np.bitwise_or.reduce(parts << (U64(4) * np.arange(16, dtype=U64)), axis=2).view(np.int64)


def _agreement(a: str, b: str):
    """SQL: the number of coordinates whose four bits agree."""
    differ = []
    for k in range(COORDINATES // 16):
        x = f"({a}[{k}] ^ {b}[{k}])"
        x = f"({x} | shiftrightunsigned({x}, 1))"
        differ.append(f"bit_count(({x} | shiftrightunsigned({x}, 2)) & {0x1111111111111111}L)")
    return F.expr(f"{COORDINATES} - ({' + '.join(differ)})")


def _least_agreement() -> int:
    """Pairs of similarity SIMILARITY agree less often with the probability that the bands miss
    them (5e-6, 4.4 standard deviations)."""
    p = SIMILARITY + (1 - SIMILARITY) / 16
    return int(COORDINATES * p - 4.4 * (COORDINATES * p * (1 - p)) ** 0.5)


def _sketches(docs: DataFrame) -> DataFrame:
    """doc_id, print (of the word sequence, null without words), band keys and signature bits."""

    def run(batches):
        for b in small_batches(batches, limit=2 << 20):
            words = Words(b["text"])
            doc, element = occurrences(words)
            signature = dart_signatures(doc, element, words.n_docs)
            keys, bits = _band_keys(signature), _nibbles(signature)
            prints = [hashlib.blake2b(b" ".join(words.doc_bytes(d).split()), digest_size=16).digest()
                      if words.count[d] else None for d in range(words.n_docs)]
            bands = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, BANDS, dtype=np.int32), keys.ravel())
            width = bits.shape[1]
            bits = pa.ListArray.from_arrays(np.arange(0, bits.size + 1, width, dtype=np.int32), bits.ravel())
            yield pa.RecordBatch.from_pydict({"doc_id": b["doc_id"], "print": pa.array(prints, pa.binary()),
                                              "bands": bands, "bits": bits})

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, print binary, bands array<long>, bits array<long>")


def _similarities(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b, similarity of the pairs, from the whole texts."""

    def run(batches):
        for batch in batches:
            for b in small_batches(small_batches([batch], "text_a", 2 << 20), "text_b", 2 << 20):
                doc_a, el_a = occurrences(Words(b["text_a"]))
                doc_b, el_b = occurrences(Words(b["text_b"]))
                n = b.num_rows
                mine, other = el_a ^ _row_key(doc_a), el_b ^ _row_key(doc_b)
                shared = np.bincount(doc_a[np.isin(mine, other)], minlength=n)
                union = np.bincount(doc_a, minlength=n) + np.bincount(doc_b, minlength=n) - shared
                yield pa.RecordBatch.from_pydict({"a": b["a"], "b": b["b"], "similarity": shared / np.maximum(union, 1)})

    found = (pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
             .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"))
    return found.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long, similarity double")


def _row_key(doc: np.ndarray) -> np.ndarray:
    return mix64((doc.astype(U64) + U64(1)) * U64(0xA0761D6478BD642F))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, print, component_id per row of ``docs``."""
    docs = docs.select("doc_id", "text")
    rows = written(_sketches(docs), "sketches")
    node = F.coalesce(F.min("doc_id"), -F.abs(F.xxhash64("print")) - 1)
    reps = written(rows.filter(F.col("print").isNotNull()).groupBy("print")
                   .agg(node.alias("node"), F.first("bands").alias("bands"), F.first("bits").alias("bits")),
                   "print-classes")
    # Texts that share a doc_id may count twice in a bucket; that only adds a bucket of one node.
    band = reps.filter("node >= 0").select("node", F.explode(F.array_distinct("bands")).alias("key"))
    size = band.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = written(band.join(size, "key").distinct(), "buckets")
    mates = shared.groupBy("node").agg(F.sum("n").alias("mates"))
    ranked = shared.join(mates, "node").select("key", "node", "mates")
    leader = ranked.groupBy("key").agg(F.max(F.struct("mates", (-F.col("node")).alias("id"))).alias("top"))
    members = written(shared.select("key", "node").join(leader, "key").select(
        "key", "node", (-F.col("top.id")).alias("leader"), F.col("top.mates").alias("mates")), "bucket-members")
    texts = _texts(docs, members.select("node").distinct())
    # Every class meets one leader first, the one with the most mates.
    best = members.filter("node <> leader").groupBy("node").agg(
        F.max(F.struct("mates", (-F.col("leader")).alias("id"))).alias("top")).select(
        "node", (-F.col("top.id")).alias("leader"))
    edges = _links(best.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))
                   .distinct(), texts)
    first = written(components(edges, "first-components"), "first-components")
    second = _links(_open_pairs(members, first, texts, reps), texts)
    edges = first.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(second)
    roots = components(edges, "document-components")
    of_print = reps.select("print", "node").join(roots, "node", "left").select(
        "print", F.coalesce("root", "node").alias("root"))
    named = rows.select("doc_id", "print").join(of_print, "print", "left")
    return named.select("doc_id", "print", F.when(F.col("root") >= 0, F.col("root")).otherwise(
        F.col("doc_id")).alias("component_id"))


def _texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, text of the documents that meet another (the smallest text of equal doc_ids).
    The ids are a table of known size first, so that Spark can choose a broadcast before it
    shuffles the texts."""
    nodes = written(nodes, "candidate-ids")
    found = docs.join(nodes, F.col("doc_id") == F.col("node"), "left_semi")
    return written(found.groupBy(F.col("doc_id").alias("node")).agg(F.min("text").alias("text")), "candidate-texts")


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of similarity SIMILARITY or more."""
    found = written(_similarities(pairs, texts), "similarities")
    return found.filter(F.col("similarity") >= SIMILARITY).select("a", "b")


def _common_shingles(texts: DataFrame, sizes: tuple[int, int]) -> DataFrame:
    """node, size (shingle occurrences), common (those that another text has too); ``sizes``
    are the groups and buckets to deal the texts into."""
    n_groups, n_buckets = sizes
    dealt = grouped(texts.select(F.col("node").alias("doc_id"), "text"), n_groups)

    def distinct(table):
        _, element = occurrences(Words(table["text"]))
        return np.unique(element, return_counts=True)

    def close(table, keys, total):
        own, count = distinct(table)
        count = lookup(own, count, keys, total)
        doc, element = occurrences(Words(table["text"]))
        size = np.bincount(doc, minlength=table.num_rows)
        common = np.bincount(doc[count[np.searchsorted(own, element)] > 1], minlength=table.num_rows)
        return pa.table({"node": table["doc_id"], "size": size, "common": common})

    answers = combine(scatter(dealt, n_buckets, distinct), totals)
    return finish(dealt, answers, close, "node long, size long, common long")


def _open_pairs(members: DataFrame, first: DataFrame, texts: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs of different first components in a bucket that may reach SIMILARITY."""
    root = F.coalesce("root", "node").alias("root")
    rows = members.join(first, "node", "left").select("key", "node", "leader", root)
    led = rows.join(first.select(F.col("node").alias("leader"), F.col("root").alias("led")), "leader", "left").select(
        "key", "node", "root", F.coalesce("led", "leader").alias("led"))
    out = led.filter("root <> led").select("key", "node", "root")
    buckets = out.select("key").distinct()
    involved = written(rows.select("key", "node", "root").join(buckets, "key", "left_semi"), "open-buckets")
    nodes = written(involved.select("node").distinct(), "open-ids")
    stats = written(_common_shingles(texts.join(nodes, "node", "left_semi"), plan_sizes(texts)), "common-shingles")
    share = SIMILARITY / (1 + SIMILARITY)
    alive = stats.filter(F.col("common") >= share * (1 + SIMILARITY) * F.col("size") - 1e-9)
    # Classes that share a doc_id keep their own bands, hence the test that they hold the key.
    alive = alive.join(reps.select("node", "bits", "bands"), "node")
    sized = written(involved.join(alive, "node").filter(F.array_contains("bands", F.col("key"))), "open-sketches")
    step = float(np.log(1 / SIMILARITY))
    low, high = F.col("x.size") * SIMILARITY, F.least(F.col("x.size") / SIMILARITY,
                                                      F.col("x.common") / share - F.col("x.size"))
    own = out.select("key", "node").distinct()
    x = sized.join(own, ["key", "node"], "left_semi").select(
        "key", F.struct("node", "root", "size", "common", "bits", "bands").alias("x"))
    x = x.filter(high >= low).withColumn("class", F.explode(F.sequence(
        F.floor(F.log(low) / step - 1e-9), F.floor(F.log(high) / step + 1e-9))))
    y = sized.withColumn("class", F.floor(F.log("size") / step))
    # A pair meets in the smallest of its common buckets only.
    met = x.join(y, ["key", "class"]).filter(
        (F.col("x.root") != F.col("root")) & (F.least("x.common", "common") >= share * (F.col("x.size") + F.col("size")) - 1e-9)
        & (_agreement("x.bits", "bits") >= _least_agreement())
        & (F.array_min(F.array_intersect("x.bands", "bands")) == F.col("key")))
    return met.select(F.least("x.node", "node").alias("a"), F.greatest("x.node", "node").alias("b")).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, component_id (smallest doc_id of the group), kept per row."""
    found = classes(docs)
    return found.select("doc_id", "component_id",
                        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def keep_documents(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per group, columns unchanged: the one of the smallest doc_id; of
    rows that repeat it, one. Rows of a null doc_id stay.

    Only the ids that go or repeat are joined, as tables of known size, so that the texts
    are shuffled only where those ids are too many for a broadcast. The search's own tables are
    deleted once those ids are written."""
    with temporary(docs.sparkSession):
        ids = near_duplicates(docs).filter("doc_id is not null").groupBy("doc_id").agg(
            F.count("*").alias("n"), F.max("kept").alias("kept")).filter("n > 1 or not kept")
        ids = written(ids, "gone-or-repeated")
    once = docs.join(ids.select("doc_id"), "doc_id", "left_anti")
    again = docs.join(ids.filter("kept").select("doc_id"), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return once.select(docs.columns).unionByName(again.select(docs.columns))
