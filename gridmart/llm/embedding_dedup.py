"""Operator 4, embedding near-dedup: collision counting over one-dimensional projections.

Equal vectors of a label become one with a multiplicity. Every vector is projected on
``PROJECTIONS`` random directions. A vector's window in a projection covers the values a
vector at the threshold cosine has with probability ``HIT``; a pair is a candidate when at
least ``needed`` of its windows collide, the largest count that pairs at the threshold reach
with probability 1 - ``MISS``. Candidates are verified by their cosine in double precision.
The first projection is sorted into blocks as wide as four standard deviations of its
difference at the threshold, so a pair meets in one block or two neighbouring ones; blocks
are split into tiles of about ``TILE`` vectors, so no task holds a whole block or label.
A task returns the links counted per vector and one edge to its local component, not pairs.

Defined cases: a vector that is null, empty, zero, of a null label, or holds a null or
non-finite component links with nothing. Vectors of different length never link. Rows of
equal vec_id count as separate vectors with one component. A null vec_id gets a component
if it equals others' vectors, else null.
"""

from __future__ import annotations

from math import comb, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmart.llm.components import components
from gridmart.llm.scratch import written
from gridmart.llm.textops import binary_parts

COSINE = 0.93
PROJECTIONS, HIT, WIDE, MISS = 32, 0.95, 4.0, 1e-4
_Z_HIT = 1.959964  # two-sided normal quantile of HIT
TILE = 1024


def needed(projections: int = PROJECTIONS, hit: float = HIT, miss: float = MISS) -> int:
    """The largest count that Binomial(projections, hit) reaches with probability 1 - miss."""
    below = 0.0
    for count in range(projections + 1):
        below += comb(projections, count) * hit**count * (1 - hit)**(projections - count)
        if below > miss:
            return count
    return projections


def _directions(dim: int) -> np.ndarray:
    return np.random.default_rng(1000 + dim).standard_normal((dim, PROJECTIONS))


def _unit_rows(raw: np.ndarray) -> np.ndarray:
    """Rows of unit length (scaled first, so that huge and tiny components stay finite)."""
    x = raw / np.abs(raw).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _checked(vectors: DataFrame) -> DataFrame:
    """vec_id, label, raw (components as doubles; null where the vector cannot link)."""
    x = F.col("embedding").cast("array<double>")
    usable = (F.col("label").isNotNull() & (F.size(x) > 0)
              & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
              & F.exists(x, lambda v: v != 0))
    # 0.0 + v turns -0.0 into 0.0, so equal vectors have equal bytes.
    flat = vectors.select("vec_id", "label", F.when(usable, F.transform(x, lambda v: v + F.lit(0.0))).alias("x"))

    def run(batches):
        for b in batches:
            x = b["x"]
            raw = [None if v is None else np.asarray(v, "<f8").tobytes() for v in x.to_pylist()]
            yield pa.RecordBatch.from_pydict({"vec_id": b["vec_id"], "label": b["label"],
                                              "raw": pa.array(raw, pa.binary())})

    kind = vectors.schema["label"].dataType.simpleString()
    return flat.mapInArrow(run, f"vec_id long, label {kind}, raw binary")


def _blocked(distinct: DataFrame, width: float) -> DataFrame:
    """Adds ``dim`` and ``block`` (of the first projection) to the distinct vectors."""

    def run(batches):
        for b in batches:
            raw, off = binary_parts(b["raw"])
            dim = np.diff(off) // 8
            block = np.zeros(len(dim), np.int64)
            for d in np.unique(dim):
                rows = np.flatnonzero(dim == d)
                x = np.stack([raw[off[r]:off[r + 1]].view("<f8") for r in rows])
                block[rows] = np.floor(_unit_rows(x) @ _directions(int(d))[:, 0] / width)
            out = {c: b[c] for c in b.schema.names}
            yield pa.RecordBatch.from_pydict(out | {"dim": dim, "block": block})

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in distinct.schema)
    return distinct.mapInArrow(run, f"{fields}, dim long, block long")


def _tile_links(cosine: float, window: float, least: int):
    def links(key, table):
        k1, k2 = key[-2].as_py(), key[-1].as_py()
        raw, off = binary_parts(table["raw"])
        node, times = table["node"].to_numpy(), table["times"].to_numpy()
        home, tile = table["home"].to_numpy(), table["tile"].to_numpy()
        empty = pa.table({"node": np.zeros(0, np.int64), "links": np.zeros(0, np.int64),
                          "root": np.zeros(0, np.int64)})
        x = _unit_rows(raw.view("<f8").reshape(len(node), -1))
        p = x @ _directions(x.shape[1])
        left, right = np.flatnonzero(tile == k1), np.flatnonzero(tile == k2)
        found = []
        for a in range(0, len(left), TILE):
            i = left[a:a + TILE]
            for b in range(0, len(right), TILE):
                j = right[b:b + TILE]
                hits = np.zeros((len(i), len(j)), np.uint8)
                for k in range(PROJECTIONS):
                    hits += np.abs(p[i, k][:, None] - p[j, k][None, :]) <= window
                r, c = np.nonzero(hits >= least)
                r, c = i[r], j[c]
                ok = home[r] | home[c]
                if k1 == k2:
                    ok &= r < c
                r, c = r[ok], c[ok]
                for s in range(0, len(r), 1 << 16):
                    u, v = r[s:s + (1 << 16)], c[s:s + (1 << 16)]
                    near = np.einsum("ij,ij->i", x[u], x[v]) >= cosine
                    found.append(np.stack([u[near], v[near]]))
        if not found or not sum(f.shape[1] for f in found):
            return empty
        u, v = np.concatenate(found, axis=1)
        links = np.bincount(u, times[v], len(node)) + np.bincount(v, times[u], len(node))
        root = node.copy()
        while True:  # smallest linked node, until nothing moves
            low = np.minimum(root[u], root[v])
            before = root.copy()
            np.minimum.at(root, u, low)
            np.minimum.at(root, v, low)
            if np.array_equal(before, root):
                break
        at = np.flatnonzero(links)
        return pa.table({"node": node[at], "links": links[at].astype(np.int64), "root": root[at]})

    return links


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept per row."""
    distance = sqrt(2 * (1 - cosine))
    rows = written(_checked(vectors.select("vec_id", "embedding", "label")), "vectors")
    usable = rows.filter(F.col("raw").isNotNull())
    node = F.coalesce(F.min("vec_id"), -F.abs(F.xxhash64("label", "raw")) - 1)
    distinct = written(_blocked(usable.groupBy("label", "raw").agg(node.alias("node"), F.count("*").alias("times")),
                                WIDE * distance), "distinct-vectors")
    group = ["label", "dim", "block"]
    # A vector is at home in its block and visits the one below.
    placed = distinct.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("down")).select(
        "label", "dim", (F.col("block") - F.col("down")).alias("block"), "node", "times", "raw",
        (F.col("down") == 0).alias("home"))
    tiles = placed.groupBy(*group).agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    dealt = placed.join(tiles, group).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    meets = F.explode(F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda o: F.struct(
        F.least("tile", o).alias("i"), F.greatest("tile", o).alias("j"))))
    dealt = dealt.withColumn("pair", meets).select(*group, "pair.i", "pair.j", "node", "times", "raw", "home", "tile")
    found = written(dealt.groupBy(*group, "i", "j").applyInArrow(
        _tile_links(cosine, _Z_HIT * distance, needed()), "node long, links long, root long"), "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "vector-components")
    classes = (distinct.select("label", "raw", "node", "times").join(links, "node", "left")
               .join(roots, "node", "left"))
    out = rows.join(classes, ["label", "raw"], "left")
    component = F.coalesce("root", "node", "vec_id")
    return out.select("vec_id", F.coalesce(F.coalesce("links", F.lit(0)) + F.col("times") - 1, F.lit(0)).alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
