from __future__ import annotations

import numpy as np

from gridmart.llm import embedding_dedup

SCHEMA = "vec_id long, embedding array<float>, label int"


def test_links_and_components_against_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = []
    for label in (0, 1):
        centres = rng.normal(size=(12, 64))
        for c in centres:
            for k in range(12):
                rows.append((c + rng.normal(scale=0.02 + 0.035 * k / 2, size=64), label))
    x = np.array([r[0] for r in rows], np.float32)
    table = [(i, x[i].tolist(), rows[i][1]) for i in range(len(rows))]
    table += [(1000 + i, x[0].tolist(), 0) for i in range(50)]  # exact copies
    odd = [(2000, None, 0), (2001, [0.0] * 64, 0), (2002, [float("nan")] * 64, 0), (2003, x[0].tolist(), None),
           (2004, [], 1), (2005, [1.0, None], 1), (2006, [1.0, 2.0], 1), (2007, [1.0, 2.0], 1), (2008, [2.0, 4.0], 1)]
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(
        spark.createDataFrame(table + odd, SCHEMA).repartition(4)).collect()}
    assert len(got) == len(table) + len(odd)
    ids = [t[0] for t in table]
    unit = np.array([t[1] for t in table], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & (np.array([t[2] for t in table])[:, None] == np.array([t[2] for t in table])[None, :])
    root = np.arange(len(ids))
    for _ in range(len(ids)):
        low = np.array([root[n].min() for n in near])
        if (low == root).all():
            break
        root = low
    missed = sum(near.sum(1) - 1) - sum(got[i].n_links for i in ids)
    assert 0 <= missed <= 0.002 * near.sum()
    assert np.mean([got[i].component_id == ids[root[k]] for k, i in enumerate(ids)]) > 0.99
    for i in (2000, 2001, 2002, 2003, 2004, 2005):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert [got[i].n_links for i in (2006, 2007, 2008)] == [2, 2, 2] and got[2008].component_id == 2006


def test_small_tiles_give_the_same_links(spark, monkeypatch):
    rng = np.random.default_rng(1)
    base = rng.normal(size=64)
    rows = [(i, (base + rng.normal(scale=0.15, size=64)).astype(np.float32).tolist(), 3) for i in range(200)]
    frame = spark.createDataFrame(rows, SCHEMA)
    whole = sorted(map(tuple, embedding_dedup.near_duplicates(frame).collect()))
    monkeypatch.setattr(embedding_dedup, "TILE", 40)
    assert sorted(map(tuple, embedding_dedup.near_duplicates(frame).collect())) == whole


def test_empty(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
