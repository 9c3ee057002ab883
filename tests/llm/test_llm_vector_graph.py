from __future__ import annotations

import numpy as np
import pytest
from helpers import classes

from corpusmill.llm.vector_graph import Graph, near_vectors, pruned_graph

SCHEMA = "vec_id long, embedding array<float>, label int, n long, shard int, home string"


def vectors(seed=2, n=400, dim=16):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=dim).tolist(), int(i % 3)) for i in range(n)]
    base = rng.normal(size=dim)
    rows += [(1000 + i, (base + 0.08 * rng.normal(size=dim)).tolist(), 1) for i in range(150)]
    rows += [(2000 + i, rows[i][1], rows[i][2]) for i in range(20)]
    rows += [(2100 + i, (np.array(rows[5][1]) * 2.0).tolist(), rows[5][2]) for i in range(3)]
    rows += [(2200 + i, (np.array(rows[i][1]) + 0.1 * rng.normal(size=dim)).tolist(), rows[i][2]) for i in range(60)]
    odd = [None, [], [0.0] * dim, [float("nan")] * dim, [float("inf")] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1), [1.0, 2.0], [2.0, 4.0]]
    rows += [(3000 + i, v, 1) for i, v in enumerate(odd)]
    rows += [(3100, rows[1][1], None), (None, rows[1][1], 1), rows[7]]
    return [(*r, 1, 2, "x") for r in rows]


def expected(rows, threshold):
    good = {}
    for i, v, label, *_ in rows:
        ok = i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        if ok:
            x = np.array(v, np.float32).astype(np.float64)
            good[i] = (label, x / np.sqrt(x @ x))
    links = [
        (a, b) for a in good for b in good
        if a < b and good[a][0] == good[b][0] and len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] >= threshold
    ]
    found = classes({r[0] for r in rows if r[0] is not None}, links)
    degree = dict.fromkeys(found, 0)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    return {i: (degree[i], found[i]) for i in found}


@pytest.mark.parametrize("graph", [Graph(), Graph(shard=40, clusters=6), Graph(shard=24, clusters=2)])
def test_against_brute_force(spark, graph):
    rows = vectors()
    want = expected(rows, 0.93)
    got = near_vectors(spark.createDataFrame(rows, SCHEMA), 0.93, graph).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert r.n_links <= want[r.vec_id][0]
            assert r.kept == (r.vec_id == r.component_id)
    found = {r.vec_id: (r.n_links, r.component_id) for r in got if r.vec_id is not None}
    assert sum(n for n, _ in found.values()) >= 0.97 * sum(n for n, _ in want.values())
    assert sum(found[i][1] == want[i][1] for i in want) >= 0.97 * len(want)


def test_sparse_pairs_over_many_shards(spark):
    """Pairs a little above the threshold among unrelated vectors: hard for shards, and no dense group hides a loss."""
    rng, n, pairs, dim = np.random.default_rng(7), 33_000, 3000, 32
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    u, r = x[:pairs], rng.normal(size=(pairs, dim))
    r -= (r * u).sum(axis=1, keepdims=True) * u
    t = rng.uniform(0.9305, 0.936, (pairs, 1))
    x[-pairs:] = t * u + np.sqrt(1 - t * t) * r / np.linalg.norm(r, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: r.n_links for r in near_vectors(df, 0.93).collect()}
    want = dict.fromkeys(range(n), 0)
    for i in range(0, n, 3000):
        row, column = np.nonzero(x[i : i + 3000] @ x.T >= 0.93)
        for a in row[row + i != column] + i:
            want[a] += 1
    assert sum(want.values()) >= 2 * pairs
    assert all(found[i] <= want[i] for i in want)
    assert sum(found.values()) >= 0.95 * sum(want.values())
    assert np.mean([found[i] / want[i] for i in want if want[i]]) >= 0.95


def test_empty_table(spark):
    assert near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_pruning_keeps_the_nearest():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    kept = pruned_graph(x, Graph())
    sims = x @ x.T
    np.fill_diagonal(sims, -2)
    assert (kept[:, 0] == sims.argmax(axis=1)).all()
    assert all(len({*r[r >= 0]}) == (r >= 0).sum() and i not in r for i, r in enumerate(kept))
