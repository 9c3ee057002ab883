"""Every search path against a plain numpy search."""

from __future__ import annotations

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from corpusmill.operators import search as S
from corpusmill.operators.index import assign_cells, build_index, hash_pivots, kmeans_centroids, load_index
from corpusmill.operators.topk import TopK


def make(spark, n, dim, seed, copies=0, prefix=None):
    """Vectors of which ``copies`` are one and the same; ids are numbers or texts."""
    rng = np.random.default_rng(seed)
    m = rng.normal(size=(n, dim)).astype(np.float32)
    if copies:
        m[rng.choice(n, copies, replace=False)] = m[0]
    ids = [f"{prefix}{i:05d}" if prefix else i for i in range(n)]
    kind = "string" if prefix else "long"
    df = spark.createDataFrame(list(zip(ids, m.tolist(), strict=True)), f"id {kind}, embedding array<float>")
    return ids, m.astype(np.float64), df


def brute(qids, q, ids, v, k, skip_self=False, allowed=None):
    def unit(m):
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(n == 0, 1, n)

    scores = np.round(unit(q) @ unit(v).T, 6) + 0.0
    out = {}
    for i, qid in enumerate(qids):
        hits = [(-s, vid) for j, (vid, s) in enumerate(zip(ids, scores[i], strict=True))
                if not (skip_self and vid == qid) and (allowed is None or allowed[i][j])]
        out[qid] = [(vid, -s) for s, vid in sorted(hits)[:k]]
    return out


def collect(hits, key="vec_id"):
    out = {}
    for r in sorted(hits.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got = out.setdefault(r["query_id"], [])
        got.append((r[key], r["score"]))
        assert r["rank"] == len(got)
    return out


CASES = [
    pytest.param(0, None, False, id="numbers"),
    pytest.param(150, None, True, id="a third are copies"),
    pytest.param(150, "v", True, id="text ids, copies"),
]


@pytest.mark.parametrize(("copies", "prefix", "skip_self"), CASES)
@pytest.mark.parametrize("method", ["broadcast", "cells"])
def test_exact(spark, copies, prefix, skip_self, method):
    ids, m, df = make(spark, 450, 8, 7, copies, prefix)
    hits = S.exact_top_k(
        df.withColumnRenamed("id", "query_id").repartition(3), df.withColumnRenamed("id", "vec_id").repartition(5), 5,
        skip_self=skip_self, method=method, n_cells=12, nprobe=2,
    )
    assert collect(hits) == brute(ids, m, ids, m, 5, skip_self)


def test_exact_with_fewer_vectors_than_k(spark):
    ids, m, df = make(spark, 4, 3, 1)
    for method in ("broadcast", "cells"):
        hits = S.exact_top_k(
            df.withColumnRenamed("id", "query_id"), df.withColumnRenamed("id", "vec_id"), 10,
            method=method, n_cells=3, nprobe=1,
        )
        assert collect(hits) == brute(ids, m, ids, m, 10)


def test_zero_and_null_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, [-1.0, 0.5]), (3, None)]
    df = spark.createDataFrame(rows, "id long, embedding array<float>")
    want = {0: [(0, 1.0), (1, 0.0), (2, -0.894427)], 1: [(0, 0.0), (1, 0.0), (2, 0.0)], 2: [(2, 1.0), (1, 0.0), (0, -0.894427)]}
    for method in ("broadcast", "cells"):
        hits = S.exact_top_k(
            df.withColumnRenamed("id", "query_id"), df.withColumnRenamed("id", "vec_id"), 3,
            method=method, n_cells=2, nprobe=1,
        )
        assert collect(hits) == want


@pytest.mark.parametrize("clustered", [False, True])
def test_exact_by_cells_on_clusters(spark, clustered):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(10, 16))
    m = (centres[rng.integers(0, 10, 400)] + (0.05 if clustered else 2.0) * rng.normal(size=(400, 16))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<float>")
    index = build_index(df, hash_pivots(df, 20))
    queries = df.withColumnRenamed("vec_id", "query_id")
    hits = S.exact_by_cells(queries, index, 6, skip_self=True, nprobe=2)
    ids = list(range(400))
    assert collect(hits) == brute(ids, m.astype(np.float64), ids, m.astype(np.float64), 6, True)
    if clustered:
        floors = hits.filter("rank = 6").select("query_id", F.col("score").alias("floor"))
        rest = S._cells_within_reach(queries.join(floors, "query_id"), index, "query_id", 2)
        assert rest.count() < 400 * 18 / 2, "the bound should rule out most cells"


@pytest.mark.parametrize("method", ["broadcast", "cells"])
def test_ann_looks_into_its_cells_only(spark, method):
    ids, m, df = make(spark, 300, 8, 11, 100)
    vectors = df.withColumnRenamed("id", "vec_id")
    centroids = hash_pivots(vectors, 10)
    index = build_index(vectors, centroids)
    queries = df.withColumnRenamed("id", "query_id")
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    scores = np.round(unit @ centroids.T, 6)
    order = np.argsort(-scores, axis=1, kind="stable")
    allowed = (order[:, :3][:, :, None] == order[:, 0][None, None, :]).any(axis=1)
    hits = S.ivf_top_k(queries, index, 4, 3, skip_self=True, method=method)
    assert collect(hits) == brute(ids, m, ids, m, 4, True, allowed)
    everything = S.ivf_top_k(queries, index, 4, 10, skip_self=True, method=method)
    assert collect(everything) == brute(ids, m, ids, m, 4, True)


def test_hot_cell_is_cut_into_parts(spark):
    ids, m, df = make(spark, 300, 8, 5, 200)
    vectors, queries = df.withColumnRenamed("id", "vec_id"), df.withColumnRenamed("id", "query_id")
    index = build_index(vectors, hash_pivots(vectors, 4))
    assert max(n for n, _ in index.cells.values()) >= 200
    probes = assign_cells(queries, index.centroids, "query_id", n=4).select("query_id", "embedding", "cell")
    local = S._score_cells(probes, index, 5, "query_id", False, query_part=16, vector_part=32)
    per_pair = local.groupBy("query_id").count().agg(F.max("count")).first()[0]
    assert per_pair > 5 * 4, "several parts must have answered each query"
    assert collect(S.rank_top_k(local, 5, "query_id", "vec_id")) == brute(ids, m, ids, m, 5)


def test_running_top_k_over_many_blocks(monkeypatch):
    from corpusmill.operators import topk

    monkeypatch.setattr(topk, "VECTOR_BLOCK", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk, "PENDING_ROWS", 50)
    rng = np.random.default_rng(0)
    m = np.round(rng.normal(size=(200, 2)), 1)
    ids = rng.permutation(200)
    top = TopK(ids, m, 9, True)
    for i in range(0, 200, 33):
        top.add(ids[i : i + 33], m[i : i + 33])
    got = {}
    for q, v, s in zip(*top.result(), strict=True):
        got.setdefault(int(q), []).append((int(v), s))
    assert got == brute(ids.tolist(), m, ids.tolist(), m, 9, True)


def test_stored_index_reopens(spark):
    _, _, df = make(spark, 100, 4, 2)
    vectors = df.withColumnRenamed("id", "vec_id")
    built = build_index(vectors, hash_pivots(vectors, 5), embed_name="e1", unique_key=True)
    again = load_index(spark, built.path)
    assert (again.key, again.dim, again.embed_name, again.cells) == (built.key, 4, "e1", built.cells)
    assert np.array_equal(again.centroids, built.centroids)
    assert sum(n for n, _ in again.cells.values()) == 100
    with pytest.raises(ValueError, match="not unique"):
        build_index(vectors.union(vectors), built.centroids, unique_key=True)


def test_kmeans_cells(spark):
    _, _, df = make(spark, 200, 4, 2)
    df = df.union(spark.createDataFrame([(-1, [0.0] * 4), (-2, None)], df.schema))
    centroids = kmeans_centroids(df, 6, per_cell=20)
    assert centroids.shape[1] == 4 and 1 < len(centroids) <= 6
    assert np.allclose(np.linalg.norm(centroids, axis=1), 1)
    index = build_index(df.withColumnRenamed("id", "vec_id"), centroids)
    assert sum(n for n, _ in index.cells.values()) == 201


def test_passages(spark):
    hits = spark.createDataFrame([(1, 1, 10, 0.9), (1, 2, 11, 0.05), (2, 1, 99, 0.8)], "query_id long, rank long, vec_id long, score double")
    chunks = spark.createDataFrame([(10, "t10", "u10", "en", 1), (11, "t11", "u11", "de", 2)], "chunk_id long, content_chunked string, doc_uri string, lang string, other int")
    got = S.fetch_passages(S.above(hits, 0.1), chunks, S.ResultColumns(additional=["lang"]), "vec_id")
    assert got.columns == ["query_id", "rank", "chunk_id", "score", "content_chunked", "doc_uri", "lang"]
    assert [tuple(r) for r in got.collect()] == [(1, 1, 10, 0.9, "t10", "u10", "en")]


def test_methods_are_chosen_not_guessed(spark):
    _, _, df = make(spark, 30, 4, 1)
    queries, vectors = df.withColumnRenamed("id", "query_id"), df.withColumnRenamed("id", "vec_id")
    with pytest.raises(ValueError, match="over 100"):
        S.exact_top_k(queries, vectors, 3, method="broadcast", max_broadcast_bytes=100)
    with pytest.raises(ValueError, match="n_cells"):
        S.exact_top_k(queries, vectors, 3)
    with pytest.raises(ValueError, match="method"):
        S.exact_top_k(queries, vectors, 3, method="fast")


@pytest.mark.parametrize("method", ["broadcast", "cells"])
@pytest.mark.parametrize(("q_type", "v_type"), [("long", "string"), ("string", "long"), ("string", "string"), ("int", "long")])
def test_id_types_and_empty_tasks(spark, method, q_type, v_type):
    rows = [(i, [1.0, float(i)]) for i in range(4)]
    df = spark.createDataFrame(rows, "id long, embedding array<float>")
    queries = df.select(F.col("id").cast(q_type).alias("query_id"), "embedding")
    vectors = df.select(F.col("id").cast(v_type).alias("vec_id"), "embedding").repartition(7)
    hits = S.exact_top_k(queries, vectors, 2, method=method, n_cells=2, nprobe=1)
    assert hits.dtypes[0][1] == queries.dtypes[0][1] and hits.dtypes[2][1] == vectors.dtypes[0][1]
    assert hits.filter("rank = 1").count() == 4
    index = build_index(vectors, hash_pivots(vectors, 2))
    assert S.ivf_top_k(queries, index, 2, 2, method=method).filter("rank = 1").count() == 4


def test_recall(spark):
    schema = "query_id long, vec_id long"
    truth = spark.createDataFrame([(1, 1), (1, 2), (2, 3), (2, 4)], schema)
    found = spark.createDataFrame([(1, 2), (1, 9), (2, 3)], schema)
    assert tuple(S.recall_at_k(found, truth, "query_id", "vec_id").first()) == (4, 2, 0.5)


def test_plan_limits_each_group_before_the_shuffle(spark):
    _, _, df = make(spark, 50, 4, 1)
    plan = plan_of(S.exact_top_k(df.withColumnRenamed("id", "query_id"), df.withColumnRenamed("id", "vec_id"), 3, method="broadcast"))
    assert plan.count("WindowGroupLimit") >= 2
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_parts_that_meet_are_small():
    """Copies of both sides are made in Python, for as many tasks as an executor has cores."""
    assert S.VECTOR_PART_BYTES <= 32 << 20 and S.QUERY_PART_BYTES <= 4 << 20


def test_second_pass_gives_out_what_reaches_the_floor(spark):
    """Scores of the floor stay, as ties go to the smaller key; a query without a floor keeps all."""
    ids, m, df = make(spark, 300, 6, 23, copies=40)
    vectors, queries = df.withColumnRenamed("id", "vec_id"), df.withColumnRenamed("id", "query_id")
    index = build_index(vectors, hash_pivots(vectors, 4))
    truth = brute(ids, m, ids, m, 5)
    floors = spark.createDataFrame([(i, float(truth[i][-1][1]) if i % 7 else None) for i in ids], "query_id long, floor double")
    cells = queries.join(floors, "query_id").withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(3))))
    hits = S._score_cells(cells, index, 5, "query_id", False, floor="floor")
    assert collect(S.rank_top_k(hits, 5, "query_id", "vec_id")) == truth
    below = hits.join(floors, "query_id").filter("score < floor")
    assert below.isEmpty()
    per_query = sum(min(5, n) for n, _ in index.cells.values())
    assert hits.filter("query_id % 7 = 0").count() == per_query * len(range(0, 300, 7))
