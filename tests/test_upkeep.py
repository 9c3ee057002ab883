"""An index kept up against one built anew from the same vectors."""

from __future__ import annotations

import numpy as np
import pytest

from corpusmill.operators.index import build_index, hash_pivots
from corpusmill.operators.search import exact_by_cells, exact_top_k, ivf_top_k
from corpusmill.operators.upkeep import apply_changes, open_index, rebuilt

SCHEMA = "vec_id long, embedding array<float>"


def vectors(rng, ids):
    return [(int(i), rng.normal(size=8).tolist()) for i in ids]


def hits(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


@pytest.fixture()
def kept_up(spark, tmp_path):
    rng, path = np.random.default_rng(3), str(tmp_path / "index")
    held = dict(vectors(rng, range(300)))
    df = spark.createDataFrame(list(held.items()), SCHEMA)
    centroids = hash_pivots(df, 6)
    build_index(df, centroids, path=path)

    def step(upserts=(), deletes=(), **more):
        held.update(upserts)
        for d in deletes:
            if d not in dict(upserts):
                held.pop(d, None)
        return apply_changes(
            spark, path,
            spark.createDataFrame(list(upserts), SCHEMA) if upserts else None,
            spark.createDataFrame([(d,) for d in deletes], "vec_id long") if deletes else None,
            **more,
        )

    step(vectors(rng, range(290, 340)))
    step(deletes=[1, 2, 3, 310, 99_999])
    step(vectors(rng, [2, 5, 400]), [5, 6])  # 2 comes back, 5 is in both
    return held, path, centroids, step, rng


def test_equals_an_index_built_anew(spark, kept_up, tmp_path):
    held, path, centroids, step, rng = kept_up
    df = spark.createDataFrame(list(held.items()), SCHEMA)
    queries = df.withColumnRenamed("vec_id", "query_id")
    index = open_index(spark, path)
    assert sorted(r.vec_id for r in index.vectors.collect()) == sorted(held)
    assert sum(n for n, _ in index.cells.values()) == len(held)
    anew = build_index(df, centroids)
    assert hits(ivf_top_k(queries, index, 5, 2)) == hits(ivf_top_k(queries, anew, 5, 2))
    assert hits(exact_by_cells(queries, index, 5)) == hits(exact_top_k(queries, df, 5, method="broadcast"))
    assert hits(exact_by_cells(queries, rebuilt(index, str(tmp_path / "again")), 5)) == hits(exact_by_cells(queries, index, 5))


def test_split_cells(spark, kept_up):
    held, path, centroids, step, rng = kept_up
    large = open_index(spark, path).cells
    index = step(vectors(rng, range(500, 560)), max_cell=60)
    assert len(index.centroids) > len(centroids)
    assert sum(n for n, _ in index.cells.values()) == len(held)
    index = step(vectors(rng, range(505, 515)), [0, 520])  # after a split
    df = spark.createDataFrame(list(held.items()), SCHEMA)
    queries = df.withColumnRenamed("vec_id", "query_id")
    assert sorted(r.vec_id for r in index.vectors.collect()) == sorted(held)
    assert hits(exact_by_cells(queries, index, 5)) == hits(exact_top_k(queries, df, 5, method="broadcast"))
    assert large


def test_files_of_other_cells_stay(spark, kept_up):
    held, path, centroids, step, rng = kept_up
    before = set(spark.read.parquet(f"{path}/vectors").inputFiles())
    one = [(700, held[7])]
    step(one)
    assert set(spark.read.parquet(f"{path}/vectors").inputFiles()) == before
    cells = {r.cell for r in spark.read.parquet(f"{path}/delta").filter("step = 4").select("cell").collect()}
    assert len(cells) == 1


def test_a_step_that_died_does_not_count(spark, kept_up):
    held, path, centroids, step, rng = kept_up
    rows = spark.createDataFrame([(800, held[7], 0.5, 0)], SCHEMA + ", cell_score double, cell int")
    rows.write.partitionBy("cell").parquet(f"{path}/delta/step=4")
    assert 800 not in {r.vec_id for r in open_index(spark, path).vectors.collect()}
    step(vectors(rng, [801]))
    assert {r.vec_id for r in open_index(spark, path).vectors.collect()} == set(held)


def test_repeated_keys_are_refused(spark, kept_up):
    _, path, *_ = kept_up
    with pytest.raises(ValueError, match="not unique"):
        apply_changes(spark, path, spark.createDataFrame([(1, [1.0] * 8), (1, [2.0] * 8)], SCHEMA))
