from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators.embed import fit_hash_embedder, function_embedder
from corpusmill.operators.index import build_index, hash_pivots
from corpusmill.workload import fixtures as fx


def test_hash_embedding_is_unit_or_zero(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(-1, ""), (-2, None)], "doc_id long, text string"))
    embedder = fit_hash_embedder(docs, "text", 64)
    rows = embedder.embed(docs, "text").collect()
    assert len(rows) == 202 and rows[0].asDict().keys() == {"doc_id", "text", "embedding"}
    for r in rows:
        assert len(r.embedding) == 64
        norm = np.linalg.norm(r.embedding)
        assert norm == pytest.approx(1.0, abs=1e-5) or (norm == 0 and not (r.text or "").strip())


def test_same_words_same_vector(spark):
    df = spark.createDataFrame([(1, "Blue sky"), (2, "sky, BLUE!"), (3, "green grass")], "i int, t string")
    got = {r.i: r.embedding for r in fit_hash_embedder(df, "t", 128).embed(df, "t").collect()}
    assert got[1] == got[2] != got[3]


def test_function_embedder_and_mismatch(spark):
    def embed(texts):
        return [[float(len(t)), 1.0] for t in texts]

    e = function_embedder("lengths", 2, lambda texts: [[float(len(t)), 1.0] for t in texts])
    df = spark.createDataFrame([(1, "abc"), (2, None)], "vec_id long, t string")
    vectors = e.embed(df, "t")
    assert {r.vec_id: r.embedding for r in vectors.collect()} == {1: [3.0, 1.0], 2: [0.0, 1.0]}
    index = build_index(vectors, hash_pivots(vectors, 2), embed_name=e.name)
    index.check_embedder(e)
    with pytest.raises(ValueError, match="index holds lengths"):
        index.check_embedder(function_embedder("other", 2, embed))
    wrong = function_embedder("wrong", 3, lambda texts: [[0.0] for _ in texts])
    with pytest.raises(Exception, match="must return 3 numbers"):
        wrong.embed(df, "t").agg(F.count("embedding")).collect()
