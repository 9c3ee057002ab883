from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import SCHEMA, documents, frame

from corpusmill.llm.quality import SIZE, _dual_descent, fit_indicators, good_documents, indicators, quality_scores


def test_held_out_labels(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality_scores(docs, labels).toPandas().set_index("doc_id")
    assert len(got) == docs.count()
    assert all(h == (zlib.crc32(str(d).encode()) % 5 == 0) for d, h in got.held_out.items())
    known = labels.toPandas().set_index("doc_id").join(got)
    held = known[known.held_out]
    rank = held.score.rank()
    ones, zeros = (held.quality == 1).sum(), (held.quality == 0).sum()
    assert (rank[held.quality == 1].sum() - ones * (ones + 1) / 2) / (ones * zeros) > 0.95
    assert (held[held.quality == 1].predicted == 1).mean() > 0.97
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(string(doc_id) as binary)) % 5 = 0, 1 - quality, quality) as quality")
    again = quality_scores(docs, flipped).toPandas().set_index("doc_id")
    assert (again.score.sort_index() == got.score.sort_index()).all()  # held-out labels change nothing


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int")


def test_odd_rows(spark):
    some = labels(spark, [(i, i % 2) for i in range(30)] + [(3, 0), (None, 1), (999, 1), (4, None), (5, 7)])
    got = quality_scores(frame(spark), some).collect()
    assert len(got) == len(documents())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert all(r.held_out for r in got if r.doc_id is None)
    kept = good_documents(frame(spark), some)
    assert kept.columns == frame(spark).columns
    assert kept.count() == sum(r.predicted for r in got)


@pytest.mark.parametrize(("rows", "score"), [([], 0.5), ([(1, 1), (2, 1)], 1.0), ([(1, 0), (2, 0)], 0.0)])
def test_one_class_or_none(spark, rows, score):
    got = quality_scores(frame(spark), labels(spark, rows)).collect()
    assert all(r.score == pytest.approx(score, abs=1e-5) for r in got)


def test_empty_table(spark):
    assert quality_scores(spark.createDataFrame([], SCHEMA), labels(spark, [(1, 1)])).collect() == []


def test_indicators_are_of_the_text_alone():
    texts = ["one two two", None, "", "Ab!! cd$$$", "one two two"]
    alone = [next(indicators(pa.array([t], pa.string()))) for t in texts]
    together = list(indicators(pa.array(texts, pa.string())))
    assert all((a == b).all() for a, b in zip(alone, together, strict=True))
    assert len(together[1]) == len(together[2]) == 0 and all(t.max(initial=0) < SIZE for t in together)


def test_descent_meets_its_conditions():
    rng = np.random.default_rng(4)
    found = [np.arange(6) for _ in range(80)]
    rows = [rng.normal(size=6) for _ in range(80)]
    y = np.array([int(r[0] + 0.3 * rng.normal() > 0) for r in rows])
    w, b = _dual_descent(found, rows, y, 1.0, 2000, 1)
    s, x = 2 * y - 1, np.array(rows)
    cost = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))

    def loss(v):
        return 0.5 * v @ v + (cost * np.maximum(0, 1 - s * (x @ v[:6] + v[6]))).sum()

    at = np.append(w[:6], b)
    assert all(loss(at) <= loss(at + 1e-2 * rng.normal(size=7)) + 1e-3 for _ in range(200))


def test_constant_features():
    model = fit_indicators([np.array([1]), np.array([2])] * 8, np.array([1, 0] * 8))
    assert model.score(np.array([1])) > 0.5 > model.score(np.array([2]))
