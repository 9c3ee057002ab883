from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import hard_negatives as module
from corpusmill.llm.hard_negatives import Band, Packed, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, id long, score string, block int, ask int, pos string, dim int, is_anchor int, v int"


def vectors(seed=3, n=500, dim=12):
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.normal(size=dim) + (i % 4)).tolist(), int(i % 3)) for i in range(n)]
    rows += [(n + i, rows[5 + i % 2][1], i % 2) for i in range(60)]  # ties
    odd = [None, [], [float("nan")] * dim, [float("inf")] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1), [0.0] * dim, [1.0, 2.0], [3.0, 1.0]]
    rows += [(1000 + 10 * i, v, 1) for i, v in enumerate(odd)]
    rows += [(1200, rows[1][1], None), (None, rows[1][1], 1), rows[10], (1210, [2.0, 2.0], 2)]
    return [(*r, 1, "x", 2, 3, "p", 4, 1, 5) for r in rows]


def expected(rows, positives, negatives, band, scale=256.0):
    good = {}
    for i, v, label, *_ in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        good[i] = (label, [math.floor(scale * float(np.float32(x))) for x in v])
    out = set()
    for a, (label, x) in good.items():
        if a % 10:
            continue
        scores = {i: sum(p * q for p, q in zip(x, y, strict=True)) for i, (_, y) in good.items() if i != a and len(x) == len(y)}
        order = sorted(scores, key=lambda i: (-scores[i], i))
        for p in [i for i in order if good[i][0] == label][:positives]:
            fit = [
                i for i in order
                if good[i][0] != label and band.low * scores[p] <= 100 * scores[i] <= band.high * scores[p]
            ]
            out |= {(a, p, k + 1, i, scores[p], scores[i]) for k, i in enumerate(fit[:negatives])}
    return out


@pytest.mark.parametrize(("anchors", "candidates"), [(2048, 8192), (9, 70)])
@pytest.mark.parametrize("band", [Band(), Band(-40, 100)])
def test_against_brute_force(spark, monkeypatch, anchors, candidates, band):
    monkeypatch.setattr(module, "ANCHORS", anchors)
    monkeypatch.setattr(module, "CANDIDATES", candidates)
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in hard_negatives(df, F.col("id") % 10 == 0, 5, 3, band).collect()]
    assert len(got) == len(set(got))
    assert set(got) == expected(rows, 5, 3, band)


def test_empty_table(spark):
    assert hard_negatives(spark.createDataFrame([], SCHEMA), F.col("id") % 10 == 0).collect() == []


@pytest.mark.parametrize("top", [1, 3, 200, 5_000, 1 << 20, 1 << 28])
def test_packed_products_are_exact(top):
    rng = np.random.default_rng(top)
    for n, m, d in ((1, 1, 1), (7, 5, 64), (40, 33, 17)):
        x, y = rng.integers(-top, top + 1, (m, d)), rng.integers(-top, top + 1, (n, d))
        packed = Packed(y.astype(float), int(x.min()), int(x.max()))
        assert packed.scores(x.astype(float)).tolist() == (x.astype(object) @ y.T.astype(object)).tolist()
    assert top > 200 or packed.fields > 1


def test_wide_integers(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (rng.integers(-(1 << 20), 1 << 20, 40) + (1 << 18)).tolist(), i % 2) for i in range(60)]
    packed = Packed(256.0 * np.array([v for _, v, _ in rows]), -(1 << 29), 1 << 29)
    assert not packed.doubles and packed.fields > 1
    df = spark.createDataFrame([(i, [float(x) for x in v], n) for i, v, n in rows], "vec_id long, embedding array<double>, label int")
    got = {tuple(r) for r in hard_negatives(df, F.col("id") % 10 == 0, 5, 3, Band(-40, 100)).collect()}
    assert got == expected(rows, 5, 3, Band(-40, 100))


def test_scores_beyond_a_long():
    with pytest.raises(OverflowError):
        Packed(np.array([[2.0**40]]), -(1 << 40), 1 << 40)
