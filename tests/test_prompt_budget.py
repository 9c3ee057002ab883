"""Passages chosen under a token budget, against plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import plan_of

from corpusmill.operators.prompt import passage_tokens, within_budget

SCHEMA = "request_id string, rank int, content_chunked string, doc_uri string, score double, e array<double>, extra int"


def plain(rows, budget, variety):
    """Ranks chosen for one request."""
    taken, left = [], budget
    vectors = {r[1]: None if r[5] is None else np.array(r[5]) / (np.linalg.norm(r[5]) or 1) for r in rows}

    def alike(a, b):
        return 0 if vectors[a] is None or vectors[b] is None else round(float(vectors[a] @ vectors[b]) * 1e6)

    def size(r):
        return len(f"Passage text: {r[2] or ''}\nPassage metadata: {r[3] or ''}\n\n".split())

    while True:
        fits = [r for r in rows if r[1] not in [t[1] for t in taken] and size(r) <= left]
        if not fits:
            return sorted((t[1], size(t)) for t in taken)

        def worth(r):
            if not variety:
                return -r[1]
            near = max((alike(r[1], t[1]) for t in taken), default=0)
            return (100 - variety) * round((r[4] or 0) * 1e6) - variety * near

        best = max(fits, key=lambda r: (worth(r), -r[1]))
        taken.append(best)
        left -= size(best)


def some_rows(seed):
    rng = random.Random(seed)
    rows = []
    for request in range(30):
        for rank in range(1, rng.randrange(2, 17)):
            text = rng.choice([None, "", " ".join(["w"] * rng.randrange(40))])
            vector = rng.choice([None, [0.0] * 4] + [[rng.choice([-1.0, 0.5, 1.0]) for _ in range(4)] for _ in range(8)])
            rows.append((f"r{request}", rank, text, rng.choice([None, "u v", "u"]), rng.choice([None, 0.25, 0.5, rng.random()]), vector, rank * 7))
    return rows


@pytest.mark.parametrize(("budget", "variety"), [(0, 0), (30, 0), (60, 40), (60, 100), (5000, 30)])
def test_same_as_plain(spark, budget, variety):
    rows = some_rows(budget + variety)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    given = {"score": "score", "embedding": "e", "variety": variety} if variety else {}
    got = within_budget(df, budget, **given)
    assert got.columns == [*(c for c in df.columns if not variety or c != "e"), "n_tokens"]
    found = {}
    for r in got.collect():
        assert r.extra == r["rank"] * 7
        found.setdefault(r.request_id, []).append((r["rank"], r.n_tokens))
    for request in {r[0] for r in rows}:
        want = plain([r for r in rows if r[0] == request], budget, variety)
        assert sorted(found.get(request, [])) == want
        assert sum(n for _, n in found.get(request, [])) <= budget


def test_lengths_given_ahead(spark):
    df = spark.createDataFrame(some_rows(9), SCHEMA)
    given = {"score": "score", "embedding": "e", "variety": 25}
    whole = within_budget(df, 70, **given).select("request_id", "rank", "n_tokens")
    ahead = df.withColumn("n", passage_tokens("content_chunked", "doc_uri")).drop("content_chunked", "doc_uri")
    assert sorted(within_budget(ahead, 70, n_tokens="n", **given).select("request_id", "rank", "n_tokens").collect()) == sorted(whole.collect())


def test_no_passages_and_bad_arguments(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert within_budget(empty, 100, score="score", embedding="e", variety=50).isEmpty()
    assert within_budget(empty, 100).isEmpty()
    with pytest.raises(ValueError):
        within_budget(empty, 100, variety=50)


def test_vectors_go_to_python_as_they_are(spark):
    """Single-precision vectors are not widened on the way, and many groups are worked on in parts."""
    rows = [(f"r{i % 900}", i // 900, "a b c", "u", 0.5 + i % 7 / 100, [float(i % 5), 1.0, float(i % 3)], i) for i in range(9000)]
    passages = spark.createDataFrame(rows, SCHEMA.replace("array<double>", "array<float>")).coalesce(1)
    chosen = within_budget(passages, 30, score="score", embedding="e", variety=30)
    assert "as array<double>" not in plan_of(chosen)
    got = {}
    for r in chosen.collect():
        got.setdefault(r["request_id"], []).append((r["rank"], r["n_tokens"]))
    for request in ("r0", "r450", "r899"):
        assert sorted(got[request]) == plain([r for r in rows if r[0] == request], 30, 30)
    assert len(got) == 900
