from __future__ import annotations

from collections import defaultdict

import pytest
from helpers import SCHEMA, documents, frame, words

from corpusmill.llm.mixing import mixed_documents, mixture


def targets(sizes: dict, weights=(1, 2, 3), epochs=3) -> dict:
    """Shares by weight; what is over a cap is dealt again, until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    out, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > epochs * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = float(epochs * sizes[s])
            open_.discard(s)
            left -= out[s]
    return out


def check(rows, source_of):
    sizes, taken, want = defaultdict(int), defaultdict(int), {}
    for r, s in zip(rows, source_of, strict=True):
        sizes[s] += r.size
        taken[s] += r.taken
        want[s] = (r.source_size, r.target)
        assert 0 <= r.taken <= 3 * r.size
    expected = targets(sizes)
    for s in sizes:
        assert want[s][0] == sizes[s]
        assert want[s][1] == pytest.approx(expected[s])
        assert taken[s] == int(want[s][1] + 1e-9) or taken[s] == int(want[s][1])


def test_targets_and_budgets(spark):
    docs = [(i, "w " * (i % 17), f"s{i % 7}" if i % 7 else None) for i in range(600)]
    docs += [(1000 + i, "x " * 900, "s3") for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = sorted(mixed_documents(df).collect())
    assert [r.size for r in got] == [len(words(t)) for _, t, _ in sorted(docs)]
    check(got, [s for _, _, s in sorted(docs)])
    assert got == sorted(mixed_documents(df.repartition(5)).collect())


def test_odd_rows(spark):
    got = mixed_documents(frame(spark)).collect()
    assert len(got) == len(documents())
    assert sorted(r.size for r in got) == sorted(len(words(r[1])) for r in documents())


def test_empty_table_and_no_words(spark):
    assert mixed_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    assert mixture(spark.createDataFrame([], SCHEMA)).collect() == []
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert {(r.size, r.taken) for r in mixed_documents(blank).collect()} == {(0, 0)}


def test_mixture_holds_the_words_taken(spark):
    df = frame(spark)
    got = mixture(df)
    assert got.columns == df.columns
    mixed = defaultdict(int)
    for r in got.collect():
        mixed[r.doc_id] += len(words(r.text))
    want = defaultdict(int)
    for r in mixed_documents(df).collect():
        if r.taken:
            want[r.doc_id] += r.taken
    assert mixed == want
