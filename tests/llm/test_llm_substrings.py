from __future__ import annotations

import hashlib

from helpers import SCHEMA, documents, frame, unique_ids, words

from corpusmill.llm.substrings import repeated_passages, without_repeats


def expected(rows, size):
    first: dict[tuple, int] = {}
    for d, t, *_ in rows:
        w = words(t)
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            first[key] = min(d, first.get(key, d))
    out = {}
    for d, t, *_ in rows:
        w = words(t)
        gone = {p for i in range(len(w) - size + 1) if first[tuple(w[i : i + size])] < d for p in range(i, i + size)}
        out[d] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def test_against_brute_force(spark):
    rows = unique_ids(documents())
    for size in (50, 8):
        want = expected(rows, size)
        for r in repeated_passages(frame(spark, rows), size).collect():
            n, gone, kept = want[r.doc_id]
            assert (r.n_words, r.n_removed, r.kept_sha256) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())
            assert sum(s.stop - s.start for s in r.spans) == gone
            assert all(a.stop < b.start for a, b in zip(r.spans, r.spans[1:], strict=False))


def test_texts(spark):
    rows = unique_ids(documents())
    want = expected(rows, 50)
    got = without_repeats(frame(spark, rows))
    assert got.columns == frame(spark, rows).columns
    texts = {r[0]: r[1] for r in rows}
    for r in got.collect():
        assert r.text == (want[r.doc_id][2] if want[r.doc_id][1] else texts[r.doc_id])


def test_odd_rows(spark):
    got = repeated_passages(frame(spark)).collect()
    assert len(got) == len(documents())
    assert all(r.n_removed == 0 for r in got if r.doc_id is None)


def test_empty_table(spark):
    assert repeated_passages(spark.createDataFrame([], SCHEMA)).collect() == []
