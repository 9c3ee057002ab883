from __future__ import annotations

from helpers import SCHEMA, classes, documents, frame, unique_ids, words

from corpusmill.llm.components import components
from corpusmill.llm.ngram_join import bitmap, ngram_classes, without_near_copies

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingles(text, n):
    w = words((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < n else frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def expected(rows, n, num, den):
    sets = {d: shingles(t, n) for d, t, *_ in rows}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])
    ]
    found = classes(sets, links)
    return {d: (len(s), found[d]) for d, s in sets.items()}


def test_against_brute_force(spark):
    rows = unique_ids(documents())
    for n, num, den in ((4, 85, 100), (2, 1, 2)):
        got = ngram_classes(frame(spark, rows), n, (num, den)).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected(rows, n, num, den)


def test_families_in_every_size(spark):
    rows = []
    for size in (5, 9, 17, 40, 90):
        base = [f"s{size}w{i}" for i in range(size)]
        for k in range(12):
            rows.append((1000 * size + k, " ".join(base[: size - k // 2] + [f"t{k}"] * (k % 3)), "", "", 0, 0, "", "", "", 0, ""))
    got = ngram_classes(frame(spark, rows), 4, (85, 100)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected(rows, 4, 85, 100)


def test_odd_rows(spark):
    got = ngram_classes(frame(spark)).collect()
    assert len(got) == len(documents())
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert all(r.component_id == r.doc_id for r in got if r.n_shingles == 0)


def test_empty_table(spark):
    assert ngram_classes(spark.createDataFrame([], SCHEMA)).collect() == []


def test_stage_keeps_one_of_each_class(spark):
    rows = unique_ids(documents())
    want = sorted(d for d, (_, c) in expected(rows, 5, 80, 100).items() if c == d)
    got = without_near_copies(frame(spark, rows))
    assert got.columns == frame(spark, rows).columns
    assert sorted(r.doc_id for r in got.collect()) == want


def test_bitmaps_bound_differences():
    import numpy as np

    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**63, 500).astype(np.uint64))
    b = np.union1d(a[:400], rng.integers(0, 2**63, 100).astype(np.uint64))
    p, q = (np.frombuffer(bitmap(x), np.uint8) for x in (a, b))
    assert len(p) == len(q)
    assert np.bitwise_count(p ^ q).sum() <= len(np.setxor1d(a, b))


def test_components_of_paths_and_hubs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3), (200, 201), (200, 201)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for pair in links for x in pair if x is not None} - {7} | {7}
    want = classes(nodes, [(a, b) for a, b in links if a is not None and a != b])
    assert got == want
