"""Chunk invariants and a plain-Python twin of the fixed windows."""

from __future__ import annotations

import random
from collections import deque

import pytest
from pyspark.sql import functions as F

from corpusmill.operators.chunk import (
    SEPARATORS, compute_chunks, fixed_windows, python_chunker, recursive_chunks, recursive_splitter,
)
from corpusmill.workload import fixtures as fx


def windows(text, size, overlap):
    w, out, i = text.split(), [], 0
    while True:
        out.append(" ".join(w[i : i + size]))
        if i + size >= len(w):
            return [c for c in out if c]
        i += size - overlap


@pytest.mark.parametrize(("size", "overlap"), [(384, 128), (5, 2), (3, 0), (7, 6)])
def test_fixed_windows(spark, size, overlap):
    rng = random.Random(size)
    texts = ["", "  ", "a"] + [
        "".join(rng.choice(["w%d" % i, "x"]) + rng.choice([" ", "\n", "　 "]) for i in range(n))
        for n in (1, 2, 3, 5, 6, 7, 8, 12, 40, 384, 385, 640, 641, 2000)
    ]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "doc_uri string, doc_content string")
    got = compute_chunks(df, fixed_windows(size, overlap)).orderBy(F.col("doc_uri").cast("int"), "chunk_index").collect()
    want = [(str(i), j, c) for i, t in enumerate(texts) for j, c in enumerate(windows(t, size, overlap))]
    assert [(r.doc_uri, r.chunk_index, r.content_chunked) for r in got] == want


def _chunks(text, size, overlap, count, seps):
    return recursive_chunks([text], size, overlap, lambda many: [count(t) for t in many], seps)[0]


def plain_chunks(text, size, overlap, count, seps):
    """The same by recursion, one piece after the other and a sliding window."""
    at = next((i for i, s in enumerate(seps) if s in text), None)
    sep, finer = ("", ()) if at is None else (seps[at], seps[at + 1 :])
    fitting = []
    for part in filter(None, text.split(sep) if sep else text):
        if count(part) <= size:
            fitting.append(part)
            continue
        yield from plain_windows(fitting, sep, size, overlap, count)
        fitting = []
        if finer:
            yield from plain_chunks(part, size, overlap, count, finer)
        else:
            yield part
    yield from plain_windows(fitting, sep, size, overlap, count)


def plain_windows(parts, sep, size, overlap, count):
    gap, window = count(sep) if sep else 0, deque()

    def total(more=()):
        held = [*window, *more]
        return sum(map(count, held)) + gap * max(0, len(held) - 1)

    for part in parts:
        if window and total([part]) > size:
            yield from filter(None, [sep.join(window).strip()])
            while window and (total() > overlap or total([part]) > size):
                window.popleft()
        window.append(part)
    yield from filter(None, [sep.join(window).strip()])


COUNTS = {
    "words": lambda t: len(t.split()),
    "characters": len,
    "word pieces": lambda t: sum(-(-len(w) // 3) for w in t.split(" ")) + t.count("\n"),
}


@pytest.mark.parametrize("count", COUNTS.values(), ids=COUNTS)
@pytest.mark.parametrize("seed", range(40))
def test_recursive_equals_plain_recursion(seed, count):
    rng = random.Random(seed)
    texts = [None, "", " ", "\n\n\n"] + [
        "".join(rng.choice(["a", "bb", "ccccc", "d" * 17, "", "\u3000"]) + rng.choice([" "] * 6 + ["\n"] * 3 + ["\n\n", "\n \n", "  ", ""])
                for _ in range(rng.randrange(70)))
        for _ in range(6)
    ]
    size = rng.randrange(1, 25)
    overlap = rng.randrange(0, size)
    seps = SEPARATORS if seed % 3 else SEPARATORS[:3]
    calls = []
    got = recursive_chunks(texts, size, overlap, lambda many: calls.append(1) or [count(t) for t in many], seps)
    assert got == [None if t is None else list(plain_chunks(t, size, overlap, count, seps)) for t in texts]
    assert len(calls) <= len(seps) + 1


def test_lengths_of_a_batch(spark):
    df = spark.createDataFrame([("u", "aa bb cc dd"), ("v", None)], "doc_uri string, doc_content string")
    by_letters = recursive_splitter(6, 3, lengths=lambda many: [len(t) for t in many])
    assert [r.content_chunked for r in compute_chunks(df, by_letters).orderBy("chunk_index").collect()] == ["aa bb", "bb cc", "cc dd"]
    with pytest.raises(ValueError):
        recursive_splitter(length=len, lengths=lambda many: [1 for _ in many])


def check_cover(text, chunks, size, overlap):
    """Chunks hold all tokens in order; each starts at most ``overlap`` tokens back."""
    words, end = text.split(), 0
    previous = 0
    for c in chunks:
        part = c.split()
        assert 0 < len(part) <= size
        starts = [s for s in range(max(previous, end - overlap), end + 1) if words[s : s + len(part)] == part]
        assert starts, "chunk does not continue the text"
        reach = max(starts, key=lambda s: -abs(s + len(part) - end))
        # With repeated words several starts fit; any that goes on from the covered part will do.
        nxt = [s for s in starts if s + len(part) > end] or [reach]
        previous, end = nxt[-1], max(end, nxt[-1] + len(part))
    assert end == len(words)


def test_recursive_on_given_documents(spark, sf_dir):
    docs = fx.docs(spark, sf_dir)
    chunks = compute_chunks(docs, recursive_splitter())
    by_doc = {}
    for r in chunks.orderBy("doc_uri", "chunk_index").collect():
        by_doc.setdefault(r.doc_uri, []).append(r)
    texts = {r.doc_uri: r.doc_content for r in docs.filter("parser_status = 'SUCCESS'").collect()}
    assert set(by_doc) == {u for u, t in texts.items() if t.split()}
    for uri, rows in by_doc.items():
        assert [r.chunk_index for r in rows] == list(range(len(rows)))
        check_cover(texts[uri], [r.content_chunked for r in rows], 384, 128)


def test_recursive_same_for_any_partitioning(spark, sf_dir):
    docs = fx.docs(spark, sf_dir)
    a, b = (compute_chunks(docs.repartition(n), recursive_splitter(50, 10)) for n in (1, 7))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("seed", range(20))
def test_recursive_random_texts(seed):
    rng = random.Random(seed)
    text = "".join(f"t{i}" + rng.choice([" "] * 12 + ["\n"] * 3 + ["\n\n", "\n\n\n", "  "]) for i in range(rng.randrange(900)))
    size = rng.randrange(2, 60)
    overlap = rng.randrange(0, size)
    chunks = list(_chunks(text, size, overlap, lambda t: len(t.split()), SEPARATORS))
    words, end = text.split(), 0
    for c in chunks:
        part = c.split()
        start = words.index(part[0])
        assert words[start : start + len(part)] == part
        assert len(part) <= size and end - overlap <= start <= end
        end = start + len(part)
    assert end == len(words)


def test_characters_are_the_last_resort():
    chunks = list(_chunks("abcdefghij klm", 4, 1, len, SEPARATORS))
    assert chunks == ["abcd", "defg", "ghij", "klm"]


def test_ids_are_stable_and_unique(spark, sf_dir):
    docs = fx.docs(spark, sf_dir)
    ids = [r[0] for r in compute_chunks(docs, fixed_windows(20, 5)).select("chunk_id").collect()]
    again = [r[0] for r in compute_chunks(docs.repartition(3), fixed_windows(20, 5)).select("chunk_id").collect()]
    assert len(ids) == len(set(ids)) and set(ids) == set(again)


def test_python_chunker_and_propagation(spark):
    df = spark.createDataFrame(
        [("u1", "a,b,,c", "SUCCESS", 1), ("u2", "x", "ERROR: no", 2), ("u3", None, "SUCCESS", 3)],
        "doc_uri string, doc_content string, parser_status string, extra int",
    )
    chunks = compute_chunks(df, python_chunker(lambda t: t.split(",")))
    assert chunks.columns == ["chunk_id", "chunk_index", "content_chunked", "doc_uri", "parser_status", "extra"]
    assert sorted((r.doc_uri, r.chunk_index, r.content_chunked, r.extra) for r in chunks.collect()) == [
        ("u1", 0, "a", 1), ("u1", 1, "b", 1), ("u1", 2, "c", 1),
    ]


def test_bad_overlap():
    with pytest.raises(ValueError):
        fixed_windows(10, 10)
