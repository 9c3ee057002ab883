from __future__ import annotations

import itertools
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import SCHEMA, documents, frame
from tokenizers import Tokenizer

from corpusmill.llm.packing import best_cuts, pack
from corpusmill.llm.token_spans import attribute, token_counts
from corpusmill.llm.tokens import encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", "a", " ", "\n\n", "a\n\nb", "a  b", "x   y", "it's  we'll\t\tz ", "  lead", "trail  ", "a\n \n b", "<|endoftext|> hi",
    "ß　 q", "1 2  3\r\n4", "\x0b\x0c a", "é" * 200 + " b", "!!  ?? \n...", "z​ z", "\x1c a\x1f b", "don't.'s 'll",
    "a.b,c;d:e!f?g", "x́. y z. w", "\U0001f600 中文。字",
]


@pytest.fixture(scope="module")
def whole():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_pieces_encode_like_whole_texts(whole):
    flat, bounds = encoder(PATH).ids(ODD + [r[1] or "" for r in documents()])
    for i, t in enumerate(ODD + [r[1] or "" for r in documents()]):
        assert flat[bounds[i] : bounds[i + 1]].tolist() == whole.encode(t, add_special_tokens=False).ids


def test_cuts_are_cheapest():
    rng = np.random.default_rng(2)
    for _ in range(60):
        at = np.concatenate([[0], np.cumsum(rng.integers(1, 6, 9))])
        penalty, length = rng.integers(0, 5, len(at)).astype(float), 8
        cost = lambda cuts: sum(penalty[np.searchsorted(at, b)] + length - (b - a) for a, b in zip(cuts, cuts[1:]))  # noqa: B905, B023, E731
        every = (
            [at[0], *middle, at[-1]] for n in range(len(at) - 1) for middle in itertools.combinations(at[1:-1], n)
        )
        least = min(cost(c) for c in every if max(np.diff(c)) <= length)
        got = best_cuts(at, penalty, length)
        assert max(np.diff(got)) <= length
        assert cost(list(got)) == least


def check_pieces(rows, docs, whole, length):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id, r.doc_tokens].append(r)
        by_seq[r.sequence_id].append(r)
    for d, t in docs:
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], np.uint32)
        mine = sorted(by_doc[d, len(ids)], key=lambda r: r.start)
        assert [r.start for r in mine] == [0, *np.cumsum([r.length for r in mine])[:-1]]
        assert mine[-1].start + mine[-1].length == len(ids)
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in mine)
    for mine in by_seq.values():
        mine.sort(key=lambda r: r.offset)
        assert [r.offset for r in mine] == [0, *np.cumsum([r.length for r in mine])[:-1]]
        assert sum(r.length for r in mine) <= length


def test_round_trip(spark, whole):
    docs = list({(i, r[1]) for i, r in enumerate(documents())})
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for length in (2048, 64, 3):
        check_pieces(pack(df, PATH, length).collect(), docs, whole, length)


def test_little_padding_and_streams(spark, whole, monkeypatch):
    import corpusmill.llm.packing as module

    docs = [(i, ("Some words go here and there. " * (i % 40))) for i in range(800)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    got = pack(df, PATH, 128).collect()
    check_pieces(got, docs, whole, 128)
    lengths = {r.sequence_id: r.sequence_length for r in got}
    assert sum(lengths.values()) / (128 * len(lengths)) > 0.95
    assert module.STRETCH * 128 < sum(lengths.values())  # decided in several stretches


def test_odd_rows(spark):
    got = pack(frame(spark), PATH).collect()
    assert sum(r.start == 0 for r in got) == len(documents())
    assert pack(spark.createDataFrame([], SCHEMA), PATH).collect() == []


def test_sections_by_first_character(spark, whole):
    docs = [(i, t) for i, t in enumerate(ODD + [r[1] for r in documents()])]
    got = defaultdict(dict)
    for r in token_counts(spark.createDataFrame(docs, "doc_id long, text string"), PATH).collect():
        got[r.doc_id][r.section] = r.n_tokens
        assert r.crossing <= r.n_tokens
    for d, t in docs:
        ids = whole.encode(t or "", add_special_tokens=False).ids
        assert sum(got[d].values()) == len(ids)
        raw = (t or "").encode()
        at, want = 0, defaultdict(int)
        for i in ids:
            before = raw[:at].count(b"\n")
            want[-1 if raw[at : at + 1] == b"\n" else before] += 1
            at += len(TABLE[i])
        assert {k: v for k, v in got[d].items() if v} == dict(want)


TABLE = encoder(PATH).table()


def test_rules():
    tokens = np.array([0, 3, 4, 9, 10])
    starts, stops = np.array([0, 2, 6]), np.array([2, 5, 9])
    section, over = attribute(tokens, starts, stops, "first")
    assert section.tolist() == [0, 1, 1, -1] and over.tolist() == [True, False, True, False]
    section, _ = attribute(tokens, starts, stops, "most")
    assert section.tolist() == [0, 1, 2, -1]


def test_given_sections(spark):
    rows = [(1, "one two three", [(0, 3), (4, 7), (8, 99)]), (2, "x", []), (3, None, None), (4, "ab", [(0, 0), (0, 2)])]
    df = spark.createDataFrame(rows, "doc_id long, text string, s array<struct<start:long,stop:long>>")
    got = {(r.doc_id, r.section): r.n_tokens for r in token_counts(df, PATH, sections=df.s).collect()}
    assert got == {(1, -1): 2, (1, 0): 1, (1, 1): 0, (1, 2): 0, (2, -1): 1, (3, -1): 0, (4, 0): 0, (4, 1): 1}
    most = {(r.doc_id, r.section): r.n_tokens for r in token_counts(df, PATH, sections=df.s, rule="most").collect()}
    assert most == {(1, 0): 1, (1, 1): 1, (1, 2): 1, (2, -1): 1, (3, -1): 0, (4, 0): 0, (4, 1): 1}


def test_sections_of_odd_rows(spark):
    assert len({r.doc_id for r in token_counts(frame(spark), PATH).collect()}) == len({r[0] for r in documents()})
    assert token_counts(spark.createDataFrame([], SCHEMA), PATH).collect() == []


def test_padding_of_powers_of_two(spark, whole):
    """What is padded, with sequences of a power of two of ids left as they are, is no more than what the cuts were charged."""
    docs = [(i, "Some words go here and there. " * (i % 40)) for i in range(400)]
    got = pack(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), PATH, 128).collect()
    check_pieces(got, docs, whole, 128)
    lengths = {r.sequence_id: r.sequence_length for r in got}.values()
    charged = sum(128 - n for n in lengths)
    padded = sum(0 if n & (n - 1) == 0 else 128 - n for n in lengths)
    assert padded <= charged <= 0.05 * 128 * len(lengths)
