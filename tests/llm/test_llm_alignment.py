from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import SCHEMA, documents, frame, prose
from tokenizers import Tokenizer

from corpusmill.llm.alignment import alignments, both, crossing, pair_counts
from corpusmill.llm.tokens import encoder

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", "a", " ", "\n\n", "a\n\nb", "it's  we'll\t\tz ", "  lead", "trail  ", "a\n \n b", "<|endoftext|> hi </s> <s> <unk>", "ß　 q",
    "1 2  3\r\n4;\r x);\r", "\x0b\x0c a", "é" * 200 + " b", "!!  ?? \n...", "z​ z", "\x1c a\x1f b", "don't.'s 'll", "a.b,c;d:e!f?g",
    "x́. y z. w", "\U0001f600 中文。字", "a▁b", "▁", "x \x00 y", "<0x41> <0x0A>", "ﬁ ①", "a" * 3000, "中" * 900, "\xa0x y",
]


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    table = encoder(A).table()
    piece = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return [], []
        x = [(i, table[i]) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = [(i, piece(i)) for i in b.encode(text)]
        raw = (" " + text).encode()
        return (x, y) if b"".join(t for _, t in x) == raw == b"".join(t for _, t in y) else ([], [])

    return tokens


def expected(docs, tokens):
    links, rows = [], []
    for _, text in docs:
        x, y = tokens(text)
        spans = []
        for side in (x, y):
            ends = np.cumsum([len(t) for _, t in side]).tolist()
            spans.append([(i, e - len(t), e) for (i, t), e in zip(side, ends, strict=True)])
        mine, j = [], 0
        for i, s, e in spans[0]:  # every overlapping pair
            while j and spans[1][j - 1][2] > s:
                j -= 1
            while j < len(spans[1]) and spans[1][j][1] < e:
                if spans[1][j][2] > s:
                    mine.append((i, spans[1][j][0]))
                j += 1
        common = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        cut = [[[] for _ in common] for _ in range(2)]
        for side in (0, 1):
            for i, _, e in spans[side]:
                cut[side][int(np.searchsorted(common, e))].append(str(i))
        groups = ";".join(f"{','.join(p)}|{','.join(q)}" for p, q in zip(*cut, strict=True))
        links.append(mine)
        rows.append((len(x), len(y), len(common), groups))
    count = Counter(p for mine in links for p in mine)
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [
        (n_a, n_b, n_g, len(mine), sum(count[p] == most[p[1]] for p in mine), sum(count[p] for p in mine), groups)
        for (n_a, n_b, n_g, groups), mine in zip(rows, links, strict=True)
    ], count


def texts():
    rng = random.Random(11)
    return list(enumerate(ODD + [r[1] for r in documents()] + [None, prose(rng, 2500), "x" * 5000 + prose(rng, 300)]))


def test_cuts_encode_like_whole_texts(plain):
    pair, some = both(A, B), [t or "" for _, t in texts()]
    flat, bounds = pair.ids(some)
    for k, t in enumerate(some):
        for side, want in enumerate(plain(t)):
            assert flat[side][bounds[side][k] : bounds[side][k + 1]].tolist() == [i for i, _ in want], t


@pytest.mark.parametrize(("work", "block"), [(1 << 17, 32), (500, 3), (7, 50)])
def test_against_brute_force(spark, plain, work, block):
    docs = texts()
    if work == 7:
        docs = [(i, t and t[:400]) for i, t in docs]
    want, _ = expected(docs, plain)
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(2)
    got = {r.doc_id: r for r in alignments(df, A, B, with_groups=True, work=work, block=block).collect()}
    assert len(got) == len(docs)
    for (i, _), (*sums, groups) in zip(docs, want, strict=True):
        r = got[i]
        assert [r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum] == sums
        assert r.groups == groups
        assert r.groups_sha256 == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")


def test_pair_counts(spark, plain):
    docs = texts()[:60]
    _, count = expected(docs, plain)
    got = pair_counts(spark.createDataFrame(docs, "doc_id long, text string"), A, B).collect()
    assert {(r.a_id, r.b_id): r.n for r in got} == dict(count)
    for b in {r.b_id for r in got}:
        mine = [r for r in got if r.b_id == b]
        assert {r.n for r in mine if r.best} == {max(r.n for r in mine)}


def test_diagonals_cut_the_merge():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a, b = (np.unique(rng.integers(1, 40, rng.integers(1, 30))) for _ in range(2))
        merged = sorted([(e, 0) for e in a] + [(e, 1) for e in b])
        for d in range(len(merged) + 1):
            i, j = crossing(a, b, d)
            assert i + j in (d, d + 1)
            assert sorted([*a[:i], *b[:j]]) == [e for e, _ in merged[: i + j]]
            assert not (set(a[:i]) & set(b[j:])) and not (set(a[i:]) & set(b[:j]))


def test_odd_rows(spark):
    got = alignments(frame(spark), A, B).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in documents())
    assert alignments(spark.createDataFrame([], SCHEMA), A, B).collect() == []


def test_string_ids(spark):
    df = spark.createDataFrame([("x", "one two"), (None, "three"), ("y", None)], "name string, body string")
    got = alignments(df, A, B, id_col="name", text_col="body", work=2).collect()
    assert {(r.doc_id, r.n_groups) for r in got} == {("x", 2), (None, 1), ("y", 0)}
