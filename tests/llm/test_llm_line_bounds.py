"""Line dedup with a bound that grows with the line, against the edit distance of all pairs."""

from __future__ import annotations

import random

import pytest
from helpers import prose, words

from corpusmill.llm import lines as module
from corpusmill.session import settings


def distance(a: list[str], b: list[str]) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def edited(rng: random.Random, line: list[str], n: int) -> list[str]:
    line = list(line)
    for _ in range(n):
        at, kind = rng.randrange(len(line)), rng.randrange(3)
        line[at : at + (kind != 0)] = [] if kind == 1 else [f"new{rng.randrange(9)}"]
    return line


@pytest.mark.parametrize("chunk", [500, 3])
def test_bound_grows_with_the_line(spark, monkeypatch, chunk):
    monkeypatch.setattr(module, "CHUNK", chunk, raising=False)
    rng, texts = random.Random(5), []
    for n in (4, 5, 9, 19, 20, 21, 35, 60, 140):
        line = prose(rng, n).split()
        texts += [line, *[edited(rng, line, e) for e in (1, 1, 2, 2, 3, 4, 6, 9, 13, 15)]]
    base = prose(rng, 50).split()
    texts += [edited(rng, base, rng.randrange(2, 5)) for _ in range(30)]  # a family; not all are near its first
    texts += [["w"] * 40, ["w"] * 43, ["w"] * 50, ["u", "v"] * 20, ["v", "u"] * 21]
    rng.shuffle(texts)
    want = {}
    for i, b in enumerate(texts):
        gone = any(
            a == b or min(len(a), len(b)) >= 5 and distance(a, b) <= max(1, min(len(a), len(b)) // 10) for a in texts[:i]
        )
        want[i] = "" if gone else " ".join(b)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in module.line_dedup(df, words_per_edit=10).collect()}
    assert got == want
    assert all(words(t) == t.split() for t in want.values())


def test_too_wide_a_bound(spark):
    with pytest.raises(ValueError, match="words_per_edit"):
        module.line_dedup(spark.createDataFrame([], "doc_id long, text string"), words_per_edit=3)


@pytest.mark.parametrize("per_edit, first", [(6, 1), (13, 2)])
def test_other_bounds_and_lines_behind_the_first_of_their_groups(spark, monkeypatch, per_edit, first):
    """Pairs share a least run whatever the bound, and lines that the first of a group do not settle are settled by their parts."""
    monkeypatch.setattr(module, "FIRST", first)
    rng, texts = random.Random(per_edit), []
    for n in (2 * per_edit, 2 * per_edit + 1, 3 * per_edit - 1, 3 * per_edit, 60, 90):
        line = prose(rng, n).split()
        texts += [line, *[edited(rng, line, e) for e in (2, 2, 3, n // per_edit, n // per_edit, n // per_edit + 1)]]
    base = prose(rng, 50).split()
    texts += [edited(rng, base, rng.randrange(2, 6)) for _ in range(25)]
    rng.shuffle(texts)

    def near(a: list[str], b: list[str]) -> bool:
        return a == b or min(len(a), len(b)) >= 5 and distance(a, b) <= max(1, min(len(a), len(b)) // per_edit)

    want = {i: "" if any(near(a, b) for a in texts[:i]) else " ".join(b) for i, b in enumerate(texts)}
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id: r.text for r in module.line_dedup(df, words_per_edit=per_edit).collect()} == want


def test_small_groups_go_no_further(spark, monkeypatch):
    """Only lines with others than the first of a group before them get variants of their parts."""
    asked, variants = [], module._part_variants
    monkeypatch.setattr(module, "_part_variants", lambda words, p: (asked.append(words.count()), variants(words, p))[1])
    rng, rows = random.Random(3), []
    for k in range(6):
        line = prose(rng, 40).split()
        rows += [(2 * k, " ".join(line)), (2 * k + 1, " ".join(["new", *line[1:20], "word", *line[21:]]))]
    got = module.line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), words_per_edit=10).collect()
    assert {r.doc_id for r in got if not r.text} == {1, 3, 5, 7, 9, 11}
    assert asked == [0]


def test_lines_that_share_a_passage_alone_do_not_meet(spark):
    """Lines with more runs of their own than their edits can take are not asked for; lines of a family meet by a run at least."""
    rng = random.Random(11)
    passage = [f"p{i}" for i in range(20)]
    family = [f"f{i}" for i in range(60)]
    texts = [[*(f"a{k}x{i}" for i in range(15)), *passage, *(f"b{k}x{i}" for i in range(25))] for k in range(30)]
    texts += [family, edited(rng, family, 6), ["w"] * 40, ["w"] * 43]
    rows = [(k, 0, k, k, len(t), True, t) for k, t in enumerate(texts)]
    lines = spark.createDataFrame(rows, "doc_id long, line_no int, h1 long, h2 long, n int, open boolean, w array<string>")
    met = {}
    for r in module._part_variants(lines, 10).select("h1", "v").collect():
        met.setdefault(r.v, set()).add(r.h1)
    assert {frozenset(x) for x in met.values() if len(x) > 1} == {frozenset({30, 31}), frozenset({32, 33})}
    assert not any(k < 30 for x in met.values() for k in x)


def test_words_of_pairs_are_moved_once(spark, tmp_path):
    """Both lines of a pair get their words from one reading, planned alike, so that one shuffle serves both."""
    rows = [(k, k, [f"w{i}" for i in range(20 + k)]) for k in range(3)]
    spark.createDataFrame(rows, "h1 long, h2 long, w array<string>").write.parquet(f"{tmp_path}/words")
    pairs = spark.createDataFrame([(1, 0), (2, 0)], "h1 long, q1 long")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        found = module._within(pairs, spark.read.parquet(f"{tmp_path}/words"), 10)
        assert found._jdf.queryExecution().executedPlan().toString().count("ReusedExchange") == 1
        assert {r.h1 for r in found.collect()} == {1, 2}
