from __future__ import annotations

from helpers import SCHEMA, documents, frame, unique_ids, words

from corpusmill.llm import lines
from corpusmill.llm.lines import line_dedup


def near(a: list[str], b: list[str]) -> bool:
    if abs(len(a) - len(b)) > 1 or min(len(a), len(b)) < 5:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(rows) -> dict:
    lines = [(d, i, words(x)) for d, t, *_ in rows if t is not None for i, x in enumerate(t.split("\n"))]
    lines = sorted((x for x in lines if x[2]), key=lambda x: x[:2])
    gone, first = set(), []
    for d, i, w in lines:
        if any(w == o or near(w, o) for o in first):
            gone.add((d, i))
        if w not in first:
            first.append(w)
    keep = lambda d, t: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone)
    return {d: None if t is None else keep(d, t) for d, t, *_ in rows}


def test_against_brute_force(spark):
    rows = unique_ids(documents())
    got = line_dedup(frame(spark, rows))
    assert got.columns == frame(spark, rows).columns
    assert {r.doc_id: r.text for r in got.collect()} == expected(rows)


def test_short_lines_of_all_lengths(spark):
    rows = []
    for n in range(1, 40):
        w = [f"w{n}x{i}" for i in range(n)]
        for k, line in enumerate([w, w[: n // 2] + w[n // 2 + 1 :], ["new", *w], [*w, "new"], [*w[:-1], "end"], w[::-1]]):
            rows.append((100 * n + k, " ".join(line)))
    assert {r.doc_id: r.text for r in line_dedup(frame(spark, rows)).collect()} == expected(rows)


def test_odd_rows(spark):
    got = line_dedup(frame(spark)).collect()
    assert len(got) == len(documents())
    assert sorted(str(r.text) for r in got if r.doc_id is None) == sorted(str(r[1]) for r in documents() if r[0] is None)
    assert len({r.text for r in got if r.doc_id == 5}) == 1  # equal rows are one document


def test_empty_table(spark):
    assert line_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_very_long_line(spark):
    long = [f"w{i}" for i in range(3000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:2000] + ["x"] + long[2001:])), (3, " ".join(long[:9] + long[10:]))]
    got = line_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.text for r in got.collect()} == {1: " ".join(long), 2: "", 3: ""}


def test_runs_of_long_lines_are_made_once(spark, monkeypatch):
    """Lines that share a run are found by one shuffle of the runs, not by counting runs and joining them again."""
    plans, spill = [], lines.spill
    monkeypatch.setattr(lines, "spill", lambda df: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), spill(df))[1])
    long = " ".join(f"w{i}" for i in range(40))
    base = spark.createDataFrame([(1, long), (2, long.replace("w7 ", "x ").replace("w31 ", "y ")), (3, long.replace("w", "z"))], "doc_id long, text string")
    found = lines._sharing(base, 20, 10)
    assert found.count() == 2
    assert plans[0].count("Generate explode") == 2


def test_variants_are_made_once(spark):
    """Groups of variants and their members come from one making and one shuffle of the variants."""
    rows = [(1, "a b c d e f"), (2, "a b c d e x"), (3, "a b c d e"), (4, "z y x w v u")]
    base = spark.createDataFrame(rows, "doc_id long, text string").withColumn("th", lines._text_hash())
    late = lines._late_lines(base, lines.spill(lines._occurrences(base, 5)), 5)
    assert late.count() == 2
    assert late._jdf.queryExecution().optimizedPlan().toString().count("Union") == 1


def test_words_are_parted_by_any_white_space(spark):
    text = " \ta\x0bb\x0c\x0cc\rd \t e f \r"
    got = spark.createDataFrame([(text,), ("\t \r",), ("",)], "line string").select(lines._words(lines.F.col("line")).alias("w")).collect()
    assert [r.w for r in got] == [["a", "b", "c", "d", "e f"], [], []]
