"""Parsing: dispatch, failures kept as rows, hooks, extra fields."""

from __future__ import annotations

from datetime import datetime

from conftest import plan_of
from pyspark.sql import functions as F

from corpusmill.constants import SUCCESS
from corpusmill.operators.parse import apply_parser, html_parser, parse_files, plain_text_parser, status_counts
from corpusmill.schemas import RAW_FILE, ParsedDocument, record_schema

T0 = datetime(2024, 5, 1, 12, 0, 0)
FILES = [
    ("store:/v/a.html", b"<h1>A</h1>\n\n\n\n<p>a test</p>"),
    ("store:/v/b.HTML", b"<p>upper</p>"),
    ("store:/v/c.pdf", b"%PDF"),
    ("store:/v/noext", b"x"),
    ("store:/v/bad.html", b"\xff<p>x</p>"),
    ("store:/v/d e.txt", b"plain words"),
    ("store:/v/boom.txt", b"boom"),
]


def raw(spark):
    return spark.createDataFrame([(p, T0, len(c), bytearray(c)) for p, c in FILES], RAW_FILE)


def make_hook():
    """Inside a function, so that workers get its code and need not import this file."""

    def hook(content, path, modified, length):
        text = content.decode("utf-8")
        if text == "boom":
            raise ValueError("cannot read this one")
        assert length == len(content)
        return {"doc_content": text.upper(), "parser_status": "SUCCESS", "doc_uri": path, "last_modified": modified}

    return hook


def test_default_parsers(spark):
    rows = parse_files(raw(spark)).collect()
    assert len(rows) == len(FILES)
    ok = [r for r in rows if r.parser_status == SUCCESS]
    assert [(r.doc_content, r.doc_uri, r.example_metadata, r.last_modified) for r in ok] == [
        ("# A\n\na test", "v/a.html", "test", T0)
    ]
    for r in rows:
        if r.parser_status != SUCCESS:
            assert r.parser_status.startswith("ERROR: An error occurred: ")
            assert (r.doc_content, r.doc_uri, r.example_metadata, r.last_modified) == ("", None, None, None)
    assert any(r.parser_status.endswith("No supported parser for store:/v/b.HTML") for r in rows)
    counts = {r.outcome: r.n_docs for r in status_counts(parse_files(raw(spark))).collect()}
    assert counts == {"SUCCESS": 1, "ERROR": 6}


def test_options(spark):
    rows = parse_files(raw(spark), fold_case=True, keep_failed_uri=True).collect()
    assert {r.doc_uri for r in rows if r.parser_status == SUCCESS} == {"v/a.html", "v/b.HTML"}
    assert all(r.doc_uri and r.last_modified == T0 for r in rows)


def test_python_hook_failure_is_one_row(spark):
    df = parse_files(raw(spark), {".html": html_parser}, {".txt": make_hook()})
    rows = {r.doc_content or r.parser_status[-60:]: r for r in df.collect()}
    assert rows["PLAIN WORDS"].last_modified == T0
    failed = [r for r in rows.values() if "cannot read this one" in r.parser_status]
    assert len(failed) == 1 and failed[0].doc_uri is None and "Traceback" in failed[0].parser_status
    assert len(rows) == len(FILES)
    assert plan_of(df).count("ArrowEvalPython [") <= 1


def test_wrong_type_is_an_error_row(spark):
    df = apply_parser(raw(spark), lambda c, p, m, n: {"doc_content": 5, "parser_status": SUCCESS})
    assert all(r.parser_status.startswith("ERROR") and r.doc_content == "" for r in df.collect())


def test_any_record_type(spark):
    class Wide(ParsedDocument):
        n_bytes: int
        words: list[str]

    def parse(content, path, modified, length):
        return {"doc_content": "x", "parser_status": SUCCESS, "n_bytes": length, "words": path.split("/")}

    rows = apply_parser(raw(spark), parse, record_schema(Wide)).collect()
    assert {r.n_bytes for r in rows} == {len(c) for _, c in FILES}
    assert rows[0].words[0] == "store:"


def test_extra_native_fields(spark):
    class Tagged(ParsedDocument):
        n_chars: int

    df = parse_files(
        raw(spark), {".txt": plain_text_parser}, metadata={"n_chars": lambda t: F.length(t)}, schema=record_schema(Tagged)
    )
    got = {r.doc_uri: r.n_chars for r in df.collect() if r.parser_status == SUCCESS}
    assert got == {"v/d e.txt": 11, "v/boom.txt": 4}
