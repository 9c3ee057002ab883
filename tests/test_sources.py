"""Files, tables, hand-written rows, typed schemas."""

from __future__ import annotations

from datetime import datetime
from typing import TypedDict

import pytest
from conftest import plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.operators.parse import parse_files
from corpusmill.schemas import EVALUATION_ROW, PARSED_DOCUMENT, propagated_columns, record_schema
from corpusmill.session import exists, scratch_dir, settings, spill, spread
from corpusmill.sources import tables
from corpusmill.sources.eval_rows import conform_eval_rows, inline_eval_rows
from corpusmill.sources.files import load_files, store_files
from corpusmill.sources.tables import default_chunk_table, overwrite_table, read_table


class Inner(TypedDict):
    x: int


class Outer(TypedDict, total=False):
    a: list[Inner]
    b: float | None
    c: bytes
    d: bool
    e: list[list[str]]
    f: datetime


def test_files_to_documents(spark, tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "a b.html").write_text("<h1>Tést</h1>")
    (tmp_path / "deep" / "er" / "c.html").write_bytes(b"\xff")
    (tmp_path / "deep" / "d.docx").write_bytes(b"zip")
    files = load_files(spark, str(tmp_path))
    assert files.columns == ["path", "modificationTime", "length", "content"]
    assert sorted(r.length for r in files.collect()) == [1, 3, 14]
    assert "content" not in plan_of(files.select("path", "length")).split("ReadSchema")[1]
    assert load_files(spark, str(tmp_path), "*.docx").count() == 1
    docs = parse_files(files, keep_failed_uri=True).collect()
    by_name = {r.doc_uri.rsplit("/", 1)[-1]: r for r in docs}
    assert by_name["a%20b.html"].doc_content == "# Tést" if "a%20b.html" in by_name else by_name["a b.html"].doc_content == "# Tést"
    assert by_name["c.html"].parser_status.endswith("content is not valid UTF-8")
    assert "No supported parser for file:" in by_name["d.docx"].parser_status


def test_every_given_file_is_listed(spark, sf_dir):
    files = load_files(spark, sf_dir).select("path", "length").collect()
    assert len(files) == 14 and all(f.length > 0 for f in files)


def test_a_file_per_key_lies_in_few_folders(spark, monkeypatch, tmp_path):
    rows = [(i, f"é{i}\nmore") for i in range(200)] + [(7, "again"), (8, None), (9, ""), (None, "no key")]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    store_files(pages, f"file://{tmp_path}/a b", "page_id", "html")
    assert len(list((tmp_path / "a b").iterdir())) <= 64  # not a folder for each file
    found = {r.path.rsplit("page_id=", 1)[1]: bytes(r.content) for r in load_files(spark, f"{tmp_path}/a b", "*.txt").collect()}
    assert found.pop("__HIVE_DEFAULT_PARTITION__.txt") == b"no key\n"
    assert sorted(found.pop("7.txt").split(b"\n")) == sorted("é7\nmore\nagain\n".encode().split(b"\n"))
    assert found.pop("8.txt") in ("é8\nmore\n\n".encode(), "\né8\nmore\n".encode())
    assert found.pop("9.txt") in ("é9\nmore\n\n".encode(), "\né9\nmore\n".encode())
    assert found == {f"{i}.txt": f"é{i}\nmore\n".encode() for i in range(200) if i not in (7, 8, 9)}
    store_files(pages.limit(0), f"{tmp_path}/none", "page_id", "html")
    assert load_files(spark, f"{tmp_path}/none", "*.txt").count() == 0


def test_small_files_are_read_many_a_task(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"{i}.txt").write_text("x" * (i + 1))
    with settings(spark, {"spark.sql.files.openCostInBytes": str(64 << 20)}):
        files = load_files(spark, str(tmp_path), "*.txt")
        assert files.rdd.getNumPartitions() <= 8 * spark.sparkContext.defaultParallelism
        assert sorted(r.length for r in files.collect()) == list(range(1, 301))


def test_overwrite_replaces_schema(spark):
    where = scratch_dir(spark)
    overwrite_table(spark.range(3).toDF("a"), "t_overwrite", path=where)
    back = overwrite_table(spark.createDataFrame([("x", 1.5)], "b string, c double"), "t_overwrite", path=where)
    assert back.columns == ["b", "c"] and back.collect()[0].b == "x"
    assert read_table(spark, "t_overwrite").count() == 1
    spark.sql("drop table t_overwrite")


def test_failed_replacement_keeps_the_old_rows(spark, monkeypatch):
    name = "t_failing"
    overwrite_table(spark.range(3).toDF("a"), name, path=scratch_dir(spark))
    broken = spark.range(3).select(F.raise_error(F.lit("lost")).cast("long").alias("a"))
    with pytest.raises(Exception, match="lost"):
        overwrite_table(broken, name)
    assert spark.table(name).count() == 3
    with monkeypatch.context() as m:  # killed when all is written and nothing turned
        m.setattr(tables, "_turn", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            overwrite_table(spark.range(9).toDF("a"), name)
    assert spark.table(name).count() == 3 and tables.previous_locations(spark, name) == []
    with monkeypatch.context() as m:  # other columns, and the catalog refuses
        m.setattr(type(spark.catalog), "createTable", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("no")))
        with pytest.raises(RuntimeError):
            overwrite_table(spark.range(9).toDF("b"), name)
    assert spark.table(name).columns == ["a"] and spark.table(name).count() == 3
    spark.sql(f"drop table {name}")


@pytest.mark.parametrize("managed", [False, True])
def test_versions_of_a_table(spark, managed):
    name = f"t_versions_{managed}".lower()
    overwrite_table(spark.range(4).toDF("a"), name, path=None if managed else scratch_dir(spark))
    first = tables.table_location(spark, name)
    old = spark.table(name)
    overwrite_table(spark.table(name).filter("a > 1"), name)  # reads what it replaces
    assert [r.a for r in spark.table(name).orderBy("a").collect()] == [2, 3]
    assert spark.read.parquet(first).count() == 4 and old.columns == ["a"]
    second = tables.table_location(spark, name)
    assert tables.previous_locations(spark, name) == [first] and second != first
    back = overwrite_table(spark.table(name).selectExpr("a", "a * 2 as b"), name)
    assert sorted(map(tuple, back.collect())) == [(2, 4), (3, 6)]
    assert first in tables.previous_locations(spark, name)
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name}_before")]
    gone = tables.delete_previous(spark, name)
    assert first in gone and not exists(spark, first) and not exists(spark, second)
    assert tables.previous_locations(spark, name) == [] and spark.table(name).count() == 2
    spark.sql(f"drop table {name}")


def test_chunk_table_name():
    assert default_chunk_table("c.s.docs") == "c.s.docs_chunked"
    assert default_chunk_table("`my docs`") == "`my docs_chunked`"
    assert default_chunk_table("docs", "given") == "given"


def test_typed_schema():
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in PARSED_DOCUMENT.fields] == [
        ("doc_content", "string", True),
        ("parser_status", "string", True),
        ("doc_uri", "string", True),
        ("example_metadata", "string", True),
        ("last_modified", "timestamp", True),
    ]
    assert propagated_columns(PARSED_DOCUMENT) == ["parser_status", "doc_uri", "example_metadata", "last_modified"]

    assert record_schema(Outer).simpleString() == (
        "struct<a:array<struct<x:bigint>>,b:double,c:binary,d:boolean,e:array<array<string>>,f:timestamp>"
    )
    with pytest.raises(TypeError):
        record_schema(dict)


def test_inline_rows(spark):
    rows = [
        {"request": "What is it?"},
        {"request": "q", "request_id": "1", "expected_response": "a", "expected_retrieved_context": [{"doc_uri": "d"}]},
    ]
    df = inline_eval_rows(spark, rows)
    assert df.schema == EVALUATION_ROW
    got = df.collect()
    assert got[0].expected_retrieved_context is None and got[1].expected_retrieved_context[0].doc_uri == "d"
    with pytest.raises(ValueError, match="no request"):
        inline_eval_rows(spark, [{"request_id": "1"}])
    with pytest.raises(ValueError, match="unknown keys"):
        inline_eval_rows(spark, [{"request": "q", "reqest_id": "1"}])


def test_conform_rows(spark):
    df = conform_eval_rows(spark.createDataFrame([(7, "q")], "id int, text string"), request="text", request_id="id")
    assert df.schema.simpleString() == EVALUATION_ROW.simpleString()
    assert df.first().request_id == "7"
    with pytest.raises(ValueError):
        conform_eval_rows(df, request_id="request_id")


def test_scratch_is_the_clusters(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_dir(spark)
    assert path != scratch_dir(spark)
    if base:
        assert path.startswith(base)


def test_spill_keeps_rows_and_schema(spark):
    df = spark.createDataFrame([(1, ["a"], None)], T.StructType.fromDDL("a int, b array<string>, c double"))
    back = spill(df)
    assert back.collect() == df.collect() and "Scan parquet" in plan_of(back)


def test_spread_leaves_wide_tables_alone(spark):
    wide = spark.range(100, numPartitions=50)
    assert spread(wide) is wide
    assert "Exchange" in plan_of(spread(spark.range(100, numPartitions=1)))
