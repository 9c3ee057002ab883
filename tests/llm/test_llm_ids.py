"""Ids of other kinds: carried where an operator keeps them as they are, refused where it compares them as numbers."""

from __future__ import annotations

import public_tokenizers
import pytest

from corpusmill.llm.lines import line_dedup
from corpusmill.llm.ngram_join import ngram_classes, without_near_copies
from corpusmill.llm.packing import pack
from corpusmill.llm.quality import good_documents, quality_scores
from corpusmill.llm.substrings import repeated_passages
from corpusmill.llm.token_spans import token_counts
from corpusmill.llm.vector_graph import near_vectors
from corpusmill.llm.warc import captures

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_strings_are_refused_before_any_job(spark):
    docs = spark.createDataFrame([("x", "one two")], "doc_id string, text string")
    pages = spark.createDataFrame([("x", "http://a/b", "t")], "page_id string, url string, html string")
    vectors = spark.createDataFrame([("x", [1.0], 1)], "vec_id string, embedding array<double>, label int")
    for run in (line_dedup, ngram_classes, without_near_copies, repeated_passages):
        with pytest.raises(TypeError, match="doc_id must hold whole numbers"):
            run(docs)
    for run in (pack, token_counts):
        with pytest.raises(TypeError, match="doc_id must hold whole numbers"):
            run(docs, PATH)
    with pytest.raises(TypeError, match="page_id must hold whole numbers"):
        captures(pages)
    with pytest.raises(TypeError, match="vec_id must hold whole numbers"):
        near_vectors(vectors)


@pytest.mark.parametrize("kind", ["int", "string", "long"])
def test_quality_carries_any_id(spark, kind):
    rows = [(i, f"good words number {i}" if i % 2 else f"zz@@ {i} ##") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(f"cast(doc_id as {kind}) as doc_id", "text")
    labels = docs.selectExpr("doc_id", "cast(cast(doc_id as int) % 2 as int) as quality")
    scored = quality_scores(docs, labels).collect()
    assert len(scored) == 60 and all(r.predicted == int(r.doc_id) % 2 for r in scored)
    assert good_documents(docs, labels).schema == docs.schema
    assert good_documents(docs, labels).count() == 30


def test_near_copies_with_clashing_names(spark):
    rows = [(1, "a b c d e f g", 1, "x"), (2, "a b c d e f g", 2, "y"), (None, "a b c d e f g", 3, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, copy int, Copy_ string")
    assert sorted(r["Copy_"] for r in without_near_copies(docs).collect()) == ["x", "z"]
