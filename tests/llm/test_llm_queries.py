"""Registered queries of the training-data operators against their SQL, and the pipeline against its stages."""

from __future__ import annotations

import pytest
from check_oracle import compare, connect
from helpers import documents, frame

import __spark_entry__ as driver
import corpus_pipeline
from corpusmill.llm import queries as llm

WITHOUT_SQL = {
    "op4_quality": "test_llm_quality",
    "op5_ngram_join": "test_llm_ngram_join",
    "op6_near_vectors": "test_llm_vector_graph",
    "op7_token_counts": "test_llm_packing",
    "op8_packing": "test_llm_packing",
    "op11_best_fit": "test_llm_best_fit",
    "op12_alignment": "test_llm_alignment",
}


@pytest.mark.parametrize("name", list(llm.registered()))
def test_matches_sql(spark, sf_dir, name):
    ok, text = compare(spark, connect(sf_dir), name, sf_dir)
    assert ok, text


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in llm.registered()) == list(range(1, 14))
    assert set(llm.registered()) - set(llm.oracles()) == set(WITHOUT_SQL)
    assert {*llm.registered(), "pipeline"} <= set(driver.queries())


@pytest.mark.parametrize("rows", [documents(), []], ids=["odd", "none"])
def test_pipeline_stages(spark, sf_dir, tmp_path, rows):
    docs, columns = frame(spark, rows), None
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        columns = columns or docs.columns
        out = stage(spark, docs, sf_dir)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
            assert out.dtypes == docs.dtypes
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
    assert (docs.count() > 0) == bool(rows)


def test_pipeline_runs(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.filter("sequence_length > 2048").isEmpty()
    assert got.count() > 0
