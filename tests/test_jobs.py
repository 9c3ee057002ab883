"""Whole jobs on small inputs."""

from __future__ import annotations

import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.constants import PROMPT_TEMPLATE
from corpusmill.operators.chunk import fixed_windows
from corpusmill.operators.embed import fit_hash_embedder
from corpusmill.operators.prompt import messages
from corpusmill.operators.quality import WITH_TRUTH
from corpusmill.operators.text_search import build_text_index
from corpusmill.plans.answer import prompts_for, retrieve
from corpusmill.plans.ingest import index_chunks, ingest, open_corpus, reread
from corpusmill.plans.review import quality_report, save_evaluation_set
from corpusmill.session import scratch_dir
from corpusmill.sources.files import load_files
from corpusmill.workload import fixtures as fx


def test_files_to_prompts(spark, tmp_path):
    topics = {"cats": "cat whisker purr kitten", "dogs": "dog bark leash puppy", "fish": "fish fin gill water"}
    for name, words in topics.items():
        (tmp_path / f"{name}.html").write_text(f"<h1>{name}</h1><p>" + (words + " ") * 30 + "</p>")
    (tmp_path / "broken.pdf").write_bytes(b"%PDF")
    name = f"t_{uuid.uuid4().hex}"
    corpus = ingest(
        load_files(spark, str(tmp_path)), name, 3, chunker=fixed_windows(40, 10), train_cells=False,
        docs_path=scratch_dir(spark), chunk_path=scratch_dir(spark), index_path=scratch_dir(spark),
    )
    assert corpus.docs.count() == 4 and spark.table(f"{name}_chunked").count() == corpus.chunks.count() > 3
    assert [d.count() for d in reread(spark, name)] == [4, corpus.chunks.count()]
    trained, _ = index_chunks(corpus.chunks, 2, corpus.embedder)
    assert sum(n for n, _ in trained.cells.values()) == corpus.chunks.count()
    questions = spark.createDataFrame(
        [("1", "puppy bark"), ("2", "gill fin"), ("3", "zzz qqq")], "request_id string, request string"
    )
    passages = retrieve(questions, corpus, k=2, nprobe=3, threshold=0.2)
    rows = passages.collect()
    assert {(r.request_id, r.doc_uri.rsplit("/", 1)[-1]) for r in rows if r["rank"] == 1} >= {("1", "dogs.html"), ("2", "fish.html")}
    # Against a plain search over the same vectors.
    embed = lambda df, c: {r[0]: np.array(r[1]) for r in corpus.embedder.embed(df, c).select(df.columns[0], "embedding").collect()}
    chunk_vectors = embed(corpus.chunks.select("chunk_id", "content_chunked"), "content_chunked")
    for request, vector in embed(questions, "request").items():
        scores = sorted((-round(float(vector @ v / max(np.linalg.norm(v) * np.linalg.norm(vector), 1e-12)), 5), c) for c, v in chunk_vectors.items())
        want = [s for s, _ in scores[:2] if -s >= 0.2]
        got = [-round(r.score, 5) for r in sorted(rows, key=lambda r: r["rank"]) if r.request_id == request]
        assert np.allclose(got, want, atol=2e-5)
    again = open_corpus(spark, name, corpus.index.path)
    assert sorted(retrieve(questions, again, k=2, nprobe=3, threshold=0.2).collect()) == sorted(rows)
    words = build_text_index(corpus.chunks)
    by_words = {r.request_id: r for r in retrieve(questions, corpus, k=1, query_type="words", words=words).collect()}
    assert {i: r.doc_uri.rsplit("/", 1)[-1] for i, r in by_words.items()} == {"1": "dogs.html", "2": "fish.html"}
    both = retrieve(questions, corpus, k=4, nprobe=3, threshold=0.2, query_type="hybrid", words=words).collect()
    assert {r.chunk_id for r in by_words.values()} <= {r.chunk_id for r in both} and set(both[0].asDict()) == set(rows[0].asDict())
    with pytest.raises(ValueError, match="needs an index"):
        retrieve(questions, corpus, query_type="hybrid")
    other = fit_hash_embedder(questions, "request")
    with pytest.raises(ValueError, match="index holds"):
        open_corpus(spark, name, corpus.index.path, embedder=other)
    prompts = {r.request_id: r for r in prompts_for(questions, passages).collect()}
    assert prompts["3"].n_passages == 0 and prompts["3"].prompt == PROMPT_TEMPLATE.replace("{context}", "")
    assert prompts["1"].prompt.count("Passage text: ") == prompts["1"].n_passages >= 1


def test_messages(spark):
    df = spark.createDataFrame([("q", [("user", "a"), ("assistant", "b")]), ("r", None)], "u string, h array<struct<role:string,content:string>>")
    got = [[tuple(m) for m in r[0]] for r in df.select(messages("u", "h", "sys")).collect()]
    assert got == [
        [("system", "sys"), ("user", "a"), ("assistant", "b"), ("user", "q")],
        [("system", "sys"), ("user", "r")],
    ]
    assert [tuple(m) for m in df.select(messages("u", system="s")).first()[0]] == [("system", "s"), ("user", "q")]


def test_logs_to_report(spark, sf_dir):
    table = f"t_{uuid.uuid4().hex}"
    stored = save_evaluation_set(
        fx.request_log(spark, sf_dir), fx.assessment_log(spark, sf_dir), table, path=scratch_dir(spark)
    )
    assert stored.count() == fx.request_log(spark, sf_dir).count() == spark.table(table).count()
    report = quality_report(fx.eval_results(spark, sf_dir), WITH_TRUTH)
    labelled = report.labelled.count()
    assert report.summary.first().n_requests == labelled
    assert report.root_causes.agg(F.round(F.sum("pct"), 3)).first()[0] == 100.0
    unlabelled = report.labelled.filter("root_cause is null").count()
    assert report.root_causes.agg(F.sum("n")).first()[0] == labelled - unlabelled
    assert report.retrieval_issues.count() + report.generation_issues.count() <= labelled
