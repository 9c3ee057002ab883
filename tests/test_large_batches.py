"""Registered searches whose query side is over the broadcast budget."""

from __future__ import annotations

import pytest
from check_oracle import canonical, connect

from corpusmill.operators import search as S
from corpusmill.workload import queries as workload

SEARCHES = ["knn_exact_top3", "knn_exact_top16", "knn_ann_ivf", "knn_ann_recall", "knn_threshold", "knn_project",
            "met_doc_recall", "prompt_passage"]


@pytest.mark.parametrize("name", SEARCHES)
def test_no_limit_on_the_number_of_queries(spark, sf_dir, name, monkeypatch):
    for f in (S.exact_top_k, S.ivf_top_k):  # the default budget stands for a table of that many times more vectors
        monkeypatch.setattr(f, "__defaults__", tuple(1000 if x == S.MAX_BROADCAST_BYTES else x for x in f.__defaults__))
    monkeypatch.setattr(workload, "QUERY_BATCH_BYTES", 1000, raising=False)
    monkeypatch.setattr(S, "VECTORS_PER_CELL", 60, raising=False)
    got = workload.registered()[name](spark, sf_dir).toPandas()
    want = connect(sf_dir).execute(workload.oracles()[name]).df()
    assert canonical(got) == canonical(want)
