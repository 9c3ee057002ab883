"""What the physical plans of the registered queries must and must not hold."""

from __future__ import annotations

import re

import pytest
from conftest import plan_of

from corpusmill.workload import queries as workload

NARROW = [
    "src_table_scan", "scl_doc_uri", "scl_user_slug", "scl_flag_test", "scl_decode_utf8", "vec_ivf_assign",
]
PRUNED = {
    "scl_flag_test": {"doc_id", "text"},
    "chat_history": {"conv_id", "turn", "role", "text"},
    "log_dedup": {"event_id", "ts", "user_id", "event_type", "value", "props"},
    "vec_ivf_assign": {"vec_id", "embedding"},
}


def columns_read(plan: str) -> set[str]:
    return {c.split(":")[0] for s in re.findall(r"ReadSchema: struct<([^\n]*)>", plan) for c in re.split(r",(?=\w+:)", s)}


@pytest.mark.parametrize("name", list(workload.registered()))
def test_no_cross_joins_and_no_row_udfs(spark, sf_dir, name):
    plan = plan_of(workload.registered()[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "CollectLimit", "LocalLimit"):
        assert bad not in plan


@pytest.mark.parametrize("name", NARROW)
def test_row_wise_queries_do_not_shuffle(spark, sf_dir, name):
    assert "Exchange" not in plan_of(workload.registered()[name](spark, sf_dir))


@pytest.mark.parametrize("name", list(PRUNED))
def test_only_wanted_columns_are_read(spark, sf_dir, name):
    assert columns_read(plan_of(workload.registered()[name](spark, sf_dir))) == PRUNED[name]


def test_search_reads_ids_and_vectors_only(spark, sf_dir):
    from corpusmill.operators.search import exact_top_k
    from corpusmill.workload import fixtures as fx

    queries, vectors = fx.query_vectors(spark, sf_dir), fx.vectors(spark, sf_dir)
    plan = plan_of(exact_top_k(queries, vectors, 16, key="chunk_id", skip_self=True, method="broadcast"))
    assert columns_read(plan) == {"vec_id", "embedding"}
    # by cells the table is read when cells are stored; what the search itself reads are those stored columns
    read = columns_read(plan_of(workload.registered()["knn_exact_top16"](spark, sf_dir)))
    assert read <= {"query_id", "chunk_id", "embedding", "cell", "rank", "score"}


@pytest.mark.parametrize("name", ["log_dedup", "eval_join", "knn_exact_top16", "knn_ann_ivf"])
def test_groups_are_limited_before_the_shuffle(spark, sf_dir, name):
    plan = plan_of(workload.registered()[name](spark, sf_dir))
    assert re.search(r"WindowGroupLimit .*Partial", plan) and re.search(r"WindowGroupLimit .*Final", plan)


def test_one_count_serves_shares_and_total(spark, sf_dir):
    df = workload.registered()["agg_root_cause_freq"](spark, sf_dir)
    df.collect()
    assert "ReusedExchange" in plan_of(df)


def test_index_search_reads_probed_cells_only(spark):
    from pyspark.sql import functions as F

    from corpusmill.operators.index import build_index, hash_pivots
    from corpusmill.operators.search import ivf_top_k

    rows = [(i, [float(i % 7) - 3, float(i % 5) - 2, 1.0]) for i in range(100)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    index = build_index(vectors, hash_pivots(vectors, 8))
    one = vectors.filter(F.col("vec_id") == 3).withColumnRenamed("vec_id", "query_id")
    for method in ("cells", "broadcast"):
        plan = plan_of(ivf_top_k(one, index, 3, nprobe=1, method=method))
        assert re.search(r"PartitionFilters: \[.*cell", plan)
        assert all("cell_score" not in part.split(">")[0] for part in plan.split("ReadSchema")[1:])
