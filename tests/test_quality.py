"""Rule matrices in full, metrics, frequencies, reports."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusmill import constants as K
from corpusmill.operators import quality as Q

SCHEMA = "i int, precision double, groundedness string, correctness string, relevance string"
PRECISIONS = [0.0, 0.49, 0.5, 1.0, float("nan"), None]
RATINGS = ["yes", "no", None, "Yes"]


def all_rows():
    return [(i, *row) for i, row in enumerate(itertools.product(PRECISIONS, RATINGS, RATINGS, RATINGS))]


def expected(rules, precision, **ratings):
    """The rules with plain comparisons: an unknown value never matches."""
    label = (None, None, None)
    for side, g, c, r, *value in rules:
        if precision is None or np.isnan(precision):
            continue
        fits = precision < 0.5 if side == "low" else precision >= 0.5
        tests = {"groundedness": g, "correctness": c, "relevance": r}
        if fits and all(want is None or ratings[name] == want for name, want in tests.items()):
            label = tuple(value)
    return label


@pytest.mark.parametrize("with_truth", [False, True])
def test_every_combination(spark, with_truth):
    table = K.RULES_WITH_TRUTH if with_truth else [(s, g, None, r, *v) for s, g, r, *v in K.RULES_WITHOUT_TRUTH]
    rules = Q.WITH_TRUTH if with_truth else Q.WITHOUT_TRUTH
    rows = all_rows()
    got = Q.classify(spark.createDataFrame(rows, SCHEMA), rules).orderBy("i").collect()
    for row, (_, p, g, c, r) in zip(got, rows, strict=True):
        want = expected(table, p, groundedness=g, correctness=c, relevance=r)
        assert (row.root_cause, row.assessment, row.rationale) == want


def test_gap_of_the_eleven_rules(spark):
    row = spark.createDataFrame([(0, 0.5, "yes", "yes", "no")], SCHEMA)
    assert Q.classify(row, Q.WITH_TRUTH).first().root_cause is None
    assert len(Q.WITHOUT_TRUTH) == 8 and len(Q.WITH_TRUTH) == 11


def test_last_matching_rule_wins(spark):
    rules = [
        Q.Rule(None, {"groundedness": "yes"}, "first", "fail", "a"),
        Q.Rule("high", {"groundedness": "yes"}, "second", "pass", "b"),
    ]
    rows = spark.createDataFrame([(0, 0.9, "yes", None, None), (1, 0.1, "yes", None, None)], SCHEMA)
    assert [r.root_cause for r in Q.classify(rows, rules).orderBy("i").collect()] == ["second", "first"]


def test_gaps_and_overlaps_of_the_rules():
    assert Q.gaps(Q.WITHOUT_TRUTH) == [] and Q.overlaps(Q.WITHOUT_TRUTH) == []
    assert Q.gaps(Q.WITH_TRUTH) == [{"side": "high", "groundedness": "yes", "correctness": "yes", "relevance": "no"}]
    assert Q.overlaps(Q.WITH_TRUTH) == []
    two = [Q.Rule(None, {"a": "x"}, "1", "", ""), Q.Rule("low", {"b": "y"}, "2", "", ""), Q.Rule("low", {"a": "x", "b": "y"}, "2", "", "")]
    assert Q.overlaps(two) == [({"side": "low", "a": "x", "b": "y"}, [0, 1, 2])]
    assert {"side": "high", "a": "x", "b": "y"} not in Q.gaps(two) and Q.overlaps(two[1:]) == []


def test_coverage_counts_every_row_once(spark):
    rows = all_rows()
    got = Q.rule_coverage(spark.createDataFrame(rows, SCHEMA), Q.WITH_TRUTH).collect()
    assert len(got) == 3 * 3 * 3 * 3 and sum(r.n_results for r in got) == len(rows)
    case = next(r for r in got if (r.side, r.groundedness, r.correctness, r.relevance) == ("high", "yes", "yes", "no"))
    assert (case.n_rules, case.n_results) == (0, 2)
    unknown = next(r for r in got if (r.side, r.groundedness, r.correctness, r.relevance) == (None, None, None, None))
    assert (unknown.n_rules, unknown.n_results) == (0, 2 * 2 * 2 * 2)


def test_rules_kept_as_rows(spark):
    rows = [(i, side, g, c, r, *label) for i, (side, g, c, r, *label) in enumerate(K.RULES_WITH_TRUTH)]
    schema = "place int, side string, groundedness string, correctness string, relevance string, root_cause string, assessment string, rationale string"
    table = spark.createDataFrame(rows[::-1], schema)
    assert Q.rules_from_table(table, ["groundedness", "correctness", "relevance"]) == Q.WITH_TRUTH


def test_too_many_cases_and_bad_sides():
    many = [Q.Rule(None, {f"c{i}": "yes"}, "", "", "") for i in range(14)]
    with pytest.raises(ValueError, match="cases"):
        Q.cases(many)
    with pytest.raises(ValueError, match="side"):
        Q.cases([Q.Rule("middle", {}, "", "", "")])


def test_frequencies_are_value_counts(spark):
    labels = ["a"] * 5 + ["b"] * 2 + ["c"] + [None] * 4
    got = Q.frequencies(spark.createDataFrame([(v,) for v in labels], "label string"), "label").collect()
    want = pd.Series(labels).value_counts(normalize=True) * 100
    assert [r["label"] for r in got] == list(want.index)
    assert [r["pct"] for r in got] == [round(v, 6) for v in want]


def test_frequencies_of_nothing(spark):
    assert Q.frequencies(spark.createDataFrame([(None,)], "label string"), "label").collect() == []


def test_precision_and_recall(spark):
    rows = [
        (1, ["yes", "no", "yes", "no"], ["a", "b", "a"], ["a", "c", "a", "b", "d"]),
        (2, [], [], ["a"]),
        (3, None, None, ["a"]),
        (4, ["no"], ["z"], []),
    ]
    df = spark.createDataFrame(rows, "i int, r array<string>, e array<string>, f array<string>")
    got = df.orderBy("i").select(
        Q.chunk_precision("r"), Q.document_recall("e", "f"), Q.document_precision("e", "f")
    ).collect()
    assert [tuple(r) for r in got] == [(0.5, 1.0, 0.5), (None, None, None), (None, None, None), (0.0, 0.0, None)]


def test_summary(spark):
    rows = [(0, 0.25, "yes", "no", None), (1, float("nan"), "no", "no", None), (2, None, None, "yes", None), (3, 0.75, "yes", "no", None)]
    got = Q.summary_metrics(spark.createDataFrame(rows, SCHEMA)).first()
    assert (got.n_requests, got.n_precision, got.avg_precision) == (4, 2, 0.5)
    assert (got.pct_groundedness, got.pct_correctness, got.pct_relevance) == (66.666667, 25.0, None)


def test_report_keeps_order_and_skips_absent(spark):
    rows = [(0, 0.1, "no", "no", "no"), (1, 0.9, "yes", "no", "yes")]
    labelled = Q.classify(spark.createDataFrame(rows, SCHEMA)).withColumn("request_id", F.col("i").cast("string"))
    report = Q.issue_report(labelled, K.IMPROVE_RETRIEVAL)
    assert report.columns == [
        "request_id",
        "overall/root_cause/rating",
        "overall/assessment",
        "overall/root_cause/rationale",
        "response/llm_judged/relevance_to_query/rating",
        "response/llm_judged/groundedness/rating",
        "retrieval/llm_judged/chunk_relevance/precision",
    ]
    assert report.count() == 1
    assert not Q.is_empty(report)
    assert Q.is_empty(Q.issue_report(labelled, K.IMPROVE_GENERATION))
