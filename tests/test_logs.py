"""Conversations and feedback logs."""

from __future__ import annotations

import random

import pytest

from corpusmill.operators import chat, evalset

TURNS = "conv_id long, turn long, role string, text string"


def conversations(spark, lengths, seed=0):
    rng = random.Random(seed)
    rows = [
        (c, t, "system" if t == 0 and c % 2 else rng.choice(["user", "assistant"]), f"{c}/{t}")
        for c, n in enumerate(lengths)
        for t in range(n)
    ]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, TURNS)


@pytest.mark.parametrize("block", [1024, 1, 3, 7])
def test_history(spark, block):
    rows, df = conversations(spark, [1, 40, 2, 7, 3, 12])
    said = {(c, t): (r, x) for c, t, r, x in rows}
    got = chat.requests_with_history(df, block).collect()
    assert len(got) == sum(r == "user" for _, _, r, _ in rows)
    for g in got:
        assert g.request_id == f"{g.conv_id}-{g.turn}"
        assert [tuple(m) for m in g.messages] == [said[g.conv_id, t] for t in range(g.turn + 1)]


def test_history_of_nothing(spark):
    assert chat.requests_with_history(spark.createDataFrame([], TURNS)).collect() == []


def test_responses(spark):
    rows, df = conversations(spark, [9, 30, 2])
    said = {(c, t): (r, x) for c, t, r, x in rows}
    got = {(r.conv_id, r.turn): (r.request, r.response) for r in chat.requests_with_responses(df).collect()}
    want = {}
    for (c, t), (role, text) in said.items():
        if role == "user":
            nxt = said.get((c, t + 1), (None, None))
            want[c, t] = (text, nxt[1] if nxt[0] == "assistant" else None)
    assert got == want


REQUESTS = "request_id string, request string, response string, trace string, timestamp long"
ASSESSMENTS = (
    "request_id string, source_user string, source_tag string, rating string, edited_response string, "
    "liked_doc_uris array<string>, timestamp long, assessment_id long"
)


def test_evaluation_set(spark):
    requests = spark.createDataFrame([(f"r{i}", f"q{i}", f"a{i}", "t", i) for i in range(6)], REQUESTS)
    log = spark.createDataFrame(
        [
            ("r0", "u", "t", "yes", None, ["d2", "d1"], 1, 1),
            ("r1", "u", "t", "yes", "edit", [], 1, 2),
            ("r2", "u", "t", "no", None, ["d1"], 1, 3),
            ("r3", "u", "t", "no", "edit", [], 1, 4),
            ("r4", "u", "t", None, "edit", None, 1, 5),
            # u takes the like of d9 back; v's later word wins for the request; equal times go by id.
            ("r0", "u", "t", "yes", None, ["d9"], 0, 6),
            ("r0", "v", "t", "no", "better", ["d1", "d3"], 2, 7),
            ("r0", "v", "t", "yes", "older", ["d8"], 2, 6),
            ("gone", "u", "t", "yes", None, ["d1"], 1, 8),
        ],
        ASSESSMENTS,
    )
    df = evalset.potential_evaluation_set(requests, log)
    rows = {r.request_id: r for r in df.collect()}
    assert set(rows) == {f"r{i}" for i in range(6)}
    expected = {k: r.expected_response for k, r in rows.items()}
    assert expected == {"r0": "better", "r1": "edit", "r2": None, "r3": "edit", "r4": None, "r5": None}
    correct = {k: r.is_correct for k, r in rows.items()}
    assert correct == {"r0": False, "r1": True, "r2": False, "r3": False, "r4": None, "r5": None}
    uris = {k: r.expected_retrieved_context and [c.doc_uri for c in r.expected_retrieved_context] for k, r in rows.items()}
    assert uris == {"r0": ["d1", "d2", "d3"], "r1": None, "r2": ["d1"], "r3": None, "r4": None, "r5": None}
    assert rows["r5"].source_user is None and rows["r0"].source_user == "v"
    assert set(evalset.INSPECT_COLUMNS) | set(evalset.SAVED_COLUMNS) <= set(df.columns)
    assert "timestamp" in df.columns and "assessment_timestamp" in df.columns


def test_dedup_is_per_assessor(spark):
    log = spark.createDataFrame(
        [("r", "u", "a", None, None, None, 1, 1), ("r", "u", "b", None, None, None, 1, 2), ("r", "u", "a", None, None, None, 3, 0)],
        ASSESSMENTS,
    )
    got = evalset.dedup_assessments(log).select("source_tag", "timestamp").collect()
    assert sorted(map(tuple, got)) == [("a", 3), ("b", 1)]


def test_answers_across_gaps_and_blocks(spark):
    turns = [(1, 0, "user", "q0"), (1, 5, "assistant", "a5"), (1, 6, "user", "q6"), (1, 7, "user", "q7"), (1, 40, "assistant", "a40")]
    df = spark.createDataFrame(turns, TURNS)
    for block in (1, 3, 1024):
        got = {r.turn: r.response for r in chat.requests_with_responses(df, block).collect()}
        assert got == {0: "a5", 6: None, 7: "a40"}


def test_shared_log_columns_keep_both(spark):
    requests = spark.createDataFrame([("r", "q", "a", "t", 1, "d1")], "request_id string, request string, response string, trace string, timestamp int, date string")
    log = spark.createDataFrame(
        [("r", "u", "x", "yes", None, ["c"], 2, 3, "d2")],
        "request_id string, source_user string, source_tag string, rating string, edited_response string, liked_doc_uris array<string>, timestamp int, assessment_id int, date string",
    )
    row = evalset.potential_evaluation_set(requests, log).first()
    assert (row.date, row.assessment_date, row.timestamp, row.assessment_timestamp, row.liked_doc_uris) == ("d1", "d2", 1, 2, ["c"])
