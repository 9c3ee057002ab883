"""Keyed state of growing logs against one reading of the whole logs."""

from __future__ import annotations

import random

import pytest

from corpusmill.operators.evalset import ASSESSOR, dedup_assessments, potential_evaluation_set
from corpusmill.streaming.logs import evaluation_set, follow, holding, refresh_evaluation_set

SAID = (
    "request_id string, source_user string, source_tag string, rating string, edited_response string, "
    "liked_doc_uris array<string>, timestamp timestamp, assessment_id long"
)
ASKED = "request_id string, request string, response string, trace string, timestamp timestamp"


def said(rng, n):
    rows = []
    for i in range(n):
        request = rng.choice([None, *[f"r{k}" for k in range(9)], "never asked"])
        when = None if rng.random() < 0.1 else f"2024-01-01 00:00:{rng.randrange(5):02d}"
        liked = [f"d{rng.randrange(4)}" for _ in range(rng.randrange(3))]
        rows.append((request, rng.choice(["u", "v", None]), "t", rng.choice(["yes", "no", None]), rng.choice([None, "e"]), liked, when, i))
    return rows


def asked(rng):
    return [(f"r{k}", f"q{k}", f"a{k}", "t", "2024-01-01 00:00:00") for k in range(12)]


def frame(spark, rows, schema):
    text = schema.replace("timestamp timestamp", "timestamp string")
    return spark.createDataFrame(rows, text).selectExpr(
        *[f"cast({c.split()[0]} as timestamp) as timestamp" if c.split()[0] == "timestamp" else c.split()[0] for c in schema.split(", ")]
    )


def plain(df):
    return sorted(map(str, (tuple(sorted(r.asDict(recursive=True).items())) for r in df.collect())))


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_in_any_order_equal_the_whole_log(spark, tmp_path, seed):
    rng = random.Random(seed)
    talk, requests = said(rng, 150), asked(rng)
    whole_said, whole_asked = frame(spark, talk, SAID), frame(spark, requests, ASKED)
    folders = {n: str(tmp_path / n) for n in ("said", "asked", "state")}
    streams = {}
    for name, rows, schema in (("said", whole_said, SAID), ("asked", whole_asked, ASKED)):
        rows.filter("false").write.parquet(folders[name])
        streams[name] = spark.readStream.schema(rows.schema).parquet(folders[name])
    rng.shuffle(talk)
    rng.shuffle(requests)
    for k in range(3):
        frame(spark, talk[k::3], SAID).write.mode("append").parquet(folders["said"])
        if k != 1:
            frame(spark, requests[k // 2 :: 2], ASKED).write.mode("append").parquet(folders["asked"])
        got = refresh_evaluation_set(streams["asked"], streams["said"], folders["state"])
    assert plain(got) == plain(potential_evaluation_set(whole_asked, whole_said).select(*got.columns))
    kept = holding(spark, f"{folders['state']}/assessments", whole_said, ASSESSOR)
    assert plain(kept) == plain(dedup_assessments(whole_said))
    again = refresh_evaluation_set(streams["asked"], streams["said"], folders["state"])  # nothing new
    assert plain(again) == plain(got)


def test_a_refresh_that_died_is_done_again(spark, tmp_path):
    rng = random.Random(5)
    folders = {n: str(tmp_path / n) for n in ("said", "asked", "state")}
    frame(spark, asked(rng), ASKED).write.parquet(folders["asked"])
    first, late = frame(spark, said(rng, 40), SAID), frame(spark, said(rng, 40), SAID)
    first.write.parquet(folders["said"])
    streams = [spark.readStream.schema(spark.read.parquet(folders[n]).schema).parquet(folders[n]) for n in ("asked", "said")]
    before = plain(refresh_evaluation_set(*streams, folders["state"]))
    late.write.mode("append").parquet(folders["said"])
    follow(streams[1], f"{folders['state']}/assessments", ASSESSOR)
    spark.createDataFrame([("junk",)], "request_id string").write.parquet(f"{folders['state']}/sets/number=1")
    assert plain(evaluation_set(spark, folders["state"])) == before  # what the dead run left does not count
    got = refresh_evaluation_set(*streams, folders["state"])
    whole = potential_evaluation_set(spark.read.parquet(folders["asked"]), spark.read.parquet(folders["said"]))
    assert plain(got.select("request_id", "rating", "is_correct")) == plain(whole.select("request_id", "rating", "is_correct"))


def test_takes_streams_only(spark, tmp_path):
    with pytest.raises(ValueError, match="stream"):
        follow(spark.createDataFrame([], SAID), str(tmp_path), ASSESSOR)
