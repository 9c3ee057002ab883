from __future__ import annotations

import base64
import glob
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from corpusmill.llm.warc import captures, loser_merge, merge_runs, parse_record, record, url_key, write_archives

SCHEMA = "page_id long, url string, html string, place int, file string, same string"


def pages():
    rng = random.Random(5)
    html = ["<p>a</p>", "é\r\n\r\nWARC/1.1\r\n\r\n中", "", None, "x" * 200_000]
    rows = [(i, rng.choice(["http://www.A.org:80/b?c=1#d", "https://b.net", "http://u@x.y/z", "no url", None]), html[i % 5]) for i in range(60)]
    rows += [(3, "http://a.org/", html[0]), (3, "http://a.org/", html[0]), (None, None, html[0]), (None, "http://q/\n", None)]
    return [(*r, 1, "f", "s") for r in rows]


def expected(rows, least=0):
    top = {}
    for p, _, h, *_ in rows:
        if p is not None:
            top[h or ""] = max(p, top.get(h or "", p))
    out = []
    for p, _, h, *_ in rows:
        raw = (h or "").encode()
        refers = None if p is None or top[h or ""] == p or len(raw) < least else top[h or ""]
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((p, len(raw), digest, "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 10])
def test_round_trip(spark, least):
    got = captures(spark.createDataFrame(pages(), SCHEMA).repartition(4), revisit_from=least).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(pages(), least)


def test_history_is_globally_ordered(spark, tmp_path):
    index = write_archives(spark.createDataFrame(pages(), SCHEMA).repartition(5), folder=f"file://{tmp_path}/w")
    rows = sorted(merge_runs(index, ranges=3).collect(), key=lambda r: (r.range, r.place))
    keys = [(r.url_key, r.captured_at, r.page_id is not None, r.page_id or 0) for r in rows]
    assert keys == sorted(keys)
    assert len(rows) == len(pages())
    raw = b"".join(gzip.open(f).read() for f in glob.glob(f"{tmp_path}/w/*.warc.gz"))
    assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n")


def test_empty_table(spark):
    assert captures(spark.createDataFrame([], SCHEMA)).collect() == []


def test_url_keys(spark):
    urls = {
        "http://www.A.org:80/b?c=1#d": "org,a)/b?c=1", "https://b.net": "net,b)/", "http://u:p@x.y/z": "y,x)/z", "no url": None,
        "http://h?q": "h)/?q", None: None,
    }
    got = spark.createDataFrame([(u,) for u in urls], "url string").select("url", url_key(F.col("url")).alias("k")).collect()
    assert {r.url: r.k for r in got} == urls


def test_damage_is_seen():
    raw = record(7, "http://a/", "2024-01-01T00:00:00Z", b"abc", hashlib.sha1(b"abc").hexdigest(), None)
    assert parse_record(raw)["page_id"] == 7
    for bad in (raw.replace(b"abc\r\n", b"abd\r\n"), raw[:-1], b"x" + raw):
        with pytest.raises(ValueError):
            parse_record(bad)


def test_loser_tree():
    rng = random.Random(1)
    for k in range(9):
        runs = [sorted((rng.randrange(9), r) for _ in range(rng.randrange(6))) for r in range(k)]
        assert list(loser_merge(runs)) == sorted(x for r in runs for x in r)
