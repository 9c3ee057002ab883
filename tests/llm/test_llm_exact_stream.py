from __future__ import annotations

import hashlib
import re

from helpers import documents, frame
from pyspark.sql import functions as F

from corpusmill.llm.exact_stream import exact_duplicates


def expected(rows):
    groups: dict[str, list] = {}
    for d, t, *_ in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), d is None, d or 0, d))
    out = []
    for bare, members in groups.items():
        keep = min(members)[3]
        out += [(d, keep, len(members), hashlib.sha256(bare.encode()).hexdigest()) for *_, d in members]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=str)


def test_odd_rows_and_ties(spark, tmp_path):
    frame(spark).repartition(3).write.parquet(str(tmp_path / "docs"))
    found = exact_duplicates(spark, str(tmp_path / "docs"))
    rows = found.collect()
    assert got(found) == expected(documents())
    kept = {}
    for r in rows:
        kept[r.text_sha256] = kept.get(r.text_sha256, 0) + r.kept
    assert set(kept.values()) == {1}


def test_many_batches_and_clashing_digests(spark, tmp_path):
    frame(spark).repartition(5).write.parquet(str(tmp_path / "docs"))
    weak = lambda bare: F.lpad((F.length(bare) % 3).cast("string"), 2, "0")
    found = exact_duplicates(spark, str(tmp_path / "docs"), digest=weak, bytes_per_batch=1)
    assert got(found) == expected(documents())


def test_state_goes_on(spark, tmp_path):
    path, state = str(tmp_path / "docs"), str(tmp_path / "state")
    half = len(documents()) // 2
    frame(spark, documents()[:half]).write.parquet(path)
    assert got(exact_duplicates(spark, path, state_dir=state)) == expected(documents()[:half])
    frame(spark, documents()[half:]).write.mode("append").parquet(path)
    assert got(exact_duplicates(spark, path, state_dir=state)) == expected(documents())


def test_empty_table(spark, tmp_path):
    frame(spark, documents()[:3]).filter("false").write.parquet(str(tmp_path / "docs"))
    assert exact_duplicates(spark, str(tmp_path / "docs")).collect() == []
