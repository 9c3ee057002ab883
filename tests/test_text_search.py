"""Search by words against plain BM25 over all chunks."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from corpusmill.operators import text_search
from corpusmill.operators.text_search import bm25_top_k, build_text_index, fuse_by_rank, load_text_index

CHUNKS = "chunk_id long, content_chunked string"
QUERIES = "query_id long, text string"


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def plain(queries, chunks, k):
    """{(query, rank): (chunk, score)} by the formula, without an index."""
    counted = {c: Counter(words(t)) for c, t in chunks if words(t)}
    n, mean = len(counted), sum(c.total() for c in counted.values()) / max(len(counted), 1)
    holders = Counter(w for c in counted.values() for w in c)
    out = {}
    for q, text in queries:
        scores = []
        for c, held in counted.items():
            norm, score = 0.25 + 0.75 * held.total() / mean, 0
            for w in set(words(text)) & held.keys():
                rarity = math.log(1 + (n - holders[w] + 0.5) / (holders[w] + 0.5))
                score += math.floor(rarity * (held[w] * 2.2 / (held[w] + 1.2 * norm)) * 1e6 + 0.5)
            if set(words(text)) & held.keys():
                scores.append((-score, c))
        for place, (score, c) in enumerate(sorted(scores)[:k], 1):
            out[q, place] = (c, round(-score / 1e6, 6))
    return out


def got(df, key="chunk_id"):
    return {(r["query_id"], r["rank"]): (r[key], r["score"]) for r in df.collect()}


def corpus(seed, n=400):
    """Every chunk holds ``the``; other words get rarer by their number; some chunks are copies."""
    rng = random.Random(seed)
    rows = [
        (i, " ".join(["the"] * rng.randint(1, 4) + [f"w{int(rng.paretovariate(0.6))}" for _ in range(rng.randint(0, 40))]))
        for i in range(n)
    ]
    return rows + [(n + i, rows[i % 7][1]) for i in range(60)] + [(-1, None), (-2, ""), (-3, " .,! ")]


@pytest.mark.parametrize(("k", "n_blocks"), [(1, 1), (5, 16), (16, 40), (64, 3)])
def test_equals_plain_scores(spark, k, n_blocks):
    chunks = corpus(k)
    rng = random.Random(k + 1)
    queries = [(i, " ".join(["The"] * (i % 2) + [f"W{int(rng.paretovariate(0.5))}" for _ in range(rng.randint(1, 9))])) for i in range(40)]
    queries += [(100, None), (101, ""), (102, "unseen words"), (103, "the"), (104, "w1 w1 w1, W1!")]
    index = build_text_index(spark.createDataFrame(chunks, CHUNKS), n_blocks=n_blocks)
    found = got(bm25_top_k(spark.createDataFrame(queries, QUERIES), index, k))
    assert found == plain(queries, chunks, k)
    assert not {q for q, _ in found} & {100, 101, 102}
    assert found[103, 1]


def test_blocks_of_common_words_are_left_out(spark, monkeypatch):
    chunks, seen = [(i, "the the " + f"rare{i}") for i in range(500)], []
    index = build_text_index(spark.createDataFrame(chunks, CHUNKS), n_blocks=25)
    scored = text_search._scored
    monkeypatch.setattr(text_search, "_scored", lambda pairs, *more: (seen.append(pairs), scored(pairs, *more))[1])
    monkeypatch.setattr(text_search, "QUERIES_PER_PART", 2)
    queries = [(i, f"the rare{i} rare{i + 1}") for i in range(5)]
    assert got(bm25_top_k(spark.createDataFrame(queries, QUERIES), index, 2)) == plain(queries, chunks, 2)
    assert seen[0].count() <= 10  # two blocks a query, of 25 that hold the common word
    assert seen[0].select("part").distinct().count() > 1


def test_few_chunks_other_names_and_types(spark):
    chunks = spark.createDataFrame([("a", "Blue sky"), ("b", "blue, blue"), ("c", "grün_gras")], "term string, query string")
    index = build_text_index(chunks, "term", "query")
    again = load_text_index(spark, index.path)
    queries = spark.createDataFrame([("x", "BLUE"), ("y", "Grün")], "key string, floor string")
    rows = bm25_top_k(queries, again, 3, "key", "floor").orderBy("key", "rank").collect()
    assert [(r["key"], r["rank"], r["term"]) for r in rows] == [("x", 1, "b"), ("x", 2, "a"), ("y", 1, "c")]
    with pytest.raises(ValueError, match="k is 1 to"):
        bm25_top_k(queries, again, 65, "key", "floor")


def test_empty_tables(spark):
    empty = build_text_index(spark.createDataFrame([], CHUNKS))
    assert bm25_top_k(spark.createDataFrame([(1, "a")], QUERIES), empty).count() == 0
    index = build_text_index(spark.createDataFrame([(1, "a")], CHUNKS))
    assert bm25_top_k(spark.createDataFrame([], QUERIES), index).count() == 0


def test_fused_by_places_only(spark):
    schema = "query_id long, rank long, chunk_id long, score double"
    one = spark.createDataFrame([(1, 1, 10, 9e9), (1, 2, 20, 1.0), (1, 3, 30, 0.5)], schema)
    two = spark.createDataFrame([(1, 1, 30, 0.9), (1, 2, 20, 0.8), (2, 1, 5, 0.1)], schema)
    fused = fuse_by_rank([one, two], 2).orderBy("query_id", "rank")
    assert [tuple(r)[:3] for r in fused.collect()] == [(1, 1, 30), (1, 2, 20), (2, 1, 5)]
    # 1/61 + 1/63 against 1/62 + 1/62: the first is a little more.
    assert fused.first()["score"] == round(1 / 61 + 1 / 63, 9)


def test_a_common_word_is_spread_over_blocks(spark):
    """Postings meet queries by block, so no task gets all postings of a word that every chunk holds."""
    index = build_text_index(spark.createDataFrame(corpus(9), CHUNKS), n_blocks=8)
    largest = index.postings.groupBy("block", "term").count().agg(F.max("count")).first()[0]
    assert largest < index.postings.filter("term = 'the'").count() / 4


def test_postings_are_stored_packed(spark):
    """A row per (block, term), not per (chunk, term), is what meets the queries; chunks go by number there."""
    chunks = [(i, f"the common words of all and own{i}") for i in range(300)]
    index = build_text_index(spark.createDataFrame(chunks, CHUNKS), n_blocks=3)
    assert index.packed.count() == 3 * 6 + 300
    assert index.packed.filter("term = 'the'").agg(F.sum(F.size("nos"))).first()[0] == 300
    assert index.postings.count() == 300 * 7


def test_a_key_of_two_texts_adds_up_and_gives_no_floor(spark):
    chunks = [(1, "red blue"), (1, "red red red green"), (2, "red"), (3, "blue blue")]
    index = build_text_index(spark.createDataFrame(chunks, CHUNKS), n_blocks=1)
    found = got(bm25_top_k(spark.createDataFrame([(7, "red")], QUERIES), index, 2))
    assert [found[7, r][0] for r in (1, 2)] == [1, 2]


def test_a_repeated_question_counts_once(spark):
    chunks = [(i, f"red blue w{i % 3}") for i in range(12)]
    index = build_text_index(spark.createDataFrame(chunks, CHUNKS), n_blocks=4)
    queries = [(1, "red w1 w2")]
    assert got(bm25_top_k(spark.createDataFrame(queries * 2, QUERIES), index, 5)) == plain(queries, chunks, 5)


def test_tables_of_queries_are_never_sent_whole(spark, monkeypatch):
    """They compress to next to nothing in files, so a broadcast by file size fills the driver."""
    chunks, stored = corpus(5), []
    index = build_text_index(spark.createDataFrame(chunks, CHUNKS), n_blocks=3)
    write = text_search.spill
    monkeypatch.setattr(text_search, "spill", lambda df: (stored.append(plan_of(df)), write(df))[1])
    found = bm25_top_k(spark.createDataFrame([(i, f"the w{i} w{i + 1}") for i in range(9)], QUERIES), index, 3)
    per_query = [p for p in [*stored, plan_of(found)] if "FlatMapCoGroupsInArrow" in p or "floor" in p]
    assert len(per_query) >= 3
    for plan in per_query:
        sent = [line for line in plan.split("\n") if "BroadcastHashJoin [" in line or "BroadcastHashJoin LeftOuter" in line]
        assert not [line for line in sent if "query" in line]
    assert "SortMergeJoin" in plan_of(found)


def test_sums_by_product_and_by_places_are_the_same(spark, monkeypatch):
    chunks = corpus(3) + [(7, "the w1 w1 again")]  # a key of two texts
    queries = spark.createDataFrame([(i, f"the w{i % 5} w{i % 9 + 1} w{i}") for i in range(70)], QUERIES)
    index, found = build_text_index(spark.createDataFrame(chunks, CHUNKS), n_blocks=2), []
    for common, places in ((0, 1 << 22), (0, 50), (2, 7), (256, 1 << 22)):
        monkeypatch.setattr(text_search, "COMMON_TERMS", common)
        monkeypatch.setattr(text_search, "PLACES", places)
        found.append(got(bm25_top_k(queries, index, 5)))
    assert found[0] and found.count(found[0]) == len(found)
