"""Search by words: an inverted index with block maxima, exact BM25 top k, and fusion of rankings by rank.

The index holds one row per (block, term), blocks of some thousand chunks: the numbers of the term's chunks within
the block and how often each holds it, heaviest first, and the highest weight. A term's rarity is not in it, so a posting
never meets the counts of its term: rarity is applied to the few terms that queries ask. Building moves each text once, to
its block; (chunk, term) rows are made and packed where they lie. Postings meet queries by block, so a word that
every chunk holds is spread over all blocks, and many queries for one block are cut into parts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusmill.constants import ANN_RESULTS
from corpusmill.operators.search import rank_top_k
from corpusmill.session import scratch_dir, spill

SATURATION = 1.2  # k1
LENGTH_SHARE = 0.75  # b
UNIT = 1e6  # weights are whole millionths, so sums and bounds are exact in any order
CHUNKS_PER_BLOCK = 4096
QUERIES_PER_PART = 131_072
QUERY_BATCH = 64  # rows of the score matrix of a block
COMMON_TERMS = 256  # at most so many words of a block are added up by one product
SPARSE = 32  # times that a sum by places costs what a cell of a product costs
PLACES = 1 << 22  # sums by places that are laid out at once
CHAMPIONS = 64  # best postings of a (block, term) whose weights are kept, from which a first floor follows
STEPS = 10_000  # steps of 1 in those weights, which are rounded down and below 2.2
_PACKED = "block int, term string, nos array<int>, ns array<int>, best array<short>, weight double"
LEADERS = 4  # heaviest terms of a query whose best postings give the floor
FUSION_CONSTANT = 60


@dataclass(frozen=True)
class TextIndex:
    """Stored index: postings packed by (block, term) with their maximum, chunks packed by block, terms with their rarity."""

    path: str
    key: str
    n_chunks: int
    mean_length: float
    n_blocks: int
    repeated: bool
    packed: DataFrame
    chunks: DataFrame
    terms: DataFrame

    @property
    def postings(self) -> DataFrame:
        """A row per (chunk, term), unpacked: block, key, term, weight."""
        numbered = self.chunks.select("block", F.posexplode(F.arrays_zip("keys", "lengths")).alias("no", "chunk"))
        each = self.packed.select("block", "term", F.explode(F.arrays_zip("nos", "ns")).alias("x"))
        met = each.select("block", "term", F.col("x.nos").cast("int").alias("no"), F.col("x.ns").alias("n")).join(numbered, ["block", "no"])
        weight = _weight(F.col("n"), F.col("chunk.lengths"), self.mean_length)
        return met.select("block", F.col("chunk.keys").alias("key"), "term", weight.alias("weight"))


def terms(text: Column | str) -> Column:
    """Lower-case runs of letters and digits, in order; NULL for NULL."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def build_text_index(
    chunks: DataFrame,
    key: str = "chunk_id",
    text: str = "content_chunked",
    path: str | None = None,
    n_blocks: int | None = None,
) -> TextIndex:
    """Index every chunk by its terms. Keys must be unique; a chunk without terms is found by no query.

    Chunks are numbered within their block. One shuffle takes each text to its block, where terms are counted per chunk
    and packed; term counts are aggregates of what that wrote.
    """
    spark = chunks.sparkSession
    path = path or scratch_dir(spark)
    n_blocks = n_blocks or max(1, -(-chunks.count() // CHUNKS_PER_BLOCK))
    block = F.pmod(F.xxhash64(key), F.lit(n_blocks)).cast("int")
    texts = chunks.select(block.alias("block"), F.col(key).alias("key"), F.col(text).alias("text"))

    lengths = texts.select("block", "key", F.size(terms("text")).alias("length")).filter("length > 0").distinct()
    by_block = lengths.select("block", F.struct("key", "length").alias("x")).groupBy("block")
    by_block = by_block.agg(F.sort_array(F.collect_list("x")).alias("x"))
    by_block.select("block", F.col("x.key").alias("keys"), F.col("x.length").alias("lengths")).write.mode("overwrite").parquet(f"{path}/chunks")
    stored = spark.read.parquet(f"{path}/chunks").select(F.explode(F.arrays_zip("keys", "lengths")).alias("x"))
    one = stored.groupBy("x.keys").agg(F.first("x.lengths").alias("length"), F.count(F.lit(1)).alias("n"))
    n_chunks, n_words, n_rows = one.agg(F.count(F.lit(1)), F.sum("length"), F.sum("n")).first()
    mean_length = (n_words or 0) / max(n_chunks, 1)
    meta = spark.createDataFrame(
        [(key, n_chunks, mean_length, n_blocks, (n_rows or 0) > n_chunks)],
        "key string, n_chunks long, mean_length double, n_blocks int, repeated boolean",
    )
    meta.write.mode("overwrite").parquet(f"{path}/meta")

    moved = texts.repartition(n_blocks, "block").select("block", "key", terms("text").alias("words"))
    packed = moved.filter(F.size("words") > 0).groupBy("block").applyInArrow(_packing(mean_length), _PACKED)
    packed.write.mode("overwrite").parquet(f"{path}/postings")
    stored = spark.read.schema(packed.schema).parquet(f"{path}/postings")
    found = stored.groupBy("term").agg(F.max("weight").alias("weight"), F.sum(F.size("nos")).alias("n"), F.count(F.lit(1)).alias("blocks"))
    found.write.mode("overwrite").parquet(f"{path}/terms")
    return load_text_index(spark, path)


def load_text_index(spark: SparkSession, path: str) -> TextIndex:
    """Open a stored index; only a few numbers reach the driver."""
    key, n_chunks, mean_length, n_blocks, repeated = spark.read.parquet(f"{path}/meta").first()
    holders = F.col("n").cast("double")
    rarity = F.log(F.lit(1.0) + (F.lit(float(n_chunks)) - holders + 0.5) / (holders + 0.5))
    return TextIndex(
        path,
        key,
        n_chunks,
        mean_length,
        n_blocks,
        repeated,
        spark.read.parquet(f"{path}/postings"),
        spark.read.parquet(f"{path}/chunks"),
        spark.read.parquet(f"{path}/terms").select("term", "weight", "blocks", rarity.alias("rarity")),
    )


def bm25_top_k(
    queries: DataFrame,
    index: TextIndex,
    k: int = ANN_RESULTS,
    query_id: str = "query_id",
    text: str = "text",
) -> DataFrame:
    """(query_id, rank, key, score): the ``k`` chunks of highest BM25 per query, exactly.

    A term counts once per query. Weights are rounded to millionths before they are added, ties go to the smaller
    key. A query without terms that the corpus holds, or without text, has no hits; ``query_id`` must be unique.

    A chunk whose weights all round to zero is no hit.

    First the best postings of each query's heaviest terms give it a floor. Terms whose highest weights add up to less
    than the floor (the common words) cannot bring a chunk to the top alone, so a block must hold one of the others,
    and its maxima must reach the floor. What is left of (query, block) meets the block's postings. Tables of queries
    take some tenths of a byte a row in files, so they are never sent whole: their file size says nothing of the memory they take.
    """
    if not 0 < k <= CHAMPIONS:
        raise ValueError(f"k is 1 to {CHAMPIONS}, not {k}")
    asked = queries.select(F.col(query_id).alias("query"), F.explode(F.array_distinct(terms(text))).alias("term"))
    asked = asked.distinct().join(index.terms, "term").select("query", "term", "rarity", "blocks", _points("weight").alias("top"))
    asked = spill(asked)
    # terms go by a number from here on, and only postings of asked terms take part
    numbers = spill(asked.select("term", "rarity").distinct().withColumn("code", F.monotonically_increasing_id()))
    wanted = spill(index.packed.join(numbers, "term").drop("term"))
    asked = spill(asked.join(numbers.select("term", "code"), "term").drop("term").withColumnRenamed("code", "term"))
    wanted = wanted.withColumnRenamed("code", "term")
    near = _blocks_within_reach(_leading_terms(asked, _floors(asked, wanted, index, k)), wanted, index)
    n_queries = asked.select("query").distinct().count()
    tasks = 2 * queries.sparkSession.sparkContext.defaultParallelism
    n_parts = max(1, -(-n_queries // QUERIES_PER_PART), min(-(-tasks // index.n_blocks), -(-n_queries // QUERY_BATCH)))
    part = F.pmod(F.xxhash64("query"), F.lit(n_parts)).cast("int")
    pairs = spill(near.withColumn("part", part))
    hits = rank_top_k(_scored(pairs, asked, wanted, index, k), k, "query", "key")
    return hits.select(
        F.col("query").alias(query_id),
        "rank",
        F.col("key").alias(index.key),
        F.round(F.col("score") / UNIT, 6).alias("score"),
    )


def fuse_by_rank(
    rankings: Sequence[DataFrame],
    k: int = ANN_RESULTS,
    query_id: str = "query_id",
    key: str = "chunk_id",
    constant: int = FUSION_CONSTANT,
) -> DataFrame:
    """(query_id, rank, key, score): rankings of the same chunks made one by the sum of ``1 / (constant + rank)``.

    Scores of different kinds are never compared, only places. A ranking without a chunk adds nothing for it.
    Ties go to the smaller key.
    """
    share = F.lit(1.0) / (F.lit(constant) + F.col("rank"))
    rows = [r.select(query_id, key, share.alias("share")) for r in rankings]
    every = rows[0]
    for more in rows[1:]:
        every = every.unionByName(more)
    score = F.round(F.sum("share"), 9).alias("score")
    return rank_top_k(every.groupBy(query_id, key).agg(score), k, query_id, key)


def _weight(n: Column, length: Column, mean_length: float) -> Column:
    """Weight of a term in its chunk, before rarity."""
    n, length = n.cast("double"), length.cast("double")
    norm = F.lit(1 - LENGTH_SHARE) + F.lit(LENGTH_SHARE) * length / F.lit(mean_length)
    return n * F.lit(SATURATION + 1) / (n + F.lit(SATURATION) * norm)


def _weights(n: np.ndarray, length: np.ndarray, mean_length: float) -> np.ndarray:
    """The same as :func:`_weight`, bit for bit."""
    return n * (SATURATION + 1) / (n + SATURATION * ((1 - LENGTH_SHARE) + LENGTH_SHARE * length / mean_length))


def _packing(mean_length: float) -> Callable[[pa.Table], pa.Table]:
    """A function of a block's chunks (block, key, words) that gives its packed postings."""
    schema = to_arrow_schema(T.StructType.fromDDL(_PACKED))

    def pack(chunks: pa.Table) -> pa.Table:
        lists = chunks["words"].combine_chunks()
        length = pc.list_value_length(lists)
        number, length_of = _numbers(chunks["key"].combine_chunks(), length)
        words = lists.flatten().dictionary_encode()
        here = words.indices.to_numpy().astype(np.int64) * len(length_of) + np.repeat(number, length.to_numpy())
        here, n = np.unique(here, return_counts=True)
        term, no = np.divmod(here, len(length_of))
        weight = _weights(n.astype(np.float64), length_of[no].astype(np.float64), mean_length)
        order = np.lexsort((no, -weight, term))  # heaviest first
        term, no, n, weight = term[order], no[order], n[order], weight[order]
        cuts = np.searchsorted(term, np.arange(len(words.dictionary) + 1))
        first = np.arange(len(term)) - cuts[term] < CHAMPIONS
        best = np.floor(weight[first] * STEPS).astype(np.int16)
        heads = np.r_[0, np.cumsum(np.minimum(np.diff(cuts), CHAMPIONS))]
        return pa.Table.from_arrays(
            [
                pa.array(np.full(len(words.dictionary), chunks["block"][0].as_py(), np.int32)),
                words.dictionary,
                pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(no, pa.int32())),
                pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(n, pa.int32())),
                pa.ListArray.from_arrays(pa.array(heads, pa.int32()), pa.array(best)),
                pa.array(weight[cuts[:-1]]),
            ],
            schema=schema,
        )

    return pack


def _numbers(keys: pa.Array, length: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of chunks by (key, length), nulls first, equal ones alike; the length of each number."""
    both = pa.table({"key": keys, "length": length})
    order = pc.sort_indices(both, [("key", "ascending"), ("length", "ascending")], null_placement="at_start").to_numpy()
    code = keys.dictionary_encode(null_encoding="encode").indices.to_numpy()[order]
    size = length.to_numpy()[order]
    new = np.r_[True, (code[1:] != code[:-1]) | (size[1:] != size[:-1])]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, size[new]


def _points(weight: str) -> Column:
    """A weight times rarity in whole units. Rounding keeps order, so a maximum stays a bound."""
    return F.round(F.col("rarity") * F.col(weight) * UNIT).cast("long")


def _floors(asked: DataFrame, wanted: DataFrame, index: TextIndex, k: int) -> DataFrame:
    """(query, floor): a score that ``k`` chunks reach for sure. Queries with fewer than ``k`` known chunks are left out.

    What the best postings of a query's heaviest terms add up to is a lower bound of a chunk's score.
    """
    falling = Window.partitionBy("query").orderBy(F.col("top").desc(), "term")
    leaders = asked.withColumn("place", F.row_number().over(falling)).filter(F.col("place") <= LEADERS)
    leaders = spill(leaders.filter(F.lit(not index.repeated)).select("query", "term", "rarity"))
    best = wanted.select("term", "block", F.arrays_zip(F.slice("nos", 1, k).alias("nos"), F.slice("best", 1, k).alias("best")).alias("x"))
    held = best.join(leaders.select("term").distinct(), "term", "left_semi").select("term", "block", F.explode("x").alias("x"))
    order = Window.partitionBy("term").orderBy(F.col("x.best").desc(), "block", "x.nos")
    champions = held.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).drop("place")
    points = F.floor(F.col("rarity") * F.col("x.best") / F.lit(float(STEPS)) * UNIT)
    found = leaders.hint("merge").join(champions, "term").groupBy("query", "block", "x.nos").agg(F.sum(points).alias("known"))
    order = Window.partitionBy("query").orderBy(F.col("known").desc())
    last = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)
    return last.filter(F.col("place") == k).select("query", F.col("known").alias("floor"))


def _leading_terms(asked: DataFrame, floors: DataFrame) -> DataFrame:
    """Terms that can bring a chunk to the floor, with the floor and the sum of the other terms' highest weights."""
    rising = Window.partitionBy("query").orderBy("top", "term").rowsBetween(Window.unboundedPreceding, 0)
    known = asked.hint("merge").join(floors, "query", "left").withColumn("floor", F.coalesce("floor", F.lit(0).cast("long")))
    summed = known.withColumn("sum", F.sum("top").over(rising))
    light = F.col("sum") < F.col("floor")
    below = F.max(F.when(light, F.col("sum"))).over(Window.partitionBy("query"))
    marked = summed.withColumn("light", light).withColumn("below", F.coalesce(below, F.lit(0).cast("long")))
    return marked.filter(~F.col("light")).select("query", "term", "rarity", "blocks", "top", "floor", "below")


def _blocks_within_reach(lead: DataFrame, wanted: DataFrame, index: TextIndex) -> DataFrame:
    """(query, block, floor): blocks whose maxima may reach the query's floor.

    A term of more than half the blocks counts with its highest weight everywhere. A query with such a leading term
    that may reach the floor without the rarer ones goes to all blocks; only rarer terms meet the maxima.
    """
    wide = F.col("blocks") * 2 > index.n_blocks
    each = Window.partitionBy("query")
    lead = lead.withColumns({"wide": wide, "base": F.col("below") + F.coalesce(F.sum(F.when(wide, F.col("top"))).over(each), F.lit(0))})
    lead = spill(lead.withColumn("open", F.max("wide").over(each) & (F.col("base") >= F.col("floor"))))
    every = lead.filter("open").select("query", "floor").distinct()
    every = every.select("query", F.explode(F.sequence(F.lit(0), F.lit(index.n_blocks - 1))).alias("block"), "floor")
    rarer = lead.filter("not open and not wide").select("query", "term", "rarity", "base", "floor")
    reach = rarer.hint("merge").join(wanted.select("term", "block", "weight"), "term").groupBy("query", "block")
    reach = reach.agg(F.first("floor").alias("floor"), F.first("base").alias("base"), F.sum(_points("weight")).alias("bound"))
    return every.unionByName(reach.filter("bound + base >= floor").select("query", "block", "floor"))


def _scored(pairs: DataFrame, asked: DataFrame, wanted: DataFrame, index: TextIndex, k: int) -> DataFrame:
    """(query, key, score): local top ``k`` of every (query, block) given, from the packed postings ``wanted``."""
    keys = index.chunks.schema["keys"].dataType
    nothing = [F.lit(None).cast(keys).alias("keys"), F.lit(None).cast("array<int>").alias("lengths")]
    given = wanted.select("block", "term", "rarity", "nos", "ns", *nothing)
    held = index.chunks.select(
        "block", F.lit(None).cast("long").alias("term"), F.lit(None).cast("double").alias("rarity"),
        F.lit(None).cast("array<int>").alias("nos"), F.lit(None).cast("array<int>").alias("ns"), "keys", "lengths",
    )
    parts = pairs.select("block", F.col("part").alias("of")).distinct()
    met = given.unionByName(held).join(parts, "block").withColumnRenamed("of", "part")
    words = asked.groupBy("query").agg(F.collect_list("term").alias("words"))
    asking = pairs.hint("merge").join(words, "query")
    schema = T.StructType([pairs.schema["query"], T.StructField("key", keys.elementType), T.StructField("score", T.LongType())])
    arrow_schema = to_arrow_schema(schema)
    mean_length = index.mean_length

    def score(queries: pa.Table, postings: pa.Table) -> pa.Table:
        if queries.num_rows == 0 or postings.num_rows < 2:
            return arrow_schema.empty_table()
        found = _best_of_block(queries, postings, mean_length, k)
        return pa.Table.from_arrays([c.cast(f.type) for c, f in zip(found, arrow_schema, strict=True)], schema=arrow_schema)

    by = ["block", "part"]
    return asking.groupBy(*by).cogroup(met.groupBy(*by)).applyInArrow(score, schema)


def _add_by_places(scores: np.ndarray, row: np.ndarray, term: np.ndarray, cuts: np.ndarray, column: np.ndarray, points: np.ndarray) -> None:
    """Add the points of each (row, term) at the chunks that hold the term, some ``PLACES`` at a time."""
    until = np.cumsum(cuts[term + 1] - cuts[term])
    first = 0
    while first < len(term):
        done = until[first - 1] if first else 0
        last = max(first + 1, np.searchsorted(until, done + PLACES, "right"))
        held = cuts[term[first:last] + 1] - cuts[term[first:last]]
        those = np.arange(held.sum()) + np.repeat(cuts[term[first:last]] - (until[first:last] - held - done), held)
        at = np.repeat(row[first:last], held) * scores.shape[1] + column[those]
        scores += np.bincount(at, points[those], scores.size).reshape(scores.shape)
        first = last


def _best_of_block(queries: pa.Table, postings: pa.Table, mean_length: float, k: int) -> list[pa.Array]:
    """Columns query, key, score: sums of the weights of each query's terms in a matrix of queries by chunks.

    Words that many queries ask and many chunks hold are summed by a product of matrices, the others place by place.
    Weights are whole numbers and sums stay far below 2^53, so doubles hold them exactly.
    """
    chunks = postings.filter(pc.is_null(postings["term"]))
    postings = postings.filter(pc.is_valid(postings["term"]))
    given = chunks["keys"].combine_chunks().flatten()
    of_row = given.dictionary_encode(null_encoding="encode")
    in_order = pc.sort_indices(of_row.dictionary).to_numpy()
    place = np.empty(len(in_order), np.int64)
    place[in_order] = np.arange(len(in_order))
    keys = of_row.dictionary.take(pa.array(in_order))
    column_of = place[of_row.indices.to_numpy(zero_copy_only=False)]
    lengths = chunks["lengths"].combine_chunks().flatten().to_numpy().astype(np.float64)

    lists = postings["nos"].combine_chunks()
    cuts = np.cumsum(np.r_[0, pc.list_value_length(lists).to_numpy(zero_copy_only=False)])
    number = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    n = postings["ns"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    points = np.repeat(postings["rarity"].to_numpy(), np.diff(cuts)) * _weights(n, lengths[number], mean_length) * UNIT
    points = np.floor(points) + (points - np.floor(points) >= 0.5)
    column = column_of[number]

    lists = queries["words"].combine_chunks()
    row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    code = pc.index_in(lists.flatten(), value_set=postings["term"].combine_chunks()).fill_null(-1).to_numpy(zero_copy_only=False)
    by_row = np.searchsorted(row, np.arange(0, len(lists) + QUERY_BATCH, QUERY_BATCH))

    sums = np.bincount(code[code >= 0], minlength=len(cuts) - 1) * np.diff(cuts)
    common = np.argsort(-sums, kind="stable")[:COMMON_TERMS]
    common = common[sums[common] * SPARSE > len(lists) * len(keys)]
    place_of = np.full(len(cuts), -1)
    place_of[common] = np.arange(len(common))
    weights = np.zeros((len(common), len(keys)))
    for at, term in enumerate(common):
        those = slice(cuts[term], cuts[term + 1])
        np.add.at(weights[at], column[those], points[those])

    floor = np.maximum(queries["floor"].to_numpy(), 1)
    found = []
    for at, start in enumerate(range(0, len(lists), QUERY_BATCH)):
        rows = min(QUERY_BATCH, len(lists) - start)
        here = np.arange(by_row[at], by_row[at + 1])
        here = here[code[here] >= 0]
        often = place_of[code[here]] >= 0
        asked = np.zeros((rows, len(common)))
        asked[row[here[often]] - start, place_of[code[here[often]]]] = 1
        scores = asked @ weights
        _add_by_places(scores, row[here[~often]] - start, code[here[~often]], cuts, column, points)
        r, c = np.nonzero(scores >= floor[start : start + rows, None])
        value = scores[r, c]
        order = np.lexsort((c, -value, r))
        r, c, value = r[order], c[order], value[order]
        best = np.arange(len(r)) - np.searchsorted(r, r) < k
        found.append((r[best] + start, c[best], value[best]))
    r, c, value = (np.concatenate(part) for part in zip(*found, strict=True))
    return [queries["query"].combine_chunks().take(pa.array(r)), keys.take(pa.array(c)), pa.array(value.astype(np.int64))]
