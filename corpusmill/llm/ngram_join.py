"""Documents whose word n-gram sets overlap: size-banded tiles, bitmap bounds, exact intersections.

Two documents link when ``|x & y| / |x | y|`` reaches the threshold, an exact fraction. The class of
a document is the smallest id reachable by links. The work goes in five steps:

1. One row per document: set size, digest of the set, and the *prefix* of the set: two sets that link
   share an element among the first ``n - ceil(t n) + 1`` of each, in whatever order all documents
   agree on. Here the order is by hash, with shingles that a bounded sample of documents shows to be
   common last. The sample only speeds things up; every order gives the same links.
2. Documents with equal sets are one class from the start; one of them goes on.
3. A few rounds compare every document with some holders of its prefix shingles from other classes,
   those it shares most with, by bitmap, and with the best of them exactly. They join most families of
   near copies, however large, by a few rows per member and round.
4. Shingles whose holders still lie in several classes become tiles: (shingle, size band, chunk,
   chunk). Inside a tile only pairs from different classes and of fitting sizes are looked at; bit
   counts of hashed bitmaps bound the overlap from above, and what passes is intersected exactly.
5. Classes are the components of the links of steps 2 to 4.

No step holds a group of unbounded size: leaders are partial minima, tiles hold at most two chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.columns import free_names, whole_numbers
from corpusmill.llm.components import components
from corpusmill.llm.words import Block, blocks, mixed
from corpusmill.session import spill

ORDER_SAMPLE = 6_000  # documents looked at to find common shingles; affects speed only
COMMON_IN_SAMPLE = 3  # holders in that sample that make a shingle common
COMMON_LIMIT = 200_000  # length of the list of common shingles that tasks carry
CHUNK = 256  # documents of one side of a tile

LEADER_ROUNDS = 3  # at most; they end with the first that finds no link
LEADERS = 3  # holders a document is compared with in a round

_SETS = "doc_id long, n_shingles long, d1 long, d2 long, keys array<long>, bits binary"


def ngram_classes(
    docs: DataFrame,
    n: int = 4,
    threshold: tuple[int, int] = (85, 100),
    id_col: str = "doc_id",
    text_col: str = "text",
    lower: bool = True,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per document.

    Words are runs of non-white characters, A-Z folded if ``lower``. The set of a document holds its
    distinct n-word shingles; with fewer words, the whole sequence as its only element. Defined cases:
    null or empty text has no shingles and links with nothing (component is its own id); a null id
    takes part in no link and keeps a null component; repeated rows of one id count as one document
    if equal, else each row links for that id; other columns are never read, whatever their names.
    """
    base = docs.select(whole_numbers(docs, id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    common = _common_shingles(base, n, lower)
    sets = spill(base.mapInArrow(_set_rows(n, threshold, lower, common), _SETS))
    filled = sets.filter("n_shingles > 0 and doc_id is not null")
    same = filled.groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("rep"))
    members = filled.select("doc_id", "n_shingles", "d1", "d2").join(same, ["n_shingles", "d1", "d2"])
    copies = members.filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    reps = filled.join(same.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    held = reps.select("doc_id", F.explode("keys").alias("key"))
    shared = held.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi")
    holders = spill(held.join(shared.select("key"), "key"))
    maps = sets.select("doc_id", F.col("n_shingles").alias("n"), "bits")
    exact = _Exact(base, n, threshold, lower)

    links = spill(copies)
    classes = components(links)
    for turn in range(LEADER_ROUNDS):
        near = _bounded(_leader_pairs(_open_rows(holders, classes), turn), maps, threshold)
        best = near.groupBy("a").agg(F.max_by("b", F.struct("bound", -F.col("b"))).alias("b"))
        found = exact.linked(best)
        if found.isEmpty():
            break
        links = links.union(found)
        classes = components(links)

    found = exact.linked(_open_pairs(_open_rows(holders, classes), maps, threshold))
    classes = components(links.union(found)).withColumnRenamed("node", "doc_id")
    rows = sets.select("doc_id", "n_shingles").join(classes, "doc_id", "left")
    return rows.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def without_near_copies(
    docs: DataFrame,
    n: int = 5,
    threshold: tuple[int, int] = (80, 100),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its class, with all columns as they are.

    Defined cases as in ``ngram_classes``: rows with a null id and rows without words stay; of rows that
    repeat an id all stay or none; ids must be whole numbers (TypeError); no name of a column matters.
    """
    classes = ngram_classes(docs, n, threshold, id_col, text_col)
    (copy,) = free_names(docs, "copy")
    copies = spill(classes.filter("component_id <> doc_id").select(F.col("doc_id").alias(copy)).distinct())
    return docs.join(copies, F.col(f"`{id_col}`").cast("long") == F.col(copy), "left_anti")


def _common_shingles(base: DataFrame, n: int, lower: bool) -> np.ndarray:
    """Hashes of shingles frequent in a sample of bounded size, rarest first."""
    total = base.count()
    part = max(1, -(-total // ORDER_SAMPLE))
    sample = base.filter(F.pmod(F.xxhash64("doc_id"), F.lit(part)) == 0)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text"), lower):
                grams = [np.unique(g) for g in _shingles(block, n)]
                every = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
                found, count = np.unique(every, return_counts=True)
                yield pa.record_batch({"key": found.view(np.int64), "c": count})

    counts = sample.mapInArrow(hashes, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))
    often = counts.filter(F.col("c") >= COMMON_IN_SAMPLE).orderBy(F.desc("c"), "key").limit(COMMON_LIMIT)
    keys = [r.key for r in often.select("key").collect()]
    return np.array(keys[::-1], np.int64).view(np.uint64)


def _shingles(block: Block, n: int) -> Iterator[np.ndarray]:
    """Shingle hashes of each text, with repeats."""
    words = block.word_hashes()
    grams, first = block.gram_hashes(words, n)
    for i, count in enumerate(np.diff(block.first)):
        if count >= n:
            yield grams[first[i] : first[i + 1]]
        else:
            yield _whole(words[block.first[i] : block.first[i + 1]])


def _whole(words: np.ndarray) -> np.ndarray:
    """One hash for a sequence shorter than a shingle; none for no words."""
    if len(words) == 0:
        return words
    h = np.array([0x51ED270B7F4A7C15 + len(words)], np.uint64)
    for w in words:
        h = mixed(h ^ w)
    return h


def _set_rows(n: int, threshold: tuple[int, int], lower: bool, common: np.ndarray):
    t_num, t_den = threshold
    order = np.argsort(common)
    ranked, rank = common[order], order.astype(np.uint64)

    def prefix(values: np.ndarray) -> np.ndarray:
        size = len(values) - -(-len(values) * t_num // t_den) + 1
        if len(ranked) == 0:
            return values[:size]
        at = np.minimum(np.searchsorted(ranked, values), len(ranked) - 1)
        often = ranked[at] == values
        rare = values[~often]
        if len(rare) >= size:
            return rare[:size]
        last = values[often]
        return np.concatenate([rare, last[np.argsort(rank[at[often]])][: size - len(rare)]])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text"), lower):
                sizes, digests, keys, maps = [], [], [], []
                for grams in _shingles(block, n):
                    values = np.unique(grams)
                    sizes.append(len(values))
                    digests.append(_digest(values))
                    maps.append(bitmap(values))
                    keys.append(prefix(values) if len(values) else values)
                lengths = np.array([len(k) for k in keys], np.int32)
                flat = np.concatenate(keys).view(np.int64)
                pairs = np.array(digests, np.uint64).view(np.int64).reshape(-1, 2)
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").slice(block.at, len(block)),
                        "n_shingles": np.array(sizes, np.int64),
                        "d1": np.ascontiguousarray(pairs[:, 0]),
                        "d2": np.ascontiguousarray(pairs[:, 1]),
                        "keys": pa.ListArray.from_arrays(
                            np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32), pa.array(flat)
                        ),
                        "bits": pa.array(maps, pa.binary()),
                    }
                )

    return rows


def _digest(values: np.ndarray) -> tuple[int, int]:
    """128 bits of a sorted set: two sums of differently mixed elements."""
    a = int(((values ^ np.uint64(0xA0761D6478BD642F)) * np.uint64(0xE7037ED1A0B428DB) ^ (values >> np.uint64(31))).sum())
    b = int(((values ^ (values >> np.uint64(27))) * np.uint64(0x8EBC6AF09C88C6E3) ^ (values << np.uint64(17))).sum())
    return a & (2**64 - 1), b & (2**64 - 1)


def bitmap(values: np.ndarray) -> bytes:
    """A bit flips for every element that hashes to it; bits are a power of two, half to all of the size."""
    bits = min(1 << 17, max(512, 1 << (max(1, len(values)).bit_length() - 1)))
    at = (values >> np.uint64(13)) & np.uint64(bits - 1)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def _folded(bits: bytes, size: int) -> np.ndarray:
    """The bitmap at ``size`` bytes; halves are combined by xor, so bounds stay valid."""
    words = np.frombuffer(bits, np.uint64)
    return np.bitwise_xor.reduce(words.reshape(-1, size // 8), axis=0)


@dataclass
class _Exact:
    """The exact test: texts of the documents in question are fetched once and both sets built anew."""

    base: DataFrame
    n: int
    threshold: tuple[int, int]
    lower: bool

    def linked(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``(a, b)`` whose sets reach the similarity, stored."""
        pairs = spill(pairs.select("a", "b").distinct())
        asked = spill(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
        texts = spill(self.base.join(asked, "doc_id", "left_semi"))
        sides = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("x")), "a")
        sides = sides.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("y")), "b")
        n, (t_num, t_den), lower = self.n, self.threshold, self.lower

        def sets(column: pa.Array) -> Iterator[np.ndarray]:
            for block in blocks(column, lower):
                for grams in _shingles(block, n):
                    yield np.unique(grams)

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = [
                    _reaches(len(np.intersect1d(x, y, assume_unique=True)), len(x) + len(y), t_num, t_den)
                    for x, y in zip(sets(batch.column("x")), sets(batch.column("y")), strict=True)
                ]
                mask = pa.array(keep, pa.bool_())
                yield pa.record_batch({"a": batch.column("a").filter(mask), "b": batch.column("b").filter(mask)})

        return spill(sides.select("a", "b", "x", "y").mapInArrow(rows, "a long, b long"))


def _bounded(pairs: DataFrame, maps: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The pairs that bit counts do not rule out, with the bound on their similarity."""
    t_num, t_den = threshold
    sides = pairs.join(maps.select(F.col("doc_id").alias("a"), F.col("n").alias("m"), F.col("bits").alias("p")), "a")
    sides = sides.join(maps.select(F.col("doc_id").alias("b"), "n", F.col("bits").alias("q")), "b")
    sides = sides.filter(F.least("m", "n") * t_den >= F.greatest("m", "n") * t_num)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met = np.zeros(len(batch), np.int64)
            both = batch.column("m").to_numpy() + batch.column("n").to_numpy()
            p, q = batch.column("p"), batch.column("q")
            for i in range(len(batch)):
                x, y = p[i].as_buffer(), q[i].as_buffer()
                size = min(len(x), len(y))
                met[i] = (both[i] - int(np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum())) // 2
            mask = pa.array(_reaches(met, both, t_num, t_den))
            table = pa.record_batch({"a": batch.column("a"), "b": batch.column("b"), "bound": met / (both - met)})
            yield table.filter(mask)

    return sides.select("a", "b", "m", "n", "p", "q").mapInArrow(rows, "a long, b long, bound double")


def _reaches(met, both, t_num: int, t_den: int):
    """Whether ``met`` common elements of ``both`` in all make the similarity."""
    return t_den * met >= t_num * (both - met)


def _open_rows(holders: DataFrame, classes: DataFrame) -> DataFrame:
    """``(key, doc_id, c)`` of the shingles whose holders lie in more than one class ``c``."""
    classes = classes.select(F.col("node").alias("doc_id"), F.col("component").alias("c"))
    known = holders.join(classes, "doc_id", "left").select("key", "doc_id", F.coalesce("c", "doc_id").alias("c"))
    several = known.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi")
    return spill(known.join(several.select("key"), "key"))


def _leader_pairs(open_rows: DataFrame, turn: int) -> DataFrame:
    """Each document with a few holders of its shingles from other classes, those it shares most with."""
    lots = [F.xxhash64("doc_id", F.lit(turn * LEADERS + i)) for i in range(1, LEADERS)]
    picks = [F.min_by(F.struct("doc_id", "c"), lot) for lot in (F.col("doc_id"), *lots)]
    leaders = open_rows.groupBy("key").agg(F.array_distinct(F.array(*picks)).alias("leaders"))
    met = open_rows.join(leaders, "key").select("doc_id", "c", F.explode("leaders").alias("leader"))
    met = met.filter("c <> leader.c").groupBy("doc_id", F.col("leader.doc_id").alias("b")).agg(F.count("*").alias("common"))
    order = Window.partitionBy("doc_id").orderBy(F.desc("common"), "b")
    best = met.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= LEADERS)
    return best.select(F.col("doc_id").alias("a"), "b")


def _open_pairs(open_rows: DataFrame, maps: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Pairs of different classes that share a prefix shingle and pass the bitmap bound."""
    t_num, t_den = threshold
    sizes = maps.select("doc_id", "n")
    level = F.log(F.col("n").cast("double")) / float(np.log(t_den / t_num))
    # A document meets those of its own band and is a guest in the next, which holds every larger
    # partner; the small addend keeps that true where rounding puts a logarithm across a band's edge.
    last = F.floor(level + 1.000001).cast("int")
    rows = open_rows.join(sizes, "doc_id").withColumn("home", F.floor(level).cast("int"))
    rows = rows.withColumn("band", F.explode(F.sequence("home", last)))
    rows = rows.withColumn("guest", F.col("band") != F.col("home"))
    sized = rows.groupBy("key", "band").agg(
        F.count("*").alias("n_rows"), F.min("guest").alias("only_guests"), F.min("c").alias("lo"), F.max("c").alias("hi")
    )
    sized = sized.filter("n_rows > 1 and not only_guests and lo < hi")
    sized = sized.select("key", "band", F.ceil(F.col("n_rows") / CHUNK).cast("int").alias("chunks"))
    dealt = rows.join(sized, ["key", "band"]).withColumn("own", F.pmod(F.xxhash64("doc_id"), "chunks").cast("int"))
    tiles = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    tile = F.xxhash64("key", "band", F.least("own", "other"), F.greatest("own", "other"))
    tiles = tiles.select(
        tile.alias("tile"), "own", (F.col("own") == F.col("other")).alias("alone"), "doc_id", "c", "n", "guest"
    )
    tiles = tiles.join(maps.select("doc_id", "bits"), "doc_id")
    tiles = tiles.repartition("tile").sortWithinPartitions("tile", "doc_id")
    return tiles.mapInArrow(_tile_rows(t_num, t_den), "a long, b long").distinct()


def _tile_rows(t_num: int, t_den: int):
    def pairs(t: pa.Table) -> np.ndarray:
        """Rows ``(a, b)`` from whole tiles, sorted by tile. Rows d places apart are compared together, for every d."""
        tile, doc, c, n, own = (t.column(x).to_numpy() for x in ("tile", "doc_id", "c", "n", "own"))
        guest, alone = (t.column(x).to_numpy(zero_copy_only=False) for x in ("guest", "alone"))
        maps = _Bitmaps(t.column("bits"))
        found, d, i = [], 0, np.arange(len(tile))
        while True:
            d += 1
            i = i[i + d < len(tile)]
            i = i[tile[i] == tile[i + d]]
            if not len(i):
                break
            j = i + d
            fit = (c[i] != c[j]) & ~(guest[i] & guest[j]) & (alone[i] | (own[i] != own[j]))
            fit &= t_den * np.minimum(n[i], n[j]) >= t_num * np.maximum(n[i], n[j])
            a, b = i[fit], j[fit]
            both = n[a] + n[b]
            fit = _reaches((both - maps.apart(a, b)) // 2, both, t_num, t_den)
            found.append(np.stack([np.maximum(doc[a], doc[b])[fit], np.minimum(doc[a], doc[b])[fit]], axis=1))
        return np.unique(np.concatenate([np.zeros((0, 2), np.int64), *found]), axis=0)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for last, batch in _and_last(batches):
            table = pa.Table.from_batches([batch]) if batch is not None else None
            table = table if kept is None else kept if table is None else pa.concat_tables([kept, table])
            if table is None or len(table) == 0:
                continue
            table = table.combine_chunks()
            tile = table.column("tile").to_numpy()
            end = len(tile) if last else int(np.searchsorted(tile == tile[-1], True))
            kept = None if last else table.slice(end)
            pair = pairs(table.slice(0, end).combine_chunks())
            if len(pair):
                yield pa.record_batch({"a": np.ascontiguousarray(pair[:, 0]), "b": np.ascontiguousarray(pair[:, 1])})

    return rows


class _Bitmaps:
    """Bitmaps of many rows; two are compared at the size of the smaller, to which the larger is folded."""

    def __init__(self, column: pa.ChunkedArray) -> None:
        self.raw = [x.as_buffer() for x in column]
        self.size = np.array([len(x) for x in self.raw], np.int64)
        self.level: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in np.unique(self.size).tolist():
            # A partner has at most four times the bits: its size is within the similarity.
            rows = np.flatnonzero((self.size >= size) & (self.size <= 4 * size))
            place = np.full(len(self.raw), -1)
            place[rows] = np.arange(len(rows))
            self.level[size] = (place, np.stack([_folded(self.raw[r], size) for r in rows]))

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), np.int64)
        smaller = np.minimum(self.size[a], self.size[b])
        for size in np.unique(smaller).tolist():
            place, maps = self.level[size]
            at = np.flatnonzero(smaller == size)
            for k in range(0, len(at), step := max(1, (8 << 20) // size)):
                some = at[k : k + step]
                out[some] = np.bitwise_count(maps[place[a[some]]] ^ maps[place[b[some]]]).sum(axis=1)
        return out


def _and_last(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch | None]]:
    for batch in batches:
        yield False, batch
    yield True, None
