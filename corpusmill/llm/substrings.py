"""Repeated passages: fixed-block anchors, rolling probes, extension to maximal exact repeats.

A word goes when some window of ``window`` consecutive words around it also starts in a document with
a smaller id. Windows are judged on the input, so removing one repeat never hides another.

1. *Index*: every document is cut into non-overlapping blocks of half a window. A window always holds
   one whole block of the document it lies in.
2. *Probe*: every rolling run of that length, at every position, is looked up among the blocks. A hit
   on a block of an earlier document is an anchor.
3. *Extend*: around an anchor the exact windows that contain it are compared, by 128-bit hashes of all
   their words, with the windows around the blocks that were hit; overlapping ones join to maximal
   repeats.

Two things come before, both without loss. Documents with equal word sequences are one: all but the
smallest id are repeats as a whole. And a rolling run is probed only where it can matter: each window
names the smallest hash among its short runs, so equal windows name the same one, and text whose
named hashes occur in one document only holds no repeat and is set aside (nine tenths of the given
tables). Groups are only ever reduced by minimum and maximum; no pairs of documents are made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.columns import free_names, whole_numbers
from corpusmill.llm.words import Block, blocks
from corpusmill.session import spill

_SCAN = "doc_id long, th long, n_words long, d1 long, d2 long, whole_sha256 string, named array<long>"
_DONE = "doc_id long, th long, n_removed long, spans array<struct<start:long,stop:long>>, kept_sha256 string"


def repeated_passages(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, th, n_words, n_removed, spans, kept_sha256)``, one row per row of ``docs``.

    Words are runs of characters other than ``[\\x20\\x09-\\x0D]``, unchanged. ``spans`` are the removed
    stretches as word positions, stop exclusive; ``kept_sha256`` is the digest of the remaining words
    joined by one space, in UTF-8; ``th`` is the hash of the text, which tells rows of one id apart.
    Defined cases: null text has no words; a text shorter than a window loses nothing; rows with a
    null id lose nothing and are no reference; rows of one id are no reference for each other;
    no document, no row; further columns are not read, whatever their names.
    """
    if window < 4 or window % 2:
        raise ValueError("window must be even and at least 4")
    base = docs.select(whole_numbers(docs, id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    base = base.withColumn("th", F.xxhash64("text"))
    scan = spill(base.mapInArrow(_scan_rows(window), _SCAN))
    long_enough = scan.filter(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
    groups = ["n_words", "d1", "d2"]
    first = long_enough.groupBy(*groups).agg(F.min("doc_id").alias("rep"))

    texts = spill(_candidates(base, long_enough, first))
    hits = spill(_anchors(texts, window))
    anchored = texts.join(hits, ["doc_id", "th"])
    left = anchored.filter(F.size("blocks") > 0).mapInArrow(_window_rows(window, "blocks"), "w1 long, w2 long, doc_id long")
    left = left.groupBy("w1", "w2").agg(F.min("doc_id").alias("first"))
    right = anchored.filter(F.size("probes") > 0).mapInArrow(
        _window_rows(window, "probes"), "w1 long, w2 long, doc_id long, th long, start int"
    )
    met = right.join(left, ["w1", "w2"]).filter("first < doc_id")
    starts = met.groupBy("doc_id", "th").agg(F.collect_set("start").alias("starts"))
    done = texts.select("doc_id", "th", "text").join(starts, ["doc_id", "th"]).mapInArrow(_kept_rows(window), _DONE)

    rows = scan.select("doc_id", "th", "n_words", "d1", "d2", "whole_sha256")
    rows = rows.join(first, groups, "left").join(done.dropDuplicates(["doc_id", "th"]), ["doc_id", "th"], "left")
    copy = F.col("rep") < F.col("doc_id")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("stop")))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    return rows.select(
        "doc_id",
        "th",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, whole).otherwise(F.coalesce("spans", none)).alias("spans"),
        F.when(copy, empty).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated words cut out of the text, and all other columns as they are.

    A document that loses words has the rest joined by single spaces; others keep their text unchanged. Defined
    cases as in ``repeated_passages``; ids must be whole numbers (TypeError); no name of a column matters.
    """
    found = repeated_passages(docs, window, id_col, text_col).filter("n_removed > 0")
    id_, th, spans = free_names(docs, "id_", "th", "spans")
    found = found.select(F.col("doc_id").alias(id_), F.col("th").alias(th), F.col("spans").alias(spans))
    same = (F.col(f"`{id_col}`").cast("long") == F.col(id_)) & (F.xxhash64(F.col(f"`{text_col}`").cast("string")) == F.col(th))
    joined = docs.join(found.dropDuplicates([id_, th]), same, "left")
    words = F.filter(F.split(F.col(text_col), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    kept = F.filter(words, lambda _, i: ~F.exists(spans, lambda s: (s["start"] <= i) & (i < s["stop"])))
    text = F.when(F.col(spans).isNull(), F.col(text_col)).otherwise(F.array_join(kept, " "))
    return joined.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def _named_length(window: int) -> int:
    return max(1, window // 3)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` values in a row, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values


def _per_text(block: Block, k: int, words: np.ndarray) -> Iterator[np.ndarray]:
    grams, first = block.gram_hashes(words, k)
    for i in range(len(block)):
        yield grams[first[i] : first[i + 1]]


def _scan_rows(window: int) -> Callable:
    k = _named_length(window)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                words, other = block.word_hashes(), block.word_hashes(seed=1)
                n = np.diff(block.first)
                digests, shas, named = [], [], []
                for i, grams in enumerate(_per_text(block, k, words)):
                    at = slice(block.first[i], block.first[i + 1])
                    place = np.arange(1, n[i] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    digests.append([_sum(words[at] * (place | np.uint64(1))), _sum(other[at] * (place ^ np.uint64(0xA5A5A5A5)))])
                    shas.append(hashlib.sha256(b" ".join(block.text(i).split())).hexdigest())
                    named.append(np.unique(_sliding_min(grams, window - k + 1)) if n[i] >= window else grams[:0])
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in named])]).astype(np.int32)
                pairs = np.array(digests, np.uint64).view(np.int64).reshape(-1, 2)
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").slice(block.at, len(block)),
                        "th": batch.column("th").slice(block.at, len(block)),
                        "n_words": n.astype(np.int64),
                        "d1": np.ascontiguousarray(pairs[:, 0]),
                        "d2": np.ascontiguousarray(pairs[:, 1]),
                        "whole_sha256": pa.array(shas, pa.string()),
                        "named": pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(named).view(np.int64))),
                    }
                )

    return rows


def _sum(values: np.ndarray) -> int:
    return int(values.sum(dtype=np.uint64))


def _candidates(base: DataFrame, scan: DataFrame, first: DataFrame) -> DataFrame:
    """Texts with named hashes that another document names too: ``(doc_id, th, text, named)``."""
    reps = scan.join(first, ["n_words", "d1", "d2"]).filter("doc_id = rep")
    held = reps.select("doc_id", "th", F.explode("named").alias("h"))
    shared = held.groupBy("h").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi")
    named = held.join(shared.select("h"), "h").groupBy("doc_id", "th").agg(F.collect_set("h").alias("named"))
    return base.join(spill(named), ["doc_id", "th"]).dropDuplicates(["doc_id", "th"])


def _regions(batch: pa.RecordBatch, window: int) -> Iterator[tuple[int, Block, int, np.ndarray, np.ndarray]]:
    """Row, block, text of the block, word hashes, and a flag per window: does it hold a named hash."""
    k = _named_length(window)
    lists = batch.column("named")
    for block in blocks(batch.column("text")):
        words = block.word_hashes()
        for i, grams in enumerate(_per_text(block, k, words)):
            row = block.at + i
            named = np.isin(grams, lists[row].values.to_numpy(zero_copy_only=False).view(np.uint64))
            counts = np.concatenate([[0], np.cumsum(named)])
            width = window - k + 1
            yield row, block, i, words, counts[width:] > counts[:-width]


def _inside(flags: np.ndarray, half: int) -> np.ndarray:
    """For every run of ``half`` words: does a flagged window contain it."""
    counts = np.concatenate([[0], np.cumsum(flags)])
    p = np.arange(len(flags) + half)
    return counts[np.minimum(p + 1, len(flags))] > counts[np.clip(p - half, 0, len(flags))]


def _anchor_rows(window: int, kind: str) -> Callable:
    """Hashes of the aligned blocks, or of all rolling runs, of the candidate regions."""
    half = window // 2

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, sizes = [], []
            for _, block, i, words, flags in _regions(batch, window):
                mine = words[block.first[i] : block.first[i + 1]]
                runs = _runs(mine, half)
                keep = _inside(flags, half)
                if kind == "blocks":
                    keep = keep & (np.arange(len(runs)) % half == 0)
                found.append(np.unique(runs[keep]))
                sizes.append(len(found[-1]))
            if found:
                take = pa.array(np.repeat(np.arange(len(batch)), sizes))
                yield pa.record_batch(
                    {
                        "h": np.concatenate(found).view(np.int64),
                        "doc_id": batch.column("doc_id").take(take),
                        "th": batch.column("th").take(take),
                    }
                )

    return rows


def _runs(words: np.ndarray, k: int) -> np.ndarray:
    one = Block(0, words[:0], np.zeros(2, np.int64), words[:0], words[:0], np.array([0, len(words)]))
    return one.gram_hashes(words, k)[0]


def _anchors(texts: DataFrame, window: int) -> DataFrame:
    """``(doc_id, th, probes, blocks)``: runs that hit a block of an earlier document, and blocks hit by a later one."""
    schema = "h long, doc_id long, th long"
    index = texts.mapInArrow(_anchor_rows(window, "blocks"), schema)
    probes = texts.mapInArrow(_anchor_rows(window, "probes"), schema)
    first = index.groupBy("h").agg(F.min("doc_id").alias("first"))
    hits = spill(probes.join(first, "h").filter("first < doc_id").drop("first"))
    last = hits.groupBy("h").agg(F.max("doc_id").alias("last"))
    hit_blocks = index.join(last, "h").filter("doc_id < last").drop("last")
    both = hits.withColumn("probe", F.lit(True)).unionByName(hit_blocks.withColumn("probe", F.lit(False)))
    return both.groupBy("doc_id", "th").agg(
        F.collect_list(F.when(F.col("probe"), F.col("h"))).alias("probes"),
        F.collect_list(F.when(~F.col("probe"), F.col("h"))).alias("blocks"),
    )


def _window_rows(window: int, kind: str) -> Callable:
    """128-bit hashes of the candidate windows that contain an anchor (probes) or a hit block (blocks)."""
    half = window // 2

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(kind)
            parts, at = [], None
            for row, block, i, words, flags in _regions(batch, window):
                if at != block.at:
                    at, other = block.at, block.word_hashes(seed=1)
                span = slice(block.first[i], block.first[i + 1])
                runs = _runs(words[span], half)
                hit = np.isin(runs, lists[row].values.to_numpy(zero_copy_only=False).view(np.uint64))
                if kind == "blocks":
                    hit &= np.arange(len(runs)) % half == 0
                counts = np.concatenate([[0], np.cumsum(hit)])
                near = counts[half + 1 :] > counts[: -half - 1]
                starts = np.flatnonzero(flags & near)
                if len(starts):
                    parts.append((row, starts, _runs(words[span], window)[starts], _runs(other[span], window)[starts]))
            if not parts:
                continue
            take = pa.array(np.repeat([p[0] for p in parts], [len(p[1]) for p in parts]))
            out = {
                "w1": np.concatenate([p[2] for p in parts]).view(np.int64),
                "w2": np.concatenate([p[3] for p in parts]).view(np.int64),
                "doc_id": batch.column("doc_id").take(take),
            }
            if kind == "probes":
                out |= {"th": batch.column("th").take(take), "start": np.concatenate([p[1] for p in parts]).astype(np.int32)}
            yield pa.record_batch(out)

    return rows


def _kept_rows(window: int) -> Callable:
    """Maximal repeats of each text from its repeated windows, and the digest of what stays."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, shas = [], [], []
            for text, starts in zip(batch.column("text"), batch.column("starts"), strict=True):
                words = text.as_py().encode().split()
                edges = np.zeros(len(words) + 1, np.int64)
                at = starts.values.to_numpy(zero_copy_only=False)
                edges[at] += 1
                edges[at + window] -= 1
                gone = np.cumsum(edges)[:-1] > 0
                turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                removed.append(int(gone.sum()))
                spans.append([{"start": int(a), "stop": int(b)} for a, b in turns.reshape(-1, 2)])
                shas.append(hashlib.sha256(b" ".join(w for w, out in zip(words, gone, strict=True) if not out)).hexdigest())
            kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "th": batch.column("th"),
                    "n_removed": pa.array(removed, pa.int64()),
                    "spans": pa.array(spans, kind),
                    "kept_sha256": pa.array(shas, pa.string()),
                }
            )

    return rows
