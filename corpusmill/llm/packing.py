"""Packing documents into sequences of bounded length, in order, by dynamic programming over cut points.

Documents follow one another as they stand in their input split; each is its token ids and one end mark.
Sequences are consecutive stretches of that stream. Cuts lie at ends of documents or of sentences, and
inside a sentence only where a stretch without any end is long. A cut costs the padding of the
sequence before it plus a penalty for what it truncates; the cheapest series of cuts comes from

    cost(j) = penalty(j) + length - at(j) + min over i with at(j) - at(i) <= length of (cost(i) + at(i))

whose minimum slides with j and is kept in a monotone queue, so the work is linear in the cut points.

Splits are packed independently and as streams: a task holds a bounded stretch, decides its cuts, gives
out all but the last few sequences and goes on with the rest. No shuffle; one short sequence per split.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.columns import whole_numbers
from corpusmill.llm.tokens import encoder

STRETCH = 256  # sequences' worth of tokens that are decided at a time
HELD_BACK = 16  # sequences at its end that are decided again with what follows
TEXT_CHARS = 1 << 20  # characters encoded at a time; a longer text is encoded alone
GAP, STEP = 128, 16  # a stretch of more than GAP tokens without an end may be cut every STEP tokens

_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "sequence_length long"
)


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = 2048,
    end_id: int = 1,
    sentence_cut: float = 4.0,
    hard_cut: float = 64.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    added_tokens: bool = False,
) -> DataFrame:
    """One row per piece: ``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_length)``.

    ``start`` counts the document's ids before the piece, ``doc_tokens`` all of them with the end mark;
    ``offset`` is the piece's place in its sequence, gapless from 0. Penalties are in tokens of padding;
    a cut at a document's end costs none. ``tokenizer`` is a path every machine can read; with
    ``added_tokens`` the string of an added token in a text is that token, else ordinary text. Defined
    cases: null or empty text is the end mark alone; a null id is kept as it is; rows that repeat an
    id are packed one by one; a text of any length is cut as often as needed; no document, no row;
    further columns are not read, whatever their names; ids must be whole numbers (TypeError). Padding is
    charged up to ``length`` for every sequence alike; where a sequence of a power of two of ids is left unpadded,
    the true padding is less than what was charged, never more.
    """
    rows = docs.select(whole_numbers(docs, id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_pack_rows(tokenizer, length, end_id, sentence_cut, hard_cut, added_tokens), _PIECES)


def _pack_rows(
    tokenizer: str, length: int, end_id: int, sentence_cut: float, hard_cut: float, added_tokens: bool
) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = _Stream(length, sentence_cut, hard_cut, _sentence_ends(tokenizer, end_id))
        for batch in batches:
            for ids, texts in _some_texts(batch):
                flat, bounds = encoder(tokenizer, added_tokens).ids(texts)
                stream.add(ids, *_with_end(flat, bounds, end_id))
                yield from stream.ready()
        yield from stream.ready(last=True)

    return rows


def _some_texts(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    ids, texts, held = [], [], 0
    for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
        text = t.as_py() or ""
        if texts and held + len(text) > TEXT_CHARS:
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(i)
        texts.append(text)
        held += len(text)
    if texts:
        yield ids, texts


def _with_end(flat: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with the end mark after every text, and their bounds."""
    return np.insert(flat, bounds[1:], end_id), bounds + np.arange(len(bounds))


_ends: dict[tuple[str, int], np.ndarray] = {}


def _sentence_ends(tokenizer: str, end_id: int) -> np.ndarray:
    """For every token id: may a sentence end after it (a full stop, ``!``, ``?`` or a line break)."""
    if (tokenizer, end_id) not in _ends:
        table = encoder(tokenizer).table()
        ends = np.zeros(max(len(table), end_id + 1), bool)
        ends[: len(table)] = [t.rstrip(b" \t")[-1:] in (b".", b"!", b"?", b"\n") for t in table]
        _ends[tokenizer, end_id] = ends
    return _ends[tokenizer, end_id]


def cut_points(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray, length: int, sentence_cut: float, hard_cut: float):
    """Positions where the stream may be cut, the stream's begin first, and the penalty of each."""
    sentence = np.flatnonzero(ends[ids]) + 1
    soft = np.unique(np.concatenate([[0], sentence, doc_ends]))
    gaps = np.diff(np.concatenate([soft, [len(ids)]]))
    wide, step = np.flatnonzero(gaps > min(GAP, length)), min(STEP, length)
    hard = [np.arange(soft[i] + step, soft[i] + gaps[i], step) for i in wide]
    at = np.unique(np.concatenate([soft, *hard])) if hard else soft
    penalty = np.full(len(at), hard_cut)
    penalty[np.searchsorted(at, soft)] = sentence_cut
    penalty[np.searchsorted(at, doc_ends)] = 0.0
    return at, penalty


def best_cuts(at: np.ndarray, penalty: np.ndarray, length: int) -> np.ndarray:
    """The cheapest positions from ``at[0]`` to ``at[-1]`` with no stretch longer than ``length``."""
    places, price = at.tolist(), penalty.tolist()
    back = [0] * len(places)
    queue: deque[tuple[float, int, int]] = deque([(float(places[0]), places[0], 0)])  # (cost + at, at, number), rising
    for j in range(1, len(places)):
        here = places[j]
        while here - queue[0][1] > length:
            queue.popleft()
        least, _, back[j] = queue[0]
        total = least + price[j] + length
        while queue and queue[-1][0] >= total:
            queue.pop()
        queue.append((total, here, j))
    cuts = [len(places) - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return at[cuts[::-1]]


class _Stream:
    """The documents of a split that are not given out yet."""

    def __init__(self, length: int, sentence_cut: float, hard_cut: float, ends: np.ndarray) -> None:
        self.length, self.sentence_cut, self.hard_cut, self.ends = length, sentence_cut, hard_cut, ends
        self.parts: list[np.ndarray] = []
        self.docs: list[tuple[int | None, int, int]] = []  # id, ids given out already, ids held
        self.held = 0
        self.sequence = TaskContext.get().partitionId() << 32

    def add(self, doc_ids: list, flat: np.ndarray, bounds: np.ndarray) -> None:
        self.parts.append(flat)
        self.docs += [(d, 0, int(n)) for d, n in zip(doc_ids, np.diff(bounds), strict=True)]
        self.held += len(flat)

    def ready(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        if self.held and (last or self.held >= STRETCH * self.length):
            yield self._give(last)

    def _give(self, last: bool) -> pa.RecordBatch:
        ids = np.concatenate(self.parts)
        sizes = np.array([n for _, _, n in self.docs], np.int64)
        doc_bounds = np.concatenate([[0], np.cumsum(sizes)])
        at, penalty = cut_points(ids, doc_bounds[1:], self.ends, self.length, self.sentence_cut, self.hard_cut)
        cuts = best_cuts(at, penalty, self.length)
        if not last:
            cuts = cuts[: max(2, len(cuts) - HELD_BACK)]
        done = int(cuts[-1])
        bounds = np.union1d(doc_bounds[doc_bounds <= done], cuts)
        starts, lengths = bounds[:-1], np.diff(bounds)
        doc = np.searchsorted(doc_bounds, starts, "right") - 1
        seq = np.searchsorted(cuts, starts, "right") - 1
        before = np.array([b for _, b, _ in self.docs], np.int64)
        raw = ids.astype("<u4").tobytes()
        crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        out = pa.record_batch(
            {
                "doc_id": pa.array([self.docs[d][0] for d in doc], pa.int64()),
                "start": starts - doc_bounds[doc] + before[doc],
                "length": lengths,
                "ids_crc32": pa.array(crc, pa.int64()),
                "doc_tokens": (before + sizes)[doc],
                "sequence_id": self.sequence + seq,
                "offset": starts - cuts[seq],
                "sequence_length": np.diff(cuts)[seq],
            }
        )
        self.sequence += len(cuts) - 1
        first = int(np.searchsorted(doc_bounds, done, "right")) - 1
        rest = self.docs[first:]
        if rest and done > doc_bounds[first]:
            gone = done - int(doc_bounds[first])
            rest[0] = (rest[0][0], rest[0][1] + gone, rest[0][2] - gone)
        self.docs, self.parts, self.held = rest, [ids[done:]], len(ids) - done
        return out
