"""Packing documents into as few sequences as it can: dominant sets first, then best fit.

1. Every document is encoded once, with its end mark. Longer ones are cut into pieces of the full length;
   a piece's number among those of its length within its task is noted as it is written.
2. Lengths are counted. From here on the instance is one count per length, at most ``length`` rows
   whatever the corpus, so that it may go to the driver.
3. Reduction (Martello and Toth): for a piece j, a small set F that holds j *dominates* when every other set
   with j that fits a sequence can be laid into F, part by part, so that no packing gets worse by fixing F.
   Such sets are fixed for as many pieces at once as the counts allow, until no length has one.
4. What remains is packed by best fit, longest first, a length at a time: the fullest sequences that can
   take it are filled alike, so a step deals with a range of sequences, not with one.
5. The plan says for each length which stretch of its pieces goes to which range of sequences. A piece
   finds its place by its number; no task sees more than its own pieces, and no length is gathered.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.llm.word_ids import word_ids
from corpusmill.session import spill

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"
_RANKS = 1 << 44  # more pieces than any length has


def best_fit(
    docs: DataFrame,
    tokenizer: str,
    length: int = 4096,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    added_tokens: bool = False,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: ``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``.

    ``start`` counts the document's ids before the piece, ``offset`` those before it in its sequence,
    gapless from 0. ``with_ids`` adds the ids themselves (``ids``, array of int). A document of at most
    ``length`` ids, its end mark among them, is one piece; a longer one is cut into full pieces and a
    last one. ``tokenizer`` is a path every machine can read; with ``added_tokens`` the string of an
    added token in a text is that token, else ordinary text. The id keeps its type. Defined cases: null or
    empty text is the end mark alone; rows with a null id and rows that repeat one are packed one by
    one; a text of any length is cut as often as needed; no document, no row; further columns are not
    read, whatever their names.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = _PIECES.replace("doc_id long", f"doc_id {rows.schema['doc_id'].dataType.simpleString()}")
    schema += ", ids array<int>" * with_ids
    pieces = spill(rows.mapInArrow(_pieces(tokenizer, length, end_id, added_tokens, with_ids), schema))
    held = spill(pieces.groupBy("task", "length").agg(F.count("*").alias("n")))
    counts = {r.length: r.n for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= length rows
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = held.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["task", "length"])
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    ranked = ranked.select(*kept, (F.col("base") + F.col("nth")).alias("rank"))
    out = schema.replace("task int, nth long", "sequence_id long, offset long")
    return ranked.mapInArrow(_places(packing_plan(counts, length).stretches()), out)


def _pieces(tokenizer: str, length: int, end_id: int, added_tokens: bool, with_ids: bool) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = word_ids(tokenizer, added_tokens), int(end_id).to_bytes(4, "little")
        task, seen = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            row, piece, size, crc, nth, ids = [], [], [], [], [], []
            for i, text in enumerate(batch.column("text")):
                raw = encoder.of_text(text.as_py() or "") + end
                for k, at in enumerate(range(0, len(raw), 4 * length)):
                    part = raw[at : at + 4 * length]
                    n = len(part) // 4
                    row.append(i)
                    piece.append(k)
                    size.append(n)
                    crc.append(zlib.crc32(part))
                    nth.append(seen[n])
                    seen[n] += 1
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(row, pa.int64())),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(np.array(piece, np.int64) * length, pa.int64()),
                "length": pa.array(size, pa.int64()),
                "ids_crc32": pa.array(crc, pa.int64()),
                "task": pa.array([task] * len(row), pa.int32()),
                "nth": pa.array(nth, pa.int64()),
            }
            yield pa.record_batch(columns | ({"ids": pa.array(ids, pa.list_(pa.int32()))} if with_ids else {}))

    return rows


def _places(stretches: np.ndarray) -> Callable:
    """Sequence and offset of every piece, by its length and its number among those of that length."""
    weight, first, each, sequence, offset = stretches

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = weight * _RANKS + first
        for batch in batches:
            size, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(keys, size * _RANKS + rank, "right") - 1
            bin_, place = np.divmod(rank - first[at], each[at])
            columns = {c: batch.column(c) for c in batch.schema.names if c not in ("rank", "ids")}
            columns |= {"sequence_id": sequence[at] + bin_, "offset": offset[at] + place * size}
            yield pa.record_batch(columns | ({"ids": batch.column("ids")} if "ids" in batch.schema.names else {}))

    return rows


# --- the plan, on one count per length ---------------------------------------------------------


@dataclass
class Plan:
    """Stretches of pieces and the ranges of sequences that take them. Sequences are numbered from 0."""

    taken: Counter = field(default_factory=Counter)
    sequences: int = 0
    rows: list[tuple[int, int, int, int, int]] = field(default_factory=list)

    def put(self, weight: int, sequences: int, each: int, first_sequence: int, offset: int) -> None:
        """The next pieces of a weight: ``each`` of them, one after the other, in every sequence of a range."""
        self.rows.append((weight, self.taken[weight], each, first_sequence, offset))
        self.taken[weight] += sequences * each

    def open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def stretches(self) -> np.ndarray:
        """Weight, number of the first piece, pieces per sequence, first sequence, offset; in order of pieces."""
        return np.array(sorted(self.rows), np.int64).reshape(-1, 5).T


def packing_plan(counts: dict[int, int], capacity: int) -> Plan:
    """Where every piece goes, for so many pieces of each length."""
    plan = Plan()
    fixed, left = dominant_sets(counts, capacity)
    for members, times in fixed:
        at, offset = plan.open(times), 0
        for weight, each in sorted(Counter(members).items(), reverse=True):
            plan.put(weight, times, each, at, offset)
            offset += weight * each
    _fill(plan, left, capacity)
    return plan


def dominant_sets(counts: dict[int, int], capacity: int) -> tuple[list[tuple[tuple[int, ...], int]], dict[int, int]]:
    """``(weights of a sequence, times)`` that some packing into the fewest sequences holds, and the counts left."""
    left = {w: n for w, n in counts.items() if n}
    if left and max(left) > capacity:
        raise ValueError("a piece is longer than a sequence")
    weights, fixed, found = sorted(left), [], True
    while found:
        found = False
        for w in sorted(left, reverse=True):
            while w in left and (members := _dominant(left, weights, w, capacity - w)):
                need = Counter(members)
                times = min(left[v] // n for v, n in need.items())
                fixed.append((members, times))
                found = True
                for v, n in need.items():
                    left[v] -= n * times
                    if not left[v]:
                        del left[v]
                        weights.remove(v)
    return fixed, left


def _dominant(left: dict[int, int], weights: list[int], w: int, room: int) -> tuple[int, ...] | None:
    """A set with one piece of weight w that dominates every other such set, if a small one is known to."""

    def others(v: int, *used: int) -> int:
        return left[v] - (v == w) - used.count(v)

    def heaviest(limit: int, *used: int) -> int:
        """The largest weight up to a limit of which a piece is left, or 0."""
        i = bisect_right(weights, limit) - 1
        while i >= 0 and not others(weights[i], *used):
            i -= 1
        return weights[i] if i >= 0 else 0

    def lightest(n: int, above: int = 0) -> list[int]:
        some: list[int] = []
        for v in weights[bisect_right(weights, above) :]:
            some += [v] * min(others(v), n - len(some))
            if len(some) == n:
                break
        return some

    best = heaviest(room)
    if not best:
        return (w,)  # nothing fits beside it
    if best == room:
        return w, best  # a full sequence: whatever else would go with w fits in the place of this one
    least = lightest(3)
    if len(least) < 2 or least[0] + least[1] > room:
        return w, best  # one more piece at most, so the largest
    if len(least) == 3 and sum(least) <= room:
        return None
    if best >= _heaviest_pair(weights, others, room):
        return w, best  # at most two more, and both would fit in the place of this one
    second = heaviest(room - best, best)
    over = lightest(2, above=second)
    if second and (len(over) < 2 or sum(over) > room):
        return w, best, second  # of any two that fit, the larger fits for ``best``, the smaller for ``second``
    return None


def _heaviest_pair(weights: list[int], others: Callable[..., int], room: int) -> int:
    """The largest sum of two pieces that fit in ``room`` together."""
    low, high, most = 0, bisect_left(weights, room) - 1, 0
    while low <= high:
        a, b = weights[low], weights[high]
        if not others(a):
            low += 1
        elif not others(b) or a + b > room or (low == high and others(a) < 2):
            high -= 1
        else:
            most = max(most, a + b)
            low += 1
    return most


def _fill(plan: Plan, left: dict[int, int], capacity: int) -> None:
    """Best fit, longest first. ``space`` holds, for each room left, the ranges of sequences that have it."""
    space: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []

    def give(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in space:
                space[room] = []
                insort(rooms, room)
            space[room].append((first, n))

    for w in sorted(left, reverse=True):
        n = left[w]
        while n:
            i = bisect_left(rooms, w)
            if i == len(rooms):
                each = min(capacity // w, n)
                room, first, held = capacity, plan.open(n // each), n // each
            else:
                room = rooms[i]
                first, held = space[room].pop()
                if not space[room]:
                    del space[room]
                    rooms.pop(i)
                each = min(room // w, n)
            used = min(held, n // each)
            plan.put(w, used, each, first, capacity - room)
            n -= used * each
            give(room - each * w, first, used)
            give(room, first + used, held - used)
