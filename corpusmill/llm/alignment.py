"""Alignment of two tokenizers' tokens by the bytes they cover, with counts of linked id pairs over the corpus.

1. Every text is encoded once by both. Byte ends of the tokens of consecutive documents form one rising
   series per tokenizer; both end together at the end of every document.
2. Merge path: the merge of the two series is a path from corner to corner of their grid. Diagonals at equal
   steps of work cross it at points found by binary search, and the stretches between them are pieces that
   can be merged alone: equal work for one long document as for many short ones. Pieces are written as rows.
3. Every step of the merge that moves on is the overlap of one A with one B token. Pieces emit the overlaps'
   id pairs, reduced per block of pieces; the corpus counts come from a plain aggregate.
4. Each block meets the counts of its own pairs and is merged again, which costs little beside the encoding:
   documents that lie within one piece are finished there.
5. A document that a piece's bound cuts leaves fragments: sums, whole groups, and the tokens before its
   first and after its last common end. They are put together by document.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from functools import cached_property
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.tokens import _OTHER_SPACE, _PIECE, _Numbers, _room, encoder
from corpusmill.session import spill

WORK = 1 << 17  # ends, of both tokenizers, that a piece merges
BLOCK = 32  # pieces whose id pairs are reduced together
TEXT_CHARS = 4 << 20  # characters encoded at a time; a longer text is encoded alone
KNOWN_PIECES, KNOWN_TOKENS = 700_000, 8_000_000  # what a worker remembers before it starts afresh

_PIECE_ROW = (
    "block long, serial long, keys array<long>, doc_ids array<ID>, stops array<long>, "
    "a_at long, b_at long, a_n int, b_n int, a binary, b binary, opens boolean, closes boolean"
)
_SUMS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
_FOUND = (
    "key long, doc_id ID, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, whole boolean, "
    "groups string, groups_sha256 string, serial long, "
    "head_a array<long>, head_b array<long>, tail_a array<long>, tail_b array<long>"
)


def alignments(
    docs: DataFrame,
    a: str,
    b: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_groups: bool = False,
    work: int = WORK,
    block: int = BLOCK,
) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, one row per document.

    ``a`` is a byte-level vocabulary for the ``tokenizers`` library and encodes a space and the text, ``b`` a
    ``sentencepiece`` model that adds the space itself; both are paths every machine can read. No special
    tokens; their strings in a text are plain text. Groups are cut where tokens of both end. A link is an
    overlap of an A and a B token; its count is that of its id pair over all documents, and it is best if
    no pair with its B id has a higher count. ``groups_sha256`` is the digest of ``a1,a2|b1;a3|b2``, which
    ``with_groups`` adds as ``groups``. A piece merges ``work`` ends, a block holds ``block`` pieces. The id keeps its type. Defined cases: texts that are null or empty,
    or that one tokenizer does not give back byte for byte, have no tokens: zeros and an empty string;
    rows with a null id and rows that repeat one are aligned one by one; a text of any length is cut
    into pieces; no document, no row; further columns are not read, whatever their names.
    """
    pieces = _pieces(docs, a, b, id_col, text_col, work, block)
    met = spill(_met(pieces, a, b))
    counts = _counted(met)
    known = met.select("block", "code").join(counts, "code")
    id_type = pieces.schema["doc_ids"].dataType.elementType.simpleString()
    found = spill(
        pieces.groupBy("block")
        .cogroup(known.select("block", "code", "n", "best").groupBy("block"))
        .applyInArrow(_align(a, b, with_groups), _FOUND.replace("ID", id_type))
    )
    columns = ["doc_id", *_SUMS, *["groups"] * with_groups, "groups_sha256"]
    cut = found.filter(~F.col("whole")).groupBy("key").applyInArrow(_stitch(with_groups), _FOUND.replace("ID", id_type))
    return found.filter("whole").select(*columns).unionByName(cut.select(*columns))


def pair_counts(docs: DataFrame, a: str, b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(a_id, b_id, n, best)``: how many links over all documents hold an id pair, and whether none of its B id has more."""
    counts = _counted(spill(_met(_pieces(docs, a, b, id_col, text_col, WORK, BLOCK), a, b)))
    return counts.select(
        F.shiftright("code", 32).cast("int").alias("a_id"), F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b_id"),
        "n", "best",
    )


def _pieces(docs: DataFrame, a: str, b: str, id_col: str, text_col: str, work: int, block: int) -> DataFrame:
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = _PIECE_ROW.replace("ID", rows.schema["doc_id"].dataType.simpleString())
    return spill(rows.mapInArrow(_encode(a, b, work, block), schema))


def _met(pieces: DataFrame, a: str, b: str) -> DataFrame:
    return pieces.select("block", "a_at", "b_at", "a_n", "b_n", "a", "b").mapInArrow(_pairs(a, b), "block long, code long, n long")


def _counted(met: DataFrame) -> DataFrame:
    """``(code, n, best)`` of every id pair; a B id has at most as many pairs as the A vocabulary has ids."""
    counts = spill(met.groupBy("code").agg(F.sum("n").alias("n")))
    counts = counts.withColumn("b", F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("code", "n", (F.col("n") == F.col("most")).alias("best"))


# --- both tokenizers ---------------------------------------------------------------------------


_pairs_of: dict[tuple[str, str], Both] = {}


def both(a: str, b: str) -> Both:
    if (a, b) not in _pairs_of:
        _pairs_of[a, b] = Both(a, b)
    return _pairs_of[a, b]


class Both:
    """Two tokenizers over the same cuts of a text; every distinct cut is encoded once per worker.

    A text is cut before white space that follows something else, and between letters and a full stop or the
    like. That changes no A token (see ``tokens``), and no B token where no B piece reaches over such a
    place, which is looked up in the model; characters of which that does not hold keep their text whole.
    """

    def __init__(self, a: str, b: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.a = encoder(a)
        given = sentencepiece_model_pb2.ModelProto.FromString(Path(b).read_bytes())
        given.normalizer_spec.add_dummy_prefix = False  # the cuts hold the space themselves
        self.model = sentencepiece.SentencePieceProcessor(model_proto=given.SerializeToString())
        n = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(n)]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.a_bytes = self.a.table()
        self.lengths = tuple(np.array([len(t) for t in table], np.int64) for table in (self.a_bytes, self.b_bytes))
        over = {c for p in pieces for c in re.findall(r"(?<=.)[\t-\r]", p)}
        odd = given.normalizer_spec.name != "identity" or any(self.model.is_unused(i) for i in range(n))
        odd = odd or any(re.search(r"[^▁]▁|[A-Za-z\xc0-\u024f][.,;:!?]", p) for p in pieces)
        self.whole = re.compile("[\\s\\S]" if odd else "|".join([_OTHER_SPACE.pattern, "▁", *sorted(over)]))
        self._forget()

    def _forget(self) -> None:
        self.known = _Numbers()
        self.tokens = [np.zeros(1 << 16, np.uint32) for _ in range(2)]
        self.bounds = [np.zeros(1 << 16, np.int64) for _ in range(2)]
        self.good = np.zeros(1 << 16, bool)

    def _learn(self) -> None:
        new, self.known.new = self.known.new, []
        if not new:
            return
        n = len(self.known) - len(new)
        found = [self.a.encode(p) for p in new], self.model.encode(new, num_threads=1)
        for side in (0, 1):
            ends = self.bounds[side][n] + np.cumsum(np.fromiter(map(len, found[side]), np.int64, len(new)))
            self.tokens[side] = _room(self.tokens[side], int(ends[-1]))
            self.bounds[side] = _room(self.bounds[side], n + len(new) + 1)
            self.tokens[side][self.bounds[side][n] : ends[-1]] = [i for ids in found[side] for i in ids]
            self.bounds[side][n + 1 : n + len(new) + 1] = ends
        self.good = _room(self.good, n + len(new))
        self.good[n : n + len(new)] = [
            self._joined(x, self.a_bytes) == raw and self._joined(y, self.b_bytes) == raw
            for raw, x, y in zip((p.encode() for p in new), *found, strict=True)
        ]

    @staticmethod
    def _joined(ids: list[int], table: list[bytes]) -> bytes:
        return b"".join([table[i] for i in ids])

    def ids(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For A and B: the ids of all texts with a space before them, and the bounds of each text's ids."""
        spaced = [" " + t if t else "" for t in texts]
        parts = [[t] if self.whole.search(t) else _PIECE.findall(t) for t in spaced]
        if len(self.known) > KNOWN_PIECES or max(b[len(self.known)] for b in self.bounds) > KNOWN_TOKENS:
            self._forget()
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        at = np.fromiter((self.known[p] for ps in parts for p in ps), np.int64, int(counts.sum()))
        self._learn()
        cuts = np.concatenate([[0], np.cumsum(counts)])
        bad = np.concatenate([[0], np.cumsum(~self.good[at])])
        at = at[np.repeat(bad[cuts[1:]] == bad[cuts[:-1]], counts)]  # texts not given back have no tokens
        cuts = np.concatenate([[0], np.cumsum(np.where(bad[cuts[1:]] == bad[cuts[:-1]], counts, 0))])
        flat, bounds = [], []
        for side in (0, 1):
            starts = self.bounds[side][at]
            lengths = self.bounds[side][at + 1] - starts
            before = np.concatenate([[0], np.cumsum(lengths)])
            flat.append(self.tokens[side][np.repeat(starts - before[:-1], lengths) + np.arange(before[-1])])
            bounds.append(before[cuts])
        return flat, bounds

    @cached_property
    def names(self) -> tuple[list[bytes], int]:
        """Ids as text after each separator: A after nothing, ``,`` and ``;``, then B after ``|`` and ``,``."""
        a, b = (range(len(n)) for n in self.lengths)
        texts = [f"{s}{i}".encode() for s, ids in (("", a), (",", a), (";", a), ("|", b), (",", b)) for i in ids]
        return texts, len(a)

    def packed(self, ids: np.ndarray, side: int) -> bytes:
        return zstandard.ZstdCompressor(level=1).compress(ids.astype(self._kind(side)).tobytes())

    def unpacked(self, raw: bytes, side: int) -> np.ndarray:
        return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), self._kind(side)).astype(np.int64)

    def _kind(self, side: int) -> str:
        return "<u2" if len(self.lengths[side]) <= 1 << 16 else "<u4"


# --- pieces ------------------------------------------------------------------------------------


def crossing(a_end: np.ndarray, b_end: np.ndarray, diagonal: int) -> tuple[int, int]:
    """How many ends of each series are among the first ``diagonal`` of their merge; ends of both stay together."""
    low, high = max(0, diagonal - len(b_end)), min(diagonal, len(a_end))
    while low < high:
        i = (low + high) // 2
        if a_end[i] <= b_end[diagonal - i - 1]:
            low = i + 1
        else:
            high = i
    j = diagonal - low
    return low, j + int(low > 0 and j < len(b_end) and b_end[j] == a_end[low - 1])


def _encode(a: str, b: str, work: int, block: int) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, task, serial, key = both(a, b), TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for first, texts in _some_texts(batch):
                ids = batch.column("doc_id").slice(first, len(texts))
                flat, bounds = pair.ids(texts)
                out = _cut(pair, flat, bounds, (task << 40) + key, ids, work)
                n = len(out["a"])
                serials = (task << 40) + serial + np.arange(n)
                yield pa.record_batch(out | {"block": serials // block, "serial": serials}).select(
                    [c.split()[0] for c in _PIECE_ROW.split(", ")]
                )
                serial += n
                key += len(texts)

    return rows


def _some_texts(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    texts, held, first = [], 0, 0
    for i, t in enumerate(batch.column("text")):
        text = t.as_py() or ""
        if texts and held + len(text) > TEXT_CHARS:
            yield first, texts
            texts, held, first = [], 0, i
        texts.append(text)
        held += len(text)
    if texts:
        yield first, texts


def _cut(pair: Both, flat: list, bounds: list, key: int, doc_ids: pa.Array, work: int) -> dict:
    """Pieces of consecutive documents, by diagonals at equal steps. Documents without tokens go to the first piece."""
    ends = [np.cumsum(pair.lengths[side][flat[side]]) for side in (0, 1)]
    total = len(ends[0]) + len(ends[1])
    steps = -(-total // work) or 1
    splits = [(0, 0), *(crossing(*ends, total * k // steps) for k in range(1, steps)), (len(ends[0]), len(ends[1]))]
    none = np.flatnonzero(bounds[0][1:] == bounds[0][:-1])
    some = np.flatnonzero(bounds[0][1:] > bounds[0][:-1])
    stops = ends[0][bounds[0][some + 1] - 1]
    at = [(int(ends[0][i - 1]) if i else 0, int(ends[1][j - 1]) if j else 0) for i, j in splits]
    out: dict[str, list] = {c: [] for c in ("keys", "doc_ids", "stops", "a_at", "b_at", "a_n", "b_n", "a", "b", "opens", "closes")}
    for k, ((i, j), (i2, j2)) in enumerate(zip(splits, splits[1:], strict=False)):
        begin, end = max(at[k]), max(at[k + 1])
        first, last = int(np.searchsorted(stops, begin, "right")), int(np.searchsorted(stops, end, "left"))
        mine = some[first : last + 1] if end > begin else some[:0]
        closes = not len(mine) or int(stops[last]) == end
        empty = none if k == 0 else none[:0]
        out["keys"].append(key + np.concatenate([mine, empty]))
        out["doc_ids"].append(doc_ids.take(pa.array(np.concatenate([mine, empty]))))
        out["stops"].append(np.concatenate([stops[first : first + len(mine)] - begin, np.zeros(len(empty), np.int64)]))
        out["a_at"].append(at[k][0] - begin)
        out["b_at"].append(at[k][1] - begin)
        out["a_n"].append(i2 - i)
        out["b_n"].append(j2 - j)
        out["a"].append(pair.packed(flat[0][i : i2 + 1], 0))  # and the token that reaches over the bound
        out["b"].append(pair.packed(flat[1][j : j2 + 1], 1))
        begun = int(stops[first - 1]) if first else 0
        out["opens"].append(bool(len(mine)) and begin > begun)
        out["closes"].append(closes)
    lists = {
        "keys": _lists(out["keys"], pa.int64()), "stops": _lists(out["stops"], pa.int64()),
        "doc_ids": _lists([x.to_pylist() for x in out["doc_ids"]], doc_ids.type),
    }
    kinds = {"a_n": pa.int32(), "b_n": pa.int32(), "a": pa.binary(), "b": pa.binary()}
    return {c: lists[c] if c in lists else pa.array(v, kinds.get(c)) for c, v in out.items()}


def _lists(values: list, kind: pa.DataType) -> pa.Array:
    return pa.array([list(v) for v in values], pa.list_(kind))


class _Merged:
    """One piece, merged: its ends of both tokenizers and the links between."""

    def __init__(self, pair: Both, row: dict) -> None:
        n, m = row["a_n"], row["b_n"]
        self.a, self.b = pair.unpacked(row["a"], 0), pair.unpacked(row["b"], 1)
        self.a_end = row["a_at"] + np.cumsum(pair.lengths[0][self.a[:n]])
        self.b_end = row["b_at"] + np.cumsum(pair.lengths[1][self.b[:m]])
        ends = np.concatenate([self.a_end, self.b_end])
        ends.sort(kind="stable")
        fresh = np.concatenate([ends[:1] == ends[:1], ends[1:] != ends[:-1]])
        self.common = ends[1:][~fresh[1:]]
        self.ends = ends[fresh]
        a_at, b_at = np.searchsorted(self.a_end, self.ends), np.searchsorted(self.b_end, self.ends)
        self.codes = (self.a[a_at] << 32) | self.b[b_at]


def _pairs(a: str, b: str) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, block, held = both(a, b), None, []

        def reduced() -> pa.RecordBatch:
            codes, at = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
            n = np.zeros(len(codes), np.int64)
            np.add.at(n, at, np.concatenate([k for _, k in held]))
            return pa.record_batch({"block": np.full(len(codes), block, np.int64), "code": codes, "n": n})

        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if held and row["block"] != block:
                    yield reduced()
                    held = []
                block = row["block"]
                if row["a_n"] + row["b_n"]:
                    held.append(np.unique(_Merged(pair, row).codes, return_counts=True))
        if held:
            yield reduced()

    return rows


def _align(a: str, b: str, with_groups: bool) -> Callable:
    def rows(key: tuple, pieces: pa.Table, known: pa.Table) -> pa.Table:
        pair = both(a, b)
        order = np.argsort(known.column("code").to_numpy())
        codes, n, best = (known.column(c).to_numpy()[order] for c in ("code", "n", "best"))
        out: dict[str, list] = {c: [] for c in _columns()}
        for row in pieces.to_pylist():
            _documents(pair, row, codes, n, best, with_groups, out)
        kind = pieces.schema.field("doc_ids").type.value_type
        return pa.table({c: pa.array(v, _kinds(kind)[c]) for c, v in out.items()})

    return rows


def _columns() -> list[str]:
    return [c.split()[0] for c in _FOUND.split(", ")]


def _kinds(doc_id: pa.DataType) -> dict[str, pa.DataType]:
    plain = {"string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "ID": doc_id}
    return {c.split()[0]: plain.get(c.split()[1], pa.int64()) for c in _FOUND.split(", ")}


def _documents(pair: Both, row: dict, codes: np.ndarray, n: np.ndarray, best: np.ndarray, with_groups: bool, out: dict) -> None:
    """Results of a piece's documents; fragments of those that go on beyond it."""
    some = sum(s > 0 for s in row["stops"])
    for key, doc in zip(row["keys"][some:], row["doc_ids"][some:], strict=True):
        _add(out, key, doc, row["serial"], [0] * len(_SUMS), True, "" if with_groups else None, "", [[], [], [], []])
    if not some:
        return
    m = _Merged(pair, row)
    stops = np.array(row["stops"][:some])
    if not row["closes"]:
        stops[-1] = max(m.ends[-1], m.a_end[-1] if len(m.a_end) else 0)
    at = np.searchsorted(codes, m.codes)
    bounds = [np.concatenate([[0], np.searchsorted(e, stops, "right")]) for e in (m.a_end, m.b_end, m.common, m.ends)]
    sums = [np.diff(x) for x in bounds]
    sums += [np.diff(np.concatenate([[0], np.cumsum(v[at].astype(np.int64))])[bounds[3]]) for v in (best, n)]
    group = [np.searchsorted(m.common, e) for e in (m.a_end, m.b_end)]
    names, n_a = pair.names
    for d in range(some):
        whole = not (d == 0 and row["opens"]) and not (d == some - 1 and not row["closes"])
        (a0, a1), (b0, b1), (c0, c1) = ((int(x[d]), int(x[d + 1])) for x in bounds[:3])
        head = c0 + 1 if d == 0 and row["opens"] and c1 > c0 else c0  # the first group began in an earlier piece
        x0, x1 = a0 + np.searchsorted(group[0][a0:a1], [head, c1])
        y0, y1 = b0 + np.searchsorted(group[1][b0:b1], [head, c1])
        text = _text(names, n_a, len(pair.lengths[1]), m.a[x0:x1], m.b[y0:y1], group[0][x0:x1], group[1][y0:y1])
        digest = hashlib.sha256(text).hexdigest() if whole else None
        rest = [m.a[a0:x0], m.b[b0:y0], m.a[x1:a1], m.b[y1:b1]]
        _add(out, row["keys"][d], row["doc_ids"][d], row["serial"], [int(s[d]) for s in sums], whole,
             text.decode() if with_groups or not whole else None, digest, [r.tolist() for r in rest])


def _add(out: dict, key: int, doc, serial: int, sums: list, whole: bool, groups: str | None, digest: str | None, rest: list) -> None:
    for c, v in zip(_columns(), [key, doc, *sums, whole, groups, digest, serial, *rest], strict=True):
        out[c].append(v)


def _text(names: list[bytes], n_a: int, n_b: int, a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray) -> bytes:
    """Whole groups as ``a1,a2|b1;a3|b2``."""
    if not len(a):
        return b""
    first_a, first_b = (np.concatenate([[True], g[1:] != g[:-1]]) for g in (a_group, b_group))
    a_name = a + n_a * np.where(first_a, 2, 1)
    a_name[0] = a[0]
    b_name = b + 3 * n_a + n_b * ~first_b
    order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
    return b"".join(map(names.__getitem__, np.concatenate([a_name, b_name])[order].tolist()))


def _stitch(with_groups: bool) -> Callable:
    """One document from its fragments: a group that a bound cuts is the tokens left over before it and those after."""

    def rows(table: pa.Table) -> pa.Table:
        some = table.sort_by("serial").to_pylist()
        done: list[str] = []
        a: list[int] = []
        b: list[int] = []
        for row in some:
            a, b = a + row["head_a"], b + row["head_b"]
            if row["n_groups"]:
                done += [_name(a, b)] if a else []
                done += [row["groups"]] if row["groups"] else []
                a, b = [], []
            a, b = a + row["tail_a"], b + row["tail_b"]
        text = ";".join(done)
        out: dict[str, list] = {c: [] for c in _columns()}
        sums = [sum(row[c] for row in some) for c in _SUMS]
        _add(out, some[0]["key"], some[0]["doc_id"], some[0]["serial"], sums, True, text if with_groups else None,
             hashlib.sha256(text.encode()).hexdigest(), [[], [], [], []])
        kind = table.schema.field("doc_id").type
        return pa.table({c: pa.array(v, _kinds(kind)[c]) for c, v in out.items()})

    return rows


def _name(a: list[int], b: list[int]) -> str:
    return ",".join(map(str, a)) + "|" + ",".join(map(str, b))
