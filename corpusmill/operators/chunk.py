"""Documents to token chunks."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.constants import CHUNK_OVERLAP, CHUNK_TOKENS
from corpusmill.functions.text import tokens
from corpusmill.operators.parse import successful
from corpusmill.schemas import propagated_columns

Chunker = Callable[[Column], Column]
SEPARATORS = ("\n\n", "\n", " ", "")


def fixed_windows(size: int = CHUNK_TOKENS, overlap: int = CHUNK_OVERLAP) -> Chunker:
    """Windows of ``size`` white-space tokens, each sharing ``overlap`` with the one before.

    All native. The token array is bound once per document (the one-element
    ``transform``), not once per window.
    """
    _check(size, overlap)
    step = size - overlap

    def windows(w: Column) -> Column:
        last = F.greatest(F.lit(0), F.ceil((F.size(w) - size) / F.lit(step)).cast("int"))
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.array_join(F.slice(w, i * step + 1, F.lit(size)), " "),
        )

    return lambda text: F.element_at(F.transform(F.array(tokens(text)), windows), 1)


def python_chunker(chunk: Callable[[str], list[str]]) -> Chunker:
    """Any ``str -> list[str]`` as a chunker. Only the text column crosses to Python."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.array(
            [None if t is None else chunk(t) for t in texts.to_pylist()], type=pa.list_(pa.string())
        )

    return lambda text: F.arrow_udf(run, "array<string>")(text)


def recursive_splitter(
    size: int = CHUNK_TOKENS,
    overlap: int = CHUNK_OVERLAP,
    length: Callable[[str], int] | None = None,
    separators: Sequence[str] = SEPARATORS,
    lengths: Callable[[list[str]], list[int]] | None = None,
) -> Chunker:
    """Split at the coarsest separator that works, then pack pieces into chunks.

    ``length`` counts the tokens of a string (default: white-space tokens); ``lengths`` those of many strings at
    once, such as the batch encoding of an embedding model's tokenizer. It is called once per depth of a batch.
    A chunk's length is that of its pieces and of the separators between them.
    """
    _check(size, overlap)
    if length and lengths:
        raise ValueError("give length or lengths")
    count = lengths or partial(_each, length or _count_tokens)
    seps = tuple(separators)

    def run(texts: pa.Array) -> pa.Array:
        return pa.array(recursive_chunks(texts.to_pylist(), size, overlap, count, seps), type=pa.list_(pa.string()))

    return lambda text: F.arrow_udf(run, "array<string>")(text)


def compute_chunks(
    docs: DataFrame,
    chunker: Chunker,
    doc_column: str = "doc_content",
    propagate: Sequence[str] | None = None,
    key_column: str = "doc_uri",
) -> DataFrame:
    """One row per chunk: id, index, text, and the document's other columns.

    Failed documents and empty chunks are left out. The id depends on the document's
    key and the chunk's place only, so a second run gives the same ids. No shuffle.
    """
    if propagate is None:
        propagate = propagated_columns(docs.schema, doc_column)
    kept = successful(docs) if "parser_status" in docs.columns else docs
    rows = kept.select(*propagate, chunker(F.col(doc_column)).alias("_chunks")).select(
        *propagate,
        F.posexplode(F.filter("_chunks", lambda c: c != "")).alias("_pos", "content_chunked"),
    )
    return rows.select(
        chunk_id(key_column, "_pos").alias("chunk_id"),
        F.col("_pos").cast("long").alias("chunk_index"),
        "content_chunked",
        *propagate,
    )


def chunk_id(key: Column | str, index: Column | str) -> Column:
    """Primary key of a chunk."""
    key = F.col(key) if isinstance(key, str) else key
    index = F.col(index) if isinstance(index, str) else index
    return F.md5(F.concat_ws("|", key.cast("string"), index.cast("string")))


def _check(size: int, overlap: int) -> None:
    if not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")


def _count_tokens(text: str) -> int:
    return len(text.split())


def _each(length: Callable[[str], int], texts: list[str]) -> list[int]:
    return [length(t) for t in texts]


@dataclass
class _Run:
    """Neighbouring pieces of one split that fit a chunk each, with their lengths."""

    sep: str
    pieces: list[str]
    sizes: list[int]


def recursive_chunks(
    texts: Sequence[str | None], size: int, overlap: int, lengths: Callable[[list[str]], list[int]], seps: tuple[str, ...]
) -> list[list[str] | None]:
    """Chunks of every text, None for None. Work is linear in the texts.

    All pieces of one depth, of all texts, are measured by one call of ``lengths``; no deeper than there are
    separators. A piece over ``size`` closes the run of fitting ones before it and is split further.
    """
    # Per text, in order: finished runs, single chunks, and pieces yet to be split as (piece, finer separators).
    items: list[list[_Run | str | tuple]] = [[] if t is None else [(t, seps)] for t in texts]
    waiting = [i for i, t in enumerate(texts) if t is not None]
    while waiting:
        opened = [(i, item) for i in waiting for item in items[i] if isinstance(item, tuple)]
        split = [_split(piece, finer) for _, (piece, finer) in opened]
        counted = iter(lengths([p for pieces, _, _ in split for p in pieces]))
        parts = iter([_runs(pieces, sep, finer, counted, size) for pieces, sep, finer in split])
        for i in waiting:
            items[i] = [new for old in items[i] for new in (next(parts) if isinstance(old, tuple) else [old])]
        waiting = [i for i in waiting if any(isinstance(item, tuple) for item in items[i])]
    gaps = dict(zip(seps, lengths(list(seps)), strict=True)) | {"": 0}
    return [
        None if t is None else [c for item in items[i] for c in _chunks_of(item, size, overlap, gaps)]
        for i, t in enumerate(texts)
    ]


def _split(piece: str, seps: tuple[str, ...]) -> tuple[list[str], str, tuple[str, ...]]:
    """Pieces by the coarsest separator that occurs, that separator, and the finer ones; characters as a last resort."""
    at = next((i for i, s in enumerate(seps) if s in piece), None)
    sep, finer = ("", ()) if at is None else (seps[at], seps[at + 1 :])
    return [p for p in (piece.split(sep) if sep else piece) if p], sep, finer


def _runs(
    pieces: list[str], sep: str, finer: tuple[str, ...], sizes: Iterator[int], size: int
) -> list[_Run | str | tuple]:
    found: list[_Run | str | tuple] = []
    for piece in pieces:
        n = next(sizes)
        if n > size:
            found.append((piece, finer) if finer else piece)
        else:
            if not (found and isinstance(found[-1], _Run)):
                found.append(_Run(sep, [], []))
            found[-1].pieces.append(piece)
            found[-1].sizes.append(n)
    return found


def _chunks_of(item: _Run | str, size: int, overlap: int, gaps: dict[str, int]) -> Iterator[str]:
    if isinstance(item, str):
        yield item
        return
    for start, end in _cuts(item.sizes, gaps[item.sep], size, overlap):
        text = item.sep.join(item.pieces[start:end]).strip()
        if text:
            yield text


def _cuts(sizes: list[int], gap: int, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Longest windows of at most ``size``; the next starts with the longest tail of at most ``overlap`` that leaves room."""
    reach = [0, *accumulate(n + gap for n in sizes)]  # pieces s to e take reach[e] - reach[s] - gap
    start = 0
    while True:
        end = bisect_right(reach, reach[start] + gap + size, lo=start + 1) - 1
        yield start, end
        if end == len(sizes):
            return
        least = max(reach[end] - gap - overlap, reach[end + 1] - gap - size)
        start = min(bisect_left(reach, least, lo=start + 1), end)
