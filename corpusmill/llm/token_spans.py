"""Token counts per section of a document: whole texts are encoded once, spans are joined to sections.

Tokens cover a text without gap or overlap, so their byte spans are running sums of token lengths.
Sections are disjoint character spans. The join of the two interval lists is one merge per document:
all bounds of both lists cut the text into pieces, each in one token and at most one section. A token
that crosses a bound counts whole for one section, by an explicit rule:

- ``"first"``: the section that holds the token's first byte;
- ``"most"``: the section that holds most of its bytes, the earlier one if equal.

Text outside all sections is a section of its own, so counts always add up to the document's tokens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.columns import whole_numbers
from corpusmill.llm.tokens import encoder

OUTSIDE = -1
TEXT_CHARS = 1 << 20  # characters encoded at a time; a longer text is encoded alone
_COUNTS = "doc_id long, section int, start long, stop long, n_tokens long, crossing long, doc_tokens long"


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    sections: Column | None = None,
    rule: str = "first",
    id_col: str = "doc_id",
    text_col: str = "text",
    added_tokens: bool = False,
) -> DataFrame:
    """``(doc_id, section, start, stop, n_tokens, crossing, doc_tokens)``, one row per section.

    ``sections`` is a column of ``array<struct<start, stop>>``, sorted and disjoint, in characters; by
    default the lines. A row of section -1 (start and stop null) has the tokens that fall outside, if
    there are any or if the document has no section. ``crossing`` counts those of the tokens that reach
    beyond the section they count for. Defined cases: null or empty text has one row with 0 tokens (a
    line of no characters; for null, section -1); empty sections count 0; spans beyond the text end with
    it; null or repeated ids are kept row by row; no document, no row; further columns are not read.
    """
    if rule not in ("first", "most"):
        raise ValueError("rule is 'first' or 'most'")
    columns = [whole_numbers(docs, id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    if sections is not None:
        columns.append(sections.alias("spans"))
    return docs.select(*columns).mapInArrow(_count_rows(tokenizer, rule, sections is None, added_tokens), _COUNTS)


def attribute(token_bounds: np.ndarray, starts: np.ndarray, stops: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """The section of each token (-1 for none) and whether the token reaches beyond it, all in bytes."""
    n = len(token_bounds) - 1
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    bounds = np.unique(np.concatenate([token_bounds, starts, stops]))
    bounds = bounds[(bounds >= token_bounds[0]) & (bounds <= token_bounds[-1])]
    at, size = bounds[:-1], np.diff(bounds)
    token = np.searchsorted(token_bounds, at, "right") - 1
    section = np.searchsorted(starts, at, "right") - 1
    section = np.where((section >= 0) & (at < (stops[section] if len(stops) else 0)), section, OUTSIDE)
    order = np.lexsort((at, -size if rule == "most" else at, token))
    first = order[np.searchsorted(token[order], np.arange(n))]
    return section[first], size[first] < np.diff(token_bounds)


def _count_rows(tokenizer: str, rule: str, lines: bool, added_tokens: bool) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(t) for t in encoder(tokenizer).table()], np.int64)
        for batch in batches:
            for at, texts in _some_texts(batch.column("text")):
                flat, bounds = encoder(tokenizer, added_tokens).ids(texts)
                out = {k: [] for k in ("row", "section", "start", "stop", "n_tokens", "crossing", "doc_tokens")}
                for i, text in enumerate(texts):
                    row = at + i
                    raw = np.frombuffer(text.encode(), np.uint8)
                    null = batch.column("text")[row].as_py() is None
                    starts, stops = _lines(text, null) if lines else _given(batch.column("spans")[row], len(text))
                    leads = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
                    mine = flat[bounds[i] : bounds[i + 1]]
                    token_bounds = np.concatenate([[0], np.cumsum(sizes[mine])])
                    section, over = attribute(token_bounds, leads[starts], leads[stops], rule)
                    n = np.bincount(section + 1, minlength=len(starts) + 1)
                    crossing = np.bincount((section + 1)[over], minlength=len(starts) + 1)
                    keep = slice(0 if n[0] or not len(starts) else 1, None)
                    number = np.arange(-1, len(starts))[keep]
                    out["row"].append(np.full(len(number), row))
                    out["section"].append(number)
                    out["start"].append(np.concatenate([[-1], starts])[keep])
                    out["stop"].append(np.concatenate([[-1], stops])[keep])
                    out["n_tokens"].append(n[keep])
                    out["crossing"].append(crossing[keep])
                    out["doc_tokens"].append(np.full(len(number), len(mine)))
                done = {k: np.concatenate(v).astype(np.int64) for k, v in out.items()}
                outside = done["section"] == OUTSIDE
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").take(pa.array(done["row"])),
                        "section": done["section"].astype(np.int32),
                        "start": pa.array(done["start"], mask=outside),
                        "stop": pa.array(done["stop"], mask=outside),
                        **{k: done[k] for k in ("n_tokens", "crossing", "doc_tokens")},
                    }
                )

    return rows


def _some_texts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    at, texts, held = 0, [], 0
    for i, t in enumerate(column):
        text = t.as_py() or ""
        if texts and held + len(text) > TEXT_CHARS:
            yield at, texts
            at, texts, held = i, [], 0
        texts.append(text)
        held += len(text)
    if texts:
        yield at, texts


def _lines(text: str, null: bool) -> tuple[np.ndarray, np.ndarray]:
    if null:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lengths = np.array([len(line) for line in text.split("\n")], np.int64)
    stops = np.cumsum(lengths + 1) - 1
    return stops - lengths, stops


def _given(spans: pa.Scalar, size: int) -> tuple[np.ndarray, np.ndarray]:
    pairs = [(s["start"], s["stop"]) for s in spans.as_py() or [] if s is not None]
    both = np.clip(np.array(pairs, np.int64).reshape(-1, 2), 0, size)
    return both[:, 0], np.maximum(both[:, 0], both[:, 1])
