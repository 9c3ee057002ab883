"""Retrieved passages and messages to prompts, one row per request."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.constants import CHUNK_TEMPLATE, PROMPT_TEMPLATE, SYSTEM_PROMPT
from corpusmill.functions.templates import template_column
from corpusmill.functions.text import tokens
from corpusmill.operators.topk import matrix, unit
from corpusmill.schemas import MESSAGES

VECTORS_AT_ONCE = 4096
UNIT = 1e6  # worth and likeness are whole millionths, so ties are exact


def passage(
    chunk_text: Column | str, metadata: Column | str, template: str = CHUNK_TEMPLATE
) -> Column:
    """One passage as prompt text."""
    return template_column(template, chunk_text=chunk_text, metadata=metadata)


def prompts(
    passages: DataFrame,
    request_id: str = "request_id",
    rank: str = "rank",
    chunk_text: str = "content_chunked",
    metadata: str = "doc_uri",
    prompt_template: str = PROMPT_TEMPLATE,
    chunk_template: str = CHUNK_TEMPLATE,
) -> DataFrame:
    """One prompt per request, its passages in order of rank.

    A group holds the passages of one request, at most the k that was searched for.
    """
    text = passage(chunk_text, metadata, chunk_template)
    ordered = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), text.alias("t"))))
    grouped = passages.groupBy(request_id).agg(ordered.alias("_passages"))
    context = F.array_join(F.transform("_passages", lambda p: p["t"]), "")
    return grouped.select(
        request_id,
        F.size("_passages").cast("long").alias("n_passages"),
        template_column(prompt_template, context=context).alias("prompt"),
    )


def within_budget(
    passages: DataFrame,
    budget: int,
    request_id: str = "request_id",
    rank: str = "rank",
    chunk_text: str = "content_chunked",
    metadata: str = "doc_uri",
    score: str | None = None,
    embedding: str | None = None,
    variety: int = 0,
    chunk_template: str = CHUNK_TEMPLATE,
    length: Callable[[Column], Column] | None = None,
    n_tokens: str | None = None,
) -> DataFrame:
    """Passages of each request that together take at most ``budget`` tokens as prompt text; adds ``n_tokens``.

    One after the other, of the passages that still fit, the one of highest worth is taken, ties to the lower rank.
    Worth is the rank alone, or with ``variety`` (percent) the score less likeness to what was taken: ``(100 - variety)
    * score - variety * highest cosine``, in millionths. A NULL score is 0, a NULL vector is like nothing. ``length``
    counts the tokens of a passage (default: white-space tokens). Ranks must be unique per request. Vectors are left
    out of the result.

    Where ``n_tokens`` names a column of lengths (see :func:`passage_tokens`), no text is needed: choose first, then
    fetch the texts of what was chosen, so that no other text is shuffled.

    A group holds the passages of one request, at most the k that was searched for. Only numbers and vectors reach Python.
    """
    if not 0 <= variety <= 100 or (variety and not (score and embedding)):
        raise ValueError("variety is 0 to 100 and needs score and embedding")
    worth = F.round(F.col(score) * UNIT).cast("long") if variety else -F.col(rank).cast("long")
    vector = F.col(embedding) if variety else F.lit(None).cast("array<double>")
    names = [c for c in passages.columns if c not in (embedding, "n_tokens")]
    counted = F.col(n_tokens) if n_tokens else passage_tokens(chunk_text, metadata, chunk_template, length)
    sized = passages.withColumn("n_tokens", counted.cast("long"))
    numbers = F.struct(F.col(rank).alias("r"), F.col("n_tokens").alias("n"), F.coalesce(worth, F.lit(0)).alias("w"), vector.alias("e"))
    row = F.struct(F.col(rank).alias("r"), *[F.struct(*names, "n_tokens").alias("row")])
    grouped = sized.groupBy(request_id).agg(F.array_sort(F.collect_list(numbers), _by_rank).alias("_numbers"),
                                            F.collect_list(row).alias("_rows"))

    def choose(groups: pa.Array) -> pa.Array:
        flat, ends = groups.flatten(), np.cumsum(np.r_[0, groups.value_lengths().to_numpy()])
        ranks, n, w = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2))
        found, units, upto = [], None, 0
        for start, end in zip(ends[:-1], ends[1:], strict=True):
            here = slice(start, end)
            if variety and end > upto:  # unit vectors of some groups at a time
                base, upto = start, max(end, ends[np.searchsorted(ends, start + VECTORS_AT_ONCE, "right") - 1])
                units = _units(flat.field(3).slice(base, upto - base))
            mine = units[start - base : end - base] if variety else None
            alike = None if mine is None else np.rint(mine @ mine.T * UNIT).astype(np.int64)
            found.append(ranks[here][_chosen(n[here], w[here], alike, budget, variety)])
        return pa.array(found, pa.list_(pa.int64()))

    chosen = grouped.select("_rows", F.arrow_udf(choose, "array<long>")("_numbers").alias("_ranks"))
    kept = F.filter("_rows", lambda x: F.array_contains("_ranks", x["r"].cast("long")))
    return chosen.select(F.explode(F.transform(kept, lambda x: x["row"])).alias("_row")).select("_row.*")


def passage_tokens(
    chunk_text: Column | str, metadata: Column | str, template: str = CHUNK_TEMPLATE,
    length: Callable[[Column], Column] | None = None,
) -> Column:
    """Tokens of a passage as prompt text (default: white-space tokens)."""
    count = length or (lambda text: F.size(tokens(text)))
    return count(passage(chunk_text, metadata, template)).cast("long")


def _by_rank(a: Column, b: Column) -> Column:
    return F.when(a["r"] < b["r"], -1).when(a["r"] > b["r"], 1).otherwise(0)


def _units(vectors: pa.Array) -> np.ndarray:
    """Unit vectors as rows, zeros for NULL."""
    present = vectors.is_valid().to_numpy(zero_copy_only=False)
    known = unit(matrix(vectors.drop_null()))
    rows = np.zeros((len(vectors), known.shape[1]))
    rows[present] = known
    return rows


def _chosen(n: np.ndarray, worth: np.ndarray, alike: np.ndarray | None, budget: int, variety: int) -> list[int]:
    taken: list[int] = []
    near, free = np.zeros(len(n), np.int64), np.ones(len(n), bool)
    while True:
        fits = np.flatnonzero(free & (n <= budget))
        if not len(fits):
            return taken
        best = fits[np.argmax((100 - variety) * worth[fits] - variety * near[fits])]
        if alike is not None:
            near = np.maximum(near, alike[best]) if taken else alike[best]
        taken.append(int(best))
        free[best] = False
        budget -= n[best]


def message(role: str, content: Column | str) -> Column:
    content = F.col(content) if isinstance(content, str) else content
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def messages(user: Column | str, history: Column | str | None = None, system: str = SYSTEM_PROMPT) -> Column:
    """``[system, …history, user]`` as an array of role and content."""
    head, tail = F.array(message("system", F.lit(system))), F.array(message("user", user))
    if history is None:
        return F.concat(head, tail).cast(MESSAGES)
    history = F.col(history) if isinstance(history, str) else history
    return F.concat(head, F.coalesce(history.cast(MESSAGES), F.array().cast(MESSAGES)), tail).cast(MESSAGES)
