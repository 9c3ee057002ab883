"""A table of questions to prompts: embed, search, filter, fetch, assemble."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.constants import ANN_RESULTS, PROMPT_TEMPLATE, SCORE_THRESHOLD
from corpusmill.operators.prompt import prompts
from corpusmill.operators.search import ResultColumns, above, fetch_passages, ivf_top_k
from corpusmill.operators.text_search import TextIndex, bm25_top_k, fuse_by_rank
from corpusmill.plans.ingest import Corpus
from corpusmill.session import spill


def retrieve(
    requests: DataFrame,
    corpus: Corpus,
    k: int = ANN_RESULTS,
    nprobe: int = 4,
    threshold: float = SCORE_THRESHOLD,
    columns: ResultColumns | None = None,
    query_type: str = "ann",
    words: TextIndex | None = None,
) -> DataFrame:
    """Passages for every request (``request_id``, ``request``), ranked, with text and URI.

    ``query_type`` is ``ann`` (by vectors), ``words`` (BM25 over the index ``words``), or ``hybrid``: both, made one
    by rank. The threshold is one of cosines and holds for hits by vectors only.
    """
    if query_type not in ("ann", "words", "hybrid"):
        raise ValueError(f"query_type is 'ann', 'words' or 'hybrid', not {query_type!r}")
    if query_type != "ann" and words is None:
        raise ValueError(f"query_type {query_type!r} needs an index of words")
    rankings = []
    if query_type != "words":
        corpus.index.check_embedder(corpus.embedder)
        embedded = spill(corpus.embedder.embed(requests.select("request_id", "request"), "request"))
        hits = ivf_top_k(embedded.select("request_id", "embedding"), corpus.index, k, nprobe, query_id="request_id")
        rankings.append(above(hits, threshold))
    if query_type != "ann":
        rankings.append(bm25_top_k(requests, words, k, "request_id", "request"))
    found = rankings[0] if len(rankings) == 1 else fuse_by_rank(rankings, k, "request_id", corpus.index.key)
    return fetch_passages(found, corpus.chunks, columns or ResultColumns())


def prompts_for(requests: DataFrame, passages: DataFrame, prompt_template: str = PROMPT_TEMPLATE) -> DataFrame:
    """One row per request with its prompt; a request without passages has an empty context."""
    filled = prompts(passages, "request_id", prompt_template=prompt_template)
    joined = requests.select("request_id", "request").join(filled, "request_id", "left")
    return joined.select(
        "request_id",
        "request",
        F.coalesce("n_passages", F.lit(0).cast("long")).alias("n_passages"),
        F.coalesce("prompt", F.lit(prompt_template.replace("{context}", ""))).alias("prompt"),
    )
