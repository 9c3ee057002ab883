"""Files to documents, chunks and a vector index; each stage is stored and read back."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from corpusmill.operators.chunk import Chunker, compute_chunks, recursive_splitter
from corpusmill.operators.embed import Embedder, fit_hash_embedder, load_hash_embedder
from corpusmill.operators.index import VectorIndex, build_index, hash_pivots, kmeans_centroids, load_index
from corpusmill.operators.parse import parse_files
from corpusmill.session import spill
from corpusmill.sources.tables import default_chunk_table, overwrite_table


@dataclass(frozen=True)
class Corpus:
    """What retrieval needs: the chunks, their index, and the embedding both share."""

    docs: DataFrame
    chunks: DataFrame
    index: VectorIndex
    embedder: Embedder


def ingest(
    raw_files: DataFrame,
    docs_table: str,
    n_cells: int,
    chunk_table: str | None = None,
    chunker: Chunker | None = None,
    embedder: Embedder | None = None,
    train_cells: bool = True,
    docs_path: str | None = None,
    chunk_path: str | None = None,
    index_path: str | None = None,
    **parse_options,
) -> Corpus:
    """Parse, chunk, embed and index a frame of raw files.

    Every stage starts from what the stage before it wrote, so files are parsed once and
    texts embedded once. ``n_cells`` shapes the index; some ten thousand chunks per cell are a good
    size. With ``index_path`` the index and the fitted embedder outlive the session: see
    :func:`open_corpus`. ``parse_options`` go to :func:`parse_files`.
    """
    docs = overwrite_table(parse_files(raw_files, **parse_options), docs_table, path=docs_path)
    chunks = overwrite_table(
        compute_chunks(docs, chunker or recursive_splitter()),
        default_chunk_table(docs_table, chunk_table),
        path=chunk_path,
    )
    return Corpus(docs, chunks, *index_chunks(chunks, n_cells, embedder, train_cells, index_path))


def index_chunks(
    chunks: DataFrame,
    n_cells: int,
    embedder: Embedder | None = None,
    train_cells: bool = True,
    index_path: str | None = None,
) -> tuple[VectorIndex, Embedder]:
    """Index over the chunk texts, keyed by ``chunk_id``."""
    embedder = embedder or fit_hash_embedder(chunks, "content_chunked")
    texts = chunks.select("chunk_id", "content_chunked")
    vectors = spill(embedder.embed(texts, "content_chunked").select("chunk_id", "embedding"))
    centroids = kmeans_centroids(vectors, n_cells) if train_cells else hash_pivots(vectors, n_cells, "chunk_id")
    index = build_index(vectors, centroids, "chunk_id", embed_name=embedder.name, path=index_path, unique_key=True)
    if embedder.save is not None:
        embedder.save(f"{index.path}/embedder")
    return index, embedder


def open_corpus(
    spark: SparkSession,
    docs_table: str,
    index_path: str,
    chunk_table: str | None = None,
    embedder: Embedder | None = None,
) -> Corpus:
    """A stored corpus, ready for questions. Pass ``embedder`` if it was not the built-in one."""
    index = load_index(spark, index_path)
    embedder = embedder or load_hash_embedder(spark, f"{index_path}/embedder")
    index.check_embedder(embedder)
    return Corpus(*reread(spark, docs_table, chunk_table), index, embedder)


def reread(spark: SparkSession, docs_table: str, chunk_table: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The stored documents and chunks of an earlier run."""
    return spark.table(docs_table), spark.table(default_chunk_table(docs_table, chunk_table))
