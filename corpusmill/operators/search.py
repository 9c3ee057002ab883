"""Batch similarity search: the top k chunks for every query, exact or through cells.

``method="cells"`` works for any number of queries: they are shuffled to the cells they need, and cells
that hold many vectors or many queries are cut into parts by hash, so no task gets a whole hot cell.
``method="broadcast"`` sends a small query batch to all tasks, leaves the vectors where they are, and
raises if the batch is over a checked byte budget. ``method="auto"`` measures the batch and broadcasts it
within the budget, else goes by cells. All give the same results.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from corpusmill.constants import ANN_RESULTS
from corpusmill.operators.index import VectorIndex, assign_cells, build_index, hash_pivots
from corpusmill.operators.topk import VECTOR_BLOCK, TopK, best_cells, ids_of, matrix, unit
from corpusmill.session import spill

MAX_BROADCAST_BYTES = 64 << 20
# Size of the query and vector matrices that meet in one task of a large search.
QUERY_PART_BYTES = 4 << 20
VECTOR_PART_BYTES = 32 << 20
VECTORS_PER_CELL = 10_000  # where the number of cells follows from the size of the table
# Rounded scores differ from true ones by half a unit of the last digit.
SLACK = 2e-6
MEETING = ["cell", "q_part", "v_part"]


@dataclass(frozen=True)
class ResultColumns:
    """Names of the search result: key, text, URI and any further chunk columns."""

    primary_key: str = "chunk_id"
    chunk_text: str = "content_chunked"
    document_uri: str = "doc_uri"
    additional: Sequence[str] = field(default_factory=tuple)

    @property
    def payload(self) -> list[str]:
        return [self.chunk_text, self.document_uri, *self.additional]


def exact_top_k(
    queries: DataFrame,
    vectors: DataFrame,
    k: int,
    query_id: str = "query_id",
    key: str = "vec_id",
    embedding: str = "embedding",
    skip_self: bool = False,
    method: str = "cells",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    n_cells: int | None = None,
    nprobe: int = 4,
) -> DataFrame:
    """(query_id, rank, key, score): the ``k`` vectors of highest cosine per query.

    Scores are rounded to six digits before ranking, ties go to the smaller key. By cells the
    search goes through an index of ``n_cells`` cells, exactly (see :func:`exact_by_cells`); some
    ten thousand vectors per cell are a good size, and with ``method="auto"`` the default.
    """
    if _checked(method) == "auto":
        small = _batch_bytes(queries, query_id, embedding) <= max_broadcast_bytes
        method = "broadcast" if small else "cells"
        if not small and n_cells is None:
            n_cells = -(-vectors.count() // VECTORS_PER_CELL)
    if method == "cells":
        if n_cells is None:
            raise ValueError("the search by cells needs n_cells")
        centroids = hash_pivots(vectors, n_cells, key, embedding)
        index = build_index(vectors, centroids, key, embedding)
        return exact_by_cells(queries, index, k, query_id, embedding, skip_self, nprobe)
    batch = _collect_queries(queries, query_id, embedding, max_broadcast_bytes)
    shared = vectors.sparkSession.sparkContext.broadcast(batch)
    source = vectors.filter(F.col(embedding).isNotNull()).select(key, embedding)
    schema = _hit_schema(queries.schema[query_id].dataType, source.schema[key].dataType, query_id, key)

    def scan(batches):
        top = TopK(*shared.value, k, skip_self)
        for b in batches:
            top.add(ids_of(b[key]), matrix(b[embedding]))
        yield _hits(top, schema)

    return rank_top_k(source.mapInArrow(scan, schema), k, query_id, key)


def ivf_top_k(
    queries: DataFrame,
    index: VectorIndex,
    k: int = ANN_RESULTS,
    nprobe: int = 4,
    query_id: str = "query_id",
    embedding: str = "embedding",
    skip_self: bool = False,
    method: str = "cells",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Approximate top ``k``: each query looks into its ``nprobe`` nearest cells only.

    Where those cells hold fewer than ``k`` vectors, a query gets fewer hits.
    """
    if _checked(method) == "auto":
        method = "broadcast" if _batch_bytes(queries, query_id, embedding) <= max_broadcast_bytes else "cells"
    if method == "cells":
        probes = assign_cells(queries, index.centroids, query_id, embedding, nprobe)
        probes = probes.select(query_id, F.col(embedding).alias("embedding"), "cell")
        return rank_top_k(_score_cells(probes, index, k, query_id, skip_self), k, query_id, index.key)
    batch = _collect_queries(queries, query_id, embedding, max_broadcast_bytes)
    wanted: dict[int, np.ndarray] = {}
    if len(batch[0]):
        cells, _ = best_cells(batch[1], index.centroids, min(nprobe, len(index.centroids)))
        wanted = {int(c): np.nonzero((cells == c).any(axis=1))[0] for c in np.unique(cells)}
    key = index.key
    shared = queries.sparkSession.sparkContext.broadcast((batch, wanted))
    source = index.vectors.filter(F.col("cell").isin(list(wanted))).select(key, "embedding", "cell")
    schema = _hit_schema(queries.schema[query_id].dataType, source.schema[key].dataType, query_id, key)

    def scan(batches):
        (query_ids, query_vectors), rows_of = shared.value
        top = TopK(query_ids, query_vectors, k, skip_self)
        for b in batches:
            ids, vectors, cell = ids_of(b[key]), matrix(b["embedding"]), ids_of(b["cell"])
            for c in np.unique(cell):
                here = cell == c
                top.add(ids[here], vectors[here], rows_of[int(c)])
        yield _hits(top, schema)

    return rank_top_k(source.mapInArrow(scan, schema), k, query_id, key)


def exact_by_cells(
    queries: DataFrame,
    index: VectorIndex,
    k: int,
    query_id: str = "query_id",
    embedding: str = "embedding",
    skip_self: bool = False,
    nprobe: int = 4,
) -> DataFrame:
    """Exact top ``k`` for a query set of any size, skipping cells that cannot matter.

    First each query searches its ``nprobe`` nearest cells; its k-th score there is a
    floor. A cell of angular radius r around its centroid holds nothing closer to the
    query than angle(query, centroid) - r, so only cells whose bound reaches the floor
    are searched in the second pass. Queries bring their floor there, so a cell gives out
    only hits that reach it. Vectors and queries meet by an equi-join on cells.
    """
    key = index.key
    named = queries.select(query_id, F.col(embedding).alias("embedding"))
    probes = assign_cells(named, index.centroids, query_id, "embedding", nprobe)
    first = spill(
        rank_top_k(_score_cells(probes.select(query_id, "embedding", "cell"), index, k, query_id, skip_self),
                   k, query_id, key)
    )
    floors = first.filter(F.col("rank") == k).select(query_id, F.col("score").alias("floor"))
    bounded = named.join(floors, query_id, "left")
    rest = _cells_within_reach(bounded, index, query_id, nprobe)
    rest = rest.withColumnRenamed("floor", "score")  # stored under the name of a column that the search reads anyway
    second = _score_cells(rest, index, k, query_id, skip_self, floor="score")
    return rank_top_k(first.drop("rank").unionByName(second), k, query_id, key)


def rank_top_k(hits: DataFrame, k: int, query_id: str, key: str) -> DataFrame:
    """Best ``k`` hits per query. Planned as a limit per group before and after the shuffle."""
    order = Window.partitionBy(query_id).orderBy(F.col("score").desc(), F.col(key).asc())
    ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(query_id, F.col("rank").cast("long").alias("rank"), key, "score")


def above(hits: DataFrame, threshold: float) -> DataFrame:
    """Hits that score at least ``threshold``; ranks stay as they were."""
    return hits.filter(F.col("score") >= threshold)


def fetch_passages(
    hits: DataFrame,
    chunks: DataFrame,
    columns: ResultColumns,
    hit_key: str | None = None,
) -> DataFrame:
    """Chunk text, URI and further columns for hits that were ranked without them.

    Only the wanted chunk columns are read. The hits are stored first, so the planner knows their
    size and chooses how to join.
    """
    hit_key = hit_key or columns.primary_key
    stored = spill(hits.withColumnRenamed(hit_key, columns.primary_key))
    joined = chunks.select(columns.primary_key, *columns.payload).join(stored, columns.primary_key)
    return joined.select(*stored.columns, *columns.payload)


def recall_at_k(found: DataFrame, truth: DataFrame, query_id: str, key: str) -> DataFrame:
    """Share of the true neighbours that were found, over all queries (one row)."""
    pairs = truth.select(query_id, key).join(
        found.select(query_id, key, F.lit(1).alias("_found")), [query_id, key], "left"
    )
    return pairs.agg(
        F.count(F.lit(1)).alias("n_true"),
        F.count("_found").alias("n_found"),
        F.round(F.count("_found") / F.count(F.lit(1)), 6).alias("recall"),
    )


def rename_result(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Select and rename result columns in the given order."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def _checked(method: str) -> str:
    if method not in ("cells", "broadcast", "auto"):
        raise ValueError(f"method is 'cells', 'broadcast' or 'auto', not {method!r}")
    return method


def _batch_bytes(queries: DataFrame, query_id: str, embedding: str) -> int:
    present = queries.filter(F.col(embedding).isNotNull()).select(query_id, embedding)
    row = F.size(embedding).cast("long") * 8 + F.coalesce(F.octet_length(F.col(query_id).cast("string")), F.lit(0)) + 16
    return present.agg(F.sum(row)).first()[0] or 0


def _collect_queries(queries: DataFrame, query_id: str, embedding: str, max_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and matrix of a query batch; its size, ids included, is measured before anything is collected."""
    size = _batch_bytes(queries, query_id, embedding)
    if size > max_bytes:
        raise ValueError(f"the query batch takes {size} bytes, over {max_bytes}; use method='cells'")
    present = queries.filter(F.col(embedding).isNotNull()).select(query_id, embedding)
    table = present.toArrow()
    return ids_of(table[query_id]), matrix(table[embedding])


def _hit_schema(query_type: T.DataType, key_type: T.DataType, query_id: str, key: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField(query_id, query_type),
            T.StructField(key, key_type),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _hits(top: TopK, schema: T.StructType) -> pa.RecordBatch:
    types = [f.type for f in to_arrow_schema(schema)]
    found = top.result()
    empty = len(found[0]) == 0  # ids of a task without vectors have no type of their own
    columns = [pa.array([] if empty else c, type=t) for c, t in zip(found, types, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=schema.names)


def _score_cells(
    query_cells: DataFrame, index: VectorIndex, k: int, query_id: str, skip_self: bool,
    query_part: int | None = None, vector_part: int | None = None, floor: str | None = None,
) -> DataFrame:
    """Local top ``k`` of every (query, cell) row given, through an equi-join on cells.

    ``floor`` names a column of scores that hits must reach to matter; null lets all through.
    """
    key = index.key
    query_part = query_part or max(1, QUERY_PART_BYTES // (index.dim * 8))
    vector_part = vector_part or max(1, VECTOR_PART_BYTES // (index.dim * 8))
    brought = [] if floor is None else [floor]
    left, right = meet_in_cells(query_cells, index, index.vectors, "embedding", query_id, query_part, vector_part, brought)
    schema = _hit_schema(left.schema[query_id].dataType, right.schema[key].dataType, query_id, key)
    arrow_schema = to_arrow_schema(schema)

    def score(q: pa.Table, v: pa.Table) -> pa.Table:
        if q.num_rows == 0 or v.num_rows == 0:
            return arrow_schema.empty_table()
        floors = None if floor is None else ids_of(q[floor].fill_null(-np.inf))
        top = TopK(ids_of(q[query_id]), matrix(q["q_embedding"]), k, skip_self, floors)
        for start in range(0, v.num_rows, VECTOR_BLOCK):  # doubles of one block at a time
            block = v.slice(start, VECTOR_BLOCK)
            top.add(ids_of(block[key]), matrix(block["embedding"]))
        return pa.Table.from_batches([_hits(top, schema)])

    return left.groupBy(*MEETING).cogroup(right.groupBy(*MEETING)).applyInArrow(score, schema)


def meet_in_cells(
    query_cells: DataFrame, index: VectorIndex, stored_vectors: DataFrame, column: str, query_id: str,
    query_part: int, vector_part: int, brought: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Both sides of the (query, cell) rows given, to be cogrouped by ``MEETING``.

    ``column`` of ``stored_vectors`` is what a vector brings, ``brought`` names what a query brings beside its vector. A cell with more than ``vector_part`` vectors or
    ``query_part`` queries is cut into parts by hash of the ids; every query part meets every vector part once.
    The table of parts has one row per cell.
    """
    spark, key = query_cells.sparkSession, index.key
    stored = spill(query_cells)
    asked = {r["cell"]: r["n"] for r in stored.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = spark.createDataFrame(
        [
            (c, -(-index.cells[c][0] // vector_part), -(-n // query_part))
            for c, n in asked.items()
            if c in index.cells
        ],
        "cell int, v_parts int, q_parts int",
    )
    bounded = F.broadcast(parts)

    def part_of(id_column: str, n: str):
        return F.pmod(F.xxhash64(id_column), F.col(n)).cast("int")

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = stored.join(bounded, "cell").select(
        query_id, F.col("embedding").alias("q_embedding"), "cell", *brought,
        part_of(query_id, "q_parts").alias("q_part"), every("v_parts").alias("v_part"),
    )
    near = stored_vectors.filter(F.col("cell").isin(list(asked)))  # prunes the partitions that are read
    right = near.join(bounded, "cell").select(
        key, column, "cell", part_of(key, "v_parts").alias("v_part"), every("q_parts").alias("q_part")
    )
    return left, right


def _cells_within_reach(bounded: DataFrame, index: VectorIndex, query_id: str, nprobe: int) -> DataFrame:
    """(query, cell, floor) for the cells not probed yet whose bound reaches the query's floor."""
    centroids, cells = index.centroids, index.cells
    low = np.array([cells.get(c, (0, 2.0))[1] for c in range(len(centroids))])
    radius = np.where(low > 1.5, -1.0, np.arccos(np.clip(low - SLACK, -1, 1)))  # -1: empty cell
    shared = bounded.sparkSession.sparkContext.broadcast((centroids, radius))
    schema = T.StructType(
        [
            bounded.schema[query_id], bounded.schema["embedding"], bounded.schema["floor"],
            T.StructField("cell", T.IntegerType()),
        ]
    )

    def reach(batches):
        centres, radii = shared.value
        for b in batches:
            if b.num_rows == 0:
                continue
            queries = matrix(b["embedding"])
            floor = b["floor"].fill_null(-2.0).to_numpy(zero_copy_only=False)
            angle = np.arccos(np.clip(unit(queries) @ centres.T, -1, 1))
            bound = np.cos(np.maximum(0.0, angle - radii)) + SLACK
            open_cells = (bound >= floor[:, None]) & (radii >= 0)
            probed, _ = best_cells(queries, centres, min(nprobe, len(centres)))
            np.put_along_axis(open_cells, probed, False, axis=1)
            q, c = np.nonzero(open_cells)
            rows = b.select([query_id, "embedding", "floor"]).take(pa.array(q))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(c.astype(np.int32))], names=schema.names)

    return bounded.filter(F.col("embedding").isNotNull()).select(query_id, "embedding", "floor").mapInArrow(
        reach, schema
    )
