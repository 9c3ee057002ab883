"""Upkeep of a stored vector index: insert, change and delete without building it anew.

An index keeps its base as built. Every step adds, partitioned by cell, the vectors that are new (``delta``)
and the keys that no longer hold in a cell (``gone``), and last one small table of all cells, which makes the
step count. A search reads base and deltas of the cells it asks for, less the keys gone from those cells since.
A cell that outgrows a size is split: its vectors, and no others, are written once more under new cells.
Cells without a change are never read for writing nor written.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.index import VectorIndex, assign_cells, build_index, checked_centroids, hash_pivots
from corpusmill.operators.topk import matrix
from corpusmill.session import exists, spill

MAX_CELL = 40_000  # vectors of a cell before it is split


def open_index(spark: SparkSession, path: str) -> VectorIndex:
    """The index under ``path`` as its last complete step left it."""
    return _opened(spark, path)[0]


def apply_changes(
    spark: SparkSession,
    path: str,
    upserts: DataFrame | None = None,
    deletes: DataFrame | None = None,
    key: str = "vec_id",
    embedding: str = "embedding",
    max_cell: int = MAX_CELL,
) -> VectorIndex:
    """One step: vectors of ``upserts`` are added or replace those of their keys, keys of ``deletes`` go.

    The result searches like an index built anew from what is left. A key of both stays with its new vector;
    of rows that repeat a key in ``upserts``, one raises an error; null vectors remove their key; keys that
    the index does not hold are deleted without effect.
    """
    index, step = _opened(spark, path)
    step += 1
    new = removed = None
    if upserts is not None:
        repeated = upserts.groupBy(key).count().filter("count > 1")
        if not repeated.isEmpty():
            raise ValueError(f"{key} is not unique")
        new = spill(assign_cells(upserts, index.centroids, key, embedding).withColumnRenamed(embedding, "embedding"))
        removed = upserts.select(F.col(key).alias(index.key))
    if deletes is not None:
        named = deletes.select(F.col(key).alias(index.key))
        removed = named if removed is None else removed.union(named)
    if removed is not None:
        _remove(index, removed, path, step)
    if new is not None:
        _add(new.withColumnRenamed(key, index.key), path, step)
    _commit(spark, path, step, index.centroids, index.key, index.embed_name, _closed(spark, path, step - 1))
    index = open_index(spark, path)
    large = [c for c, (n, _) in index.cells.items() if n > max_cell]
    return _split(spark, index, path, step + 1, large, max_cell) if large else index


def rebuilt(index: VectorIndex, path: str) -> VectorIndex:
    """The same vectors and cells as one base under another path, for when many steps have gathered."""
    rows = index.vectors.select(index.key, "embedding")
    return build_index(rows, index.centroids, index.key, embed_name=index.embed_name, path=path)


def _opened(spark: SparkSession, path: str) -> tuple[VectorIndex, int]:
    steps = spark.read.parquet(f"{path}/steps") if exists(spark, f"{path}/steps") else None
    step = steps.agg(F.max("step")).first()[0] if steps is not None else 0
    table = steps.filter(F.col("step") == step) if step else spark.read.parquet(f"{path}/centroids")
    meta = table.toArrow().sort_by("cell")  # one row per cell
    centroids = checked_centroids(matrix(meta["centroid"]))
    named = zip(*(meta[c].to_pylist() for c in ("cell", "n", "low")), strict=True)
    cells = {c: (n, low) for c, n, low in named if n}
    key, embed_name = meta["key"][0].as_py(), meta["embed_name"][0].as_py()
    vectors = _vectors(spark, path, step, key, _closed(spark, path, step))
    return VectorIndex(path, vectors, centroids, cells, key, centroids.shape[1], embed_name), step


def _closed(spark: SparkSession, path: str, step: int) -> dict[int, int]:
    """For cells that were split: the first step whose rows still count. One entry per split cell."""
    if not step:
        return {}
    rows = spark.read.parquet(f"{path}/steps").filter((F.col("step") == step) & (F.col("since") > 0))
    return {r.cell: r.since for r in rows.select("cell", "since").collect()}


def _vectors(spark: SparkSession, path: str, step: int, key: str, closed: dict[int, int]) -> DataFrame:
    base = spark.read.parquet(f"{path}/vectors")
    columns = [key, "embedding", "cell_score", "cell"]
    rows = base.select(*columns, F.lit(0).alias("step"))
    if exists(spark, f"{path}/delta"):
        delta = spark.read.parquet(f"{path}/delta").filter(F.col("step") <= step)
        rows = rows.unionByName(delta.select(*columns, "step"))
    if closed:
        since = F.broadcast(spark.createDataFrame(list(closed.items()), "cell int, since int"))  # a row per split cell
        rows = rows.join(since, "cell", "left").filter("since is null or step >= since").drop("since")
    if exists(spark, f"{path}/gone"):
        gone = spark.read.parquet(f"{path}/gone").filter(F.col("step") <= step).alias("g")
        rows = rows.alias("v")
        same = (F.col(f"v.{key}") == F.col(f"g.{key}")) & (F.col("v.cell") == F.col("g.cell"))
        rows = rows.join(gone, same & (F.col("v.step") < F.col("g.step")), "left_anti")
    return rows.select(*columns)


def _remove(index: VectorIndex, keys: DataFrame, path: str, step: int) -> None:
    held = index.vectors.select(index.key, "cell").join(keys.distinct(), index.key, "left_semi")
    held.hint("rebalance", F.col("cell")).write.mode("overwrite").partitionBy("cell").parquet(f"{path}/gone/step={step}")


def _add(rows: DataFrame, path: str, step: int) -> None:
    rows.hint("rebalance", F.col("cell")).write.mode("overwrite").partitionBy("cell").parquet(f"{path}/delta/step={step}")


def _commit(
    spark: SparkSession, path: str, step: int, centroids: np.ndarray, key: str, embed_name: str, closed: dict[int, int]
) -> None:
    """Write the table of cells, by which the step counts from here on."""
    stats = _vectors(spark, path, step, key, closed).groupBy("cell").agg(F.count("*").alias("n"), F.min("cell_score").alias("low"))
    meta = pa.table(
        {
            "cell": pa.array(range(len(centroids)), pa.int32()),
            "centroid": pa.array(centroids.tolist(), pa.list_(pa.float64())),
            "key": [key] * len(centroids),
            "embed_name": [embed_name] * len(centroids),
            "since": pa.array([closed.get(c, 0) for c in range(len(centroids))], pa.int32()),
        }
    )
    known = spark.createDataFrame(meta).join(stats, "cell", "left")
    known.coalesce(1).write.mode("overwrite").parquet(f"{path}/steps/step={step}")


def _split(spark: SparkSession, index: VectorIndex, path: str, step: int, cells: list[int], max_cell: int) -> VectorIndex:
    """Each of the cells becomes itself and new ones; centroids are vectors of its own."""
    centroids, closed, moved = [*index.centroids], _closed(spark, path, step - 1), None
    for cell in cells:
        mine = index.vectors.filter(F.col("cell") == cell).select(index.key, "embedding")
        pivots = hash_pivots(mine, -(-2 * index.cells[cell][0] // max_cell), index.key)
        numbers = [cell, *range(len(centroids), len(centroids) + len(pivots) - 1)]
        centroids[cell] = pivots[0]
        centroids += [*pivots[1:]]
        closed[cell] = step
        placed = assign_cells(mine, pivots, index.key)
        names = F.array(*[F.lit(n) for n in numbers])
        placed = placed.withColumn("cell", F.get(names, F.col("cell")).cast("int"))
        moved = placed if moved is None else moved.union(placed)
    _add(moved, path, step)
    _commit(spark, path, step, checked_centroids(np.array(centroids)), index.key, index.embed_name, closed)
    return open_index(spark, path)
