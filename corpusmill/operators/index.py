"""Vector index: vectors stored by the cell of their nearest centroid."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.operators.embed import Embedder
from corpusmill.operators.topk import best_cells, matrix, unit
from corpusmill.session import scratch_dir

# Centroids travel to every task, so their size is checked, not assumed.
MAX_CENTROID_BYTES = 256 << 20


@dataclass(frozen=True)
class VectorIndex:
    """Stored index. ``cells`` holds one row per cell, so it is bounded by ``n_cells``."""

    path: str
    vectors: DataFrame
    centroids: np.ndarray
    cells: dict[int, tuple[int, float]]
    key: str
    dim: int
    embed_name: str

    def check_embedder(self, embedder: Embedder) -> None:
        """Queries must come from the embedding the index was built with."""
        if (embedder.name, embedder.dim) != (self.embed_name, self.dim):
            raise ValueError(
                f"index holds {self.embed_name} ({self.dim}), queries are {embedder.name} ({embedder.dim})"
            )


def hash_pivots(vectors: DataFrame, n_cells: int, key: str = "vec_id", embedding: str = "embedding") -> np.ndarray:
    """``n_cells`` of the vectors themselves as centroids: those with the smallest id digest.

    The digest spreads the choice over the data and gives the same choice on every
    run. Only ``n_cells`` rows reach the driver.
    """
    digest = F.md5(F.col(key).cast("string"))
    picked = (
        vectors.filter(F.col(embedding).isNotNull())
        .select(digest.alias("_digest"), F.col(key).alias("_key"), embedding)
        .orderBy("_digest", "_key")
        .limit(n_cells)
    )
    return checked_centroids(unit(matrix(picked.toArrow()[embedding])))


def kmeans_centroids(
    vectors: DataFrame, n_cells: int, per_cell: int | None = None, seed: int = 1, embedding: str = "embedding"
) -> np.ndarray:
    """Centroids trained by k-means on all vectors, or on a sample of about ``per_cell`` vectors per cell.

    Training data shapes the cells only; every vector is indexed.
    """
    # A zero vector has no direction; cosine k-means does not take it (and NULL is no vector).
    train = vectors.filter(F.exists(embedding, lambda x: x != 0)).select(embedding)
    if per_cell is not None:
        wanted, n = per_cell * n_cells, train.count()
        if n > wanted:
            train = train.sample(wanted / n, seed)
    features = train.select(array_to_vector(embedding).alias("features"))
    model = KMeans(k=n_cells, seed=seed, distanceMeasure="cosine").fit(features)
    return checked_centroids(unit(np.array(model.clusterCenters())))


def checked_centroids(centroids: np.ndarray) -> np.ndarray:
    if centroids.size == 0:
        raise ValueError("no vectors to take centroids from")
    if centroids.nbytes > MAX_CENTROID_BYTES:
        raise ValueError(f"centroids take {centroids.nbytes} bytes, limit is {MAX_CENTROID_BYTES}")
    return centroids


def assign_cells(
    vectors: DataFrame, centroids: np.ndarray, key: str = "vec_id", embedding: str = "embedding", n: int = 1
) -> DataFrame:
    """Key, vector, and its ``n`` nearest cells (one row each) with their scores. No shuffle."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)
    n = min(n, len(centroids))
    source = vectors.filter(F.col(embedding).isNotNull()).select(key, embedding)
    schema = T.StructType(
        [*source.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("cell_score", T.DoubleType())]
    )

    def assign(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            cells, scores = best_cells(matrix(batch[embedding]), shared.value, n)
            rows = batch if n == 1 else batch.take(pa.array(np.repeat(np.arange(batch.num_rows), n)))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(cells.ravel().astype(np.int32)), pa.array(scores.ravel())],
                names=schema.names,
            )

    return source.mapInArrow(assign, schema)


def build_index(
    vectors: DataFrame,
    centroids: np.ndarray,
    key: str = "vec_id",
    embedding: str = "embedding",
    embed_name: str = "given",
    path: str | None = None,
    unique_key: bool = False,
) -> VectorIndex:
    """Assign every vector to a cell and write them partitioned by cell.

    The rebalance hint gives each cell few, evenly sized files and splits a cell that
    holds a large share of the vectors over several tasks. ``unique_key`` first checks
    that no key occurs twice (a shuffle of the keys alone).
    """
    spark = vectors.sparkSession
    if unique_key:
        repeated = vectors.groupBy(key).count().filter("count > 1")
        if not repeated.isEmpty():
            raise ValueError(f"{key} is not unique")
    path = path or scratch_dir(spark)
    assigned = assign_cells(vectors, centroids, key, embedding).withColumnRenamed(embedding, "embedding")
    placed = assigned.hint("rebalance", F.col("cell"))
    placed.write.mode("overwrite").partitionBy("cell").parquet(f"{path}/vectors")
    meta = pa.table(
        {
            "cell": pa.array(range(len(centroids)), pa.int32()),
            "centroid": pa.array(centroids.tolist(), pa.list_(pa.float64())),
            "key": [key] * len(centroids),
            "embed_name": [embed_name] * len(centroids),
        }
    )
    stored = spark.read.schema(_stored_schema(assigned)).parquet(f"{path}/vectors")
    stats = stored.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("cell_score").alias("low"))
    known = spark.createDataFrame(meta).join(stats, "cell", "left")
    known.coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")
    return load_index(spark, path)


def load_index(spark: SparkSession, path: str) -> VectorIndex:
    """Open a stored index; reads one row per cell, with its count and lowest score, to the driver."""
    meta = spark.read.parquet(f"{path}/centroids").toArrow().sort_by("cell")
    centroids = checked_centroids(matrix(meta["centroid"]))
    filled = ((c, n, low) for c, n, low in zip(*(meta[k].to_pylist() for k in ("cell", "n", "low")), strict=True) if n)
    cells = {c: (n, low) for c, n, low in filled}
    key, embed_name = meta["key"][0].as_py(), meta["embed_name"][0].as_py()
    vectors = spark.read.parquet(f"{path}/vectors")
    return VectorIndex(path, vectors, centroids, cells, key, centroids.shape[1], embed_name)


def _stored_schema(assigned: DataFrame) -> T.StructType:
    """Partition columns come last in what is read back."""
    return T.StructType([*[f for f in assigned.schema.fields if f.name != "cell"], assigned.schema["cell"]])
