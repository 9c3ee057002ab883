"""Text columns to vectors: a hook for any embedder and a built-in hashing baseline."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Embedder:
    """A named embedding. Index and queries must use one of the same name and size."""

    name: str
    dim: int
    apply: Callable[[DataFrame, str, str], DataFrame]
    save: Callable[[str], None] | None = None

    def embed(self, df: DataFrame, text_column: str, out: str = "embedding") -> DataFrame:
        """``df`` plus the array column ``out``."""
        return self.apply(df, text_column, out)


def function_embedder(name: str, dim: int, fn: Callable[[list[str]], list[list[float]]]) -> Embedder:
    """Wrap a Python embedder; it gets the texts of one Arrow batch at a time."""

    def run(texts: pa.Array) -> pa.Array:
        given = ["" if t is None else t for t in texts.to_pylist()]
        vectors = fn(given)
        if len(vectors) != len(given) or any(len(v) != dim for v in vectors):
            raise ValueError(f"embedder {name} must return {dim} numbers per text")
        return pa.array(vectors, type=pa.list_(pa.float32()))

    def column(text: Column) -> Column:
        return F.arrow_udf(run, "array<float>")(text)

    return Embedder(name, dim, lambda df, text, out: df.withColumn(out, column(F.col(text))))


def fit_hash_embedder(corpus: DataFrame, text_column: str, dim: int = 256) -> Embedder:
    """Hashed term frequencies, weighted by rarity in ``corpus``, scaled to unit length.

    Fitting is one pass that keeps ``dim`` counters per task.
    """
    stages = [
        RegexTokenizer(inputCol="_text", outputCol="_words", pattern=r"(?U)\W+"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=dim),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        Normalizer(inputCol="_tfidf", outputCol="_unit"),
    ]
    text = F.coalesce(F.col(text_column), F.lit("")).alias("_text")
    return _hash_embedder(Pipeline(stages=stages).fit(corpus.select(text)))


def load_hash_embedder(spark: SparkSession, path: str) -> Embedder:
    """The embedder that ``save`` stored under ``path``."""
    return _hash_embedder(PipelineModel.load(path))


def _hash_embedder(model: PipelineModel) -> Embedder:
    weights = model.stages[2].idf.toArray()
    digest = hashlib.sha256(weights.tobytes()).hexdigest()[:16]  # two fits differ by name if they differ at all

    def apply(df: DataFrame, column: str, out: str) -> DataFrame:
        named = df.withColumn("_text", F.coalesce(F.col(column), F.lit("")))
        return model.transform(named).select(*df.columns, vector_to_array("_unit", "float32").alias(out))

    def save(path: str) -> None:
        model.write().overwrite().save(path)

    return Embedder(f"hash-idf-{len(weights)}-{digest}", len(weights), apply, save)
