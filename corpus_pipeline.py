"""The cleaning pipeline over ``documents``: stages in order, each written as Parquet and read again.

Documents that the quality classifier rejects go; lines that repeat an earlier one, up to a word
or a tenth of their words, go; one document of each near-duplicate class stays; sources are mixed to their target weights; what is left is
packed into sequences. Every stage works on all rows its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.lines import line_dedup
from corpusmill.llm.mixing import mixture
from corpusmill.llm.ngram_join import without_near_copies
from corpusmill.llm.packing import pack
from corpusmill.llm.quality import good_documents
from corpusmill.session import spill


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of texts that a stage may have shortened."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.3)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(line_dedup(docs, min_words=5, words_per_edit=10))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_copies(docs, n=5, threshold=(80, 100))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(mixture(docs, weights=(1, 2, 3), max_epochs=3))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), length=2048, end_id=1, added_tokens=True)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", dedup_near),
    ("mixing sources", mix_sources),
    ("packing", pack_sequences),
]

# The classifier, the packing and its tokens have no SQL form; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the result is the packed pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = spill(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
