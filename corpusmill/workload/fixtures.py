"""Inputs of the registered queries, derived from the given tables.

Each derivation has a twin in :mod:`corpusmill.workload.sql`. None picks rows: every
row of the table it starts from takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.chat import requests_with_responses
from corpusmill.operators.parse import parse_files, plain_text_parser
from corpusmill.operators.quality import chunk_precision
from corpusmill.session import spread

BASE_SECONDS = 1704067200  # 2024-01-01 00:00:00 UTC
UNPARSED_SOURCE = "src7"  # where formats are mixed, this source delivers one without a parser
TEXT_PARSERS = {".txt": plain_text_parser}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_docs(spark: SparkSession, sf_dir: str, mixed: bool = False) -> DataFrame:
    """``documents`` as raw text files; ``mixed`` makes one source's files unreadable, to see them fail."""
    fails = F.lit(mixed) & (F.col("source") == UNPARSED_SOURCE)
    ext = F.when(fails, F.lit(".pdf")).otherwise(F.lit(".txt"))
    docs = spread(table(spark, sf_dir, "documents"))
    return docs.select(
        F.concat(F.lit("file:/corpus/"), "source", F.lit("/"), "doc_id", ext).alias("path"),
        F.timestamp_seconds(F.col("doc_id") + BASE_SECONDS).alias("modificationTime"),
        F.octet_length("text").cast("long").alias("length"),
        F.encode("text", "UTF-8").alias("content"),
    )


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` as raw files at their URLs; a URL that ends in ``/`` is its index page."""
    return _page_files(spark, sf_dir, F.regexp_replace("url", r"/\z", "/index.html"))


def saved_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` as raw files named by their id. Different URLs may share a path; these do not."""
    return _page_files(spark, sf_dir, F.concat(F.lit("file:/pages/"), "page_id", F.lit(".html")))


def _page_files(spark: SparkSession, sf_dir: str, path) -> DataFrame:
    return spread(table(spark, sf_dir, "pages")).select(
        path.alias("path"),
        F.timestamp_seconds(F.col("page_id") + BASE_SECONDS).alias("modificationTime"),
        F.octet_length("html").cast("long").alias("length"),
        F.encode("html", "UTF-8").alias("content"),
    )


def docs(spark: SparkSession, sf_dir: str, mixed: bool = False) -> DataFrame:
    return parse_files(raw_docs(spark, sf_dir, mixed), TEXT_PARSERS)


def passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload of the vectors: the document with the vector's id."""
    uri = F.concat(F.lit("corpus/"), "source", F.lit("/"), "doc_id", F.lit(".txt"))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("chunk_id"), F.col("text").alias("content_chunked"), uri.alias("doc_uri"), "lang"
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("chunk_id"), "embedding")


def query_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("query_id"), "embedding")


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = requests_with_responses(table(spark, sf_dir, "conversations"))
    return turns.select(
        "request_id",
        "request",
        "response",
        F.concat(F.lit("trace-"), "request_id").alias("trace"),
        F.timestamp_seconds(F.col("conv_id") * 60 + F.col("turn") + BASE_SECONDS).alias("timestamp"),
    )


def assessment_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one assessment of turn (event_id * 7) mod 8 of conversation user_id."""
    k = F.get_json_object("props", "$.k").cast("long")
    kind = F.col("event_type")
    uri = F.concat(F.lit("corpus/src"), k % 20, F.lit("/"), k, F.lit(".txt"))
    return table(spark, sf_dir, "events").select(
        F.concat_ws("-", F.col("user_id").cast("string"), ((F.col("event_id") * 7) % 8).cast("string")).alias(
            "request_id"
        ),
        F.concat(F.lit("u"), F.col("event_id") % 3).alias("source_user"),
        kind.alias("source_tag"),
        F.when(kind.isin("click", "purchase", "signup"), "yes").when(kind == "error", "no").alias("rating"),
        F.when((kind == "signup") | ((kind == "error") & (F.col("value") > 10)), F.col("props")).alias(
            "edited_response"
        ),
        F.when(kind == "click", F.array(uri)).otherwise(F.array().cast("array<string>")).alias("liked_doc_uris"),
        F.col("ts").alias("timestamp"),
        F.col("event_id").alias("assessment_id"),
    )


def _yes_no(condition):
    return F.when(condition, F.lit("yes")).otherwise(F.lit("no"))


def eval_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judged answers: one per label, rated from its document and its vector.

    The components of the vector stand for the ratings of the retrieved chunks; where a
    document has no vector there are no ratings.
    """
    labels = table(spark, sf_dir, "labels")
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    embeddings = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    joined = labels.join(documents, "doc_id").join(embeddings, "doc_id", "left")
    rated = joined.select(
        F.concat(F.lit("r"), "doc_id").alias("request_id"),
        F.transform("embedding", lambda x: _yes_no(x >= 0)).alias("ratings"),
        _yes_no(F.col("quality") == 1).alias("groundedness"),
        _yes_no((F.col("toxic") == 0) & (F.col("n_chars") >= 500)).alias("relevance"),
        _yes_no(F.col("n_chars") % 2 == 0).alias("correctness"),
        F.concat(F.lit("trace-"), "doc_id").alias("trace"),
        "lang",
        "source",
    )
    return rated.withColumn("precision", chunk_precision("ratings"))


def eval_results_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with NaN precision for one source and no groundedness for one language."""
    results = eval_results(spark, sf_dir)
    return results.withColumn(
        "precision", F.when(F.col("source") == "src3", F.lit(float("nan"))).otherwise(F.col("precision"))
    ).withColumn("groundedness", F.when(F.col("lang") != "de", F.col("groundedness")))
