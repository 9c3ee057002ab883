"""Request and assessment logs to an evaluation set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.constants import INSPECT_COLUMNS, SAVED_COLUMNS

ASSESSOR = ("request_id", "source_user", "source_tag")
NEWEST = ("timestamp", "assessment_id")

def newest_per(df: DataFrame, keys: Sequence[str], order: Sequence[str] = NEWEST) -> DataFrame:
    """The newest row per key.

    ``row_number() <= 1`` is planned as a limit per group in each input task too, so a
    key that holds a large share of the log sends one row per task through the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= 1).drop("_n")


def dedup_assessments(log: DataFrame, keys: Sequence[str] = ASSESSOR) -> DataFrame:
    """Last word of each assessor on each request."""
    return newest_per(log, keys)


def liked_documents(assessments: DataFrame) -> DataFrame:
    """Per request, the URIs of all liked chunks, each once, sorted.

    Pairs are made distinct before they are grouped, so a group holds one entry per
    document and the first shuffle is on (request, document), not on the request.
    """
    liked = assessments.select("request_id", F.explode("liked_doc_uris").alias("doc_uri")).distinct()
    uris = F.array_sort(F.collect_list(F.struct("doc_uri")))
    return liked.groupBy("request_id").agg(uris.alias("expected_retrieved_context"))


def expected_response(
    rating: Column | str = "rating", edited: Column | str = "edited_response", response: Column | str = "response"
) -> Column:
    """Liked: the user's edit, else the answer. Disliked: the edit, else NULL. No rating: NULL."""
    rating, edited, response = (F.col(c) if isinstance(c, str) else c for c in (rating, edited, response))
    return F.when(rating == "yes", F.coalesce(edited, response)).when(rating == "no", edited)


def potential_evaluation_set(requests: DataFrame, assessments: DataFrame) -> DataFrame:
    """Every request with its newest assessment, if any, and the derived columns.

    Both sides of each join have one row per request, so the join neither multiplies
    rows nor meets a hot key. All columns of both logs stay for debugging; an assessment column
    that the request log has too gets the prefix ``assessment_``. Take :data:`SAVED_COLUMNS` for
    the evaluation set proper.
    """
    last_words = dedup_assessments(assessments)
    one = newest_per(last_words, ["request_id"])
    shared = [c for c in one.columns if c in requests.columns and c != "request_id"]
    one = one.withColumnsRenamed({c: f"assessment_{c}" for c in shared})
    liked = liked_documents(last_words)
    return (
        requests.join(one, "request_id", "left")
        .join(liked, "request_id", "left")
        .withColumn("expected_response", expected_response())
        .withColumn("is_correct", F.col("rating") == "yes")
    )
