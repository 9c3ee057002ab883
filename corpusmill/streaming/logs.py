"""Logs that grow: the evaluation set kept up to date from keyed state instead of a second reading of all rows.

A log is followed as a stream. The newest row per key is state in RocksDB, without expiry, so a row that comes
late, by (timestamp, id), changes nothing if a newer one of its key is known, whenever it comes. Each run
takes in what is new since the one before and writes the keys it changed, in buckets by request; what holds
now is the newest row per key of all that was written. The evaluation set is made anew only for requests
that a run touched.

Everything lies under one folder that all machines share. A run that dies is taken up by the next: the stream
by its checkpoint, a batch or a refresh by being written over. One run at a time per folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.operators.evalset import ASSESSOR, NEWEST, newest_per, potential_evaluation_set
from corpusmill.session import exists, settings

BUCKETS = 64  # of requests; a refresh reads those it touches
_ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}


def follow(log: DataFrame, path: str, keys: Sequence[str], order: Sequence[str] = NEWEST) -> None:
    """Take in the rows of a streaming ``log`` that ``path`` has not seen; ends when there are none left.

    ``order`` decides which row of a key is the newest; rows equal in it must be equal. Null keys are keys like
    others, a null in ``order`` is older than any value. Every run must pass the same keys and order.
    """
    if not log.isStreaming:
        raise ValueError("follow takes a stream: spark.readStream")
    rest = [c for c in log.columns if c not in keys]
    newest = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("newest"))
    bucket = F.pmod(F.xxhash64("request_id"), F.lit(BUCKETS)).cast("int")
    changed = newest.select(*keys, "newest.*", bucket.alias("bucket")).select(*log.columns, "bucket")

    def keep(batch: DataFrame, number: int) -> None:
        batch.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/changes/batch={number}")

    with settings(log.sparkSession, _ROCKSDB):
        query = (
            changed.writeStream.outputMode("update")
            .option("checkpointLocation", f"{path}/state")
            .trigger(availableNow=True)
            .foreachBatch(keep)
            .start()
        )
        query.awaitTermination()


def changes(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """All rows that runs of :func:`follow` wrote, with ``batch`` and ``bucket``."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema.fields), "batch long, bucket int"])
    if not exists(spark, f"{path}/changes"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/changes")


def holding(spark: SparkSession, path: str, like: DataFrame, keys: Sequence[str], order: Sequence[str] = NEWEST) -> DataFrame:
    """The newest row per key of everything taken in so far; the same as ``newest_per`` over the whole log."""
    return newest_per(changes(spark, path, like).drop("batch", "bucket"), keys, order)


def refresh_evaluation_set(requests: DataFrame, assessments: DataFrame, path: str) -> DataFrame:
    """Follow both log streams, bring the evaluation set under ``path`` up to date, and return it.

    Equal to :func:`potential_evaluation_set` over both whole logs, in whatever batches and order their
    rows came. Only requests whose own row or whose assessments changed since the last refresh are joined
    again: their buckets are read, not the logs.
    """
    spark = requests.sparkSession
    where = {"requests": f"{path}/requests", "assessments": f"{path}/assessments"}
    follow(requests, where["requests"], ["request_id"], ["timestamp"])
    follow(assessments, where["assessments"], ASSESSOR)
    asked, said = changes(spark, where["requests"], requests), changes(spark, where["assessments"], assessments)

    runs = spark.read.parquet(f"{path}/runs") if exists(spark, f"{path}/runs") else None
    last = runs.orderBy(F.desc("number")).first() if runs is not None else None
    number, seen_asked, seen_said = (last.number + 1, last.asked, last.said) if last else (0, -1, -1)
    fresh = asked.filter(F.col("batch") > seen_asked).select("bucket", "request_id")
    fresh = fresh.union(said.filter(F.col("batch") > seen_said).select("bucket", "request_id")).distinct()
    near = lambda rows: rows.join(fresh, ["bucket", "request_id"], "left_semi").drop("batch", "bucket")
    rows = potential_evaluation_set(
        newest_per(near(asked), ["request_id"], ["timestamp"]), newest_per(near(said), ASSESSOR)
    )
    rows.write.mode("overwrite").parquet(f"{path}/sets/number={number}")
    upto = [df.agg(F.coalesce(F.max("batch"), F.lit(-1))).first()[0] for df in (asked, said)]
    # the refresh counts from here on
    spark.createDataFrame([(number, *upto)], "number long, asked long, said long").write.mode("append").parquet(f"{path}/runs")
    return evaluation_set(spark, path)


def evaluation_set(spark: SparkSession, path: str) -> DataFrame:
    """The evaluation set as the last complete refresh left it."""
    last = spark.read.parquet(f"{path}/runs").agg(F.max("number")).first()[0]
    sets = spark.read.parquet(f"{path}/sets").filter(F.col("number") <= last)
    return newest_per(sets, ["request_id"], ["number"]).drop("number")
