"""Exact dedup as a stateful stream: keyed state on disk without expiry, full bytes checked on hits.

Two texts are equal when they are identical after deleting every ASCII white-space character. The
stream reads the files of a table once. Its state, kept by RocksDB on the executors and logged to the
shared folder, holds per digest how many rows were seen and the row that stays so far: its length, id
and content locator (file and row number). The state never expires, so a run that goes on later
with new files from the same checkpoint still knows every text. A hot text costs one row per task and batch.

Rows whose digest has several holders are hits. Their contents are fetched and compared byte for byte with
the content at the locator; holders of one digest with different bytes are grouped by their bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.session import scratch_dir, spill

WHITE = " \t\n\x0b\x0c\r"  # fixed values: the characters [\x20\x09-\x0D]
_STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else each of many small stores reserves megabytes
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def exact_duplicates(
    spark: SparkSession,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    bytes_per_batch: int = 64 << 30,
    state_dir: str | None = None,
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per row of the Parquet table at ``path``.

    Of equal texts the one with the most code points stays, then the smallest id, then the first in file order.
    With ``state_dir`` a later call reads only new files into the same state. Defined cases: null text
    counts as empty, and all empty or white texts are equal; a null id comes after every other (and is its
    own keep_id only if all ids of its group are null); rows that repeat an id are rows like others;
    no file rows, no rows; further columns are not read, whatever their names.
    """
    state_dir = state_dir or scratch_dir(spark)
    table = spark.read.parquet(path)
    columns = (id_col, text_col, digest)
    with _settings(spark, _STATE_STORE):
        _run_stream(_rows(_streamed(spark, path, table, bytes_per_batch), *columns), state_dir)
    seen = spark.read.schema(_seen_schema(table, id_col)).parquet(f"{state_dir}/seen")
    groups = spill(seen.groupBy("key").agg(F.max_by("best", "size").alias("best"), F.max("size").alias("size")))

    rows = _rows(table, *columns)
    joined = rows.select("doc_id", "key", "sha").join(groups.filter("size = 1"), "key")
    alone = joined.select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha"
    )
    return alone.union(_checked_hits(rows, groups.filter("size > 1"))).withColumnRenamed("sha", "text_sha256")


def _rows(table: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    meta = table.metadataColumn("_metadata")  # of the file, even where a column of the rows has that name
    rows = table.select(
        F.col(id_col).alias("doc_id"),
        F.translate(text, WHITE, "").alias("bare"),
        F.length(text).alias("n_points"),
        meta["file_path"].alias("file"),
        meta["row_index"].alias("row"),
    )
    key = digest(F.col("bare"))
    sha = F.col("key") if digest is sha256 else sha256(F.col("bare"))
    order = F.struct(
        (-F.col("n_points")).alias("minus_points"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "file", "row"
    )
    return rows.withColumn("key", key).withColumn("sha", sha).withColumn("place", order)


def _streamed(spark: SparkSession, path: str, table: DataFrame, bytes_per_batch: int) -> DataFrame:
    path = path.rstrip("/")
    pattern = f"{path[:-1]}[{path[-1]}]"  # matches the path itself; a plain path would have to be a folder
    return spark.readStream.schema(table.schema).option("maxBytesPerTrigger", bytes_per_batch).parquet(pattern)


def _run_stream(rows: DataFrame, state_dir: str) -> None:
    counted = rows.groupBy("key").agg(F.count("*").alias("size"), F.min("place").alias("best"))

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{state_dir}/seen/batch={number}")

    query = (
        counted.writeStream.outputMode("update")
        .option("checkpointLocation", f"{state_dir}/state")
        .trigger(availableNow=True)
        .foreachBatch(keep)
        .start()
    )
    query.awaitTermination()


def _seen_schema(table: DataFrame, id_col: str) -> str:
    kind = table.select(id_col).schema[0].dataType.simpleString()
    return f"key string, size long, best struct<minus_points:int,no_id:boolean,doc_id:{kind},file:string,row:long>, batch int"


def _checked_hits(rows: DataFrame, groups: DataFrame) -> DataFrame:
    hits = rows.select("doc_id", "key", "sha", "bare", "place").join(groups, "key")
    hits = spill(hits.withColumn("kept", F.col("place") == F.col("best")))
    holders = hits.filter("kept").select("key", F.col("bare").alias("held"))
    compared = hits.join(holders, "key").withColumn("equal", F.col("bare") == F.col("held")).drop("held")
    unequal = spill(compared.filter("not equal").select("key").distinct())
    if unequal.isEmpty():
        return hits.select("doc_id", F.col("best.doc_id").alias("keep_id"), F.col("size").alias("group_size"), "kept", "sha")
    same = hits.join(unequal, "key", "left_anti")
    clashing = hits.join(unequal, "key").drop("best", "size", "kept")
    regrouped = clashing.groupBy("key", "bare").agg(F.count("*").alias("size"), F.min("place").alias("best"))
    clashing = clashing.join(regrouped, ["key", "bare"]).withColumn("kept", F.col("place") == F.col("best"))
    both = same.unionByName(clashing, allowMissingColumns=True)
    return both.select("doc_id", F.col("best.doc_id").alias("keep_id"), F.col("size").alias("group_size"), "kept", "sha")


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
