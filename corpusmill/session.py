"""Session for local runs, the shared scratch folder, and spreading of small inputs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_fallback_scratch: str | None = None
_WITHOUT_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark. A cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("corpusmill")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir``.

    Where that setting is absent, the warehouse stands in on a cluster, if it is not a
    folder of one machine, and a temporary folder on a single machine, as in tests.
    """
    global _fallback_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and spark.sparkContext.master.startswith("local"):
        _fallback_scratch = _fallback_scratch or tempfile.mkdtemp(prefix="corpusmill-")
        base = _fallback_scratch
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        if base.startswith(("file:", "/")):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return f"{base.rstrip('/')}/corpusmill-{uuid.uuid4().hex}"


def spill(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the scratch folder and return the reading of it.

    Used where a result feeds several branches: later stages and retries after a
    lost executor start from files instead of the whole lineage. Shuffle files of the
    writing go when it is done, as nothing reads them again.
    """
    spark = df.sparkSession
    path = scratch_dir(spark)
    with settings(spark, _WITHOUT_SHUFFLES):
        df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside the block."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store the path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(where)


def release(*stored: DataFrame) -> None:
    """Delete tables that ``spill`` wrote, once what was made of them is written too and nothing else reads them."""
    for df in stored:
        delete_folder(df.sparkSession, df._stored_at)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, in whatever store the path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def spread(df: DataFrame) -> DataFrame:
    """Give a file scan that has fewer splits than the cluster has cores one split per core.

    A large table has more splits than cores and comes back as it is, so at scale
    this adds no shuffle. Call it on bare scans only: counting the splits of a plan
    with a shuffle would run that shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)
