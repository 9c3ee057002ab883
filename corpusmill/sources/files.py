"""Files as rows of bytes, and rows as files."""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

FOLDERS = 64  # folders over which files are spread, each listed by one task
TASK_BYTES = 32 << 20  # of small files that one task reads
TASKS_PER_CORE = 8


def load_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Every file below ``path``: path, modificationTime, length, content.

    ``content`` is read only if it is selected, and a filter on the other three
    columns is answered from the file listing. Spark counts the opening of a file as megabytes, so it would
    give a task a few small files; here a task reads as many as their own bytes allow.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path)
    size = int(files._jdf.queryExecution().analyzed().stats().sizeInBytes())
    return files.coalesce(max(TASKS_PER_CORE * spark.sparkContext.defaultParallelism, -(-size // TASK_BYTES)))


def store_files(rows: DataFrame, folder: str, key: str, text: str) -> None:
    """One text file per value of ``key``, its rows as lines, ``key=value`` in its path.

    In a folder that all machines mount, tasks write the files themselves, each whole under a hidden name first, so a
    task that is run again replaces its own. They lie in a few folders. Spark's writer, which other stores need, makes a folder
    per file, moves each once more from the driver, and has a task list each folder.
    """
    moved = rows.select(key, text).repartition(key)
    local = re.match(r"(?:file:(?://[^/]*)?)?(/.*)", folder)
    if local is None:
        moved.write.partitionBy(key).text(folder)
        return
    where = local[1]
    os.makedirs(where, exist_ok=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, lines in groupby(_named_lines(batches, key), itemgetter(0)):
            into = f"{where}/{zlib.crc32(name.encode()) % FOLDERS:02d}"
            os.makedirs(into, exist_ok=True)
            hidden = f"{into}/.{name}-{uuid.uuid4().hex}"
            with open(hidden, "xb") as out:
                out.writelines(line for _, line in lines)
            os.replace(hidden, f"{into}/{name}.txt")
        yield from ()

    done = moved.withColumn(text, moved[text].cast("binary")).sortWithinPartitions(key).mapInArrow(write, "n long")
    done.write.format("noop").mode("overwrite").save()


def _named_lines(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[str, bytes]]:
    """Name of its file and bytes of each row."""
    for batch in batches:
        for value, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield f"{key}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}", (line or b"") + b"\n"
