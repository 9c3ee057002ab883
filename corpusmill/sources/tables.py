"""Named tables: read, overwrite with schema replacement and without a time in which rows are gone, default names."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusmill.session import delete_folder

PREVIOUS = "corpusmill.previous"  # table property: folders of earlier versions
_VERSION = re.compile(r"-[0-9a-f]{32}$")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def default_chunk_table(docs_table: str, chunk_table: str | None = None) -> str:
    """Name of the chunk table: as given, else the docs table's name with ``_chunked``."""
    if chunk_table:
        return chunk_table
    return _suffixed(docs_table, "_chunked")


def overwrite_table(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None) -> DataFrame:
    """Replace table ``name`` and its schema by ``df``; return the table read back.

    Callers go on from the returned table, so the work behind ``df`` runs once. ``path`` is where a new table's
    files go. An existing table keeps its rows until all new ones are written to a folder beside it; then the
    catalog is turned to that folder. So ``df`` may read the table, a failing job changes nothing, and earlier
    files stay for readers that still use them, until :func:`delete_previous`.

    With the same columns the turn is one change of the catalog. With others the old table is first renamed to
    ``…_before_…``, where its rows can be read should the driver die before the new one is made.
    """
    spark = df.sparkSession
    if fmt == "delta" or not spark.catalog.tableExists(name):
        writer = df.write.format(fmt).mode("overwrite")
        if fmt == "delta":
            writer = writer.option("overwriteSchema", "true")
        if path:
            writer = writer.option("path", path)
        writer.saveAsTable(name)
        return spark.table(name)
    old = _described(spark, name)
    if old.get("Type") == "VIEW":
        raise ValueError(f"{name} is a view")
    aside = f"{_VERSION.sub('', (path or old['Location']).rstrip('/'))}-{uuid.uuid4().hex}"
    df.write.format(fmt).save(aside)
    _turn(spark, name, old, df.schema, fmt, aside)
    return spark.table(name)


def table_location(spark: SparkSession, name: str) -> str:
    """Folder of the files of table ``name``."""
    return _described(spark, name)["Location"]


def previous_locations(spark: SparkSession, name: str) -> list[str]:
    """Folders that table ``name`` had before it was replaced, oldest first."""
    known = spark.sql(f"show tblproperties {name}").filter(F.col("key") == PREVIOUS).first()
    return json.loads(known["value"]) if known else []


def delete_previous(spark: SparkSession, name: str) -> list[str]:
    """Delete the files of earlier versions of table ``name``, once nothing reads them; return their folders."""
    now, gone = table_location(spark, name), []
    for location in previous_locations(spark, name):
        if location != now:
            delete_folder(spark, location)
            gone.append(location)
    spark.sql(f"alter table {name} unset tblproperties if exists ('{PREVIOUS}')")
    return gone


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    """What the catalog says of a table as a whole; columns come before it, under their own names."""
    rows = [(r["col_name"], r["data_type"]) for r in spark.sql(f"describe table extended {name}").collect()]
    start = next(i for i, (k, _) in enumerate(rows) if k == "# Detailed Table Information")
    return dict(rows[start:])


def _turn(spark: SparkSession, name: str, old: dict[str, str], schema: StructType, fmt: str, aside: str) -> None:
    """Make ``name`` the files in ``aside``."""
    earlier = [*previous_locations(spark, name), old["Location"]]
    same = _columns(spark.table(name).schema) == _columns(schema) and old["Provider"].lower() == fmt.lower()
    if same:
        spark.sql(f"alter table {name} set location '{aside}'")
    else:
        before = _suffixed(name, f"_before_{uuid.uuid4().hex[:8]}")
        spark.sql(f"alter table {name} rename to {before}")
        try:
            spark.catalog.createTable(name, path=aside, source=fmt, schema=schema)
        except Exception:
            spark.sql(f"alter table {before} rename to {name}")
            raise
        if old.get("Type") == "MANAGED":
            earlier.pop()  # its files go with it
        spark.sql(f"drop table {before}")
    spark.catalog.refreshTable(name)
    spark.sql(f"alter table {name} set tblproperties ('{PREVIOUS}' = '{json.dumps(earlier)}')")


def _columns(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def _suffixed(name: str, suffix: str) -> str:
    return f"{name[:-1]}{suffix}`" if name.endswith("`") else name + suffix
