"""Evaluation rows written by hand or taken from a question table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.schemas import EVALUATION_ROW


def inline_eval_rows(spark: SparkSession, rows: Iterable[Mapping]) -> DataFrame:
    """A short hand-written list under the fixed schema; optional keys may be absent."""
    rows = list(rows)
    for i, row in enumerate(rows):
        if not row.get("request"):
            raise ValueError(f"evaluation row {i} has no request")
        unknown = set(row) - set(EVALUATION_ROW.names)
        if unknown:
            raise ValueError(f"evaluation row {i} has unknown keys {sorted(unknown)}")
    data = [tuple(row.get(name) for name in EVALUATION_ROW.names) for row in rows]
    return spark.createDataFrame(data, EVALUATION_ROW)


def conform_eval_rows(df: DataFrame, **columns: Column | str) -> DataFrame:
    """Any question table as evaluation rows; fields not named become NULL."""
    if "request" not in columns:
        raise ValueError("a request column is required")
    unknown = set(columns) - set(EVALUATION_ROW.names)
    if unknown:
        raise ValueError(f"unknown evaluation fields {sorted(unknown)}")

    def field(f):
        c = columns.get(f.name)
        c = F.lit(None) if c is None else F.col(c) if isinstance(c, str) else c
        return c.cast(f.dataType).alias(f.name)

    return df.select(*[field(f) for f in EVALUATION_ROW.fields])
