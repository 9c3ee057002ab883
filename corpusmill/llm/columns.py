"""Checks and names of columns that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def whole_numbers(rows: DataFrame, name: str) -> Column:
    """Column ``name`` as long; a column of another kind than whole numbers is refused before any job runs."""
    kind = rows.select(F.col(f"`{name}`")).schema[0].dataType
    if not isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.NullType)):
        raise TypeError(f"{name} must hold whole numbers, not {kind.simpleString()}")
    return F.col(f"`{name}`").cast("long")


def free_names(rows: DataFrame, *wanted: str) -> list[str]:
    """``wanted`` as names that no column of ``rows`` has, whatever the case."""
    taken, free = {c.lower() for c in rows.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        free.append(name)
    return free
