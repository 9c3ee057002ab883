"""Text templates with named fields, compiled once into a native Column."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F


def template_column(template: str, **fields: Column | str) -> Column:
    """``"a {x}"`` filled from ``fields``; a NULL field is written as empty text.

    Unknown field names fail here, on the driver, before any job starts.
    """
    parts: list[Column] = []
    for literal, name, _spec, _conv in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            if name not in fields:
                raise KeyError(f"template field {{{name}}} has no column")
            value = fields[name]
            value = F.col(value) if isinstance(value, str) else value
            parts.append(F.coalesce(value.cast("string"), F.lit("")))
    return F.concat(*parts) if parts else F.lit("")
