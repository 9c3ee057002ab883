"""Record types and the Spark schemas derived from them."""

from __future__ import annotations

import types
import typing
from datetime import datetime
from typing import TypedDict

from pyspark.sql import types as T

_SCALARS = {
    str: T.StringType(),
    datetime: T.TimestampType(),
    int: T.LongType(),
    float: T.DoubleType(),
    bool: T.BooleanType(),
    bytes: T.BinaryType(),
}


def spark_type(hint: object) -> T.DataType:
    """Spark type of one Python type hint."""
    if hint in _SCALARS:
        return _SCALARS[hint]
    if typing.is_typeddict(hint):
        return record_schema(hint)
    origin, args = typing.get_origin(hint), typing.get_args(hint)
    if origin is list:
        return T.ArrayType(spark_type(args[0]))
    if origin in (typing.Union, types.UnionType):
        present = [a for a in args if a is not type(None)]
        if len(present) == 1:
            return spark_type(present[0])
    if origin in (typing.Required, typing.NotRequired):
        return spark_type(args[0])
    raise TypeError(f"no Spark type for {hint!r}")


def record_schema(record: type) -> T.StructType:
    """Schema of a ``TypedDict``: one nullable field per key, in declaration order.

    All fields are nullable because a failed record leaves some of them unset.
    """
    if not typing.is_typeddict(record):
        raise TypeError(f"{record!r} is not a TypedDict")
    hints = typing.get_type_hints(record)
    return T.StructType([T.StructField(k, spark_type(h), True) for k, h in hints.items()])


class ParsedDocument(TypedDict):
    """What a parser returns. Extra keys become extra columns of docs and chunks."""

    doc_content: str
    parser_status: str
    doc_uri: str
    example_metadata: str
    last_modified: datetime


class DocReference(TypedDict):
    doc_uri: str


class EvaluationRow(TypedDict):
    """One hand-written evaluation question; only ``request`` is required."""

    request: str
    request_id: str
    expected_response: str
    expected_retrieved_context: list[DocReference]


class ChatMessage(TypedDict):
    role: str
    content: str


RAW_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)

PARSED_DOCUMENT = record_schema(ParsedDocument)
EVALUATION_ROW = record_schema(EvaluationRow)
MESSAGES = T.ArrayType(record_schema(ChatMessage))


def propagated_columns(schema: T.StructType, doc_column: str = "doc_content") -> list[str]:
    """All columns of the docs table but the text itself; these follow the chunks."""
    return [f.name for f in schema.fields if f.name != doc_column]
