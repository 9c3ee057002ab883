"""Raw files to parsed documents: dispatch by extension, errors kept as rows."""

from __future__ import annotations

import traceback
from collections.abc import Callable, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from corpusmill.constants import BAD_UTF8, ERROR_PREFIX, NO_PARSER, NO_TEXT, SUCCESS
from corpusmill.functions.html import html_to_markdown
from corpusmill.functions.text import doc_uri, extension, flag_test, utf8_text
from corpusmill.schemas import PARSED_DOCUMENT

# (content, path, modification_time, length) -> record
PythonParser = Callable[[bytes, str, object, int], Mapping]
# content -> text, NULL where the bytes cannot be read
ColumnParser = Callable[[Column], Column]


def html_parser(content: Column) -> Column:
    return html_to_markdown(utf8_text(content))


def plain_text_parser(content: Column) -> Column:
    """For formats that are text already; register it under the wanted extension."""
    return utf8_text(content)


COLUMN_PARSERS: dict[str, ColumnParser] = {".html": html_parser}
# Parsers that fail exactly where the bytes are not UTF-8; their status needs no look at the text.
UTF8_PARSERS = (html_parser, plain_text_parser)
METADATA: dict[str, Callable[[Column], Column]] = {"example_metadata": flag_test}


def python_parser_column(parse: PythonParser, schema: T.StructType, *inputs: Column) -> Column:
    """A Python parser as a struct Column, one Arrow batch at a time.

    A raised exception becomes an error record; the job goes on. NULL content gives
    NULL, so rows meant for other parsers cost nothing here.
    """
    names = schema.names
    arrow_type = to_arrow_type(schema, timestamp_utc=True)

    def failed(e: Exception) -> dict:
        error = f"{ERROR_PREFIX}{e}\n{traceback.format_exc()}"
        return dict.fromkeys(names) | {"doc_content": "", "parser_status": error}

    def run(content: pa.Array, path: pa.Array, modified: pa.Array, length: pa.Array) -> pa.Array:
        out = []
        for c, p, m, n in zip(content, path, modified, length, strict=True):
            raw = c.as_py()
            if raw is None:
                out.append(None)
                continue
            try:
                record = parse(raw, p.as_py(), m.as_py(), n.as_py())
                out.append({k: record.get(k) for k in names})
            except Exception as e:
                out.append(failed(e))
        try:
            return pa.array(out, type=arrow_type)
        except (pa.ArrowException, TypeError, ValueError, OverflowError):
            return pa.array([checked(row) for row in out], type=arrow_type)

    def checked(row: dict | None) -> dict | None:
        """A record of the wrong type is its own row's error."""
        try:
            pa.array([row], type=arrow_type)
            return row
        except (pa.ArrowException, TypeError, ValueError, OverflowError) as e:
            return failed(e)

    return F.arrow_udf(run, schema)(*inputs)


def apply_parser(raw: DataFrame, parse: PythonParser, schema: T.StructType = PARSED_DOCUMENT) -> DataFrame:
    """Run one Python parser over every raw file; its record becomes the columns."""
    record = python_parser_column(
        parse, schema, F.col("content"), F.col("path"), F.col("modificationTime"), F.col("length")
    )
    return raw.select(record.alias("record")).select("record.*")


def parse_files(
    raw: DataFrame,
    parsers: Mapping[str, ColumnParser] | None = None,
    python_parsers: Mapping[str, PythonParser] | None = None,
    metadata: Mapping[str, Callable[[Column], Column]] | None = None,
    schema: T.StructType = PARSED_DOCUMENT,
    keep_failed_uri: bool = False,
    fold_case: bool = False,
) -> DataFrame:
    """Parse each raw file by the extension of its path, in one pass over the files.

    ``parsers`` are native (text Column from content Column), ``python_parsers`` run
    through Arrow on their own extensions only. A row without parser, with bytes that
    are not text, or whose parser raised keeps its place with empty content, a status
    that starts with ``ERROR:`` and NULL in all other fields; ``keep_failed_uri`` keeps
    the URI and the time of such rows. Extensions match by case unless ``fold_case``.
    """
    parsers = dict(COLUMN_PARSERS if parsers is None else parsers)
    hooks = dict(python_parsers or {})
    metadata = dict(METADATA if metadata is None else metadata)
    suffix = extension("path")
    suffix = F.lower(suffix) if fold_case else suffix

    text = F.lit(None).cast("string")
    for ext, parser in parsers.items():
        if ext not in hooks:
            text = F.when(suffix == ext, parser(F.col("content"))).otherwise(text)
    simple = [ext for ext, parser in parsers.items() if parser in UTF8_PARSERS and ext not in hooks]
    other = [ext for ext in parsers if ext not in simple and ext not in hooks]
    failure = F.when(~suffix.isin(*parsers, *hooks), F.concat(F.lit(NO_PARSER), F.col("path")))
    if simple:
        failure = failure.when(suffix.isin(simple) & utf8_text("content").isNull(), F.lit(BAD_UTF8))
    if other:
        failure = failure.when(suffix.isin(other) & text.isNull(), F.lit(NO_TEXT))
    df = raw.select(
        "path", "modificationTime", "length", "content",
        suffix.alias("_ext"), text.alias("_text"), failure.alias("_failure"),
    )
    if hooks:
        own = F.when(F.col("_ext").isin(*hooks), F.col("content"))
        columns = []
        for ext, fn in hooks.items():
            mine = F.when(F.col("_ext") == ext, own)
            columns.append(
                python_parser_column(fn, schema, mine, F.col("path"), F.col("modificationTime"), F.col("length"))
            )
        df = df.select("path", "modificationTime", "_ext", "_text", "_failure", F.coalesce(*columns).alias("_hook"))
        hook = F.col("_hook")
    else:
        df = df.select("path", "modificationTime", "_ext", "_text", "_failure")
        hook = None

    problem = F.col("_failure")
    uri, modified = doc_uri("path"), F.col("modificationTime")
    native = {
        "doc_content": F.coalesce("_text", F.lit("")),
        "parser_status": F.when(problem.isNull(), F.lit(SUCCESS)).otherwise(F.concat(F.lit(ERROR_PREFIX), problem)),
        "doc_uri": uri if keep_failed_uri else F.when(problem.isNull(), uri),
        "last_modified": modified if keep_failed_uri else F.when(problem.isNull(), modified),
    }
    native |= {k: F.when(problem.isNull(), fn(F.col("_text"))) for k, fn in metadata.items()}

    def column(f: T.StructField) -> Column:
        c = native.get(f.name, F.lit(None)).cast(f.dataType)
        if hook is None:
            return c.alias(f.name)
        given = hook[f.name]
        if keep_failed_uri and f.name in ("doc_uri", "last_modified"):
            given = F.coalesce(given, uri if f.name == "doc_uri" else modified)
        return F.when(hook.isNotNull(), given).otherwise(c).alias(f.name)

    return df.select(*[column(f) for f in schema.fields])


def successful(docs: DataFrame) -> DataFrame:
    """Documents that parsed; apply before anything that costs per text."""
    return docs.filter(F.col("parser_status") == SUCCESS)


def status_counts(docs: DataFrame) -> DataFrame:
    """Number of documents, failed ones included, by outcome."""
    outcome = F.when(F.col("parser_status") == SUCCESS, F.lit(SUCCESS)).otherwise(F.lit("ERROR"))
    return docs.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n_docs"))
