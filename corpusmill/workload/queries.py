"""Registered queries and, where SQL can say the same, their DuckDB form."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill import constants as K
from corpusmill.functions.html import html_to_markdown
from corpusmill.functions.text import (
    doc_uri,
    extension,
    flag_test,
    ordered_join,
    squeeze_blank_lines,
    unquote,
    user_slug,
    utf8_text,
)
from corpusmill.operators.chat import requests_with_history, requests_with_responses, transcript
from corpusmill.operators.chunk import compute_chunks, fixed_windows, recursive_splitter
from corpusmill.operators.compressed import compress_index, compressed_top_k, hash_codebooks, scored_bytes
from corpusmill.operators.embed import fit_hash_embedder
from corpusmill.constants import INSPECT_COLUMNS, SAVED_COLUMNS
from corpusmill.operators.evalset import (
    ASSESSOR,
    dedup_assessments,
    expected_response,
    newest_per,
    potential_evaluation_set,
)
from corpusmill.operators.index import assign_cells, build_index, hash_pivots
from corpusmill.operators.parse import COLUMN_PARSERS, parse_files, status_counts, successful
from corpusmill.operators.prompt import messages, passage, passage_tokens, prompts, within_budget
from corpusmill.operators.quality import (
    WITH_TRUTH,
    chunk_precision,
    classify,
    document_hits,
    document_precision,
    document_recall,
    frequencies,
    is_empty,
    issue_report,
    rule_coverage,
    summary_metrics,
    tolerant_select,
    with_report_names,
)
from corpusmill.operators.search import (
    VECTORS_PER_CELL,
    ResultColumns,
    above,
    exact_by_cells,
    exact_top_k,
    fetch_passages,
    ivf_top_k,
    recall_at_k,
    rename_result,
)
from corpusmill.operators.text_search import bm25_top_k, build_text_index, fuse_by_rank
from corpusmill.operators.upkeep import apply_changes
from corpusmill.plans.answer import prompts_for, retrieve
from corpusmill.plans.ingest import ingest
from corpusmill.schemas import ParsedDocument, record_schema
from corpusmill.session import scratch_dir, spill, spread
from corpusmill.sources.eval_rows import conform_eval_rows, inline_eval_rows
from corpusmill.sources.files import load_files, store_files
from corpusmill.sources.tables import default_chunk_table, overwrite_table, table_location
from corpusmill.streaming.logs import follow, holding, refresh_evaluation_set
from corpusmill.workload import fixtures as fx
from corpusmill.workload import sql as q

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register the function under its own name, with its SQL twin if it has one."""

    def register(fn: Query) -> Query:
        _queries[fn.__name__] = fn
        if sql is not None:
            _oracles[fn.__name__] = sql
        return fn

    return register


def registered() -> dict[str, Query]:
    return dict(_queries)


def oracles() -> dict[str, str]:
    return dict(_oracles)


def _seconds(df: DataFrame) -> DataFrame:
    """Times as epoch seconds in text, so results depend on no time zone and NULLs on no integer type."""
    seconds = F.unix_timestamp("last_modified").cast("string")
    return df.withColumn("last_modified_s", seconds).drop("last_modified")


def _without_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Forget a table that a query made; with ``path``, return what its files hold."""
    schema = df.schema
    df.sparkSession.sql(f"drop table {name}")
    return df.sparkSession.read.schema(schema).parquet(path) if path else df


def _uris(column: str):
    return F.array_join(F.transform(column, lambda s: s["doc_uri"]), ",")


# --- sources and sinks -----------------------------------------------------------------------


@query("""
select page_id, octet_length(encode(html)) + 1 as length, md5(html || chr(10)) as digest from pages""")
def src_binary_files(spark, sf_dir):
    """Every page as a file of its own, loaded again by its bytes; the text writer ends a file with a line break."""
    pages, folder = fx.table(spark, sf_dir, "pages"), scratch_dir(spark)
    store_files(pages, folder, "page_id", "html")
    files = load_files(spark, folder, "*.txt")
    page = F.regexp_extract("path", "page_id=([0-9]+)", 1).cast("long")
    return files.select(page.alias("page_id"), "length", F.md5("content").alias("digest"))


@query("select event_id, user_id, event_type, value from events")
def src_table_scan(spark, sf_dir):
    return fx.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")


@query("""
select text as request, item_id::varchar as request_id, case when item_id % 2 = 0 then 'Answer ' || item_id end as expected_response,
  case when item_id % 3 = 0 then 'bench/' || item_id || '.txt' end as expected_uris
from benchmark
union all values ('What is set?', 'i1', 'Everything.', 'a.txt,b.txt'), ('What is absent?', null, null, null)""")
def src_inline_eval_rows(spark, sf_dir):
    """Hand-written rows, one with all fields and one with the least, beside those of a question table."""
    written = inline_eval_rows(
        spark,
        [
            {
                "request": "What is set?",
                "request_id": "i1",
                "expected_response": "Everything.",
                "expected_retrieved_context": [{"doc_uri": "a.txt"}, {"doc_uri": "b.txt"}],
            },
            {"request": "What is absent?"},
        ],
    )
    item = F.col("item_id")
    uri = F.concat(F.lit("bench/"), item, F.lit(".txt"))
    asked = conform_eval_rows(
        fx.table(spark, sf_dir, "benchmark"),
        request="text",
        request_id=item.cast("string"),
        expected_response=F.when(item % 2 == 0, F.concat(F.lit("Answer "), item)),
        expected_retrieved_context=F.when(item % 3 == 0, F.array(F.struct(uri.alias("doc_uri")))),
    )
    rows = asked.unionByName(written)
    return rows.select("request", "request_id", "expected_response", _uris("expected_retrieved_context").alias("expected_uris"))


@query(q.with_ctes(q.DOCS) + """
select * from (
  select 'doc_content' as field, 'string' as type, count(doc_content) as n_set from docs
  union all select 'parser_status', 'string', count(parser_status) from docs
  union all select 'doc_uri', 'string', count(doc_uri) from docs
  union all select 'example_metadata', 'string', count(example_metadata) from docs
  union all select 'last_modified', 'timestamp', count(last_modified_s) from docs)""")
def src_typed_schema(spark, sf_dir):
    fields = record_schema(ParsedDocument).fields
    counts = fx.docs(spark, sf_dir).agg(
        *[F.count(f.name).alias(f.name) for f in fields]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("field"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col(f.name).alias("n_set"),
            )
            for f in fields
        ]
    )
    return counts.select(F.inline(rows))


@query(q.with_ctes(q.DOCS, q.CHUNKS) + """
select chunk_id, chunk_index, content_chunked, parser_status, doc_uri, example_metadata, last_modified_s from chunks""")
def snk_overwrite_roundtrip(spark, sf_dir):
    docs_table = f"corpusmill_docs_{uuid.uuid4().hex}"
    chunk_table = default_chunk_table(docs_table)
    docs = overwrite_table(fx.docs(spark, sf_dir), docs_table, path=scratch_dir(spark))
    where = scratch_dir(spark)
    overwrite_table(docs.select("doc_uri", "parser_status"), chunk_table, path=where)
    chunks = overwrite_table(compute_chunks(docs, fixed_windows()), chunk_table, path=where)
    written = table_location(spark, chunk_table)
    return _seconds(_without_table(_without_table(chunks, docs_table), chunk_table, written))


@query("""
select event_type, count(*) as n_rows, sum(event_id)::bigint as id_sum from events where event_type <> 'error' group by 1""")
def snk_replace_own_rows(spark, sf_dir):
    """A table replaced by what a query keeps of it, twice, the second time with other columns."""
    name = f"corpusmill_events_{uuid.uuid4().hex}"
    events = overwrite_table(fx.table(spark, sf_dir, "events").select("event_id", "event_type"), name, path=scratch_dir(spark))
    kept = overwrite_table(events.filter("event_type <> 'error'"), name)
    counts = kept.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("id_sum"))
    stored = overwrite_table(counts, name)
    return _without_table(stored, name, table_location(spark, name))


@query(q.with_ctes(q.REQUESTS, q.ASSESSMENTS, q.EVAL_SET) + """
select request, request_id, expected_response, expected_uris, source_user, source_tag from eval_set""")
def snk_eval_set_roundtrip(spark, sf_dir):
    rows = _eval_set(spark, sf_dir).select(*SAVED_COLUMNS)
    name, where = f"corpusmill_eval_set_{uuid.uuid4().hex}", scratch_dir(spark)
    stored = _without_table(overwrite_table(rows, name, path=where), name, where)
    return stored.withColumn("expected_uris", _uris("expected_retrieved_context")).drop("expected_retrieved_context")


# --- scalar functions ------------------------------------------------------------------------------


@query(r"""
select c_custkey, substr(lower(replace(split_part(email, '@', 1), '.', '')), 1, 35) as user_slug
from (select c_custkey, replace(c_name, '#', '.') || '.Of.' || c_mktsegment || '@example.com' as email from customer)""")
def scl_user_slug(spark, sf_dir):
    email = F.concat(F.replace("c_name", F.lit("#"), F.lit(".")), F.lit(".Of."), "c_mktsegment", F.lit("@example.com"))
    return fx.table(spark, sf_dir, "customer").select("c_custkey", user_slug(email).alias("user_slug"))


@query(f"select page_id, {q.extension('url')} as extension, {q.extension(q.PAGE_PATH)} as path_extension from pages")
def scl_extension(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages")
    path = F.regexp_replace("url", r"/\z", "/index.html")
    return pages.select("page_id", extension("url").alias("extension"), extension(path).alias("path_extension"))


@query(f"select page_id, {q.doc_uri('url')} as doc_uri from pages")
def scl_doc_uri(spark, sf_dir):
    return fx.table(spark, sf_dir, "pages").select("page_id", doc_uri("url").alias("doc_uri"))


@query("""
select doc_id, case when contains(text, 'test') then 'test' else 'not test' end as flag from documents""")
def scl_flag_test(spark, sf_dir):
    return fx.table(spark, sf_dir, "documents").select("doc_id", flag_test("text").alias("flag"))


@query(f"select page_id, {q.squeeze(q.replace_all('html', '<[^>]*>', chr(10)))} as text from pages")
def scl_blank_lines(spark, sf_dir):
    lines = F.regexp_replace("html", "<[^>]*>", "\n")
    return fx.table(spark, sf_dir, "pages").select("page_id", squeeze_blank_lines(lines).alias("text"))


@query("select doc_id, lang <> 'fr' as valid, case when lang <> 'fr' then text end as text from documents")
def scl_decode_utf8(spark, sf_dir):
    # French documents get one byte that no UTF-8 text may hold.
    content = F.encode("text", "UTF-8")
    content = F.when(F.col("lang") == "fr", F.concat(content, F.unhex(F.lit("FF")))).otherwise(content)
    text = utf8_text("content")
    return (
        fx.table(spark, sf_dir, "documents")
        .select("doc_id", content.alias("content"))
        .select("doc_id", text.isNotNull().alias("valid"), text.alias("text"))
    )


@query("select p_partkey, replace('`' || p_brand || '`.`' || p_type || '`', '`', '') as name from part")
def scl_unquote(spark, sf_dir):
    quoted = F.concat(F.lit("`"), "p_brand", F.lit("`.`"), "p_type", F.lit("`"))
    return fx.table(spark, sf_dir, "part").select("p_partkey", unquote(quoted).alias("name"))


@query("select conv_id, string_agg(text, chr(10) order by turn) as content from conversations group by conv_id")
def doc_join_pages(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "conversations")
    return pages.groupBy("conv_id").agg(ordered_join("turn", "text").alias("content"))


# --- documents -----------------------------------------------------------------------------------------


_PARSED = "doc_content, parser_status, doc_uri, example_metadata, last_modified_s"


def _reverse_words(content, path, modified, length):
    """A custom parser: every line with its words in reverse order."""
    text = "\n".join(" ".join(reversed(line.split(" "))) for line in content.decode("utf-8").split("\n"))
    return {
        "doc_content": text,
        "parser_status": K.SUCCESS,
        "doc_uri": path.removeprefix("file:/"),
        "example_metadata": "test" if "test" in text else "not test",
        "last_modified": modified,
    }


@query(q.with_ctes(q.MIXED_DOCS, q.SAVED_PAGES) + f"""
select {_PARSED} from saved_pages
union all
select * replace (array_to_string([array_to_string(list_reverse(string_split(l, ' ')), ' ')
  for l in string_split(doc_content, chr(10))], chr(10)) as doc_content)
from (select {_PARSED} from docs)""")
def doc_parse(spark, sf_dir):
    raw = fx.raw_docs(spark, sf_dir, mixed=True).unionByName(fx.saved_pages(spark, sf_dir))
    return _seconds(parse_files(raw, python_parsers={".txt": _reverse_words}))


@query(f"""
select {q.doc_uri(q.PAGE_PATH)} as doc_uri, {q.extension(q.PAGE_PATH)} as extension,
  case when {q.extension(q.PAGE_PATH)} = '.html' then 'SUCCESS'
    else {q.lit(K.ERROR_PREFIX + K.NO_PARSER)} || {q.PAGE_PATH} end as parser_status
from pages""")
def doc_dispatch(spark, sf_dir):
    parsed = parse_files(fx.raw_pages(spark, sf_dir), keep_failed_uri=True)
    given = F.regexp_extract("parser_status", "(?s)^" + K.ERROR_PREFIX + K.NO_PARSER + "(.*)", 1)
    ext = F.when(F.col("parser_status") == K.SUCCESS, extension("doc_uri")).otherwise(extension(given))
    return parsed.select("doc_uri", ext.alias("extension"), "parser_status")


@query(f"select page_id, {q.markdown('html')} as markdown from pages")
def doc_html_to_text(spark, sf_dir):
    pages = spread(fx.table(spark, sf_dir, "pages"))
    return pages.select("page_id", html_to_markdown("html").alias("markdown"))


_ODD_SQL = """
'<header><nav>menu ' || page_id || '<p>' || html || '<table><tr><th>one</th><th>two</th></tr><tr><td>' || page_id || '</td><td>b</td></tr></table>'
|| 'dash &#8211; han &#x4e2d; end &mdash; <a class="x" href=''u' || page_id || '''>there</a> <code>x = 1</code><pre>a  b</pre>'
|| '<img src="p.png" alt="pic"><script>never' """


@query(f"select page_id, {q.markdown(_ODD_SQL)} as markdown from pages")
def doc_html_odd(spark, sf_dir):
    """Every page within unclosed elements, and with a table, references, quotes, code and an image after it."""
    page, number = F.col("html"), F.col("page_id").cast("string")
    odd = F.concat(
        F.lit("<header><nav>menu "), number, F.lit("<p>"), page,
        F.lit("<table><tr><th>one</th><th>two</th></tr><tr><td>"), number, F.lit("</td><td>b</td></tr></table>"),
        F.lit('dash &#8211; han &#x4e2d; end &mdash; <a class="x" href=\'u'), number,
        F.lit("'>there</a> <code>x = 1</code><pre>a  b</pre><img src=\"p.png\" alt=\"pic\"><script>never"),
    )
    return spread(fx.table(spark, sf_dir, "pages")).select("page_id", html_to_markdown(odd).alias("markdown"))


@query(q.with_ctes(q.PARSED_PAGES) + f"select {_PARSED} from parsed_pages where parser_status <> 'SUCCESS'")
def doc_error_rows(spark, sf_dir):
    parsed = parse_files(fx.raw_pages(spark, sf_dir))
    return _seconds(parsed.filter(F.col("parser_status") != K.SUCCESS))


@query(q.with_ctes(q.MIXED_DOCS) + """
select case when parser_status = 'SUCCESS' then 'SUCCESS' else 'ERROR' end as outcome, count(*) as n_docs
from docs group by 1""")
def doc_status_counts(spark, sf_dir):
    return status_counts(fx.docs(spark, sf_dir, mixed=True))


@query(q.with_ctes(q.MIXED_DOCS) + f"select {_PARSED} from docs where parser_status = 'SUCCESS'")
def doc_success_only(spark, sf_dir):
    return _seconds(successful(fx.docs(spark, sf_dir, mixed=True)))


# --- chunks ---------------------------------------------------------------------------------------------


@query(q.with_recursive(q.DOCS, q.RECURSIVE_CHUNKS) + """
select md5(doc_uri || '|' || chunk_index) as chunk_id, chunk_index, chunk as content_chunked, doc_uri
from recursive_chunks join docs using (src_key)""")
def chunk_recursive(spark, sf_dir):
    chunks = compute_chunks(fx.docs(spark, sf_dir), recursive_splitter())
    return chunks.select("chunk_id", "chunk_index", "content_chunked", "doc_uri")


@query(q.with_ctes(q.DOCS, q.CHUNKS) + "select doc_uri, chunk_index, content_chunked from chunks")
def chunk_fixed(spark, sf_dir):
    chunks = compute_chunks(fx.docs(spark, sf_dir), fixed_windows())
    return chunks.select("doc_uri", "chunk_index", "content_chunked")


@query(q.with_ctes(q.DOCS, q.CHUNKS) + """
select doc_uri, count(*) as n_chunks, sum(length(content_chunked))::bigint as n_chars from chunks group by 1""")
def chunk_explode(spark, sf_dir):
    chunks = compute_chunks(fx.docs(spark, sf_dir), fixed_windows())
    return chunks.groupBy("doc_uri").agg(
        F.count(F.lit(1)).alias("n_chunks"), F.sum(F.length("content_chunked")).alias("n_chars")
    )


@query(q.with_ctes(q.DOCS, q.CHUNKS) + """
select chunk_id, parser_status, doc_uri, example_metadata, last_modified_s from chunks""")
def chunk_propagate(spark, sf_dir):
    chunks = compute_chunks(fx.docs(spark, sf_dir), fixed_windows())
    return _seconds(chunks.drop("chunk_index", "content_chunked"))


@query(q.with_ctes(q.DOCS, q.CHUNKS) + """
select chunk_id, count(*) as n_rows from chunks group by 1""")
def chunk_ids(spark, sf_dir):
    chunks = compute_chunks(fx.docs(spark, sf_dir), fixed_windows())
    return chunks.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n_rows"))


# --- vectors and search -----------------------------------------------------------------------------------


@query("""
select doc_id, 256::bigint as dim, case when regexp_matches(text, '[A-Za-z0-9]') then 1.0 else 0.0 end as norm from documents""")
def vec_hash_embed(spark, sf_dir):
    documents = spread(fx.table(spark, sf_dir, "documents").select("doc_id", "text"))
    embedded = fit_hash_embedder(documents, "text").embed(documents, "text")
    square = F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    return embedded.select("doc_id", F.size("embedding").cast("long").alias("dim"), F.round(F.sqrt(square), 3).alias("norm"))


@query(q.with_ctes(q.IVF) + "select vec_id as chunk_id, cell, cell_score from near where place = 1")
def vec_ivf_assign(spark, sf_dir):
    vectors = fx.vectors(spark, sf_dir)
    centroids = hash_pivots(vectors, q.CELLS, "chunk_id")
    return assign_cells(vectors, centroids, "chunk_id").select(
        "chunk_id", F.col("cell").cast("long").alias("cell"), "cell_score"
    )


def _exact(spark, sf_dir, k):
    vectors = fx.vectors(spark, sf_dir)
    n_cells = max(q.CELLS, -(-vectors.count() // VECTORS_PER_CELL))
    return exact_top_k(
        fx.query_vectors(spark, sf_dir), vectors, k, key="chunk_id", skip_self=True, method="cells", n_cells=n_cells
    )


def _ann(spark, sf_dir):
    vectors = fx.vectors(spark, sf_dir)
    index = build_index(vectors, hash_pivots(vectors, q.CELLS, "chunk_id"), "chunk_id")
    return ivf_top_k(fx.query_vectors(spark, sf_dir), index, K.ANN_RESULTS, q.PROBES, skip_self=True)


@query(q.with_ctes(q.knn(K.TRIAL_RESULTS)) + "select query_id, rank, chunk_id, score from knn")
def knn_exact_top3(spark, sf_dir):
    return _exact(spark, sf_dir, K.TRIAL_RESULTS)


@query(q.with_ctes(q.knn(K.ANN_RESULTS)) + "select query_id, rank, chunk_id, score from knn")
def knn_exact_top16(spark, sf_dir):
    return _exact(spark, sf_dir, K.ANN_RESULTS)


@query(q.with_ctes(q.knn(K.ANN_RESULTS)) + "select query_id, rank, chunk_id, score from knn")
def knn_upkeep(spark, sf_dir):
    """Search after insert, change, delete and a split of cells; what is left is every vector of the table, as given.

    The index starts without every third vector, with every fifth one turned around, and with a stray copy of
    every fourth under a key of its own.
    """
    vectors, key = fx.vectors(spark, sf_dir), F.col("chunk_id")
    turned = F.transform("embedding", lambda x: -x)
    old = vectors.filter(key % 3 != 0).withColumn("embedding", F.when(key % 5 == 0, turned).otherwise(F.col("embedding")))
    stray = vectors.filter(key % 4 == 0).withColumn("chunk_id", -key - 1)
    n = vectors.count()
    n_cells = max(q.CELLS, -(-n // VECTORS_PER_CELL))
    path = scratch_dir(spark)
    build_index(old.union(stray), hash_pivots(vectors, n_cells, "chunk_id"), "chunk_id", path=path)
    changed = vectors.filter((key % 3 == 0) | (key % 5 == 0))
    apply_changes(spark, path, changed, key="chunk_id")
    index = apply_changes(spark, path, None, stray, key="chunk_id", max_cell=-(-2 * n // n_cells))
    return exact_by_cells(fx.query_vectors(spark, sf_dir), index, K.ANN_RESULTS, skip_self=True)


@query(q.with_ctes(q.IVF) + "select query_id, rank, chunk_id, score from ann")
def knn_ann_ivf(spark, sf_dir):
    return _ann(spark, sf_dir)


@query(q.with_ctes(q.IVF, q.knn(K.ANN_RESULTS)) + """
select count(*) as n_true, count(a.chunk_id) as n_found, round(count(a.chunk_id) / count(*), 6) as recall
from knn k left join ann a on a.query_id = k.query_id and a.chunk_id = k.chunk_id""")
def knn_ann_recall(spark, sf_dir):
    return recall_at_k(_ann(spark, sf_dir), _exact(spark, sf_dir, K.ANN_RESULTS), "query_id", "chunk_id")


def _compressed(spark, sf_dir):
    vectors = fx.vectors(spark, sf_dir)
    index = build_index(vectors, hash_pivots(vectors, q.CELLS, "chunk_id"), "chunk_id")
    return compress_index(index, hash_codebooks(vectors, q.CODE_PARTS, q.CODES, "chunk_id"))


def _by_codes(spark, sf_dir, compressed):
    asked = fx.query_vectors(spark, sf_dir)
    return compressed_top_k(asked, compressed, K.ANN_RESULTS, q.PROBES, q.SURVIVORS, skip_self=True)


@query(q.with_ctes(q.IVF, q.CODED) + "select query_id, rank, chunk_id, score from by_codes")
def knn_pq_top16(spark, sf_dir):
    return _by_codes(spark, sf_dir, _compressed(spark, sf_dir))


@query(q.with_ctes(q.IVF, q.CODED, q.knn(K.ANN_RESULTS)) + f"""
select count(*) as n_true, count(a.chunk_id) as n_found, round(count(a.chunk_id) / count(*), 6) as recall,
  any_value(n_scored) as n_scored, any_value(n_scored * {q.CODE_PARTS})::bigint as code_bytes,
  any_value(vector_bytes)::bigint as vector_bytes
from knn k left join by_codes a on a.query_id = k.query_id and a.chunk_id = k.chunk_id,
  (select count(*) as n_scored, sum(4 * len(v.embedding)) as vector_bytes
   from near q join near v on q.cell = v.cell where q.place <= {q.PROBES} and v.place = 1)""")
def knn_pq_recall(spark, sf_dir):
    """What codes find of the true top 16, beside the bytes that codes and true vectors of the probed cells take."""
    compressed = _compressed(spark, sf_dir)
    found = recall_at_k(_by_codes(spark, sf_dir, compressed), _exact(spark, sf_dir, K.ANN_RESULTS), "query_id", "chunk_id")
    read = scored_bytes(fx.query_vectors(spark, sf_dir), compressed, q.PROBES).first()
    return found.withColumns({name: F.lit(n) for name, n in read.asDict().items()})


@query(q.with_ctes(q.knn(K.ANN_RESULTS)) + """
select query_id, rank, chunk_id, score, score >= 0.27 as above_strict from knn where score >= 0.1""")
def knn_threshold(spark, sf_dir):
    hits = above(_exact(spark, sf_dir, K.ANN_RESULTS), K.SCORE_THRESHOLD)
    return hits.withColumn("above_strict", F.col("score") >= 0.27)


@query(q.with_ctes(q.knn(K.TRIAL_RESULTS), q.PASSAGES) + """
select query_id as request, rank, chunk_id as primary_key, content_chunked as chunk_text, doc_uri as document_uri, lang
from knn join passages using (chunk_id)""")
def knn_project(spark, sf_dir):
    hits = _exact(spark, sf_dir, K.TRIAL_RESULTS)
    found = fetch_passages(hits, fx.passages(spark, sf_dir), ResultColumns(additional=["lang"]))
    return rename_result(
        found,
        {
            "query_id": "request",
            "rank": "rank",
            "chunk_id": "primary_key",
            "content_chunked": "chunk_text",
            "doc_uri": "document_uri",
            "lang": "lang",
        },
    )


@query(q.with_ctes(q.REQUESTS, q.bm25("select request_id as query_id, request as text from requests", K.ANN_RESULTS)) + """
select query_id, rank, chunk_id, score from bm25""")
def text_bm25_top16(spark, sf_dir):
    """Every question of the conversations, by its words."""
    questions = fx.request_log(spark, sf_dir).select(F.col("request_id").alias("query_id"), F.col("request").alias("text"))
    return bm25_top_k(questions, build_text_index(spread(fx.passages(spark, sf_dir))), K.ANN_RESULTS)


_OPENINGS = "select conv_id as query_id, arg_min(text, turn) as text from conversations where role = 'user' group by 1"


@query(q.with_ctes(q.bm25(_OPENINGS, K.ANN_RESULTS), q.knn(K.ANN_RESULTS)) + f"""
select query_id, chunk_id, score, row_number() over (partition by query_id order by score desc, chunk_id) as rank
from (
  select query_id, chunk_id, round(sum(1.0::double / (60 + rank)), 9) as score
  from (
    select query_id, chunk_id, rank from bm25
    union all select query_id, chunk_id, rank from knn where query_id in (select query_id from ({_OPENINGS})))
  group by 1, 2)
qualify rank <= 16""")
def text_hybrid_top16(spark, sf_dir):
    """The first question of every conversation by its words, and by the vector of the same number; ranks made one."""
    turns = fx.table(spark, sf_dir, "conversations").filter("role = 'user'")
    questions = turns.groupBy(F.col("conv_id").alias("query_id")).agg(F.min_by("text", "turn").alias("text"))
    words = bm25_top_k(questions, build_text_index(spread(fx.passages(spark, sf_dir))), K.ANN_RESULTS)
    asked = fx.query_vectors(spark, sf_dir).join(questions, "query_id", "left_semi")
    vectors = fx.vectors(spark, sf_dir)
    n_cells = max(q.CELLS, -(-vectors.count() // VECTORS_PER_CELL))
    near = exact_top_k(asked, vectors, K.ANN_RESULTS, key="chunk_id", skip_self=True, n_cells=n_cells)
    return fuse_by_rank([words, near], K.ANN_RESULTS)


# --- prompts and conversations -------------------------------------------------------------------------------


def _retrieved(spark, sf_dir):
    """Request → passages: approximate top 16 above the threshold, with text and URI."""
    hits = above(_ann(spark, sf_dir), K.SCORE_THRESHOLD)
    return fetch_passages(hits, fx.passages(spark, sf_dir), ResultColumns())


_PASSAGE_SQL = "'Passage text: ' || content_chunked || chr(10) || 'Passage metadata: ' || doc_uri || chr(10) || chr(10)"
_RETRIEVED_SQL = f"""retrieved as (
  select query_id, rank, chunk_id, {_PASSAGE_SQL} as passage
  from ann join passages using (chunk_id) where score >= 0.1)"""


def _prompt_sql(template: str) -> str:
    head = template.removesuffix("{context}")
    return q.with_ctes(q.IVF, q.PASSAGES, _RETRIEVED_SQL) + f"""
select query_id, count(*) as n_passages, {q.lit(head)} || string_agg(passage, '' order by rank) as prompt
from retrieved group by 1"""


@query(q.with_ctes(q.IVF, q.PASSAGES, _RETRIEVED_SQL) + "select query_id, rank, chunk_id, passage from retrieved")
def prompt_passage(spark, sf_dir):
    found = _retrieved(spark, sf_dir)
    return found.select("query_id", "rank", "chunk_id", passage("content_chunked", "doc_uri").alias("passage"))


@query(_prompt_sql(K.PROMPT_TEMPLATE))
def prompt_context(spark, sf_dir):
    return prompts(_retrieved(spark, sf_dir), "query_id")


@query(_prompt_sql(K.CITING_PROMPT_TEMPLATE))
def prompt_context_cited(spark, sf_dir):
    return prompts(_retrieved(spark, sf_dir), "query_id", prompt_template=K.CITING_PROMPT_TEMPLATE)


@query(q.with_recursive(q.IVF, q.PASSAGES, _RETRIEVED_SQL) + f""",
sized as (
  select r.*, {q.count_tokens('passage')} as n, round(a.score * 1e6)::bigint as points, embedding as e
  from retrieved r join ann a using (query_id, chunk_id) join embeddings on vec_id = chunk_id),
picked as (
  select query_id, 0 as step, {q.PROMPT_TOKENS}::bigint as room, []::bigint[] as taken, [[]]::float[][] as seen
  from sized group by 1
  union all
  select query_id, step + 1, room - best.n, list_append(taken, best.rank), list_append(seen, best.e)
  from (
    select p.query_id, step, any_value(room) as room, any_value(taken) as taken, any_value(seen) as seen,
      arg_max({{'n': n, 'rank': s.rank, 'e': e}}, 100 * (
        {100 - q.VARIETY} * points - {q.VARIETY} * (case when step = 0 then 0 else list_max(
          list_transform(seen[2:], lambda x: round(list_cosine_similarity(x::double[], e::double[]) * 1e6)::bigint)) end)) - s.rank) as best
    from picked p join sized s on s.query_id = p.query_id and s.n <= room and not list_contains(taken, s.rank)
    group by 1, 2)),
last as (select * from picked qualify row_number() over (partition by query_id order by step desc) = 1)
select s.query_id, count(*) as n_passages, sum(n)::bigint as n_tokens,
  {q.lit(K.PROMPT_TEMPLATE.removesuffix("{context}"))} || string_agg(passage, '' order by s.rank) as prompt
from sized s join last l on l.query_id = s.query_id and list_contains(taken, s.rank) group by 1""".replace("\n,", ",", 1))
def prompt_budget(spark, sf_dir):
    """Prompts of passages chosen for score and variety, none over its budget of tokens."""
    passages = fx.passages(spark, sf_dir)
    lengths = passages.select("chunk_id", passage_tokens("content_chunked", "doc_uri").alias("n"))
    hits = above(_ann(spark, sf_dir), K.SCORE_THRESHOLD).join(lengths, "chunk_id").join(fx.vectors(spark, sf_dir), "chunk_id")
    chosen = within_budget(
        hits, q.PROMPT_TOKENS, "query_id", score="score", embedding="embedding", variety=q.VARIETY, n_tokens="n"
    )
    chosen = spill(chosen.select("query_id", "rank", "chunk_id", "n_tokens"))
    sizes = chosen.groupBy("query_id").agg(F.sum("n_tokens").alias("n_tokens"))
    found = fetch_passages(chosen.drop("n_tokens"), passages, ResultColumns())
    return prompts(found, "query_id").join(sizes, "query_id")


@query(f"""
select conv_id || '-' || turn as request_id, n + 1 as n_messages,
  'system: ' || {q.lit(K.SYSTEM_PROMPT)} || chr(10) || said as transcript
from (
  select conv_id, turn, role,
    count(*) over w as n, string_agg(role || ': ' || text, chr(10)) over w as said
  from conversations
  window w as (partition by conv_id order by turn rows between unbounded preceding and current row))
where role = 'user'""")
def chat_messages(spark, sf_dir):
    asked = requests_with_history(fx.table(spark, sf_dir, "conversations"))
    earlier = F.slice("messages", F.lit(1), F.size("messages") - 1)
    chat = messages(F.element_at("messages", -1)["content"], earlier)
    return asked.select("request_id", chat.alias("m")).select(
        "request_id", F.size("m").cast("long").alias("n_messages"), transcript("m").alias("transcript")
    )


@query("""
select conv_id || '-' || turn as request_id, n as n_messages, said as transcript
from (
  select conv_id, turn, role,
    count(*) over w as n, string_agg(role || ': ' || text, chr(10)) over w as said
  from conversations
  window w as (partition by conv_id order by turn rows between unbounded preceding and current row))
where role = 'user'""")
def chat_history(spark, sf_dir):
    asked = requests_with_history(fx.table(spark, sf_dir, "conversations"))
    return asked.select(
        "request_id",
        F.size("messages").cast("long").alias("n_messages"),
        transcript("messages").alias("transcript"),
    )


@query(q.with_ctes(q.REQUESTS) + "select request_id, request, response from requests")
def chat_request_response(spark, sf_dir):
    turns = fx.table(spark, sf_dir, "conversations")
    return requests_with_responses(turns).select("request_id", "request", "response")


@query()
def job_files_to_prompts(spark, sf_dir):
    """The whole way: pages and documents as files, chunks, index, a prompt per benchmark text."""
    raw = fx.saved_pages(spark, sf_dir).unionByName(fx.raw_docs(spark, sf_dir))
    corpus = ingest(
        raw,
        f"corpusmill_docs_{uuid.uuid4().hex}",
        q.CELLS,
        docs_path=scratch_dir(spark),
        chunk_path=scratch_dir(spark),
        parsers=COLUMN_PARSERS | fx.TEXT_PARSERS,
    )
    questions = fx.table(spark, sf_dir, "benchmark").select(
        F.col("item_id").cast("string").alias("request_id"), F.col("text").alias("request")
    )
    return prompts_for(questions, retrieve(questions, corpus))


# --- evaluation set -------------------------------------------------------------------------------------------


def _eval_set(spark, sf_dir):
    return potential_evaluation_set(fx.request_log(spark, sf_dir), fx.assessment_log(spark, sf_dir))


@query(q.with_ctes(q.ASSESSMENTS) + """
select request_id, source_user, source_tag, rating, edited_response, liked as liked_uris, assessment_id from last_words""")
def log_dedup(spark, sf_dir):
    kept = dedup_assessments(fx.assessment_log(spark, sf_dir))
    return kept.select(
        "request_id", "source_user", "source_tag", "rating", "edited_response",
        F.try_element_at("liked_doc_uris", F.lit(1)).alias("liked_uris"),
        "assessment_id",
    )


@query(q.with_ctes(q.REQUESTS, q.ASSESSMENTS, q.EVAL_SET) + """
select request_id, request, response, trace, source_user, source_tag, rating, edited_response,
  assessment_id::varchar as assessment_id, is_correct::varchar as is_correct from eval_set""")
def eval_join(spark, sf_dir):
    return _eval_set(spark, sf_dir).select(
        "request_id", "request", "response", "trace", "source_user", "source_tag", "rating", "edited_response",
        F.col("assessment_id").cast("string"), F.col("is_correct").cast("string"),
    )


REPLAYS = 3


def _arriving(rows: DataFrame, name: str):
    """A log that comes in ``REPLAYS`` parts, later rows as likely first as last: the stream, and what lets the next part in."""
    spark, folder = rows.sparkSession, scratch_dir(rows.sparkSession)
    spark.createDataFrame([], rows.schema).write.parquet(folder)  # a stream needs its folder
    part = F.pmod(F.xxhash64(F.lit(name), *[c for c in rows.columns if c != "liked_doc_uris"]), F.lit(REPLAYS))

    def let_in(number: int) -> None:
        rows.filter(part == number).write.mode("append").parquet(folder)

    return spark.readStream.schema(rows.schema).parquet(folder), let_in


@query(q.with_ctes(q.ASSESSMENTS) + """
select request_id, source_user, source_tag, rating, edited_response, liked as liked_uris, assessment_id from last_words""")
def log_dedup_stream(spark, sf_dir):
    """The same as ``log_dedup`` from keyed state, the log coming in parts and out of order."""
    log, state = fx.assessment_log(spark, sf_dir), scratch_dir(spark)
    stream, let_in = _arriving(log, "assessments")
    for number in range(REPLAYS):
        let_in(number)
        follow(stream, state, ASSESSOR)
    return holding(spark, state, log, ASSESSOR).select(
        "request_id", "source_user", "source_tag", "rating", "edited_response",
        F.try_element_at("liked_doc_uris", F.lit(1)).alias("liked_uris"),
        "assessment_id",
    )


@query(q.with_ctes(q.REQUESTS, q.ASSESSMENTS, q.EVAL_SET) + """
select request_id, request, response, trace, source_user, source_tag, rating, edited_response,
  assessment_id::varchar as assessment_id, is_correct::varchar as is_correct, expected_uris from eval_set""")
def eval_join_stream(spark, sf_dir):
    """The same as ``eval_join``, refreshed after each part of both logs."""
    asked, ask = _arriving(fx.request_log(spark, sf_dir), "requests")
    said, say = _arriving(fx.assessment_log(spark, sf_dir), "assessments")
    state = scratch_dir(spark)
    for number in range(REPLAYS):
        ask(number)
        say((2 * number + 1) % REPLAYS)
        found = refresh_evaluation_set(asked, said, state)
    return found.select(
        "request_id", "request", "response", "trace", "source_user", "source_tag", "rating", "edited_response",
        F.col("assessment_id").cast("string"), F.col("is_correct").cast("string"),
        _uris("expected_retrieved_context").alias("expected_uris"),
    )


@query(q.with_ctes(q.REQUESTS, q.ASSESSMENTS, q.EVAL_SET) + "select request_id, rating, expected_response from eval_set")
def eval_expected_response(spark, sf_dir):
    requests = fx.request_log(spark, sf_dir)
    last = newest_per(fx.assessment_log(spark, sf_dir), ["request_id"])
    joined = requests.join(last, "request_id", "left")
    return joined.select("request_id", "rating", expected_response().alias("expected_response"))


@query(q.with_ctes(q.REQUESTS, q.ASSESSMENTS, q.EVAL_SET) + "select request_id, n_uris, expected_uris from eval_set")
def eval_expected_context(spark, sf_dir):
    return _eval_set(spark, sf_dir).select(
        "request_id",
        F.coalesce(F.size("expected_retrieved_context"), F.lit(0)).cast("long").alias("n_uris"),
        _uris("expected_retrieved_context").alias("expected_uris"),
    )


@query(q.with_ctes(q.REQUESTS, q.ASSESSMENTS, q.EVAL_SET) + """
select request_id, request, response, trace, expected_response, expected_uris, is_correct::varchar as is_correct
from eval_set""")
def prj_eval_inspect(spark, sf_dir):
    rows = _eval_set(spark, sf_dir).select(*[F.col(c) for c in INSPECT_COLUMNS])
    rows = rows.withColumn("is_correct", F.col("is_correct").cast("string"))
    return rows.withColumn("expected_uris", _uris("expected_retrieved_context")).drop("expected_retrieved_context")


@query(q.with_ctes(q.REQUESTS, q.ASSESSMENTS, q.EVAL_SET) + """
select request, request_id, expected_response, expected_uris, source_user, source_tag from eval_set""")
def prj_eval_save(spark, sf_dir):
    rows = _eval_set(spark, sf_dir)[SAVED_COLUMNS]
    return rows.withColumn("expected_uris", _uris("expected_retrieved_context")).drop("expected_retrieved_context")


# --- metrics, labels, reports -----------------------------------------------------------------------------------


@query(q.with_ctes(q.RESULTS) + """
select request_id, coalesce(len(ratings), 0) as n_ratings, round(precision, 6) as precision from results""")
def met_chunk_precision(spark, sf_dir):
    results = fx.eval_results(spark, sf_dir)
    return results.select(
        "request_id",
        F.coalesce(F.array_size("ratings"), F.lit(0)).cast("long").alias("n_ratings"),
        F.round(chunk_precision("ratings"), 6).alias("precision"),
    )


@query(q.with_ctes(q.knn(K.ANN_RESULTS), q.PASSAGES, q.ASSESSMENTS) + """,
retrieved as (select distinct query_id, doc_uri from knn join passages using (chunk_id)),
expected as (
  select distinct user_id as query_id, liked as doc_uri
  from events join assessments on assessment_id = event_id where liked is not null),
sizes as (
  select query_id, (select count(*) from retrieved r where r.query_id = v.query_id) as n_retrieved,
    (select count(*) from expected e where e.query_id = v.query_id) as n_expected,
    (select count(*) from expected e join retrieved r using (query_id, doc_uri) where e.query_id = v.query_id) as n_hits
  from (select vec_id as query_id from embeddings) v)
select query_id, n_hits, case when n_expected > 0 then round(n_hits / n_expected, 6) end as recall,
  case when n_expected > 0 then round(n_hits / n_retrieved, 6) end as precision
from sizes""".replace("\n,", ",", 1))
def met_doc_recall(spark, sf_dir):
    hits = fetch_passages(
        _exact(spark, sf_dir, K.ANN_RESULTS), fx.passages(spark, sf_dir).drop("content_chunked"),
        ResultColumns(chunk_text="doc_uri", document_uri="lang"),
    )
    retrieved = hits.groupBy("query_id").agg(F.collect_list("doc_uri").alias("retrieved"))
    conversation = F.split_part("request_id", F.lit("-"), F.lit(1)).cast("long")
    expected = (
        fx.assessment_log(spark, sf_dir)
        .select(conversation.alias("query_id"), F.explode("liked_doc_uris").alias("doc_uri"))
        .distinct()
        .groupBy("query_id")
        .agg(F.collect_list("doc_uri").alias("expected"))
    )
    both = retrieved.join(expected, "query_id", "left").withColumn(
        "expected", F.coalesce("expected", F.array().cast("array<string>"))
    )
    return both.select(
        "query_id",
        document_hits("expected", "retrieved").cast("long").alias("n_hits"),
        F.round(document_recall("expected", "retrieved"), 6).alias("recall"),
        F.round(document_precision("expected", "retrieved"), 6).alias("precision"),
    )


@query(q.with_ctes(q.RESULTS, q.GAPS) + """
select count(*) as n_requests, count(precision) as n_precision, round(avg(precision), 6) as avg_precision,
  round(100.0 * count(*) filter (groundedness = 'yes') / count(groundedness), 6) as pct_groundedness,
  round(100.0 * count(*) filter (relevance = 'yes') / count(relevance), 6) as pct_relevance,
  round(100.0 * count(*) filter (correctness = 'yes') / count(correctness), 6) as pct_correctness
from gaps""")
def met_summary(spark, sf_dir):
    return summary_metrics(fx.eval_results_gaps(spark, sf_dir))


@query(q.with_ctes(q.RESULTS, q.GAPS, q.classified("gaps")) + """
select request_id, root_cause, assessment, rationale from labelled""")
def cls_root_cause_8(spark, sf_dir):
    labelled = classify(fx.eval_results_gaps(spark, sf_dir))
    return labelled.select("request_id", "root_cause", "assessment", "rationale")


@query(q.with_ctes(q.RESULTS, q.GAPS, q.classified("gaps", q.WITH_TRUTH)) + """
select request_id, root_cause, assessment, rationale from labelled""")
def cls_root_cause_11(spark, sf_dir):
    labelled = classify(fx.eval_results_gaps(spark, sf_dir), WITH_TRUTH)
    return labelled.select("request_id", "root_cause", "assessment", "rationale")


@query(q.with_ctes(q.RESULTS, q.GAPS) + f""",
told as (
  select * from (select unnest(['low', 'high', null]) as side), (select unnest(['yes', 'no', null]) as groundedness),
    (select unnest(['yes', 'no', null]) as correctness), (select unnest(['yes', 'no', null]) as relevance)),
matched as (
  select t.*, count(k.root_cause) as n_rules from told t left join (values {{q.WITH_TRUTH}}) k(side, g, c, r, root_cause, a, b)
    on k.side = t.side and k.g = t.groundedness and k.c = t.correctness and (k.r is null or k.r = t.relevance)
  group by all)
select m.*, count(g.request_id) as n_results from matched m left join gaps g
  on m.side is not distinct from case when precision < 0.5 then 'low' when precision >= 0.5 then 'high' end
  and m.groundedness is not distinct from g.groundedness and m.correctness is not distinct from g.correctness
  and m.relevance is not distinct from g.relevance
group by all""".replace("\n,", ",", 1).replace("{q.WITH_TRUTH}", q.WITH_TRUTH))
def cls_rule_coverage(spark, sf_dir):
    """Every case that the eleven rules tell apart, the rules and the results in it: no rule and some results is a gap."""
    return rule_coverage(fx.eval_results_gaps(spark, sf_dir), WITH_TRUTH)


def _freq_sql(column: str) -> str:
    return q.with_ctes(q.RESULTS, q.GAPS, q.classified("gaps")) + f"""
select {column}, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (), 6) as pct
from labelled where {column} is not null group by 1"""


@query(_freq_sql("root_cause"))
def agg_root_cause_freq(spark, sf_dir):
    return frequencies(classify(fx.eval_results_gaps(spark, sf_dir)), "root_cause")


@query(_freq_sql("rationale"))
def agg_rationale_freq(spark, sf_dir):
    return frequencies(classify(fx.eval_results_gaps(spark, sf_dir)), "rationale")


_REPORT_SQL = """
select request_id, root_cause as "overall/root_cause/rating", assessment as "overall/assessment",
  rationale as "overall/root_cause/rationale", trace, relevance as "response/llm_judged/relevance_to_query/rating",
  groundedness as "response/llm_judged/groundedness/rating",
  array_to_string(ratings, ',') as "retrieval/llm_judged/chunk_relevance/ratings",
  precision as "retrieval/llm_judged/chunk_relevance/precision"
from labelled"""


def _report(spark, sf_dir):
    """Labelled results; the ratings as text, so that results compare by value."""
    labelled = classify(fx.eval_results(spark, sf_dir))
    return labelled.withColumn("ratings", F.array_join("ratings", ","))


@query(q.with_ctes(q.RESULTS, q.classified("results")) + _REPORT_SQL)
def prj_tolerant(spark, sf_dir):
    return tolerant_select(with_report_names(_report(spark, sf_dir)))


@query(q.with_ctes(q.RESULTS, q.classified("results")) + _REPORT_SQL + " where root_cause = 'Improve Retrieval'")
def flt_retrieval_issues(spark, sf_dir):
    return issue_report(_report(spark, sf_dir), K.IMPROVE_RETRIEVAL)


@query(q.with_ctes(q.RESULTS, q.classified("results")) + _REPORT_SQL + " where root_cause = 'Improve Generation'")
def flt_generation_issues(spark, sf_dir):
    return issue_report(_report(spark, sf_dir), K.IMPROVE_GENERATION)


@query(q.with_ctes(q.RESULTS, q.classified("results")) + """
select count(*) filter (root_cause = 'Improve Retrieval') = 0 as no_retrieval_issue,
  count(*) filter (root_cause = 'Improve Generation') = 0 as no_generation_issue,
  count(*) filter (root_cause = 'Other') = 0 as no_other_issue
from labelled""")
def empty_report(spark, sf_dir):
    labelled = spill(classify(fx.eval_results(spark, sf_dir)))
    causes = (K.IMPROVE_RETRIEVAL, K.IMPROVE_GENERATION, "Other")
    flags = tuple(is_empty(issue_report(labelled, cause)) for cause in causes)
    return spark.createDataFrame([flags], "no_retrieval_issue boolean, no_generation_issue boolean, no_other_issue boolean")
