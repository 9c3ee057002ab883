"""Registered queries of the training-data operators and, where SQL can say the same, their DuckDB form."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.alignment import alignments
from corpusmill.llm.best_fit import best_fit
from corpusmill.llm.exact_stream import exact_duplicates
from corpusmill.llm.hard_negatives import hard_negatives
from corpusmill.llm.lines import judged_documents, kept_text
from corpusmill.llm.mixing import mixed_documents
from corpusmill.llm.ngram_join import ngram_classes
from corpusmill.llm.packing import pack
from corpusmill.llm.quality import quality_scores
from corpusmill.llm.substrings import repeated_passages
from corpusmill.llm.token_spans import token_counts
from corpusmill.llm.vector_graph import near_vectors
from corpusmill.llm.warc import captures

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL form if there is one."""

    def register(fn: Query) -> Query:
        _queries[fn.__name__] = fn
        if sql:
            _oracles[fn.__name__] = sql
        return fn

    return register


def registered() -> dict[str, Query]:
    return dict(_queries)


def oracles() -> dict[str, str]:
    return dict(_oracles)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("""
with l as (
  select doc_id, line_no, list_filter(string_split_regex(line, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w
  from (
    select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as line_no
    from documents where text is not null)),
d as (
  select array_to_string(w, ' ') as line, any_value(w) as w, min({'doc_id': doc_id, 'line_no': line_no}) as first
  from l where len(w) > 0 group by 1),
v as (
  select line, first, len(w) as n, i, array_to_string(list_concat(w[:i - 1], w[i + 1:]), ' ') as cut
  from (select line, first, w, unnest(range(1, len(w) + 1)) as i from d)),
replaced as (
  select line from v join (select n, i, cut, min(first) as one from v where n >= 5 group by all) g using (n, i, cut)
  where g.one < v.first),
longer as (select v.line from v join d on v.cut = d.line and len(d.w) >= 5 where d.first < v.first),
shorter as (select d.line from v join d on v.cut = d.line and len(d.w) >= 5 where v.first < d.first),
gone as (
  select l.doc_id, l.line_no from l join d on array_to_string(l.w, ' ') = d.line
  where {'doc_id': l.doc_id, 'line_no': l.line_no} <> d.first
     or d.line in (select line from replaced union select line from longer union select line from shorter)),
kept as (
  select documents.doc_id, x.line_no, x.line, gone.line_no is not null as out
  from documents, (select doc_id as i, unnest(string_split(text, chr(10))) as line,
                          generate_subscripts(string_split(text, chr(10)), 1) - 1 as line_no from documents) x
  left join gone on gone.doc_id = x.i and gone.line_no = x.line_no where documents.doc_id = x.i)
select doc_id, count(*) as n_lines, count(*) filter (out) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by line_no) filter (not out), '')) as kept_sha256
from kept group by doc_id""")
def op1_line_dedup(spark, sf_dir):
    judged = judged_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), min_words=5)
    return judged.select(
        "doc_id",
        F.size(F.split("text", "\n", -1)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(kept_text(), 256).alias("kept_sha256"),
    )


@query("""
with p as (select page_id, url, coalesce(html, '') as payload from pages),
s as (select *, sha1(payload) as hex, max(page_id) over (partition by payload) as top from p),
groups as (
  select page_id, payload, top, list_transform(range(8), lambda g: ('0x' || substr(hex, 5 * g + 1, 5))::bigint) as twenty from s)
select page_id, octet_length(encode(payload)) as payload_bytes,
  array_to_string(list_transform(twenty, lambda v: array_to_string(list_transform([15, 10, 5, 0],
    lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> b) & 31)::int + 1, 1)), '')), '') as payload_digest,
  case when page_id = top then 'response' else 'revisit' end as record_type,
  case when page_id <> top then top end as refers_to
from groups""")
def op2_warc(spark, sf_dir):
    found = captures(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("""
with d as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') as bare, length(coalesce(text, '')) as n
  from documents),
g as (select bare, first(doc_id order by n desc, doc_id) as keep_id, count(*) as group_size from d group by bare)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(bare) as text_sha256 from d join g using (bare)""")
def op3_exact_dedup(spark, sf_dir):
    return exact_duplicates(spark, f"{sf_dir}/documents.parquet")


@query()
def op4_quality(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


@query()
def op5_ngram_join(spark, sf_dir):
    return ngram_classes(table(spark, sf_dir, "documents"), n=4, threshold=(85, 100))


@query("""
with docs as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
         ('0x' || substr(md5('7:' || coalesce(doc_id::varchar, 'null')), 1, 15))::bigint as key
  from documents),
sources as (
  select source, sum(size)::bigint as source_size,
         ((row_number() over (order by source nulls last) - 1) % 3 + 1)::double as w
  from docs group by source),
ordered as (
  select *, sum(source_size) over () - coalesce(sum(3 * source_size) over (
             order by 3 * source_size / w, source nulls last rows between unbounded preceding and 1 preceding), 0) as remaining,
         sum(w) over (order by 3 * source_size / w, source nulls last rows between current row and unbounded following) as w_left
  from sources),
marked as (select *, 3 * source_size * w_left < remaining * w as capped from ordered),
level as (select remaining, w_left from marked where not capped order by w_left desc limit 1),
targets as (
  select source, source_size,
         case when capped then (3 * source_size)::double
              else (select remaining from level)::double * w / (select w_left from level) end as target
  from marked),
placed as (
  select docs.*, coalesce(sum(size) over (
           partition by source order by key, doc_id rows between unbounded preceding and 1 preceding), 0) as start
  from docs)
select doc_id, size, source_size, target,
       (case when source_size = 0 then 0 else
          (floor(target)::bigint // source_size) * size
          + greatest(0, least(size, floor(target)::bigint % source_size - start)) end)::bigint as taken
from placed join targets on placed.source is not distinct from targets.source""")
def op9_mixing(spark, sf_dir):
    return mixed_documents(table(spark, sf_dir, "documents"), weights=(1, 2, 3), max_epochs=3)


@query("""
with w as (
  select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
runs as (
  select doc_id, i, array_to_string(w[i:i + 49], ' ') as run
  from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from w where len(w) >= 50)),
hits as (select doc_id, i from runs join (select run, min(doc_id) as first from runs group by run) using (run) where first < doc_id),
gone as (select distinct doc_id, unnest(range(i, i + 50)) as p from hits),
words as (select doc_id, w[p] as word, p from (select doc_id, w, unnest(range(1, len(w) + 1)) as p from w)),
kept as (
  select words.doc_id, count(gone.p) as n_removed, string_agg(word, ' ' order by words.p) filter (gone.p is null) as rest
  from words left join gone using (doc_id, p) group by words.doc_id)
select w.doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(rest, '')) as kept_sha256
from w left join kept using (doc_id)""")
def op10_substring_dedup(spark, sf_dir):
    found = repeated_passages(table(spark, sf_dir, "documents"), window=50)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query()
def op6_near_vectors(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


@query()
def op7_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), rule="first", added_tokens=True)


@query()
def op8_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), length=2048, end_id=1, added_tokens=True)


@query()
def op11_best_fit(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return best_fit(documents, public_tokenizers.path("word_bpe_49k.json"), length=4096, end_id=1, added_tokens=True)


@query()
def op12_alignment(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return alignments(documents, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


@query("""
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as e
  from embeddings
  where label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
scores as (
  select a.vec_id as anchor_id, c.vec_id as other_id, a.label = c.label as same,
         list_sum(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * c.e[i]))::bigint as score
  from v a join v c on a.vec_id % 50 = 0 and a.vec_id <> c.vec_id),
pos as (
  select anchor_id, other_id as positive_id, score as positive_score from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select anchor_id, positive_id, (row_number() over w)::int as rank, other_id as negative_id, positive_score, score as negative_score
from pos join scores using (anchor_id)
where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
window w as (partition by anchor_id, positive_id order by score desc, other_id)
qualify row_number() over w <= 3""")
def op13_hard_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", "embedding", label.alias("label")), anchor=F.col("id") % 50 == 0)
