"""DuckDB twins of the derived inputs, as common table expressions."""

from __future__ import annotations

from corpusmill import constants as K

# White space as str.split() sees it, in RE2's notation.
SPACE = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def lit(s: str) -> str:
    """SQL string literal; line breaks are spelled out."""
    quoted = s.replace("'", "''")
    if "\n" not in quoted:
        return f"'{quoted}'"
    return "('" + quoted.replace("\n", "' || chr(10) || '") + "')"


def replace_all(expr: str, pattern: str, to: str) -> str:
    return f"regexp_replace({expr}, {lit(pattern)}, {lit(to)}, 'g')"


def strip(expr: str) -> str:
    return replace_all(expr, rf"^{SPACE}+|{SPACE}+\z", "")


def squeeze(expr: str) -> str:
    return replace_all(strip(expr), r"\n{3,}", "\n\n")


def markdown(expr: str) -> str:
    """HTML as Markdown, for what the given pages and the page of odd elements hold."""
    for element in ("script", "style"):
        expr = replace_all(expr, f"(?is)<{element}[^>]*>.*?</{element} *>", "")
    expr = replace_all(expr, "(?s)<!--.*?-->", "")
    for level in (1, 2, 3, 4, 5, 6):
        expr = f"regexp_replace({expr}, '(?i)<h{level}( [^>]*)?>', chr(10) || chr(10) || repeat('#', {level}) || ' ', 'g')"
    two = "\n\n"
    for pattern, to in (
        ("(?i)</h[123456]>", two),
        ('(?is)<img src="([^"]*)" alt="([^"]*)">', r"![\2](\1)"),
        ('(?is)<a [^>]*href="([^"]*)"[^>]*>(.*?)</a>', r"[\2](\1)"),
        ("(?is)<a [^>]*href='([^']*)'[^>]*>(.*?)</a>", r"[\2](\1)"),
        ("(?is)<pre>(.*?)</pre>", "\n\n```\n\\1\n```\n\n"),
        ("(?i)</?code>", "`"),
        ("(?i)</?(?:b|strong)( [^>]*)?>", "**"),
        ("(?i)</?(?:i|em)( [^>]*)?>", "*"),
        ("(?i)<li( [^>]*)?>", "\n* "),
        ("(?i)<hr( [^>]*)?/?>", "\n\n---\n\n"),
        ("(?i)<tr( [^>]*)?>", "\n| "),
        ("(?i)</t[dh]>", " | "),
        ("(?i)</?(?:p|div|article|section|header|footer|nav|main|title|ul|ol|br|table|blockquote)( [^>]*)?/?>", two),
        ("(?s)<[^>]*>", ""),
    ):
        expr = replace_all(expr, pattern, to)
    for name, char in (
        ("&#8211;", "–"), ("&#x4e2d;", "中"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "),
        ("&copy;", "©"), ("&middot;", "·"), ("&mdash;", "—"), ("&amp;", "&"),
    ):
        expr = f"replace({expr}, {lit(name)}, {lit(char)})"
    lines = f"array_to_string(list_transform(string_split({expr}, chr(10)), lambda l: trim(l, ' ' || chr(9))), chr(10))"
    return squeeze(lines)


def extension(expr: str) -> str:
    """By the last segment: its suffix from the last dot, unless the dot leads the name."""
    name = f"list_last(string_split({expr}, '/'))"
    return f"(case when strpos({name}[2:], '.') > 0 then '.' || list_last(string_split({name}, '.')) else '' end)"


def doc_uri(expr: str) -> str:
    """What follows the host of a URL, up to the first mark of a query, a fragment or parameters."""
    bare = f"string_split(string_split({expr}, '#')[1], '?')[1]"
    rest = f"(case when strpos({bare}, '://') > 0 then array_to_string(string_split({bare}, '/')[4:], '/') else substr({bare}, strpos({bare}, ':') + 1) end)"
    return f"ltrim({rest}, '/')"


def parsed(source: str, key: str, path: str, content: str, exts: str) -> str:
    """SELECT of parsed documents from a source; ``content`` is the text when parsed."""
    ok = f"{extension(path)} in ({exts})"
    return f"""
      select {key} as src_key,
        case when {ok} then {content} else '' end as doc_content,
        case when {ok} then 'SUCCESS'
          else {lit(K.ERROR_PREFIX + K.NO_PARSER)} || {path} end as parser_status,
        case when {ok} then {doc_uri(path)} end as doc_uri,
        case when {ok} then case when contains({content}, 'test') then 'test' else 'not test' end
          end as example_metadata,
        case when {ok} then ({key} + 1704067200)::varchar end as last_modified_s
      from {source}"""


DOC_PATH = "('file:/corpus/' || source || '/' || doc_id || '.txt')"
MIXED_PATH = "('file:/corpus/' || source || '/' || doc_id || case when source = 'src7' then '.pdf' else '.txt' end)"
SAVED_PATH = "('file:/pages/' || page_id || '.html')"
PAGE_PATH = replace_all("url", r"/\z", "/index.html")

DOCS = "docs as (" + parsed("documents", "doc_id", DOC_PATH, "text", "'.txt'") + ")"
MIXED_DOCS = "docs as (" + parsed("documents", "doc_id", MIXED_PATH, "text", "'.txt'") + ")"
SAVED_PAGES = (
    "saved_pages as ("
    + parsed(f"(select *, {markdown('html')} as md from pages)", "page_id", SAVED_PATH, "md", "'.html'")
    + ")"
)
PARSED_PAGES = (
    "parsed_pages as ("
    + parsed(f"(select *, {markdown('html')} as md from pages)", "page_id", PAGE_PATH, "md", "'.html'")
    + ")"
)
TOKENS = f"list_filter(regexp_split_to_array(doc_content, {lit(SPACE + '+')}), lambda t: t <> '')"
CHUNKS = f"""
words as (select *, {TOKENS} as w from docs where parser_status = 'SUCCESS'),
windows as (
  select *, unnest(range(0, greatest(0, ceil((len(w) - 384) / 256.0))::bigint + 1)) as chunk_index from words),
chunks as (
  select md5(doc_uri || '|' || chunk_index) as chunk_id, chunk_index,
    array_to_string(w[chunk_index * 256 + 1 : chunk_index * 256 + 384], ' ') as content_chunked,
    parser_status, doc_uri, example_metadata, last_modified_s
  from windows where len(w) > 0)"""

def count_tokens(expr: str) -> str:
    return f"len(list_filter(regexp_split_to_array({expr}, {lit(SPACE + '+')}), lambda t: t <> ''))"


_PIECES = "list_filter(string_split(piece, cut), lambda p: p <> '')"
_JOINED = "case sep " + " ".join(
    f"when {sep} then array_to_string(parts[s + 1 : e], {sep})" for sep in ("chr(10) || chr(10)", "chr(10)", "' '", "''")
) + " end"
# Pieces down to those of at most 384 tokens, runs of neighbours that fit, windows of a run by its running sums.
RECURSIVE_CHUNKS = f"""
tree as (
  select src_key, []::bigint[] as parent, 0::bigint as place, doc_content as piece, '' as sep, true as large
  from docs where parser_status = 'SUCCESS'
  union all
  select src_key, list_append(parent, place), i, p, cut, {count_tokens('p')} > 384
  from (
    select src_key, parent, place, cut, unnest({_PIECES}) as p, unnest(range(len({_PIECES}))) as i
    from (
      select *, case when contains(piece, chr(10) || chr(10)) then chr(10) || chr(10)
        when contains(piece, chr(10)) then chr(10) when contains(piece, ' ') then ' ' else '' end as cut
      from tree where large))),
pieces as (
  select *, sum(large::int) over (partition by src_key, parent order by place) as run, {count_tokens('piece')} as n
  from tree where len(parent) > 0),
runs as (
  select src_key, parent, min(place) as place, any_value(sep) as sep, list(piece order by place) as parts,
    list_concat([0], list(reach order by place)) as reach
  from (
    select *, sum(n) over (partition by src_key, parent, run order by place)::bigint as reach from pieces where not large)
  group by src_key, parent, run),
cuts as (
  select src_key, parent, place, 0::bigint as s, len(list_filter(reach, lambda x: x <= 384)) - 1 as e from runs
  union all
  select src_key, parent, place, next, len(list_filter(reach, lambda x: x <= reach[next + 1] + 384)) - 1
  from (
    select c.*, reach, least(e, greatest(s + 1,
      len(list_filter(reach, lambda x: x < greatest(reach[e + 1] - 128, reach[e + 2] - 384))))) as next
    from cuts c join runs using (src_key, parent, place) where e < len(parts))),
recursive_chunks as (
  select src_key, row_number() over (partition by src_key order by list_append(parent, place), s) - 1 as chunk_index, chunk
  from (
    select *, {strip(_JOINED)} as chunk
    from cuts join runs using (src_key, parent, place))
  where chunk <> '')"""

PASSAGES = """passages as (
  select doc_id as chunk_id, text as content_chunked, 'corpus/' || source || '/' || doc_id || '.txt' as doc_uri, lang
  from documents)"""


def cosine(a: str, b: str) -> str:
    return f"round(list_cosine_similarity({a}::double[], {b}::double[]), 6)"


def knn(k: int) -> str:
    return f"""knn as (
  select q.vec_id as query_id, v.vec_id as chunk_id, {cosine('q.embedding', 'v.embedding')} as score,
    row_number() over (partition by q.vec_id order by {cosine('q.embedding', 'v.embedding')} desc, v.vec_id) as rank
  from embeddings q join embeddings v on q.vec_id <> v.vec_id
  qualify rank <= {k})"""


CELLS = 32
PROBES = 4
PROMPT_TOKENS = 1500
VARIETY = 30
IVF = f"""pivots as (
  select row_number() over (order by md5(vec_id::varchar), vec_id) - 1 as cell, embedding as centroid
  from embeddings qualify cell < {CELLS}),
near as (
  select vec_id, embedding, cell, {cosine('embedding', 'centroid')} as cell_score,
    row_number() over (partition by vec_id order by {cosine('embedding', 'centroid')} desc, cell) as place
  from embeddings, pivots),
ann as (
  select q.vec_id as query_id, v.vec_id as chunk_id, {cosine('q.embedding', 'v.embedding')} as score,
    row_number() over (partition by q.vec_id order by {cosine('q.embedding', 'v.embedding')} desc, v.vec_id) as rank
  from near q join near v on q.cell = v.cell and q.vec_id <> v.vec_id
  where q.place <= {PROBES} and v.place = 1
  qualify rank <= 16)"""

CODE_PARTS = 16
CODES = 64
SURVIVORS = 64
_UNIT = "list_transform(embedding, lambda x: x::double / sqrt(list_dot_product(embedding::double[], embedding::double[])))"
_WIDTH = f"(len(e) // {CODE_PARTS})"
# Needs ``near`` of IVF: code words by digest, the nearest word of every part, scores as sums of a table, the true cosine.
CODED = f"""units as (select vec_id, {_UNIT} as e, md5(vec_id::varchar) as digest from embeddings),
cut as (
  select vec_id, digest, part, e[part * {_WIDTH} + 1 : (part + 1) * {_WIDTH}] as x
  from units, (select unnest(range(0, {CODE_PARTS})) as part)),
book as (
  select part, row_number() over (partition by part order by digest, vec_id) - 1 as code, x as word
  from cut qualify code < {CODES}),
products as (
  select vec_id, part, code, list_dot_product(x, word) as product, list_dot_product(word, word) / 2 as half
  from cut join book using (part)),
codes as (
  select vec_id, part, code
  from products qualify row_number() over (partition by vec_id, part order by round(product - half, 6) desc, code) = 1),
scored as (
  select q.vec_id as query_id, v.vec_id as chunk_id, sum(round(t.product * 1e6)::bigint) as points
  from near q join near v on q.cell = v.cell and q.vec_id <> v.vec_id
    join codes c on c.vec_id = v.vec_id
    join products t on t.vec_id = q.vec_id and t.part = c.part and t.code = c.code
  where q.place <= {PROBES} and v.place = 1 group by 1, 2),
survivors as (
  select query_id, chunk_id from scored
  qualify row_number() over (partition by query_id order by points desc, chunk_id) <= {SURVIVORS}),
by_codes as (
  select query_id, chunk_id, {cosine('q.embedding', 'v.embedding')} as score,
    row_number() over (partition by query_id order by {cosine('q.embedding', 'v.embedding')} desc, chunk_id) as rank
  from survivors join embeddings q on q.vec_id = query_id join embeddings v on v.vec_id = chunk_id
  qualify rank <= 16)"""


def bm25(asked: str, k: int) -> str:
    """CTE ``bm25``: the best documents by their words for a SELECT of (query_id, text), by the formula over all pairs."""
    split = lambda text: f"regexp_split_to_array(lower({text}), {lit(r'[^\p{L}\p{N}]+')})"
    return f"""posts as (
  select doc_id, t, count(*)::double as tf
  from (select doc_id, unnest({split('text')}) as t from documents) where t <> '' group by all),
sized as (select *, sum(tf) over (partition by doc_id) as len from posts),
corpus as (select count(distinct doc_id)::double as n, sum(tf) / count(distinct doc_id) as mean from posts),
holders as (select t, count(*)::double as df from posts group by 1),
weights as (
  select doc_id, t, round(
    ln(1.0::double + (n - df + 0.5::double) / (df + 0.5::double))
    * (tf * 2.2::double / (tf + 1.2::double * (0.25::double + 0.75::double * len / mean))) * 1e6::double)::bigint as weight
  from sized join holders using (t), corpus),
wanted as (select distinct query_id, t from (select query_id, unnest({split('text')}) as t from ({asked}))),
bm25 as (
  select query_id, doc_id as chunk_id, round(sum(weight) / 1e6::double, 6) as score,
    row_number() over (partition by query_id order by sum(weight) desc, doc_id) as rank
  from wanted join weights using (t) group by 1, 2 having sum(weight) > 0 qualify rank <= {k})"""


REQUESTS = """requests as (
  select * from (
    select conv_id || '-' || turn as request_id, conv_id, turn, text as request, role,
      case when lead(role) over w = 'assistant' then lead(text) over w end as response,
      'trace-' || conv_id || '-' || turn as trace
    from conversations window w as (partition by conv_id order by turn))
  where role = 'user')"""

ASSESSMENTS = """assessments as (
  select user_id || '-' || ((event_id * 7) % 8) as request_id, 'u' || (event_id % 3) as source_user,
    event_type as source_tag,
    case when event_type in ('click', 'purchase', 'signup') then 'yes' when event_type = 'error' then 'no' end as rating,
    case when event_type = 'signup' or (event_type = 'error' and value > 10) then props end as edited_response,
    case when event_type = 'click' then 'corpus/src' || ((props->>'$.k')::bigint % 20) || '/'
      || (props->>'$.k')::bigint || '.txt' end as liked,
    ts, event_id as assessment_id
  from events),
last_words as (
  select * from assessments qualify row_number() over (
    partition by request_id, source_user, source_tag order by ts desc, assessment_id desc) = 1)"""

EVAL_SET = """one as (
  select * from last_words qualify row_number() over (
    partition by request_id order by ts desc, assessment_id desc) = 1),
liked as (select distinct request_id, liked from last_words where liked is not null),
context as (
  select request_id, string_agg(liked, ',' order by liked) as expected_uris, count(*) as n_uris
  from liked group by 1),
eval_set as (
  select r.*, o.source_user, o.source_tag, o.rating, o.edited_response, o.assessment_id, c.expected_uris,
    coalesce(c.n_uris, 0) as n_uris,
    case when o.rating = 'yes' then coalesce(o.edited_response, r.response)
      when o.rating = 'no' then o.edited_response end as expected_response,
    o.rating = 'yes' as is_correct
  from requests r left join one o using (request_id) left join context c using (request_id))"""

RESULTS = """results as (
  select 'r' || l.doc_id as request_id, case when quality = 1 then 'yes' else 'no' end as groundedness,
    case when toxic = 0 and n_chars >= 500 then 'yes' else 'no' end as relevance,
    case when n_chars % 2 = 0 then 'yes' else 'no' end as correctness,
    [case when x >= 0 then 'yes' else 'no' end for x in embedding] as ratings,
    'trace-' || l.doc_id as trace, lang, source,
    len([x for x in embedding if x >= 0]) / len(embedding) as precision
  from labels l join documents d on d.doc_id = l.doc_id left join embeddings e on e.vec_id = l.doc_id)"""

GAPS = """gaps as (
  select * replace (
    case when source = 'src3' then null else precision end as precision,
    case when lang <> 'de' then groundedness end as groundedness)
  from results)"""


# Share of relevant chunks below one half (low) or not (high); grounded; correct; relevant; the labels.
WITHOUT_TRUTH = """
  ('low', 'no', null, 'no', 'Improve Retrieval', 'fail', 'Retrieval quality is poor.'),
  ('low', 'no', null, 'yes', 'Improve Retrieval', 'fail', 'Retrieval quality is poor.'),
  ('low', 'yes', null, 'no', 'Improve Retrieval', 'fail', 'Response is grounded in retrieval, but retrieval is poor.'),
  ('low', 'yes', null, 'yes', 'Improve Retrieval', 'pass',
   'Relevant response grounded in the retrieved context and relevant, but retrieval is poor.'),
  ('high', 'no', null, 'no', 'Improve Generation', 'fail', 'Hallucination'),
  ('high', 'no', null, 'yes', 'Improve Generation', 'fail', 'Hallucination'),
  ('high', 'yes', null, 'no', 'Improve Generation', 'fail',
   'Good retrieval & grounded, but LLM does not provide a relevant response.'),
  ('high', 'yes', null, 'yes', 'No root cause, record passed', 'pass',
   'Good retrieval and relevant response. Collect ground-truth to know if the answer is correct.')"""
WITH_TRUTH = """
  ('low', 'no', 'no', 'no', 'Improve Retrieval', 'fail', 'Retrieval is poor.'),
  ('low', 'no', 'no', 'yes', 'Improve Retrieval', 'fail',
   'LLM generates relevant response, but retrieval is poor e.g., the LLM ignores retrieval and uses its training knowledge to answer.'),
  ('low', 'no', 'yes', null, 'Improve Retrieval', 'fail',
   'Retrieval quality is poor, but LLM gets the answer correct regardless.'),
  ('low', 'yes', 'no', 'no', 'Improve Retrieval', 'fail', 'Response is grounded in retrieval, but retrieval is poor.'),
  ('low', 'yes', 'no', 'yes', 'Improve Retrieval', 'fail',
   'Relevant response grounded in the retrieved context, but retrieval may not be related to the expected answer.'),
  ('low', 'yes', 'yes', null, 'No root cause, record passed', 'pass',
   'Retrieval finds enough information for the LLM to correctly answer.'),
  ('high', 'no', 'no', null, 'Improve Generation', 'fail', 'Hallucination'),
  ('high', 'no', 'yes', null, 'Improve Generation', 'fail', 'Hallucination, correct but generates details not in context'),
  ('high', 'yes', 'no', 'no', 'Improve Generation', 'fail',
   'Good retrieval, but the LLM does not provide a relevant response.'),
  ('high', 'yes', 'no', 'yes', 'Improve Generation', 'fail', 'Good retrieval and relevant response, but not correct.'),
  ('high', 'yes', 'yes', 'yes', 'No root cause, record passed', 'pass', 'No issues.')"""


def classified(source: str, rules: str = WITHOUT_TRUTH) -> str:
    """CTE ``labelled``: the source with root_cause, assessment, rationale."""
    return f"""rules as (
  select * from (values {rules})
    t(side, g, c, r, root_cause, assessment, rationale)),
labelled as (
  select s.*, t.root_cause, t.assessment, t.rationale
  from {source} s left join rules t on t.side = case when s.precision < 0.5 then 'low' when s.precision >= 0.5 then 'high' end
    and t.g = s.groundedness and (t.c is null or t.c = s.correctness) and (t.r is null or t.r = s.relevance))"""


def with_ctes(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def with_recursive(*ctes: str) -> str:
    return "with recursive " + ",\n".join(ctes) + "\n"
