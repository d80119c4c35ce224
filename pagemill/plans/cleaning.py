"""Queries on cleaning modes, token tables, metrics and limits."""

from pyspark.sql import functions as F

from pagemill.functions.entities import decode_entities
from pagemill.functions.text import collapse_lines
from pagemill.operators import clean, limits, metrics, tokens
from pagemill.operators.fetch import fetch_job
from pagemill.operators.markdown import html_to_markdown
from pagemill.plans import sql as Q
from pagemill.plans.registry import query
from pagemill.session import spread, table
from pagemill.sources.responses import response_log

R = Q.RESPONSES


def pages(spark, folder, *columns):
    return spread(table(spark, folder, "pages", *(columns or ("page_id", "html"))), "page_id")


def _strip_query(mode, sql):
    @query(f"strip_{mode}", f"select page_id, {sql} as text from pages")
    def run(spark, folder):
        return pages(spark, folder).select("page_id", clean.ROW_LOCAL[mode](F.col("html")).alias("text"))


_strip_query("none", "html")
_strip_query("whitespace", Q.whitespace("html"))
_strip_query("attributes", Q.attributes("html"))
_strip_query("tags", Q.tags("html"))


@query("collapse_preserve_lines", f"select doc_id, {Q.lines('text')} as text from documents")
def q_collapse_lines(spark, folder):
    docs = spread(table(spark, folder, "documents", "doc_id", "text"))
    return docs.select("doc_id", collapse_lines(F.col("text")).alias("text"))


@query("entity_decode", f"select page_id, {Q.decode('html')} as text from pages")
def q_entity_decode(spark, folder):
    return pages(spark, folder).select("page_id", decode_entities(F.col("html")).alias("text"))


@query("entity_usage", """
select name, name in ('amp', 'copy', 'quot', 'lt', 'gt', 'nbsp', 'apos') as known, count(*) as uses
from (select unnest(regexp_extract_all(html, '&([A-Za-z0-9]{1,10}|#[0-9]{1,8}|#[xX][0-9a-fA-F]{1,7});', 1)) as name from pages)
group by all""")
def q_entity_usage(spark, folder):
    return clean.entity_usage(pages(spark, folder), [], "html").select("name", "known", "uses")


@query("whitespace_profile", f"""
select source, sum(length(raw_text) - length({Q.sub('raw_text', Q.WS, "''")}))::bigint as whitespace,
  sum(length(raw_text))::bigint as chars
from {R} where source <> 'embeddings' group by source""")
def q_whitespace_profile(spark, folder):
    log = response_log(spark, folder, ("pages", "documents", "events", "conversations"))
    return clean.whitespace_profile(log, ["source"], "raw_text")


_MODE = "case page_id % 5 when 0 then 'none' when 1 then 'whitespace' when 2 then 'attributes' when 3 then 'tags' else 'keep' end"


@query("apply_strip", f"""
select source, id, applied, md5(case when source <> 'pages' then raw_text when applied = 'whitespace' then {Q.whitespace('raw_text')}
  when applied = 'attributes' then {Q.attributes('raw_text')} when applied = 'tags' then {Q.tags('raw_text')}
  else raw_text end) as digest
from (select *, case when source <> 'pages' then 'none' else {_MODE.replace('page_id', 'id')} end as applied
      from {R} where source in ('pages', 'documents', 'events'))""")
def q_apply_strip(spark, folder):
    """Each response cleaned by the mode asked for; an unknown mode and non-HTML change nothing."""
    log = response_log(spark, folder, ("pages", "documents", "events")).withColumn(
        "requested", F.expr(_MODE.replace("page_id", "id")))
    rows = log.withColumn("applied", clean.resolve_strip(F.col("requested"), F.col("content_type")))
    done = clean.apply_strip(rows, "raw_text", "applied", "stripped", ["source", "id"],
                             ("none", "whitespace", "attributes", "tags"))
    return done.select("source", "id", "applied", F.md5(F.encode("stripped", "UTF-8")).alias("digest"))


# ---- token tables ---------------------------------------------------------------------
_TOKEN_RE = "(?is)<!--.*?-->|<!doctype[^>]*>|<style[^>]*>|<script[^>]*>|</[a-z0-9]+>|<[a-z][^>]*>|[^<]+"
_TOKENS = f"""(
  select page_id, pos - 1 as pos, tok, case when tok like '<!--%' then 'comment' when lower(tok) like '<!doctype%' then 'doctype'
      when tok like '<%' then 'tag' else 'text' end as kind
  from (select page_id, unnest(toks) as tok, generate_subscripts(toks, 1) as pos
        from (select page_id, regexp_extract_all(replace(html, '="</p>"', '="{{p}}"'), '{_TOKEN_RE}') as toks from pages)))"""
_NAME = "case when kind = 'tag' then lower(regexp_extract(tok, '^</?([a-zA-Z0-9]+)', 1)) end"
_DATA = """replace(case kind when 'text' then tok when 'comment' then tok[5:length(tok) - 3]
  when 'doctype' then tok[10:length(tok) - 1] end, '="{p}"', '="</p>"')"""


@query("html_tokens", f"""
select page_id, pos, kind, {_NAME} as name, kind = 'tag' and tok like '</%' as is_closing, false as self_closing,
  case when kind = 'tag' and tok not like '</%' then len(regexp_extract_all(tok, '[a-z]+="[^"]*"')) end as attrs,
  {_DATA} as data from {_TOKENS}""")
def q_html_tokens(spark, folder):
    return tokens.html_tokens(pages(spark, folder)).select(
        "page_id", "pos", "kind", "name", "is_closing", "self_closing",
        F.when(F.col("attributes").isNotNull(), F.size("attributes").cast("bigint")).alias("attrs"), "data")


@query("token_counts", f"""
select page_id, kind, count(*) as n, sum(length(replace(tok, '{{p}}', '</p>')))::bigint as chars from {_TOKENS} group by all""")
def q_token_counts(spark, folder):
    return tokens.token_counts(pages(spark, folder))


@query("html_attributes", f"""
select page_id, pos, tag, idx - 1 as idx, regexp_extract(a, '^([a-z]+)=', 1) as name, regexp_extract(a, '="(.*)"', 1) as value,
  {Q.decode("regexp_extract(a, '=\"(.*)\"', 1)")} as decoded
from (select page_id, pos, {_NAME} as tag, unnest(regexp_extract_all(tok, '[a-z]+="[^"]*"')) as a,
        generate_subscripts(regexp_extract_all(tok, '[a-z]+="[^"]*"'), 1) as idx
      from {_TOKENS} where kind = 'tag')""")
def q_html_attributes(spark, folder):
    return tokens.html_attributes(pages(spark, folder))


@query("attr_lookup", f"""
select page_id, pos, regexp_extract(tok, 'href="([^"]*)"', 1) as value,
  {Q.decode("regexp_extract(tok, 'href=\"([^\"]*)\"', 1)")} as decoded
from {_TOKENS} where tok like '<a %'""")
def q_attr_lookup(spark, folder):
    return tokens.attr_lookup(pages(spark, folder), "a", "href")


@query("md_events", f"""
select page_id, case when kind = 'text' then 'text' when tok like '</%' then 'close' else 'open' end as type,
  count(*) as n, min(pos) as first_pos, max(pos) as last_pos
from {_TOKENS} where kind in ('text', 'tag') group by all""")
def q_md_events(spark, folder):
    return tokens.md_events(pages(spark, folder)).groupBy("page_id", "type").agg(
        F.count("*").alias("n"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"))


@query("element_classes", f"""
select {_NAME} as name, count(*) filter (tok not like '</%') as opens, count(*) filter (tok like '</%') as closes,
  lower({_NAME}) in ('script', 'style', 'head', 'meta', 'link', 'title', 'noscript', 'template', 'slot', 'base') as is_skip,
  {_NAME} in ('article', 'br', 'div', 'footer', 'h1', 'li', 'nav', 'p', 'ul') as is_block,
  {_NAME} in ('a', 'b') as is_inline, {_NAME} in ('br', 'meta') as is_void, case when {_NAME} = 'h1' then 1 else 0 end as heading_level,
  {_NAME} = 'ul' as is_list
from {_TOKENS} where kind = 'tag' group by {_NAME}""")
def q_element_classes(spark, folder):
    return tokens.element_class_usage(pages(spark, folder)).drop("is_skip_void", "is_table_row")


@query("comments_doctypes", f"""
select page_id, row_number() over (partition by page_id order by pos) - 1 as idx, kind, {_DATA} as data
from {_TOKENS} where kind in ('comment', 'doctype')""")
def q_comments_doctypes(spark, folder):
    return tokens.comments_doctypes(pages(spark, folder))


@query("raw_text_blocks", """
select page_id, 0 as idx, 'style' as name, regexp_extract(html, '<style>(.*?)</style>', 1) as data, true as closed from pages
union all select page_id, 1, 'script', regexp_extract(html, '<script>(.*?)</script>', 1), true from pages""")
def q_raw_text_blocks(spark, folder):
    return tokens.raw_text_blocks(pages(spark, folder))


@query("tag_balance", f"""
select page_id, {_NAME} as name, count(*) filter (tok not like '</%') as opens, count(*) filter (tok like '</%') as closes,
  count(*) filter (tok not like '</%') - count(*) filter (tok like '</%') as balance
from {_TOKENS} where kind = 'tag' and {_NAME} not in ('br', 'meta') group by all""")
def q_tag_balance(spark, folder):
    return tokens.tag_balance(pages(spark, folder))


# ---- metrics, report and limits --------------------------------------------------------
@query("page_metrics", f"""
select page_id, strlen(html) as raw_bytes, length(html) as raw_chars, strlen(t) as stripped_bytes, length(t) as stripped_chars,
  len(string_split(t, chr(10))) as lines, true as is_html
from (select page_id, html, {Q.tags('html')} as t from pages)""")
def q_page_metrics(spark, folder):
    rows = pages(spark, folder).select(
        "page_id", "html", clean.strip_tags(F.col("html")).alias("t"), F.lit("text/html; charset=utf-8").alias("ct"))
    return metrics.page_metrics(rows, ["page_id"], "html", "t", "ct")


def _reduction_sql(extra=""):
    modes = " union all ".join(
        f"select url, '{m}' as mode, strlen(html) as raw_bytes, strlen({e}) as stripped_bytes from pages" for m, e in (
            ("none", "html"), ("whitespace", Q.whitespace("html")), ("attributes", Q.attributes("html")), ("tags", Q.tags("html"))))
    return f"""
select host, mode, count(*) as pages, sum(raw_bytes)::bigint as raw_bytes, sum(stripped_bytes)::bigint as stripped_bytes,
  quantile_disc(stripped_bytes, 0.5) as median_bytes, round(sum(stripped_bytes) / sum(raw_bytes), 6) as kept
from (select lower(regexp_extract(url, '^https?://([^/:?#]+)', 1)) as host, * from ({modes}{extra})) group by rollup (host, mode)"""


@query("reduction_by_host", _reduction_sql())
def q_reduction(spark, folder):
    return metrics.reduction_by_host(pages(spark, folder, "page_id", "url", "html"), clean.ROW_LOCAL)


@query("fetch_report", f"""
select source, id, 'HTTP ' || status || ' ' || final_url || chr(10) || 'Content-Type: ' || content_type || chr(10)
  || 'Raw size: ' || ({Q.size('strlen(raw_text)')}) || ' (' || length(raw_text) || ' chars)' || chr(10)
  || case when source = 'pages' then 'Strip: tags' else 'Strip: tags (skipped, non-HTML content)' end || ' → '
  || ({Q.size('strlen(t)')}) || ' (' || length(t) || ' chars)' || chr(10)
  || 'Lines: ' || len(string_split(t, chr(10))) || chr(10) || chr(10) || 'Response Headers:' || chr(10)
  || '  Content-Type: ' || content_type || chr(10) || '  Content-Length: ' || size || chr(10) || '---' || chr(10)
  || array_to_string(list_slice(string_split(t, chr(10)), 1, 8), chr(10))
  || case when len(string_split(t, chr(10))) > 8 then chr(10) || chr(10) || '[Output truncated: 8 of '
       || len(string_split(t, chr(10))) || ' lines ('
       || ({Q.size("strlen(array_to_string(list_slice(string_split(t, chr(10)), 1, 8), chr(10)))")}) || ' of ' || ({Q.size('strlen(t)')})
       || ').]' else '' end as report
from (select *, case when source = 'pages' then {Q.tags('raw_text')} else raw_text end as t
      from {R} where source in ('pages', 'documents', 'events', 'conversations'))""")
def q_fetch_report(spark, folder):
    log = response_log(spark, folder, ("pages", "documents", "events", "conversations")).withColumn(
        "requested", F.lit("tags"))
    rows = log.withColumn("applied", clean.resolve_strip(F.col("requested"), F.col("content_type")))
    stripped = clean.apply_strip(rows, "raw_text", "applied", "stripped", ["source", "id"], ("none", "tags"))
    cut = limits.truncate(stripped, "stripped", "head", max_bytes=10**8, max_lines=8)
    return cut.select("source", "id", metrics.fetch_report(cut).alias("report"))


def _truncate_sql(order, max_bytes, max_lines):
    return f"""
with l as (
  select doc_id, i, line, sum(strlen(line) + 1) over w - 1 as used, row_number() over w as n
  from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from documents)
  window w as (partition by doc_id order by i {order}))
select doc_id, coalesce(string_agg(line, chr(10) order by i) filter (used <= {max_bytes} and n <= {max_lines}), '') as content,
  count(*) filter (used <= {max_bytes} and n <= {max_lines}) < count(*) as truncated,
  count(*) filter (used <= {max_bytes} and n <= {max_lines}) as output_lines, count(*) as total_lines,
  coalesce(max(used) filter (used <= {max_bytes} and n <= {max_lines}), 0)::bigint as output_bytes, max(used)::bigint as total_bytes
from l group by doc_id"""


def _truncate(spark, folder, strategy):
    docs = table(spark, folder, "documents", "doc_id", "text")
    return limits.truncate(docs, "text", strategy, max_bytes=2000, max_lines=9).drop("text")


@query("truncate_head", _truncate_sql("asc", 2000, 9))
def q_truncate_head(spark, folder):
    return _truncate(spark, folder, "head")


@query("truncate_tail", _truncate_sql("desc", 2000, 9))
def q_truncate_tail(spark, folder):
    return _truncate(spark, folder, "tail")


# ---- Markdown ---------------------------------------------------------------------------
def _markdown_sql():
    x = "regexp_replace(html, '(?s)<head>.*?</head>', '', 'g')"
    x = Q.no_declarations(x)
    x = Q.sub(x, '<a href="([^"]*)">([^<]*)</a>', "'[\\2](\\1)'")
    x = Q.sub(x, "<b>([^<]*)<", "'**\\1**<'")
    x = Q.sub(x, "<h1>", "chr(10)||chr(10)||'# '")
    x = Q.sub(x, "<li>", "'- '")
    x = Q.sub(x, "\\s*</li>", "chr(10)")
    x = Q.sub(x, "</?(p|h1|br|div|article|footer|nav|ul)( [^>]*)?>", "chr(10)||chr(10)")
    return Q.lines(Q.decode(Q.sub(x, "<[^>]*>", "''")))


@query("strip_html2md", f"select page_id, {_markdown_sql()} as text from pages")
def q_markdown(spark, folder):
    return html_to_markdown(table(spark, folder, "pages", "page_id", "html"), ["page_id"], out="text")


@query("reduction_all_modes", _reduction_sql(
    f" union all select url, 'html2md', strlen(html), strlen(text) from (select url, html, {_markdown_sql()} as text from pages)"))
def q_reduction_all_modes(spark, folder):
    """All five modes, Markdown among them."""
    rows = table(spark, folder, "pages", "page_id", "url", "html")
    return metrics.reduction_by_host(rows, clean.ROW_LOCAL, markdown_keys=["page_id"])


# ---- a whole fetch job --------------------------------------------------------------------
_ASKED = "['none', 'whitespace', 'attributes', 'tags', 'html2md']"
_FETCHED_SQL = f"""
select source, id, asked, blocked, final_url, case when blocked then 0 else status end as status,
  case when blocked then '' else content_type end as content_type, size,
  case when blocked then asked when source = 'pages' then asked else 'none' end as applied,
  case when blocked then '' when source = 'embeddings'
    then '[Binary content: ' || content_type || ', ' || size || ' bytes. Use raw_http_request for binary downloads.]'
    else raw_text end as body
from (select *, {_ASKED}[(id % 5)::int + 1] as asked, source = 'events' and status = 503 as blocked from {R})"""
_CLEANED_SQL = f"""
select *, case when source <> 'pages' then body when asked = 'whitespace' then {Q.whitespace('body')}
  when asked = 'attributes' then {Q.attributes('body')} when asked = 'tags' then {Q.tags('body')}
  when asked = 'html2md' then {_markdown_sql().replace('html,', 'body,', 1)} else body end as t
from ({_FETCHED_SQL})"""
_LIMITED_SQL = f"""
select *, case when strlen(t) <= 200000 and len(l) <= 5000 then len(l) else len(list_filter(range(1, least(len(l), 5000) + 1),
  lambda i: strlen(array_to_string(list_slice(l, 1, i), chr(10))) <= 200000)) end as n
from (select *, string_split(t, chr(10)) as l from ({_CLEANED_SQL}))"""
_SHOWN = "case when n = len(l) then t else array_to_string(list_slice(l, 1, n), chr(10)) end"


@query("http_fetch_report", f"""
select source, id, status, blocked or status >= 400 as is_error, asked as requested, applied, strlen(body) as raw_bytes,
  strlen(t) as stripped_bytes, len(l) as stripped_lines, n < len(l) as truncated, n as output_lines,
  'HTTP ' || status || ' ' || final_url || chr(10) || 'Content-Type: ' || content_type || chr(10)
  || 'Raw size: ' || ({Q.size('strlen(body)')}) || ' (' || length(body) || ' chars)' || chr(10)
  || case when applied <> 'none' then 'Strip: ' || applied || ' → ' || ({Q.size('strlen(t)')}) || ' (' || length(t) || ' chars)' || chr(10)
       when asked <> 'none' and source <> 'pages' then 'Strip: ' || asked || ' (skipped, non-HTML content) → '
         || ({Q.size('strlen(t)')}) || ' (' || length(t) || ' chars)' || chr(10) else '' end
  || 'Lines: ' || len(l) || chr(10) || chr(10) || 'Response Headers:' || chr(10)
  || case when blocked then '' else '  Content-Type: ' || content_type || chr(10) || '  Content-Length: ' || size || chr(10) end
  || '---' || chr(10) || {_SHOWN}
  || case when n < len(l) then chr(10) || chr(10) || '[Output truncated: ' || n || ' of ' || len(l) || ' lines ('
       || ({Q.size(f'strlen({_SHOWN})')}) || ' of ' || ({Q.size('strlen(t)')}) || ').]' else '' end as report
from ({_LIMITED_SQL})""")
def q_http_fetch_report(spark, folder):
    """Fetch jobs over all sources, each response with one of the five modes, at the default limits."""
    log = response_log(spark, folder).withColumn(
        "asked", F.element_at(F.array(*[F.lit(m) for m in Q.STRIP_MODES]), (F.col("id") % 5 + 1).cast("int")))
    return fetch_job(log, "asked", ["source", "id"]).drop("final_url")
