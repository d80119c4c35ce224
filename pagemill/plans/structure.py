"""Queries on structure tables, over the pages and over pages derived from the documents."""

from pyspark.sql import functions as F

from pagemill.operators import structure as S
from pagemill.operators.markdown import html_to_markdown
from pagemill.plans import sql as Q
from pagemill.plans.cleaning import pages
from pagemill.plans.derived import nested_pages, rich_pages
from pagemill.plans.registry import query


def one_line(x):
    return f"trim({Q.sub(x, Q.WS + '+', chr(39) + ' ' + chr(39))})"


@query("heading_outline", f"""
select page_id, 0 as idx, 1 as level, {one_line(Q.decode("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"))} as text from pages""")
def q_headings(spark, folder):
    return S.heading_outline(pages(spark, folder))


@query("heading_outline_derived", """
select doc_id, 0 as idx, 1 as level, 'Document ' || doc_id as text from documents
union all select doc_id, 1, 2, lang || ' from ' || source from documents""")
def q_headings_derived(spark, folder):
    return S.heading_outline(rich_pages(spark, folder), ["doc_id"])


@query("page_links", f"""
select page_id, i - 1 as idx, regexp_extract(a, 'href="([^"]*)"', 1) as href,
  {one_line(Q.decode("regexp_extract(a, '>([^<]*)', 1)"))} as text
from (select page_id, unnest(regexp_extract_all(html, '<a [^>]*>[^<]*')) as a,
        generate_subscripts(regexp_extract_all(html, '<a [^>]*>[^<]*'), 1) as i from pages)""")
def q_links(spark, folder):
    return S.page_links(pages(spark, folder))


@query("list_items", f"""
select page_id, i - 1 as idx, 1 as depth, 'ul' as kind, {one_line(Q.decode("regexp_replace(a, '<[^>]*>', '', 'g')"))} as text
from (select page_id, unnest(regexp_extract_all(html, '<li>.*?</li>')) as a,
        generate_subscripts(regexp_extract_all(html, '<li>.*?</li>'), 1) as i from pages)""")
def q_items(spark, folder):
    return S.list_items(pages(spark, folder))


_LINES = "(select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from documents)"


@query("list_items_derived", f"""
select doc_id, i - 1 as idx, 1 as depth, 'ol' as kind, {one_line('line')} as text from {_LINES}
union all select doc_id, len(string_split(text, chr(10))), 1, 'ul', 'Top' from documents
union all select doc_id, len(string_split(text, chr(10))) + 1, 2, 'ul', 'Sub' from documents""")
def q_items_derived(spark, folder):
    return S.list_items(rich_pages(spark, folder), ["doc_id"])


@query("table_rows", f"""
select doc_id, 0 as table_idx, 0 as row_idx, 'no~line' as cells from documents
union all select doc_id, 0, i, i || '~' || {one_line('line')} from {_LINES}""")
def q_tables(spark, folder):
    return S.table_rows(rich_pages(spark, folder), ["doc_id"]).withColumn("cells", F.array_join("cells", "~"))


@query("code_blocks", "select doc_id, 0 as idx, text as code from documents")
def q_code(spark, folder):
    return S.code_blocks(rich_pages(spark, folder), ["doc_id"])


@query("blockquotes", f"""
select doc_id, 0 as idx, 1 as depth, {one_line("string_split(text, chr(10))[1] || 'Inner ' || doc_id")} as text from documents
union all select doc_id, 1, 2, 'Inner ' || doc_id from documents""")
def q_quotes(spark, folder):
    return S.blockquotes(rich_pages(spark, folder), ["doc_id"])


@query("page_images", """
select doc_id, 0 as idx, '/i/' || doc_id || '.png' as src, '[' || lang || '] ' || source as alt,
  '![\\[' || lang || '\\] ' || source || '](/i/' || doc_id || '.png)' as markdown from documents
union all select doc_id, 1, '/s/' || doc_id || '.jpg', 'P ' || source, '![P ' || source || '](/s/' || doc_id || '.jpg)' from documents
union all select doc_id, 2, '/f/' || doc_id || '.png', 'F', '![F](/f/' || doc_id || '.png)' from documents""")
def q_images(spark, folder):
    return S.page_images(rich_pages(spark, folder), ["doc_id"])


@query("page_pictures", "select doc_id, 0 as idx, '/l/' || doc_id || '.jpg' as src, 'P ' || source as alt from documents")
def q_pictures(spark, folder):
    return S.page_pictures(rich_pages(spark, folder), ["doc_id"])


@query("figure_captions", "select doc_id, 0 as idx, '/f/' || doc_id || '.png' as src, 'Fig no ' || doc_id as caption from documents")
def q_figures(spark, folder):
    return S.figure_captions(rich_pages(spark, folder), ["doc_id"])


@query("details_sections", "select doc_id, 0 as idx, 'More ' || doc_id as summary, 'Body ' || source as body from documents")
def q_details(spark, folder):
    return S.details_sections(rich_pages(spark, folder), ["doc_id"])


@query("time_values", """
select doc_id, 0 as idx, 'time' as name, '2024-01-01' as value, 'first' as text from documents
union all select doc_id, 1, 'abbr', 'Language', lang from documents""")
def q_times(spark, folder):
    return S.time_values(rich_pages(spark, folder), ["doc_id"])


@query("heading_outline_nested", f"select doc_id, i - 1 as idx, 2 as level, {one_line('line')} as text from {_LINES}")
def q_headings_nested(spark, folder):
    return S.heading_outline(nested_pages(spark, folder), ["doc_id"])


@query("page_links_nested", f"select doc_id, i - 1 as idx, '/l/' || i as href, {one_line('line')} as text from {_LINES}")
def q_links_nested(spark, folder):
    return S.page_links(nested_pages(spark, folder), ["doc_id"])


@query("page_images_nested", f"""
select doc_id, 3 * (i - 1) + k as idx, '/' || substr('von', k + 1, 1) || '/' || i || '.png' as src,
  case k when 0 then 'v' || i else '' end as alt,
  '![' || case k when 0 then 'v' || i else '' end || '](/' || substr('von', k + 1, 1) || '/' || i || '.png)' as markdown
from {_LINES}, (select unnest([0, 1, 2]) as k)""")
def q_images_nested(spark, folder):
    return S.page_images(nested_pages(spark, folder), ["doc_id"])


@query("figure_captions_nested", f"""
select doc_id, 2 * (i - 1) as idx, '/o/' || i || '.png' as src, 'Out ' || i as caption from {_LINES}
union all select doc_id, 2 * i - 1, '/n/' || i || '.png', {one_line('line')} from {_LINES}""")
def q_figures_nested(spark, folder):
    return S.figure_captions(nested_pages(spark, folder), ["doc_id"])


@query("details_sections_nested", f"""
select doc_id, 2 * (i - 1) as idx, {one_line('line')} as summary, 'A' || i || ' In ' || i || 'B' || i || ' Z' || i as body from {_LINES}
union all select doc_id, 2 * i - 1, 'In ' || i, 'B' || i from {_LINES}""")
def q_details_nested(spark, folder):
    return S.details_sections(nested_pages(spark, folder), ["doc_id"])


@query("time_values_nested", f"""
select doc_id, 2 * (i - 1) as idx, 'time' as name, 'd' || i as value, {one_line("'T' || i || ' ' || line || ' end'")} as text from {_LINES}
union all select doc_id, 2 * i - 1, 'abbr', 't' || i, {one_line('line')} from {_LINES}""")
def q_times_nested(spark, folder):
    return S.time_values(nested_pages(spark, folder), ["doc_id"])


@query("emphasis_spans", """
select doc_id, v.name, v.marker, v.closed, v.text from documents, lateral (values
  ('em', '*', true, 'from'), ('em', '*', true, 'no'), ('strong', '**', true, lang), ('i', '*', true, source),
  ('del', '~~', true, 'old'), ('code', '`', true, 'n=' || n_chars), ('sub', '~', true, '2'), ('sup', '^', true, '2'),
  ('mark', '==', true, 'm'), ('q', '"', true, 'said'), ('b', '**', true, 'bold both'), ('em', '*', true, 'both'),
  ('b', '**', false, 'open ' || doc_id)) as v(name, marker, closed, text)""")
def q_emphasis(spark, folder):
    return S.emphasis_spans(rich_pages(spark, folder), ["doc_id"]).drop("pos")


def _rich_markdown_sql():
    # The line break between two rows is page text before the table; a single one ends the line only.
    item = f"case when {one_line('x')} = '' then '1.' else '1. ' || {one_line('x')} end"
    row = f"case when {one_line('x')} = '' then '| ' || i || ' | |' else '| ' || i || ' | ' || {one_line('x')} || ' |' end"
    fold = Q.sub("text", "\\n{3,}", "chr(10)||chr(10)")
    nl = "' || chr(10) || '"
    return f"""
select doc_id, '# Document ' || doc_id || '{nl}{nl}## ' || lang || ' *from* ' || source || '{nl}{nl}```{nl}' || {fold} || '{nl}```{nl}{nl}> '
  || {one_line("string_split(text, chr(10))[1] || '> Inner ' || doc_id")} || '{nl}{nl}'
  || array_to_string(list_transform(string_split(text, chr(10)), lambda x: {item}), chr(10) || chr(10)) || '{nl}{nl}- Top{nl}{nl}- Sub{nl}{nl}'
  || 'Lines of ' || doc_id || '{nl}' || case when len(string_split(text, chr(10))) = 2 then '' else chr(10) end || '| no | line |{nl}| --- | --- |{nl}'
  || array_to_string(list_transform(string_split(text, chr(10)), lambda x, i: {row}), chr(10)) || '{nl}'
  || 'Image ![\\[' || lang || '\\] ' || source || '](/i/' || doc_id || '.png){nl}{nl}![P ' || source || '](/l/' || doc_id || '.jpg)'
  || '![F](/f/' || doc_id || '.png){nl}*Fig *no* ' || doc_id || '*{nl}{nl}> **More ' || doc_id || '**{nl}> Body ' || source || '{nl}{nl}'
  || '**' || lang || '**, *' || source || '*, ~~old~~, `n=' || n_chars || '`, H~2~O, x^2^, ==m==, "said", **bold *both***, '
  || 'first (2024-01-01), ' || lang || ' (Language){nl}{nl}---{nl}{nl}End **open ' || doc_id || '**{nl}{nl}tail' as text
from documents"""


@query("strip_html2md_derived", _rich_markdown_sql())
def q_markdown_derived(spark, folder):
    return html_to_markdown(rich_pages(spark, folder), ["doc_id"], out="text")
