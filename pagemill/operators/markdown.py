"""HTML to Markdown as a relational job.

A page table is exploded into events (text, open tag, close tag). Running window columns
over (page order by pos) give each event its context: inside a code block, a table row, a
caption, how deep in lists, which inline segment. Each event then yields rendered pieces
with an output position; pieces are put in output order and joined per page.

The only exchange is one hash partitioning of the *unexploded* pages by key; every window
and the final aggregation reuse it. A page is the unit of work and never leaves its task.
"""

from pyspark.sql import Column, DataFrame, functions as F

from pagemill import fixed
from pagemill.fixed import (
    LINE_TRIM, CAPTION_CLOSE, CAPTION_OPEN, CELL_MARK, FENCE_CLOSE, FENCE_OPEN, LI_MARK, ROW_MARK)
from pagemill.functions import html as H
from pagemill.functions.entities import decode_escaped
from pagemill.functions.text import (
    NOT_TRIM_ANY, TRIM_ANY, char_class, collapse_inline, collapse_whitespace, escape_marks,
    fold_blank_lines, run_of, unescape_marks)
from pagemill.operators.tokens import token_pieces
from pagemill.session import by_page

_RESET = 1 << 40  # larger than any depth: subtracting it restarts a clamped running sum

_SKIP_NESTED = ["head", "title", "noscript", "template", "slot"]
_DROPPED = (
    r"(?i)\A<(?:!--|!doctype|/?+(?:script|style|meta|link|base)(?:[ \t\n\r>/]|\z))")

# Opens that end a code block, table, picture and figure before they start.
_FLUSHING = fixed.HEADINGS + ["p", "hr", "pre", "blockquote", "table", "ul", "ol"]
_TABLE_INNER = ["caption", "thead", "tbody", "tfoot", "th", "td", "tr"]
_OWN_RULE = _FLUSHING + _TABLE_INNER + ["br", "li", "figure", "figcaption", "details", "summary"]
_PLAIN_BLOCKS = [n for n in fixed.BLOCK_ELEMENTS if n not in _OWN_RULE]
_BREAK_OPENS = _FLUSHING + _PLAIN_BLOCKS + ["br", "li", "details", "picture", "figure"]
_SPACED_CLOSES = ["/" + n for n in
                  fixed.HEADINGS + ["blockquote", "ul", "ol", "details", "br", "hr"] + _PLAIN_BLOCKS]
_BREAK_CLOSES = _SPACED_CLOSES + ["/p", "/li", "/picture", "/figure", "/table"]
_CELL_EDGES = ["tr", "td", "th", "/tr", "/td", "/th", "figcaption", "/figcaption"]
_END = "end-of-page"


def _names(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


def _lit(text: str) -> str:
    return f"'{text}'"


def _over(page: list[str], frame="current row", order="pos", also=()) -> str:
    """SQL window over the events of a page, from its start up to the current or previous row."""
    by = ", ".join(f"`{c}`" for c in [*page, *also])
    return f"over (partition by {by} order by {order} rows between unbounded preceding and {frame})"


_PREVIOUS = "1 preceding"
_FLUSH = f"(ev in ({_names(_FLUSHING)}) or ev = '{_END}')"


def _events(pages: DataFrame, keys: list[str], html: str, others: list[str], only: list[str] | None = None) -> DataFrame:
    """Events of each page; with `only`, tags of other elements are left out before the page is exploded."""
    tokens = F.filter(H.token_array(escape_marks(F.col(html))), lambda t: ~t.rlike(_DROPPED))
    if only is not None:
        tag = rf"(?i)\A</?+(?:{'|'.join([*only, *_SKIP_NESTED, 'textarea'])})(?:[ \t\n\r/>]|\z)"
        tokens = F.filter(tokens, lambda t: H.is_text(t) | t.rlike(tag))
    pieces = token_pieces(F.col(html), tokens)
    edge = F.struct(F.lit("").alias("token"), F.lit(True).alias("raw"))
    last = F.struct(F.lit(_END).alias("token"), F.lit(False).alias("raw"))
    rows = by_page(pages, *keys).select(
        *keys, F.struct(*others).alias("carried") if others else F.lit(None).cast("string").alias("carried"),
        F.posexplode(F.concat(F.array(edge), F.coalesce(pieces, F.array()), F.array(last))).alias("pos", "p"))
    token = F.col("p.token")
    is_text = F.col("p.raw") | (H.is_text(token) & (token != _END))
    return rows.select(
        *keys, "pos",
        # Untouched columns travel on the first row of the page only.
        F.when(F.col("pos") == 0, F.col("carried")).alias("carried"),
        F.when(is_text, token).alias("text"),
        F.when(~is_text, token).alias("tag"),
        F.when(token == _END, _END).when(
            ~is_text, F.lower(F.regexp_extract(token, r"\A<(/?+[^ \t\n\r>/]++)", 1))
        ).otherwise("").alias("ev"),
    )


def _without_skipped(events: DataFrame, page: list[str]) -> DataFrame:
    """Drop skip elements with their whole subtree; a stray end tag counts for nothing."""
    w = _over(page)
    sums = events.selectExpr("*", *[
        f"sum(case ev when '{n}' then 1 when '/{n}' then -1 else 0 end) {w} as s_{n}" for n in _SKIP_NESTED])
    lows = sums.selectExpr("*", *[f"least(min(s_{n}) {w}, 0) as m_{n}" for n in _SKIP_NESTED])
    outside = " and ".join(f"s_{n} <= m_{n}" for n in _SKIP_NESTED)
    skip_tags = _names(_SKIP_NESTED + ["/" + n for n in _SKIP_NESTED])
    return lows.where(
        f"({outside} and ev not in ({skip_tags})) or pos = 0 or ev = '{_END}'").select(*events.columns)


def _escape_alt(alt: Column) -> Column:
    return F.replace(F.replace(alt, F.lit("]"), F.lit("\\]")), F.lit("["), F.lit("\\["))


def _with_attributes(events: DataFrame) -> DataFrame:
    """Decode texts and the attributes the rules need: `note` (address, title, alt) and `src`."""
    ev = F.col("ev")
    rows = events.withColumn(
        "attrs", F.when(ev.isin("a", "img", "source", "abbr", "time"), H.tag_attributes(F.col("tag"))))
    rows = rows.selectExpr(
        *[c if c == "pos" else f"`{c}`" for c in events.columns if c != "tag"],
        """get(filter(attrs, a -> lower(a.name) = case ev when 'a' then 'href' when 'img' then 'alt'
           when 'abbr' then 'title' when 'time' then 'datetime' end), 0).value as note""",
        """coalesce(
           case when ev = 'source' then nullif(get(filter(attrs, a -> lower(a.name) = 'srcset'), 0).value, '') end,
           case when ev in ('img', 'source') then get(filter(attrs, a -> lower(a.name) = 'src'), 0).value end) as src""")
    decoded = rows.withColumns({c: decode_escaped(F.col(c)) for c in ("text", "note", "src")})
    return decoded.withColumns({
        "note": F.expr("case when ev in ('a', 'img', 'abbr', 'time') then coalesce(note, '') end"),
        "src": F.expr(r"""case ev when 'img' then coalesce(src, '')
                          when 'source' then regexp_extract(coalesce(src, ''), r'\A[^\s]*', 0) end""")})


def _is_blank() -> Column:
    return F.col("text").isNotNull() & ~F.coalesce("text", F.lit("")).rlike(NOT_TRIM_ANY)


#: A cell starts at td or th; text in a row before any cell is a cell of its own.
_CELL_START = "in_row and (ev in ('td', 'th') or (text is not null and not blank and td_in_row = 0))"


def _context(events: DataFrame, page: list[str]) -> DataFrame:
    """Running context of each event; all forward windows share one sort, all backward ones another."""
    w, before = _over(page), _over(page, _PREVIOUS)

    def switch(sets, clears):
        """State before the event of a switch that some events set and others clear."""
        return f"coalesce(last(case when {sets} then true when {clears} then false end, true) {before}, false)"

    def at(event, column):
        """Value of a running count at the last such event."""
        return f"coalesce(last(case when ev = '{event}' then {column} end, true) {w}, 0)"

    list_step = "case when ev in ('ul', 'ol') then 1 when ev in ('/ul', '/ol') then -1 else 0 end"
    clears_lists = f"ev in ({_names(fixed.HEADINGS + ['hr', 'pre'])})"
    rows = events.withColumn("blank", _is_blank())
    rows = rows.selectExpr(
        "*",
        switch("ev = 'pre'", f"ev = '/pre' or {_FLUSH}") + " as in_pre",
        switch("ev = 'table'", f"ev = '/table' or {_FLUSH}") + " as in_table",
        switch("ev = 'tr'", f"ev in ('/tr', '/table') or {_FLUSH}") + " as in_tr",
        switch("ev = 'figcaption'", f"ev in ('/figcaption', '/figure', 'figure') or {_FLUSH}") + " as in_cap",
        switch("ev = 'picture'", f"ev in ('/picture', '/figure') or {_FLUSH}") + " as in_pic",
        f"coalesce(last(case when not blank and pos > 0 then ev end, true) {before} = 'hr', false) as after_hr",
        f"sum({list_step}) {w} as s_list",
        f"sum({list_step} - case when {clears_lists} then {_RESET} else 0 end) {w} as s_marks")
    breaks = _names(_BREAK_OPENS + _BREAK_CLOSES + _CELL_EDGES + [_END])
    rows = rows.selectExpr(
        "*", "in_table and in_tr as in_row", "in_pre and text is not null and text != '' as pre_text",
        f"ev in ({breaks}) or (ev = 'img' and not in_pic) as breaks")
    rows = rows.selectExpr(
        "*",
        f"s_list - least(min(s_list) {w}, 0) as list_depth",
        f"s_marks - least(min(s_marks) {w}, 0) as mark_depth",
        f"count_if(ev in ('td', 'th') and in_row) {w} as n_td",
        f"count_if(pre_text) {w} as n_pre",
        f"count_if(in_pic and coalesce(src, '') != '') {w} as n_src",
        f"count_if(in_pic and ev = 'img' and note != '') {w} as n_alt",
        f"count_if(breaks) {w} as segment")
    rows = rows.selectExpr(
        "*",
        f"""sum(case when ev = 'li' then 1 when ev = '/li' then -1
            when ev in ('/ul', '/ol') and list_depth = 0 then -{_RESET} else 0 end) {w} as s_li""",
        f"n_td - {at('tr', 'n_td')} as td_in_row",
        f"n_pre - {at('pre', 'n_pre')} as pre_no",
        f"n_src - {at('picture', 'n_src')} as src_no",
        f"n_alt - {at('picture', 'n_alt')} as alt_no")
    rows = rows.selectExpr(
        "*", f"{_CELL_START} as cell_start",
        f"s_li > least(min(s_li) {w}, 0) as in_li")
    rows = rows.selectExpr("*", f"count_if(cell_start) {w} as n_cell")
    rows = rows.selectExpr(
        "*",
        f"coalesce(last(case when ev = 'tr' then n_cell end, true) {before}, 0) as row_base",
        f"coalesce(last(case when ev = 'table' then n_cell end, true) {before}, 0) as table_base")
    rows = rows.selectExpr(
        "*", f"""case when in_row and (ev in ('tr', '/tr', '/table') or {_FLUSH}) and n_cell > row_base
                 then n_cell - row_base end as row_cells""")

    # Nearest following event that lets deferred output out.
    here, after = _over(page, order="pos desc"), _over(page, _PREVIOUS, "pos desc")

    def following(condition, frame):
        return f"last(case when {condition} then pos end, true) {frame}"

    return rows.selectExpr(
        "*",
        following(f"ev = '/pre' or {_FLUSH}", here) + " as pre_out",
        following(f"ev = '/table' or {_FLUSH}", here) + " as table_out",
        following(f"ev in ('/figure', 'figure') or {_FLUSH}", here) + " as caption_out",
        following(f"ev in ('/picture', '/figure', 'picture') or {_FLUSH}", after) + " as picture_out",
        following(f"ev in ('/figcaption', '/figure', 'figure') or {_FLUSH}", after) + " as caption_end",
        following("breaks", after) + " as segment_end")


def _inline(context: DataFrame, page: list[str]) -> DataFrame:
    """Pair inline markers inside a segment, and give list items their list kind."""
    name = "ltrim('/', ev)"
    markers = " ".join(f"when '{n}' then '{m}'" for n, m in fixed.EMPHASIS.items())
    rows = context.selectExpr("*", f"""
        case when in_pre then null
             when (ev = 'a' and note != '') or ev = '/a' then 'link'
             when (ev in ('abbr', 'time') and note != '') or ev in ('/abbr', '/time') then 'note'
             else case {name} {markers} end end as kind""")
    # One partitioning serves both: markers by (segment, kind), list rows by depth.
    rows = rows.selectExpr(
        "*", "case when kind is null then 0 when ev like '/%' then -1 else 1 end as step",
        """case when kind is not null then segment
                when ev in ('ul', 'ol', 'li') and mark_depth > 0 then -1 else -2 end as g_seg""",
        """case when kind is not null then kind
                when ev in ('ul', 'ol', 'li') and mark_depth > 0 then cast(mark_depth as string) end as g_kind""",
        """case when kind is not null and ev not like '/%' then
                case kind when 'link' then concat('](', note, ')') when 'note' then concat(' (', note, ')') else kind end
           end as close_text""")
    group = ("g_seg", "g_kind")
    w, before = _over(page, also=group), _over(page, _PREVIOUS, also=group)
    rows = rows.selectExpr(
        "*", f"sum(step) {w} as s_mark", f"last(case when ev in ('ul', 'ol') then ev end, true) {w} as list_kind")
    rows = rows.selectExpr("*", f"s_mark - least(coalesce(min(s_mark) {before}, 0), 0) as depth")
    rows = rows.selectExpr(
        "*", "case when step = 1 then depth when step = -1 and depth >= 0 then depth + 1 end as level")
    by = ", ".join(f"`{c}`" for c in [*page, *group, "level"])
    v = f"over (partition by {by} order by pos)"
    return rows.selectExpr(
        "*", f"case when step = -1 and level is not null then lag(close_text) {v} end as closed_text",
        f"case when step = 1 then lead(pos) {v} is null end as unclosed")


def _piece(o1, o2, o3, o4, text, spacing="false", quoting="false") -> str:
    return (
        f"named_struct('o1', cast({o1} as bigint), 'o2', {o2}, 'o3', cast({o3} as bigint), "
        f"'o4', cast({o4} as bigint), 's', {text}, 'spacing', {spacing}, 'quoting', {quoting})")


def _pieces(rows: DataFrame) -> DataFrame:
    """Adds `pieces`, the rendered pieces of each event.

    Order: output position, phase, position, sub-position. Phases: 0 code content, 1 closing
    fence, 2 open inline markers, 3 table rows, 4 picture, 5 caption, 6 block spacing, 7 the
    event's own text. A piece goes to the table cell, the caption or the page, by context;
    inside cells and captions line breaks are blanks.
    """
    block = fixed.HEADINGS + ["pre", "blockquote", "table", "ul", "ol", "details"] + _PLAIN_BLOCKS
    rows = rows.selectExpr(
        "*",
        f"""case when ev in ({_names(_FLUSHING)}) then 'page' when in_row then 'cell' when in_cap then 'caption'
            else 'page' end as route""",
        f"""ev in ({_names(block)}) or (ev = 'p' and not in_li) or (ev = 'hr' and not after_hr) as spaced""",
        f"""case
            when text is not null then case when not in_row or not blank or td_in_row > 0 then text end
            when step = 1 then case kind when 'link' then '[' when 'note' then '' else kind end
            when kind is not null then closed_text
            when ev in ({_names(fixed.HEADINGS)}) then concat(repeat('#', cast(substring(ev, 2, 1) as int)), ' ')
            when ev in ({_names(_SPACED_CLOSES)}) or (ev = '/p' and not in_li) or ev = 'br' then '\n\n'
            when ev = 'hr' then case when not after_hr then '---\n\n' end
            when ev = 'li' then case when mark_depth > 0
              then concat(repeat('  ', cast(mark_depth - 1 as int)), case when list_kind = 'ol' then '1. ' else '- ' end)
              else '- ' end
            when ev = '/li' then '{LI_MARK}'
            when ev = 'summary' then '**'
            when ev = '/summary' then '**\n> '
            when ev in ('blockquote', 'details') then '> '
            when ev = 'img' then concat('![', replace(replace(note, ']', '\\\\]'), '[', '\\\\['), '](', src, ')')
            end as own""")
    # Where the piece goes, and as what.
    rows = rows.selectExpr(
        "*",
        "case route when 'cell' then table_out when 'caption' then caption_out else pos end as r1",
        "case route when 'cell' then 3 when 'caption' then 5 else 7 end as r2",
        "case route when 'page' then 6 when 'cell' then 3 else 5 end as e2")
    rows = rows.withColumn("own", F.when(F.col("route") == "page", F.col("own")).otherwise(
        collapse_whitespace(F.replace("own", F.lit(LI_MARK), F.lit(" ")))))
    first_code = "pre_no = 1"
    fence = [
        f"case when {first_code} then {_piece('pre_out', 0, 'pos', 0, _lit(''), 'true')} end",
        f"case when {first_code} then {_piece('pre_out', 0, 'pos', 1, _lit(FENCE_OPEN))} end",
        _piece("pre_out", 0, "pos", 2, "text"),
        f"case when {first_code} then {_piece('pre_out', 1, 'pos', 0, _lit(FENCE_CLOSE + chr(92) + 'n' + chr(92) + 'n'))} end"]
    cell = [
        f"case when cell_start and n_cell - table_base = 1 then {_piece('table_out', 3, 'pos', 0, _lit(''), 'true')} end",
        f"case when cell_start then {_piece('table_out', 3, 'pos', 1, _lit(CELL_MARK))} end"]
    own = f"case when own is not null then {_piece('r1', 'r2', 'pos', 2, 'own', 'false', 'coalesce(ev in (' + _names(['blockquote', 'details']) + ') and route = ' + _lit('page') + ', false)')} end"
    closer = f"""case when unclosed then case route
        when 'page' then {_piece('segment_end', 2, '-pos', 0, 'close_text')}
        else {_piece('r1', 'r2', 'segment_end', '-pos - 1', 'close_text')} end end"""
    separator = """case when row_base = table_base
        then concat('|', repeat(' --- |', cast(row_cells as int)), '\n') else '' end"""
    row_end = f"case when row_cells is not null then {_piece('table_out', 3, 'pos', 0, 'concat(' + _lit(ROW_MARK) + ', ' + separator + ')')} end"
    spacing = f"case when spaced then {_piece('r1', 'e2', 'pos', 1, 'case route when ' + _lit('page') + ' then ' + _lit('') + ' else ' + _lit(' ') + ' end', 'route = ' + _lit('page'))} end"

    def picture(sub, text):
        return f"""case route when 'cell' then {_piece('table_out', 3, 'picture_out', sub - 1000000, text)}
                   else {_piece('picture_out', 4, 0, sub, text)} end"""

    has_src = "coalesce(src, '') != '' and src_no = 1"
    in_picture = [
        f"case when {has_src} then {picture(0, _lit('!['))} end",
        f"""case when ev = 'img' and note != '' and alt_no = 1 and src_no > 0
            then {picture(1, "replace(replace(note, ']', '\\\\]'), '[', '\\\\[')")} end""",
        f"case when {has_src} then {picture(2, 'concat(' + _lit('](') + ', src, ' + _lit(')') + ')')} end"]
    caption = [
        _piece("caption_out", 5, "pos", 0, f"'{CAPTION_OPEN}'"),
        _piece("caption_out", 5, "caption_end", 0, f"'{CAPTION_CLOSE}'")]
    code_break = [_piece("pre_out", 0, "pos", 2, "'\n'")]
    listed = {
        "pre_text": fence,
        "in_pre and text is not null": [],
        "text is not null": cell + [own],
        "kind is not null": [own, closer],
        "in_pic and ev in ('img', 'source')": in_picture,
        "ev = 'figcaption'": caption,
        "in_pre and ev = 'br'": code_break,
        "ev in ('td', 'th')": cell,
        "true": [row_end, spacing, own],
    }
    cases = " ".join(
        f"when {c} then array({', '.join(parts) or 'cast(null as ' + _TYPE + ')'})" for c, parts in listed.items())
    return rows.withColumn("pieces", F.expr(f"filter(case {cases} end, p -> p is not null)"))


_TYPE = "struct<o1:bigint,o2:int,o3:bigint,o4:bigint,s:string,spacing:boolean,quoting:boolean>"


def _normalise(df: DataFrame, column: str) -> DataFrame:
    """Turn the marks into Markdown, fold whitespace outside code, keep it inside.

    One step per projection: each reads the column before it several times.
    """
    text = F.col(column)
    item_end = char_class(LINE_TRIM + "\n" + LI_MARK)
    captioned = F.regexp_replace(F.regexp_replace(F.regexp_replace(
        text, f"{CAPTION_OPEN}{TRIM_ANY}*+{CAPTION_CLOSE}", ""),
        f"{CAPTION_OPEN}{TRIM_ANY}*+", "\n*"),
        f"(?:{run_of(TRIM_ANY)})?{CAPTION_CLOSE}", "*")
    celled = F.replace(
        F.regexp_replace(text, f" *+{CELL_MARK} *+", " | "), F.lit(ROW_MARK), F.lit(" |\n"))
    fenced = F.array_join(F.transform(
        F.split(text, f"[{FENCE_OPEN}{FENCE_CLOSE}]", -1),
        lambda part, i: F.when(
            i % 2 == 1, F.concat(F.lit("```\n"), F.regexp_replace(part, r"\n\z", ""), F.lit("\n```"))
        ).otherwise(collapse_inline(part))), "")
    return (
        df.withColumn(column, F.regexp_replace(text, f"{item_end}(?<!{item_end}{item_end}){item_end}*(?<={LI_MARK})", "\n"))
        .withColumn(column, F.when(F.contains(text, F.lit(CAPTION_OPEN)), captioned).otherwise(text))
        .withColumn(column, F.when(F.contains(text, F.lit(CELL_MARK)), celled).otherwise(text))
        .withColumn(column, F.when(F.contains(text, F.lit(FENCE_OPEN)), fenced).otherwise(collapse_inline(text)))
        .withColumn(column, unescape_marks(fold_blank_lines(text)))
    )


def html_to_markdown(pages: DataFrame, keys: list[str], html="html", out="markdown",
                     carry=False) -> DataFrame:
    """Markdown per page. `keys` must identify a row; with `carry` all columns are kept."""
    keys = list(keys)
    others = [c for c in pages.columns if c not in keys] if carry else []
    events = _with_attributes(_without_skipped(_events(pages, keys, html, others), keys))
    rows = _pieces(_inline(_context(events, keys), keys))
    pieces = rows.select(*keys, "carried", F.explode_outer("pieces").alias("p")).select(*keys, "carried", "p.*")

    order = "o1, o2, o3, o4"
    w, before = _over(keys, order=order), _over(keys, _PREVIOUS, order)
    # Spacing asked for right after "> " is left out once.
    marked = pieces.selectExpr(
        "*", f"spacing and not coalesce(last(case when spacing or quoting then quoting end, true) {before}, false) as gap",
        f"row_number() {w} as i")
    marked = marked.selectExpr(
        "*", f"""coalesce(last(case when gap then true when s != '' then
              right(s, 1) in ('\n', '{LI_MARK}', '{ROW_MARK}') end, true) {before}, true) as at_line_start""")
    spaced = marked.selectExpr(
        *[f"`{k}`" for k in keys], "carried", "i",
        "case when gap then case when at_line_start then '' else '\n\n' end else s end as s")
    joined = spaced.groupBy(*keys).agg(
        F.first("carried", True).alias("carried"),
        F.array_sort(F.collect_list(F.when(F.col("s") != "", F.struct("i", "s")))).alias("parts"))
    text = F.array_join(F.transform("parts", lambda p: p["s"]), "")
    whole = joined.select(*keys, *[F.col(f"carried.{c}").alias(c) for c in others], text.alias(out))
    return _normalise(whole, out)
