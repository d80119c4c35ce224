"""Structure tables: headings, links, images, lists, tables, quotes and other elements as rows.

Elements are intervals of the text that Markdown shows, found by running windows over the events of the Markdown job,
partitioned by page; each table selects from them. Code blocks are cut out of the page by one expression.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from pagemill import fixed
from pagemill.functions import html as H
from pagemill.functions.entities import decode_entities
from pagemill.functions.text import collapse_whitespace, let, trim_any, unescape_marks
from pagemill.operators import markdown as M

_ATTRS = rf"(?:[ \t\n\r/=]|{H.ATTRIBUTE})*+"
_ANY_TAG = rf"(?s)</?+[^ \t\n\r>/]++{_ATTRS}>?+"


def _before(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _upto(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _readable(html: Column) -> Column:
    """The page without comments, doctypes and raw-text elements."""
    hidden = r"(?i)\A<(?:!--|!doctype|(?:script|style|textarea)[ \t\n\r>/])"
    return F.array_join(F.filter(H.token_array(html), lambda t: ~t.rlike(hidden)), "")


def _inner_text(inner: Column) -> Column:
    return let(F.regexp_replace(inner, _ANY_TAG, ""), decode_entities)


def _tidy(text: Column) -> Column:
    return trim_any(collapse_whitespace(text))


def _elements(pages: DataFrame, keys, html, names, nested_end=True) -> DataFrame:
    """keys + (idx, open, inner) of the named elements; one ends at its close or the next open."""
    alt = "|".join(names)
    end = rf"(?=</?(?:{alt})[ \t\n\r>/])" if nested_end else rf"(?=</(?:{alt})[ \t\n\r>])"
    whole = rf"(?is)<(?:{alt})(?=[ \t\n\r>/]){_ATTRS}>?+.*?(?:{end}|\z)"
    split = rf"(?is)\A(<(?:{alt})(?=[ \t\n\r>/]){_ATTRS}>?+)(.*)\z"
    found = pages.select(*keys, F.posexplode(
        F.regexp_extract_all(_readable(F.col(html)), F.lit(whole), F.lit(0))).alias("idx", "element"))
    return found.select(
        *keys, "idx", F.regexp_extract("element", split, 1).alias("open"),
        F.regexp_extract("element", split, 2).alias("inner"))


def code_blocks(pages: DataFrame, keys=("page_id",), html="html") -> DataFrame:
    """keys + (idx, code): text of pre elements with its whitespace."""
    return _elements(pages, keys, html, ["pre"]).select(
        *keys, "idx", _inner_text(F.col("inner")).alias("code"))


# ---- nesting elements ---------------------------------------------------------------------

def _visible_events(pages: DataFrame, keys, html, only=None) -> DataFrame:
    """Events outside skip elements with `at`: the number of text characters before the event.

    With `only`, just the tags of those elements come out, and one row without a tag (pos -1) holds the page's whole text, so
    that no later sort or window moves the texts.
    """
    events = M._with_attributes(M._without_skipped(M._events(pages, list(keys), html, [], only), list(keys)))
    w = Window.partitionBy(*keys).orderBy("pos")
    rows = events.withColumn("at", F.coalesce(F.sum(F.length("text")).over(_before(w)), F.lit(0)))
    if only is None:
        return rows
    row = ["pos", "text", "ev", "note", "src", "at"]
    per_page = rows.groupBy(*keys).agg(
        _joined_text().alias("page_text"), F.collect_list(F.when(F.col("ev") != "", F.struct(*row))).alias("tags"))
    types = rows.select(F.struct(*row).alias("r")).schema["r"].dataType
    whole = F.struct(F.lit(-1).alias("pos"), F.col("page_text").alias("text"), F.lit("").alias("ev"), F.lit(None).alias("note"),
                     F.lit(None).alias("src"), F.lit(0).alias("at")).cast(types)
    return per_page.select(*keys, F.explode(F.concat(F.array(whole), "tags")).alias("r")).select(*keys, "r.*")


def _joined_text() -> Column:
    """Aggregate: the texts of a group's events in order of pos."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(
        F.when(F.col("text") != "", F.struct("pos", "text")))), lambda t: t["text"]), "")


#: Characters of a block of page text. Offsets count characters, so a cut from a whole text would step through all before it.
_BLOCK = 1024


def _between(blocks: Column, start: Column, stop: Column) -> Column:
    """Characters from start up to stop of a text in blocks; only the blocks that hold them are read."""
    first = F.floor(start / _BLOCK).cast("int")
    held = F.slice(blocks, first + 1, F.floor(stop / _BLOCK).cast("int") - first + 1)
    return F.when(stop > start, F.substr(
        F.array_join(held, ""), (start - first * _BLOCK + 1).cast("int"), (stop - start).cast("int"))).otherwise("")


def _cut(rows: DataFrame, keys, span: Column, columns: list[str], texts=None) -> DataFrame:
    """Cut spans out of the page text, which is put together once per page.

    `span` is a struct with start, stop and `columns`, null on rows that are no span. `texts` names the texts
    to cut and how, from the page's blocks and a span; without it there is one, from start to stop.
    """
    texts = texts or {"text": lambda page, s: _between(page, s["start"], s["stop"])}
    per_page = rows.groupBy(*keys).agg(_joined_text().alias("page_text"), F.collect_list(span).alias("spans"))
    blocks = F.regexp_extract_all("page_text", F.lit(rf"(?s).{{1,{_BLOCK}}}"), F.lit(0))
    per_page = per_page.where(F.size("spans") > 0).select(*keys, "spans", blocks.alias("blocks"))
    cut = F.transform("spans", lambda s: F.struct(
        *[s[c].alias(c) for c in columns], *[fn(F.col("blocks"), s).alias(name) for name, fn in texts.items()]))
    return per_page.select(*keys, F.explode(cut).alias("s")).select(
        *keys, *[f"s.{c}" for c in columns], *[unescape_marks(_tidy(F.col(f"s.{t}"))).alias(t) for t in texts])


def list_items(pages: DataFrame, keys=("page_id",), html="html") -> DataFrame:
    """keys + (idx, depth, kind, text): own text of each item, up to a nested list or the next item."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy("pos")
    ev = F.col("ev")
    step = F.when(ev.isin("ul", "ol"), 1).when(ev.isin("/ul", "/ol"), -1).otherwise(0)
    rows = _visible_events(pages, keys, html, ["ul", "ol", "li"]).select("*", F.sum(step).over(_upto(w)).alias("s"))
    edge = ev.isin("ul", "ol", "li", "/ul", "/ol", "/li", M._END)
    rows = rows.select(
        "*", (F.col("s") - F.least(F.min("s").over(_upto(w)), F.lit(0))).alias("depth"),
        F.count_if(ev == "li").over(_upto(w)).alias("n_li"))
    by_depth = Window.partitionBy(*keys, "depth").orderBy("pos")
    rows = rows.where(edge | (F.col("text") != "")).select(
        "*", F.last(F.when(ev.isin("ul", "ol"), ev), True).over(_upto(by_depth)).alias("kind"))
    edges = Window.partitionBy(*keys, edge).orderBy("pos")
    rows = rows.withColumn("stop", F.when(edge, F.lead("at").over(edges)))
    span = F.when(ev == "li", F.struct(
        F.col("at").alias("start"), F.col("stop"), (F.col("n_li") - 1).alias("idx"), "depth",
        F.when(F.col("depth") > 0, F.col("kind")).alias("kind")))
    return _cut(rows, keys, span, ["idx", "depth", "kind"])


def _paired(rows: DataFrame, keys, name: str) -> DataFrame:
    """Match opens and closes of one element by depth: adds depth and stop on open events."""
    w = Window.partitionBy(*keys).orderBy("pos")
    ev = F.col("ev")
    step = F.when(ev == name, 1).when(ev == "/" + name, -1).otherwise(0)
    rows = rows.select("*", step.alias("step"), F.sum(step).over(_upto(w)).alias("s"))
    floor = F.least(F.coalesce(F.min("s").over(_before(w)), F.lit(0)), F.lit(0))
    rows = rows.select("*", (F.col("s") - floor).alias("d"), F.max("at").over(
        Window.partitionBy(*keys)).alias("page_end"), F.count_if(ev == name).over(_upto(w)).alias("nth"))
    rows = rows.withColumn("depth", F.when(F.col("step") == 1, F.col("d")).when(
        (F.col("step") == -1) & (F.col("d") >= 0), F.col("d") + 1))
    v = Window.partitionBy(*keys, "depth").orderBy("pos")
    return rows.withColumn("stop", F.when(
        F.col("step") == 1, F.coalesce(F.lead("at").over(v), F.col("page_end"))))


def blockquotes(pages: DataFrame, keys=("page_id",), html="html") -> DataFrame:
    """keys + (idx, depth, text): the text of each quote, inner quotes included."""
    keys = list(keys)
    rows = _paired(_visible_events(pages, keys, html, ["blockquote"]), keys, "blockquote")
    span = F.when(F.col("ev") == "blockquote", F.struct(
        F.col("at").alias("start"), "stop", (F.col("nth") - 1).alias("idx"), "depth"))
    return _cut(rows, keys, span, ["idx", "depth"])


def emphasis_spans(pages: DataFrame, keys=("page_id",), html="html") -> DataFrame:
    """keys + (pos, name, marker, closed, text): inline spans; an unclosed one ends with its segment."""
    keys = list(keys)
    context = M._context(_visible_events(pages, keys, html), keys)
    back = Window.partitionBy(*keys).orderBy(F.col("pos").desc())
    context = context.withColumn(
        "segment_at", F.last(F.when(F.col("breaks"), F.col("at")), True).over(_before(back)))
    rows = M._inline(context, keys)
    v = Window.partitionBy(*keys, "g_seg", "g_kind", "level").orderBy("pos")
    rows = rows.withColumn("next_at", F.lead("at").over(v))
    is_span = (F.col("step") == 1) & ~F.col("kind").isin("link", "note")
    span = F.when(is_span, F.struct(
        F.col("at").alias("start"), F.when(F.col("unclosed"), F.col("segment_at")).otherwise(F.col("next_at")).alias("stop"),
        "pos", F.col("ev").alias("name"), F.col("kind").alias("marker"), (~F.col("unclosed")).alias("closed")))
    return _cut(rows, keys, span, ["pos", "name", "marker", "closed"])


def _row_events(pages: DataFrame, keys, html) -> DataFrame:
    """Events of table rows with the cell context of the Markdown job.

    No other tags but those that start or end a row are in it, and what stands outside rows is left out before texts are
    decoded and cells are counted.
    """
    kept = [*M._FLUSHING, "tr", "td", "th"]
    events = M._without_skipped(M._events(pages, keys, html, [], kept), keys)
    w, before = M._over(keys), M._over(keys, M._PREVIOUS)

    def switch(sets, clears):
        return f"coalesce(last(case when {sets} then true when {clears} or {M._FLUSH} then false end, true) {before}, false)"

    events = events.selectExpr(
        "*", switch("ev = 'table'", "ev = '/table'") + " as in_table", switch("ev = 'tr'", "ev in ('/tr', '/table')") + " as in_tr")
    rows = M._with_attributes(events.selectExpr("*", "in_table and in_tr as in_row").where("in_row or ev in ('tr', 'table')"))
    rows = rows.withColumn("blank", M._is_blank()).selectExpr("*", f"count_if(ev in ('td', 'th') and in_row) {w} as n_td")
    rows = rows.selectExpr("*", f"n_td - coalesce(last(case when ev = 'tr' then n_td end, true) {w}, 0) as td_in_row")
    rows = rows.selectExpr("*", f"{M._CELL_START} as cell_start")
    rows = rows.selectExpr("*", f"count_if(cell_start) {w} as n_cell")
    return rows.selectExpr(
        "*", f"coalesce(last(case when ev = 'tr' then n_cell end, true) {before}, 0) as row_base",
        f"coalesce(last(case when ev = 'table' then n_cell end, true) {before}, 0) as table_base")


def table_rows(pages: DataFrame, keys=("page_id",), html="html") -> DataFrame:
    """keys + (table_idx, row_idx, cells): one text per cell."""
    keys = list(keys)
    rows = _row_events(pages, keys, html)
    inside = rows.where(F.col("in_row") & (F.col("n_cell") > F.col("row_base")) & (
        F.col("cell_start") | F.col("text").isNotNull()))
    # A row is one text in which each cell starts with a mark, so cells are cut without a group for each.
    own = F.concat(F.when(F.col("cell_start"), fixed.CELL_MARK).otherwise(""), F.coalesce("text", F.lit("")))
    joined = inside.select(*keys, "table_base", "row_base", "pos", own.alias("text")).groupBy(
        *keys, "table_base", "row_base").agg(_joined_text().alias("row"))
    texts = F.split("row", fixed.CELL_MARK)
    rows = joined.select(*keys, "table_base", "row_base", F.transform(
        F.slice(texts, F.lit(2), F.size(texts) - 1), lambda c: unescape_marks(_tidy(c))).alias("cells"))
    tables = Window.partitionBy(*keys).orderBy("table_base")
    within = Window.partitionBy(*keys, "table_base").orderBy("row_base")
    return rows.select(
        *keys, (F.dense_rank().over(tables) - 1).alias("table_idx"),
        (F.row_number().over(within) - 1).alias("row_idx"), "cells")


# ---- elements as intervals ----------------------------------------------------------------
#
# An element is the interval of page text from its open tag to its end, beside its depth and the element
# around it. All tables below select from these intervals, so they leave out what Markdown skips.

def _ordered(keys, *also):
    return Window.partitionBy(*keys, *also).orderBy("pos")


def _nested(rows: DataFrame, keys, name: str) -> DataFrame:
    """Adds NAME_depth; NAME_of: pos of the innermost such element around a row, itself included; and on open tags NAME_stop.

    A stray end tag counts for nothing. An element that is not closed ends with the next of its name, else with the page.
    """
    w, ev = _ordered(keys), F.col("ev")
    step = F.when(ev == name, 1).when(ev == "/" + name, -1).otherwise(0)
    depth, level = f"{name}_depth", f"{name}_level"
    rows = rows.withColumn("s", F.sum(step).over(_upto(w)))
    rows = rows.withColumn("low", F.least(F.min("s").over(_upto(w)), F.lit(0)))
    rows = rows.withColumn("before", F.coalesce(F.lag("low").over(w), F.lit(0))).withColumn(depth, F.col("s") - F.col("low"))
    # An end tag has the level of what it closes; one that closes nothing has none.
    rows = rows.withColumn(level, F.when(ev == name, F.col(depth)).when(
        (ev == "/" + name) & (F.col("low") == F.col("before")), F.col(depth) + 1))
    following = F.when(F.lead("ev").over(_ordered(keys, level)) == "/" + name, F.lead("at").over(_ordered(keys, level)))
    own = ev == name
    next_open = F.lead("at").over(_ordered(keys, own))
    page_end = F.max("at").over(Window.partitionBy(*keys))
    rows = rows.withColumn(f"{name}_stop", F.when(own, F.coalesce(following, next_open, page_end)))
    around = F.last(F.when(own, F.col("pos")), True).over(_upto(_ordered(keys, depth)))
    return rows.withColumn(f"{name}_of", F.when(F.col(depth) > 0, around)).drop("s", "low", "before", level)


def _flat(rows: DataFrame, keys, names) -> DataFrame:
    """Adds stop to open tags of elements that do not nest: their end tag or the next open tag of them."""
    edge = F.col("ev").isin(*names, *("/" + n for n in names))
    page_end = F.max("at").over(Window.partitionBy(*keys))
    following = F.lead("at").over(Window.partitionBy(*keys, edge).orderBy("pos"))
    return rows.withColumn("stop", F.when(F.col("ev").isin(*names), F.coalesce(following, page_end)))


def _number(keys, names) -> Column:
    """Number from 0 of an open tag among those of the names."""
    return (F.count_if(F.col("ev").isin(*names)).over(_upto(_ordered(keys))) - 1).cast("int")


def heading_outline(pages: DataFrame, keys=("page_id",), html="html") -> DataFrame:
    """keys + (idx, level, text) in document order."""
    names = fixed.HEADINGS
    rows = _flat(_visible_events(pages, keys, html, names), keys, names).withColumn("idx", _number(keys, names))
    span = F.when(F.col("ev").isin(*names), F.struct(
        F.col("at").alias("start"), "stop", "idx", F.substring("ev", 2, 1).cast("int").alias("level")))
    return _cut(rows, keys, span, ["idx", "level"])


def page_links(pages: DataFrame, keys=("page_id",), html="html") -> DataFrame:
    """keys + (idx, href, text); anchors without a target are left out."""
    rows = _flat(_visible_events(pages, keys, html, ["a"]), keys, ["a"]).withColumn("idx", _number(keys, ["a"]))
    span = F.when((F.col("ev") == "a") & (F.col("note") != ""), F.struct(
        F.col("at").alias("start"), "stop", "idx", unescape_marks(F.col("note")).alias("href")))
    return _cut(rows, keys, span, ["idx", "href"])


def page_images(pages: DataFrame, keys=("page_id",), html="html") -> DataFrame:
    """keys + (idx, src, alt, markdown)."""
    images = _visible_events(pages, keys, html, ["img"]).withColumn("idx", _number(keys, ["img"])).where("ev = 'img'")
    images = images.select(*keys, "idx", unescape_marks(F.col("src")).alias("src"), unescape_marks(F.col("note")).alias("alt"))
    return images.withColumn("markdown", F.concat(
        F.lit("!["), M._escape_alt(F.col("alt")), F.lit("]("), "src", F.lit(")")))


def _first_of(event: str, column: str, window) -> Column:
    """The first value of an event within a window that is not empty, else an empty text."""
    given = (F.col("ev") == event) & (F.col(column) != "")
    return F.coalesce(F.min(F.when(given, F.struct("pos", column))).over(window)[column], F.lit(""))


def page_pictures(pages: DataFrame, keys=("page_id",), html="html") -> DataFrame:
    """keys + (idx, src, alt): the first source with an address, else the image."""
    rows = _visible_events(pages, keys, html, ["picture", "source", "img"]).withColumn("idx", _number(keys, ["picture"]))
    edge = F.last(F.when(F.col("ev").isin("picture", "/picture"), F.struct("ev", "pos")), True).over(_upto(_ordered(keys)))
    rows = rows.withColumn("of", F.when(edge["ev"] == "picture", edge["pos"]))
    inside = Window.partitionBy(*keys, "of")
    source, image, alt = _first_of("source", "src", inside), _first_of("img", "src", inside), _first_of("img", "note", inside)
    found = rows.select(*keys, "idx", "ev", "of", source.alias("source"), image.alias("image"), alt.alias("alt")).where("ev = 'picture'")
    src = F.when(F.col("source") != "", F.col("source")).otherwise(F.col("image"))
    return found.select(*keys, "idx", unescape_marks(src).alias("src"), unescape_marks(F.col("alt")).alias("alt")).where(F.col("src") != "")


def figure_captions(pages: DataFrame, keys=("page_id",), html="html") -> DataFrame:
    """keys + (idx, src, caption): the first image and the first caption of each figure that stand in no figure inside it."""
    rows = _visible_events(pages, keys, html, ["figure", "figcaption", "img"]).withColumn("idx", _number(keys, ["figure"]))
    rows = _nested(_nested(rows, keys, "figure"), keys, "figcaption")
    inside = Window.partitionBy(*keys, "figure_of")
    caption = F.min(F.when(F.col("ev") == "figcaption", F.struct("pos", "at", "figcaption_stop"))).over(inside)
    rows = rows.withColumns({"image": _first_of("img", "src", inside), "cap": caption})
    # A caption that is not closed ends with its figure.
    start = F.coalesce(F.col("cap.at"), F.col("at"))
    span = F.when(F.col("ev") == "figure", F.struct(
        start.alias("start"), F.coalesce(F.least("cap.figcaption_stop", "figure_stop"), start).alias("stop"),
        "idx", unescape_marks(F.col("image")).alias("src")))
    return _cut(rows, keys, span, ["idx", "src"]).withColumnRenamed("text", "caption")


def details_sections(pages: DataFrame, keys=("page_id",), html="html") -> DataFrame:
    """keys + (idx, summary, body): the body is all text but the section's own summary, sections inside it included whole."""
    keys = list(keys)
    rows = _visible_events(pages, keys, html, ["details", "summary"]).withColumn("idx", _number(keys, ["details"]))
    rows = _nested(_nested(rows, keys, "details"), keys, "summary")
    inside = Window.partitionBy(*keys, "details_of")
    own = (F.col("ev") == "summary") & (F.col("summary_depth") == F.min("summary_depth").over(inside) + 1)
    rows = rows.withColumn("own", own).withColumn("summaries", F.array_sort(F.collect_list(
        F.when(F.col("own"), F.struct(F.col("at").alias("start"), F.col("summary_stop").alias("stop")))).over(inside)))
    # A summary that is not closed ends with its section.
    parts = F.transform("summaries", lambda s: F.struct(s["start"].alias("start"), F.least(s["stop"], F.col("details_stop")).alias("stop")))
    rows = rows.withColumn("parts", F.when(F.col("ev") == "details", parts))
    span = F.when(F.col("ev") == "details", F.struct("idx", F.col("at").alias("start"), F.col("details_stop").alias("stop"), "parts"))

    def pieces(page, s):
        starts = F.concat(F.array(s["start"]), F.transform(s["parts"], lambda p: p["stop"]))
        stops = F.concat(F.transform(s["parts"], lambda p: p["start"]), F.array(s["stop"]))
        return F.array_join(F.transform(F.arrays_zip(starts.alias("a"), stops.alias("b")), lambda p: _between(page, p["a"], p["b"])), "")

    def summary(page, s):
        return F.when(F.size(s["parts"]) > 0, _between(page, s["parts"][0]["start"], s["parts"][0]["stop"])).otherwise("")

    return _cut(rows, keys, span, ["idx"], {"summary": summary, "body": pieces})


def time_values(pages: DataFrame, keys=("page_id",), html="html") -> DataFrame:
    """keys + (idx, name, value, text) of time and abbr elements with a value; either may stand inside the other."""
    names = ["time", "abbr"]
    rows = _visible_events(pages, keys, html, names).withColumn("idx", _number(keys, names))
    rows = _nested(_nested(rows, keys, "time"), keys, "abbr")
    span = F.when(F.col("ev").isin(*names) & (F.col("note") != ""), F.struct(
        F.col("at").alias("start"), F.coalesce("time_stop", "abbr_stop").alias("stop"), "idx",
        F.col("ev").alias("name"), unescape_marks(F.col("note")).alias("value")))
    return _cut(rows, keys, span, ["idx", "name", "value"])
