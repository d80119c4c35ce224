"""Cleaning by strip mode. All modes but html2md are Column -> Column, with no shuffle."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pagemill.fixed import STRIP_MODES, TAG_MARK
from pagemill.functions import html as H
from pagemill.functions.entities import decode_escaped, entity_pieces, entity_table
from pagemill.functions.text import (
    WS, collapse_lines, collapse_whitespace, escape_marks, unescape_marks, whitespace_count)

# A run of tag marks between a visible character and more text.
_SPACE_AT_TAGS = rf"{TAG_MARK}(?<!\A{TAG_MARK})(?<!{WS}{TAG_MARK})(?<!{TAG_MARK}{TAG_MARK}){TAG_MARK}*+(?!\z)"


def resolve_strip(requested: Column, content_type: Column) -> Column:
    """The mode that applies: non-HTML content is never stripped."""
    lower = F.lower(F.coalesce(content_type, F.lit("")))
    is_html = F.contains(lower, F.lit("text/html")) | F.contains(lower, F.lit("application/xhtml+xml"))
    return F.when(is_html, requested).otherwise("none")


def strip_none(text: Column) -> Column:
    return text


def strip_whitespace(text: Column) -> Column:
    return collapse_whitespace(text)


def strip_attributes(html: Column) -> Column:
    """Tags without attributes, whitespace collapsed; entities and comments stay."""

    def bare_tag(tag):
        return F.concat(
            F.when(H.is_closing(tag), "</").otherwise("<"), H.tag_name(tag),
            F.when(H.is_self_closing(tag), "/").otherwise(""), F.lit(">"))

    def render(token):
        raw = F.concat(
            bare_tag(H.raw_open(token)), H.raw_content(token),
            F.lower(H.raw_close(token)))
        doctype = F.concat(F.lit("<!DOCTYPE"), F.substring(token, 10, 2**31 - 1))
        return (
            F.when(H.is_text(token) | H.is_comment(token), token)
            .when(H.is_doctype(token), doctype)
            .when(H.is_raw_element(token), raw)
            .otherwise(bare_tag(token))
        )

    return collapse_whitespace(F.array_join(F.transform(H.token_array(html), render), ""))


def strip_tags(html: Column) -> Column:
    """Visible text with line structure; a space where a tag separates two texts."""

    def render(token):
        return (
            F.when(H.is_text(token), decode_escaped(token))
            .when(H.is_comment(token) | H.is_doctype(token), "")
            .when(token.rlike(r"(?i)\A<textarea[ \t\n\r>/]"),
                  F.concat(F.lit(TAG_MARK), decode_escaped(H.raw_content(token)), F.lit(TAG_MARK)))
            .when(token.rlike(r"(?i)\A</?(?:script|style)(?:[ \t\n\r>/]|\z)"), "")
            .otherwise(TAG_MARK)
        )

    joined = F.array_join(F.transform(H.token_array(escape_marks(html)), render), "")
    spaced = F.regexp_replace(joined, _SPACE_AT_TAGS, " ")
    return unescape_marks(collapse_lines(F.replace(spaced, F.lit(TAG_MARK), F.lit(""))))


ROW_LOCAL = {
    "none": strip_none,
    "whitespace": strip_whitespace,
    "attributes": strip_attributes,
    "tags": strip_tags,
}


def apply_strip(df: DataFrame, text: str, mode: str, out: str, keys: list[str],
                modes=tuple(STRIP_MODES), one_pass=False) -> DataFrame:
    """Adds column `out`: `text` cleaned by the mode named in column `mode`.

    Row-local modes are one CASE, so a row only pays for its own mode. Markdown is a
    multi-row plan and runs on the rows that ask for it; `keys` must identify a row there.
    With `one_pass` they identify every row: all rows go through that plan, the others without a text, so that df,
    where it is itself much work, is not computed once for Markdown and once for the rest.
    An unknown mode changes nothing.
    """
    local = [m for m in modes if m in ROW_LOCAL and m != "none"]
    cleaned = F.col(text)
    if local:
        first, *rest = local
        case = F.when(F.col(mode) == first, ROW_LOCAL[first](F.col(text)))
        cleaned = reduce(lambda c, m: c.when(F.col(mode) == m, ROW_LOCAL[m](F.col(text))), rest, case)
        cleaned = cleaned.otherwise(F.col(text))
    if "html2md" not in modes:
        return df.withColumn(out, cleaned)

    from pagemill.operators.markdown import html_to_markdown

    is_md = F.coalesce(F.col(mode) == "html2md", F.lit(False))
    if one_pass:
        asked = df.withColumn("asked", F.when(is_md, F.col(text)))
        rendered = html_to_markdown(asked, keys, "asked", "rendered", carry=True)
        return rendered.withColumn(out, F.when(is_md, F.col("rendered")).otherwise(cleaned)).drop("asked", "rendered")
    markdown = html_to_markdown(df.where(is_md), keys, text, out, carry=True)
    return df.where(~is_md).withColumn(out, cleaned).unionByName(markdown)


def entity_usage(df: DataFrame, group: list[str], text: str) -> DataFrame:
    """Uses of each reference per group; `known` tells whether it decodes by name."""
    refs = F.filter(entity_pieces(F.col(text)), lambda p: F.startswith(p, F.lit("&")) & (F.length(p) > 1))
    used = (
        df.where(F.contains(F.col(text), F.lit("&")))
        .select(*group, F.explode(refs).alias("ref"))
        .groupBy(*group, F.expr("substring(ref, 2, length(ref) - 2)").alias("name"))
        .agg(F.count("*").alias("uses"))
    )
    names = entity_table(df.sparkSession)
    return used.join(F.broadcast(names), "name", "left").select(
        *group, "name", F.col("value").isNotNull().alias("known"), "value", "uses")


def whitespace_profile(df: DataFrame, group: list[str], text: str) -> DataFrame:
    """Whitespace characters and share of the text per group."""
    return df.groupBy(*group).agg(
        F.sum(whitespace_count(F.col(text))).alias("whitespace"),
        F.sum(F.length(text)).alias("chars"))
