"""Token tables: one row per HTML token, derived from a page table."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagemill import fixed
from pagemill.functions import html as H
from pagemill.functions.entities import decode_entities


def _split(token: Column, raw: bool, shown: Column | None) -> Column:
    more = [] if shown is None else [shown.alias("shown")]
    return F.struct(token.alias("token"), F.lit(raw).alias("raw"), *more)


def token_pieces(html: Column, tokens: Column = None, with_shown=False) -> Column:
    """array<struct<token,raw>>; a raw-text element gives its open tag, content and end tag.

    with_shown adds a field shown: the piece is text that a reader sees; of raw-text elements that is textarea content alone.
    """
    tokens = H.token_array(html) if tokens is None else tokens

    def expand(token):
        tag, content, text = (
            (F.lit(False), token.rlike(r"(?i)\A<textarea"), H.is_text(token)) if with_shown else (None, None, None))
        raw = F.filter(
            F.array(
                _split(H.raw_open(token), False, tag),
                _split(H.raw_content(token), True, content),
                _split(H.raw_close(token), False, tag),
            ),
            lambda piece: piece["token"] != "",
        )
        return F.when(H.is_raw_element(token), raw).otherwise(F.array(_split(token, False, text)))

    return F.flatten(F.transform(tokens, expand))


def explode_pieces(pages: DataFrame, keys: list[str], html: str, pieces: Column = None) -> DataFrame:
    """keys + (pos, token, raw): narrow rows, no shuffle, lossless."""
    pieces = token_pieces(F.col(html)) if pieces is None else pieces
    return pages.select(*keys, F.posexplode(pieces).alias("pos", "piece")).select(
        *keys, "pos", "piece.token", "piece.raw")


def html_tokens(pages: DataFrame, keys=("page_id",), html="html") -> DataFrame:
    """keys + (pos, kind, name, is_closing, self_closing, attributes, data)."""
    token = F.col("token")
    rows = explode_pieces(pages, list(keys), html).withColumn(
        "kind", F.when(F.col("raw"), "text").otherwise(H.token_kind(token)))
    tag = F.col("kind") == "tag"
    data = (
        F.when(F.col("kind") == "text", token)
        .when(F.col("kind") == "comment", F.expr("substring(token, 5, length(token) - 7)"))
        .when(F.col("kind") == "doctype", F.expr("substring(token, 10, length(token) - 10)"))
    )
    return rows.select(
        *keys, "pos", "kind",
        F.when(tag, H.tag_name(token)).alias("name"),
        (tag & H.is_closing(token)).alias("is_closing"),
        (tag & H.is_self_closing(token)).alias("self_closing"),
        F.when(tag & ~H.is_closing(token), H.tag_attributes(token)).alias("attributes"),
        data.alias("data"),
    )


def token_counts(pages: DataFrame, keys=("page_id",), html="html") -> DataFrame:
    """Tokens per page and kind, counted without looking at attributes."""
    kind = F.when(F.col("raw"), "text").otherwise(H.token_kind(F.col("token")))
    return (
        explode_pieces(pages, list(keys), html)
        .groupBy(*keys, kind.alias("kind"))
        .agg(F.count("*").alias("n"), F.sum(F.length("token")).alias("chars"))
    )


def html_attributes(pages: DataFrame, keys=("page_id",), html="html") -> DataFrame:
    """One row per attribute: keys + (pos, tag, idx, name, value); decoded value beside it."""
    token = F.col("token")
    tags = explode_pieces(pages, list(keys), html).where(
        ~F.col("raw") & (H.token_kind(token) == "tag") & ~H.is_closing(token)
        & token.rlike(r"[ \t\n\r]"))
    return (
        tags.select(*keys, "pos", H.tag_name(token).alias("tag"),
                    F.posexplode(H.tag_attributes(token)).alias("idx", "a"))
        .select(*keys, "pos", "tag", "idx", F.col("a.name").alias("name"),
                F.col("a.value").alias("value"),
                decode_entities(F.col("a.value")).alias("decoded"))
    )


def attr_lookup(pages: DataFrame, tag: str, attr: str, keys=("page_id",), html="html") -> DataFrame:
    """Every open tag of one name with the value of one attribute, raw and decoded."""
    token = F.col("token")
    tags = explode_pieces(pages, list(keys), html).where(
        ~F.col("raw") & token.rlike(rf"(?i)\A<{tag}(?:[ \t\n\r/>]|\z)"))
    values = tags.select(*keys, "pos", H.get_attr(H.tag_attributes(token), attr).alias("value"))
    return values.withColumn("decoded", decode_entities(F.col("value")))


def md_events(pages: DataFrame, keys=("page_id",), html="html") -> DataFrame:
    """keys + (pos, type, name, attributes, data): text, open and close events."""
    tokens = html_tokens(pages, keys, html).where(F.col("kind").isin("text", "tag"))
    return tokens.select(
        *keys, "pos",
        F.when(F.col("kind") == "text", "text")
        .when(F.col("is_closing"), "close").otherwise("open").alias("type"),
        "name", "attributes", "data")


def element_classes(spark: SparkSession) -> DataFrame:
    """Dimension of element names with their class flags (a fixed, small table)."""
    names = sorted(set(
        fixed.SKIP_ELEMENTS + fixed.BLOCK_ELEMENTS + fixed.INLINE_ELEMENTS + fixed.VOID_ELEMENTS))
    rows = [(
        n, n in fixed.SKIP_ELEMENTS, n in fixed.SKIP_VOID_ELEMENTS, n in fixed.BLOCK_ELEMENTS,
        n in fixed.INLINE_ELEMENTS, n in fixed.VOID_ELEMENTS,
        int(n[1]) if n in fixed.HEADINGS else 0, n in ("ul", "ol"), n in ("tr", "td", "th"),
    ) for n in names]
    return spark.createDataFrame(
        rows,
        "name string, is_skip boolean, is_skip_void boolean, is_block boolean, is_inline boolean, "
        "is_void boolean, heading_level int, is_list boolean, is_table_row boolean")


def tag_names(pages: DataFrame, keys=("page_id",), html="html") -> DataFrame:
    """keys + (pos, name, is_closing) of all tags, without parsing attributes."""
    token = F.col("token")
    return (
        explode_pieces(pages, list(keys), html)
        .where(~F.col("raw") & (H.token_kind(token) == "tag"))
        .select(*keys, "pos", H.tag_name(token).alias("name"), H.is_closing(token).alias("is_closing"))
    )


def element_class_usage(pages: DataFrame, keys=("page_id",), html="html") -> DataFrame:
    """Open and close tags per element name, with the flags of the element dimension."""
    per_name = tag_names(pages, keys, html).groupBy("name").agg(
        F.count_if(~F.col("is_closing")).alias("opens"),
        F.count_if(F.col("is_closing")).alias("closes"))
    dim = element_classes(pages.sparkSession)
    return per_name.join(F.broadcast(dim), "name", "left").select(
        "name", "opens", "closes",
        *[F.coalesce(c, F.lit(False)).alias(c)
          for c in ("is_skip", "is_skip_void", "is_block", "is_inline", "is_void", "is_list", "is_table_row")],
        F.coalesce("heading_level", F.lit(0)).alias("heading_level"))


def comments_doctypes(pages: DataFrame, keys=("page_id",), html="html") -> DataFrame:
    token = F.col("token")
    kind = H.token_kind(token)
    # Only the markup declarations leave the array, so few rows are exploded.
    declared = F.filter(token_pieces(F.col(html)), lambda p: ~p["raw"] & F.startswith(p["token"], F.lit("<!")))
    return (
        explode_pieces(pages, list(keys), html, declared)
        .where(kind.isin("comment", "doctype"))
        .select(*keys, F.col("pos").alias("idx"), kind.alias("kind"),
                F.when(kind == "comment", F.expr("substring(token, 5, length(token) - 7)"))
                .otherwise(F.expr("substring(token, 10, length(token) - 10)")).alias("data"))
    )


def raw_text_blocks(pages: DataFrame, keys=("page_id",), html="html") -> DataFrame:
    """Contents of script, style and textarea elements."""
    raw = F.filter(H.token_array(F.col(html)), H.is_raw_element)
    token = F.col("token")
    return pages.select(*keys, F.posexplode(raw).alias("idx", "token")).select(
        *keys, "idx", H.tag_name(token).alias("name"), H.raw_content(token).alias("data"),
        (H.raw_close(token) != "").alias("closed"))


def tag_balance(pages: DataFrame, keys=("page_id",), html="html") -> DataFrame:
    """Opens minus closes per page and element; void elements are left out."""
    return (
        tag_names(pages, keys, html)
        .where(~F.col("name").isin(fixed.VOID_ELEMENTS))
        .groupBy(*keys, "name")
        .agg(F.count_if(~F.col("is_closing")).alias("opens"),
             F.count_if(F.col("is_closing")).alias("closes"))
        .withColumn("balance", F.col("opens") - F.col("closes"))
    )
