"""Predicates and projections on the response log."""

from pyspark.sql import Column, DataFrame, functions as F

from pagemill.fixed import LINE_TRIM
from pagemill.functions.text import let
from pagemill.functions.urls import validate_url
from pagemill.sources.responses import header

_TEXT_TYPE = r"(?i)\A(?:text/|application/(?:json|xml|xhtml\+xml|javascript)|application/x-www-form-urlencoded)"


def is_text_content(content_type: Column) -> Column:
    return F.coalesce(content_type, F.lit("")).rlike(_TEXT_TYPE)


def redirect_error(url: Column, final_url: Column, allow_private=False) -> Column:
    """Error text when a redirect leads to an address that must not be fetched."""
    moved = final_url.isNotNull() & (final_url != "") & (final_url != url)
    return F.when(moved, validate_url(final_url, "fetch", allow_private))


def check_redirects(responses: DataFrame, allow_private=False) -> DataFrame:
    """Blocked redirects become error rows with status 0 and no content."""
    checked = responses.withColumn(
        "redirect_error", redirect_error(F.col("url"), F.col("final_url"), allow_private))
    blocked = F.col("redirect_error").isNotNull()
    return checked.select(
        *[F.when(blocked, F.lit(0)).otherwise(F.col(c)).cast("int").alias(c) if c == "status"
          else F.when(blocked, F.lit("")).otherwise(F.col(c)).alias(c) if c in ("content_type", "raw_text")
          else F.when(~blocked, F.col(c)).otherwise(F.array().cast(responses.schema[c].dataType)).alias(c) if c == "headers"
          else F.col(c)
          for c in checked.columns],
        (blocked | (F.col("status") >= 400)).alias("is_error"))


def binary_placeholder(content_type: Column, content_length: Column) -> Column:
    size = F.when(F.coalesce(content_length, F.lit("")) != "", F.concat(content_length, F.lit(" bytes"))).otherwise("unknown size")
    kind = F.when(F.coalesce(content_type, F.lit("")) != "", content_type).otherwise("unknown type")
    return F.concat(F.lit("[Binary content: "), kind, F.lit(", "), size,
                    F.lit(". Use raw_http_request for binary downloads.]"))


def text_or_placeholder(responses: DataFrame, out="body") -> DataFrame:
    """The body of text responses; a placeholder with type and size for the others."""
    return responses.withColumn(out, F.when(
        is_text_content(F.col("content_type")), F.col("raw_text")
    ).otherwise(let(header("content-length"), lambda n: binary_placeholder(F.col("content_type"), n))))


def search_gate_error(content_type: Column, content_length: Column) -> Column:
    """Search refuses non-text responses instead of showing a placeholder."""
    size = F.when(F.coalesce(content_length, F.lit("")) != "", F.concat(content_length, F.lit(" bytes"))).otherwise("unknown size")
    return F.when(~is_text_content(content_type), F.concat(
        F.lit("Non-text content received: "), content_type, F.lit(" ("), size,
        F.lit("). in_page_search only supports text content.")))


def is_error(status: Column) -> Column:
    return status >= 400


def size_limit_error(body: Column, limit: Column) -> Column:
    """Error text when the UTF-8 size is over the limit; a null limit never fails."""
    size = F.octet_length(body)
    return F.when(size > limit, F.concat(
        F.lit("Response body ("), size, F.lit(" bytes) exceeds limit ("), limit, F.lit(" bytes)")))


def valid_terms(terms: DataFrame, column="term") -> DataFrame:
    """Search terms must hold something but blanks."""
    return terms.where(F.trim(F.col(column), F.lit(LINE_TRIM + "\n")) != "")
