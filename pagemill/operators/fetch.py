"""One fetch job from the response log to report texts: limit, redirect, gate, strip, truncation, report."""

from pyspark.sql import DataFrame, functions as F

from pagemill.fixed import MAX_BYTES, MAX_LINES, STRIP_MODES
from pagemill.operators import clean, limits, metrics
from pagemill.operators.responses import redirect_error, text_or_placeholder


def fetch_job(responses: DataFrame, requested: str, keys: list[str], admitted: str | None = None, strategy="head",
              max_bytes=MAX_BYTES, max_lines=MAX_LINES, modes=tuple(STRIP_MODES)) -> DataFrame:
    """Per response (columns of the response log, keys that identify it, and the strip mode asked for) its report.

    A request that `admitted` says no to ends as status 429 at its own URL, one whose redirect leads to a private address
    as status 0 at that address; neither has headers or content, and their mode counts as applied. Other responses
    give their text, or a placeholder where it is not text, cleaned by the mode if it is HTML and cut to the limits.
    Returns keys, final_url, status, is_error, requested, applied, raw_bytes, stripped_bytes, stripped_lines, truncated,
    output_lines and report. All but Markdown is one projection; only rows that ask for Markdown are taken apart.
    """
    refused = F.lit(False) if admitted is None else ~F.coalesce(F.col(admitted), F.lit(True))
    rows = text_or_placeholder(responses, "_text").select(
        *keys, "url", "final_url", "status", "headers", "content_type", F.col("_text"),
        F.col(requested).alias("requested"), refused.alias("_refused"),
        redirect_error(F.col("url"), F.col("final_url")).isNotNull().alias("_blocked"))
    empty = F.col("_refused") | F.col("_blocked")
    no_headers = F.array().cast(responses.schema["headers"].dataType)
    rows = rows.select(
        *keys, F.when(F.col("_refused"), F.col("url")).otherwise(F.coalesce("final_url", "url")).alias("final_url"),
        F.when(F.col("_refused"), 429).when(F.col("_blocked"), 0).otherwise(F.col("status")).alias("status"),
        (empty | (F.col("status") >= 400)).alias("is_error"),
        F.when(empty, no_headers).otherwise(F.col("headers")).alias("headers"),
        F.when(empty, "").otherwise(F.coalesce("content_type", F.lit("unknown"))).alias("content_type"),
        F.when(empty, "").otherwise(F.coalesce("_text", F.lit(""))).alias("raw_text"), "requested",
        F.when(empty, F.col("requested")).otherwise(
            clean.resolve_strip(F.col("requested"), F.col("content_type"))).alias("applied"), empty.alias("_empty"))
    # An empty text has nothing to clean, so it does not enter the Markdown plan.
    rows = rows.withColumn("_mode", F.when(F.col("_empty"), "none").otherwise(F.col("applied")))
    stripped = clean.apply_strip(rows, "raw_text", "_mode", "stripped", keys, modes)
    cut = limits.truncate(stripped, "stripped", strategy, max_bytes, max_lines)
    return cut.select(
        *keys, "final_url", "status", "is_error", "requested", "applied",
        F.octet_length("raw_text").alias("raw_bytes"), F.octet_length("stripped").alias("stripped_bytes"),
        F.col("total_lines").alias("stripped_lines"), "truncated", "output_lines",
        metrics.fetch_report(cut).alias("report"))
