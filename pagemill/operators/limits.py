"""Truncation to whole lines within a line and a byte limit. Row-local: no explode, no shuffle."""

from pyspark.sql import Column, DataFrame, functions as F

from pagemill.fixed import MAX_BYTES, MAX_LINES
from pagemill.functions.text import let
from pagemill.operators.metrics import line_count


def _head(text: Column, max_bytes: int, max_lines: int) -> Column:
    def cut(lines):
        # One byte more than allowed: a newline there means the line before it fits.
        window = F.substring(F.encode(lines, "UTF-8"), 1, max_bytes + 1)
        last = F.octet_length(F.substring_index(window.cast("string"), "\n", -1))
        kept = F.octet_length(window) - last - 1
        return F.when(F.octet_length(lines) <= max_bytes, lines).otherwise(
            F.when(kept > 0, window.substr(F.lit(1), kept).cast("string")).otherwise(""))

    return let(F.substring_index(text, "\n", max_lines), cut)


def _tail(text: Column, max_bytes: int, max_lines: int) -> Column:
    def cut(lines):
        data = F.encode(lines, "UTF-8")
        size = F.octet_length(lines)
        window = data.substr(size - max_bytes, F.lit(max_bytes + 1))
        first = F.octet_length(F.substring_index(window.cast("string"), "\n", 1))
        return F.when(size <= max_bytes, lines).otherwise(
            F.when(first <= max_bytes, window.substr(first + 2, F.lit(max_bytes + 1)).cast("string")).otherwise(""))

    return let(F.substring_index(text, "\n", -max_lines), cut)


def truncate(df: DataFrame, text: str, strategy="head", max_bytes=MAX_BYTES, max_lines=MAX_LINES) -> DataFrame:
    """Adds content, truncated, output_lines, total_lines, output_bytes and total_bytes.

    The longest prefix (suffix) of whole lines within both limits; when not even one line
    fits, the content is empty and counts no line.
    """
    cut = (_tail if strategy == "tail" else _head)(F.col(text), max_bytes, max_lines)
    whole = df.withColumn("content", cut)
    fits = F.octet_length("content") == F.octet_length(text)
    nothing = ~fits & (F.col("content") == "") & (F.octet_length(
        F.substring_index(F.col(text), "\n", -1 if strategy == "tail" else 1)) > 0)
    return whole.select(
        "*", (~fits).alias("truncated"),
        F.when(nothing, 0).otherwise(line_count(F.col("content"))).alias("output_lines"),
        line_count(F.col(text)).alias("total_lines"),
        F.octet_length("content").alias("output_bytes"), F.octet_length(text).alias("total_bytes"))
