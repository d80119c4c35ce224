"""Size metrics, the fetch report and size reduction per host."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from pagemill.functions.urls import host
from pagemill.sources.bodies import scratch_folder


def line_count(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1


def is_html(content_type: Column) -> Column:
    return F.contains(F.lower(F.coalesce(content_type, F.lit(""))), F.lit("text/html"))


def format_size(size: Column) -> Column:
    """512B, 1.5KB, 2.0MB: one decimal, halves rounded up, in whole-number arithmetic."""

    def scaled(unit, name):
        tenths = F.floor((size * 10 + unit // 2) / unit).cast("bigint")
        return F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit(name))

    return (
        F.when(size < 1024, F.concat(size.cast("string"), F.lit("B")))
        .when(size < 1024 * 1024, scaled(1024, "KB"))
        .otherwise(scaled(1024 * 1024, "MB")))


def page_metrics(df: DataFrame, keys, raw: str, stripped: str, content_type: str) -> DataFrame:
    return df.select(
        *keys,
        F.octet_length(raw).alias("raw_bytes"), F.length(raw).alias("raw_chars"),
        F.octet_length(stripped).alias("stripped_bytes"), F.length(stripped).alias("stripped_chars"),
        line_count(F.col(stripped)).alias("lines"), is_html(F.col(content_type)).alias("is_html"))


def fetch_report(df: DataFrame) -> Column:
    """Report text for rows with status, final_url, content_type, headers, raw_text, stripped,
    requested, applied, content, truncated, output_lines, total_lines, output_bytes, total_bytes."""
    sized = F.concat(F.lit(" → "), format_size(F.octet_length("stripped")), F.lit(" ("),
                     F.length("stripped"), F.lit(" chars)\n"))
    strip_line = (
        F.when(F.col("applied") != "none", F.concat(F.lit("Strip: "), "applied", sized))
        .when((F.col("requested") != "none") & ~is_html(F.col("content_type")),
              F.concat(F.lit("Strip: "), "requested", F.lit(" (skipped, non-HTML content)"), sized))
        .otherwise(""))
    header_lines = F.array_join(F.transform(
        "headers", lambda h: F.concat(F.lit("  "), h["key"], F.lit(": "), h["value"], F.lit("\n"))), "")
    note = F.when(F.col("truncated"), F.concat(
        F.lit("\n\n[Output truncated: "), "output_lines", F.lit(" of "), "total_lines", F.lit(" lines ("),
        format_size(F.col("output_bytes")), F.lit(" of "), format_size(F.col("total_bytes")), F.lit(").]"))).otherwise("")
    return F.concat(
        F.lit("HTTP "), "status", F.lit(" "), "final_url", F.lit("\nContent-Type: "), "content_type",
        F.lit("\nRaw size: "), format_size(F.octet_length("raw_text")), F.lit(" ("), F.length("raw_text"),
        F.lit(" chars)\n"), strip_line, F.lit("Lines: "), line_count(F.col("stripped")),
        F.lit("\n\nResponse Headers:\n"), header_lines, F.lit("---\n"), "content", note)


def raw_report(body_file: Column = None) -> Column:
    """Report text of a raw request: status, method, url, body or file, headers, error."""
    file = F.col("body_file") if body_file is None else body_file
    body = F.coalesce("body", F.lit(""))
    shown = (
        F.when(F.coalesce(file, F.lit("")) != "", F.concat(F.lit("Response written to: "), file, F.lit("\n")))
        .when(body != "", F.concat(F.lit("Body size: "), format_size(F.octet_length(body)),
                                   F.lit(" bytes\n---\n"), body))
        .otherwise(""))
    header_lines = F.when(F.size("headers") > 0, F.concat(F.lit("\n\nResponse Headers:\n"), F.array_join(F.transform(
        "headers", lambda h: F.concat(F.lit("  "), h["key"], F.lit(": "), h["value"], F.lit("\n"))), ""))).otherwise("")
    failed = F.when(F.col("error").isNotNull(), F.concat(F.lit("\nError: "), "error", F.lit("\n"))).otherwise("")
    return F.concat(F.lit("HTTP "), "status", F.lit("\nMethod: "), "method", F.lit("\nURL: "), "url",
                    F.lit("\n"), shown, header_lines, failed)


def exact_quantile(counted: DataFrame, keys: list[str], value: str, n: str, share: float, out: str) -> DataFrame:
    """The exact discrete quantile of each group: the smallest value that at least `share` of the rows do not exceed.

    counted holds rows (keys, value, n): a whole-number value of 0 or more and how often it occurs; null values count
    nothing and null keys are a group. The histogram is refined from bins of 4,096 values to single ones, so a pass
    sorts few bins of a group (half a million for sizes of up to 2 GB), however many rows the group has.
    """
    names = [f"k{i}" for i in range(len(keys))]
    rows = counted.where(F.col(value).isNotNull()).select(
        *[F.col(k).alias(a) for k, a in zip(keys, names)], F.col(value).cast("bigint").alias("v"), F.col(n).alias("n"))
    found = None
    for shift in (12, 0):
        binned = rows.withColumn("bin", F.shiftright("v", shift))
        if found is not None:
            # Only rows of the bin that holds the group's rank go on.
            before = found.select(*[F.col(a).alias(f"f_{a}") for a in names], F.col("bin").alias("outer"), "rank")
            same = F.shiftright("v", last) == F.col("outer")
            for a in names:
                same = same & F.col(a).eqNullSafe(F.col(f"f_{a}"))
            binned = binned.join(before, same).select(*names, "v", "n", "bin", "rank")
        given = [] if found is None else [F.first("rank").alias("rank")]
        bins = binned.groupBy(*names, "bin").agg(F.sum("n").alias("n"), *given)
        group = Window.partitionBy(*names)
        upto = F.sum("n").over(group.orderBy("bin"))
        if found is None:
            bins = bins.withColumn("rank", F.greatest(F.lit(1), F.ceil(F.sum("n").over(group) * F.lit(share))))
        found = (bins.withColumn("upto", upto).where("rank <= upto and rank > upto - n")
                 .select(*names, "bin", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank")))
        last = shift
    return found.select(*[F.col(a).alias(k) for k, a in zip(keys, names)], F.col("bin").alias(out))


def reduction(sizes: DataFrame) -> DataFrame:
    """Totals per (host, mode), per host and over all of rows (host, mode, raw_bytes, stripped_bytes), with exact medians.

    Equal sizes are combined map-side first, so a host with a third of all pages is at most as many rows as it has sizes.
    These counts are written to the shared scratch folder: totals and each pass of the medians read them, the pages are
    cleaned once.
    """
    spark = sizes.sparkSession
    folder = scratch_folder(spark, "sizes")
    sizes.groupBy("host", "mode", "stripped_bytes").agg(
        F.count("*").alias("n"), F.sum("raw_bytes").alias("raw_bytes")).write.parquet(folder)
    counted = spark.read.parquet(folder)
    nothing = F.lit(None).cast("string")
    levels = F.array(
        F.struct(F.lit(0).alias("level"), F.col("host").alias("host"), F.col("mode").alias("mode")),
        F.struct(F.lit(1).alias("level"), F.col("host").alias("host"), nothing.alias("mode")),
        F.struct(F.lit(2).alias("level"), nothing.alias("host"), nothing.alias("mode")))
    rows = counted.select(F.explode(levels).alias("of"), "stripped_bytes", "n", "raw_bytes").select(
        "of.*", "stripped_bytes", "n", "raw_bytes")
    keys = ["level", "host", "mode"]
    totals = rows.groupBy(*keys).agg(
        F.sum("n").alias("pages"), F.sum("raw_bytes").alias("raw_bytes"),
        F.sum(F.col("stripped_bytes") * F.col("n")).alias("stripped_bytes"))
    medians = exact_quantile(rows, keys, "stripped_bytes", "n", 0.5, "median_bytes").select(
        *[F.col(k).alias(f"m_{k}") for k in keys], "median_bytes")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"m_{k}"))
    return totals.join(medians, same, "left").select(
        "host", "mode", "pages", "raw_bytes", "stripped_bytes", "median_bytes",
        F.round(F.col("stripped_bytes") / F.col("raw_bytes"), 6).alias("kept"))


def reduction_by_host(pages: DataFrame, modes: dict, url="url", html="html", markdown_keys=None) -> DataFrame:
    """How much each strip mode shrinks pages, per host and in total: the row-local modes given, and Markdown
    where markdown_keys name the columns that identify a page."""
    by_host = host(F.col(url)).alias("host")
    sizes = pages.select(
        by_host, F.octet_length(html).alias("raw_bytes"),
        F.explode(F.array(*[
            F.struct(F.lit(m).alias("mode"), F.octet_length(fn(F.col(html))).alias("stripped_bytes"))
            for m, fn in modes.items()])).alias("m")).select("host", "m.mode", "raw_bytes", "m.stripped_bytes")
    if markdown_keys:
        from pagemill.operators.markdown import html_to_markdown

        # The host and the size go through the plan in place of the URL, so the page itself is not read twice.
        narrow = pages.select(*markdown_keys, html, by_host, F.octet_length(html).alias("raw_bytes"))
        text = html_to_markdown(narrow, [*markdown_keys, "host", "raw_bytes"], html, "text")
        sizes = sizes.unionByName(text.select(
            "host", F.lit("html2md").alias("mode"), "raw_bytes", F.octet_length("text").alias("stripped_bytes")))
    return reduction(sizes)
