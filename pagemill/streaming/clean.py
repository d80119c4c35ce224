"""Cleaning a stream of arriving pages."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from pagemill.operators.clean import apply_strip
from pagemill.operators.markdown import html_to_markdown


def page_stream(spark: SparkSession, folder: str, schema, pattern="*.parquet", files_per_trigger=None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def table_stream(spark: SparkSession, path: str, files_per_trigger=None) -> DataFrame:
    """A table as a stream, by the schema that it has as a batch: a folder of part files, or a single file."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    schema = spark.read.parquet(path).schema
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory():
        return page_stream(spark, path, schema, files_per_trigger=files_per_trigger)
    return page_stream(spark, place.getParent().toString(), schema, place.getName(), files_per_trigger)


def clean_stream(pages: DataFrame, mode: str, html="html", out="text") -> DataFrame:
    """Row-local modes run on the stream itself."""
    moded = pages.withColumn("_mode", F.lit(mode))
    return apply_strip(moded, html, "_mode", out, [], ("none", "whitespace", "attributes", "tags")).drop("_mode")


def start_clean(pages: DataFrame, path: str, checkpoint: str, mode="tags", html="html", out="text"):
    """Append cleaned pages to a parquet folder; returns the query, run until the input is used up."""
    return (
        clean_stream(pages, mode, html, out).drop(html).writeStream.format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start())


def start_markdown(pages: DataFrame, path: str, checkpoint: str, keys=("page_id",), html="html", out="text"):
    """Markdown needs windows over a page, so it runs on each micro-batch.

    A batch is written to its own folder with overwrite, so a repeated batch after a failure
    replaces itself.
    """

    def write(batch, batch_id):
        html_to_markdown(batch, list(keys), html, out).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start())
