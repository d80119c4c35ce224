"""The response log: one canonical row per fetched response, from several source tables."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagemill.session import table

SOURCES = ("pages", "documents", "events", "conversations", "embeddings")


def _headers(content_type: Column, size: Column) -> Column:
    def pair(key, value):
        return F.struct(F.lit(key).alias("key"), value.alias("value"))

    return F.array(
        pair("Content-Type", content_type),
        pair("Content-Length", size.cast("string")))


def _record(df: DataFrame, source, key, url, final_url, status, content_type, body, size=None):
    ct = F.lit(content_type)
    size = F.octet_length(body) if size is None else size
    return df.select(
        F.lit(source).alias("source"), key.cast("bigint").alias("id"),
        url.alias("url"), final_url.alias("final_url"), status.cast("int").alias("status"),
        _headers(ct, size).alias("headers"), ct.alias("content_type"), body.alias("raw_text"))


def response_log(spark: SparkSession, folder: str, sources=SOURCES) -> DataFrame:
    """Union of the fetched tables; Catalyst prunes the columns a query does not read."""
    ok = F.lit(200)
    parts = []
    if "pages" in sources:
        url = F.col("url")
        # Plain http pages were redirected to https.
        parts.append(_record(
            table(spark, folder, "pages"), "pages", F.col("page_id"), url,
            F.regexp_replace(url, r"\Ahttp://", "https://"), ok, "text/html; charset=utf-8", F.col("html")))
    if "documents" in sources:
        url = F.concat(F.lit("https://docs.example.org/"), "source", F.lit("/"), "doc_id")
        parts.append(_record(
            table(spark, folder, "documents"), "documents", F.col("doc_id"), url, url, ok,
            "text/plain", F.col("text")))
    if "events" in sources:
        url = F.concat(F.lit("https://api.example.net/users/"), "user_id", F.lit("/events/"), "event_id")
        failed = F.col("event_type") == "error"
        # Failed calls were sent to an internal address.
        parts.append(_record(
            table(spark, folder, "events"), "events", F.col("event_id"), url,
            F.when(failed, F.concat(F.lit("http://192.168.0."), F.col("user_id") % 256, F.lit("/"))).otherwise(url),
            F.when(failed, 503).otherwise(200), "application/json", F.col("props")))
    if "conversations" in sources:
        url = F.concat(F.lit("https://chat.example.com/"), "conv_id", F.lit("/"), "turn")
        parts.append(_record(
            table(spark, folder, "conversations"), "conversations",
            F.col("conv_id") * 1000 + F.col("turn"), url, url,
            F.when(F.col("role") == "user", 200).otherwise(404), "text/plain; charset=utf-8", F.col("text")))
    if "embeddings" in sources:
        url = F.concat(F.lit("https://vec.example.com/"), "vec_id")
        parts.append(_record(
            table(spark, folder, "embeddings"), "embeddings", F.col("vec_id"), url, url, ok,
            "application/octet-stream", F.lit(None).cast("string"), F.size("embedding") * 4))
    return reduce(DataFrame.unionByName, parts)


def response_headers(responses: DataFrame, keys=("source", "id")) -> DataFrame:
    """Long form of the header lists, keys in lower case."""
    return responses.select(*keys, F.posexplode("headers").alias("idx", "h")).select(
        *keys, "idx", F.lower("h.key").alias("key"), F.col("h.value").alias("value"))


def header(name: str) -> Column:
    """Value of one response header, looked up by its name in any case."""
    hit = F.filter(F.col("headers"), lambda h: F.lower(h["key"]) == name.lower())
    return F.get(hit, 0)["value"]
