"""Request manifest: what would be sent for each row of a request table."""

from pyspark.sql import Column, DataFrame, functions as F

from pagemill.fixed import (
    DEFAULT_TIMEOUT_S, ACCEPT, BODY_EXTENSIONS, DEFAULT_BODY_TYPE, MAX_TIMEOUT_MS, MIN_TIMEOUT_MS, USER_AGENT)
from pagemill.functions.text import let
from pagemill.functions.urls import validate_url


def default_headers() -> Column:
    return F.create_map(F.lit("User-Agent"), F.lit(USER_AGENT), F.lit("Accept"), F.lit(ACCEPT))


def build_headers(custom: Column) -> Column:
    """Defaults overlaid with custom headers, matched by exact key."""
    custom = F.coalesce(custom, F.expr("cast(map() as map<string,string>)"))
    kept = F.map_filter(default_headers(), lambda k, v: ~F.map_contains_key(custom, k))
    return F.map_concat(kept, custom)


def parse_headers(text: Column) -> Column:
    """Headers given as a JSON object; null when the whole text is not one. The last value of a name counts.

    The text is parsed as the first item of an array that ends with an object named by the text's own digest:
    anything before, between or after would give another array.
    """
    def by_name(entries):
        return F.array_sort(F.transform(
            entries, lambda e, i: F.struct(e["key"].alias("key"), (-i).alias("place"), e["value"].alias("value"))))

    def last(named):
        kept = F.filter(named, lambda e, i: (i == 0) | (F.get(named, i - 1)["key"] != e["key"]))
        return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["key"], e["value"])))

    def of(parsed):
        whole = (F.size(parsed["items"]) == 2) & (F.element_at(F.map_keys(F.get(parsed["items"], F.lit(1))), 1) == parsed["mark"])
        return F.when(whole, let(by_name(F.map_entries(F.get(parsed["items"], F.lit(0)))), last))

    def parse(mark):
        return F.struct(mark.alias("mark"), F.from_json(
            F.concat(F.lit("["), text, F.lit(',{"'), mark, F.lit('":""}]')), "array<map<string,string>>",
            {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}).alias("items"))

    # Each step is bound once: a text is parsed once, however many names it holds.
    return let(let(F.sha2(text, 256), parse), of)


def timeout_ms(seconds: Column) -> Column:
    """Null gives the default."""
    ms = F.coalesce(seconds, F.lit(DEFAULT_TIMEOUT_S)).cast("double") * 1000
    return F.least(F.lit(MAX_TIMEOUT_MS), F.greatest(F.lit(MIN_TIMEOUT_MS), ms)).cast("int")


def sends_body(method: Column, body: Column, tool: str) -> Column:
    """fetch: POST, PUT and PATCH as written; raw: everything but GET and HEAD in any case."""
    allowed = (
        method.isin("POST", "PUT", "PATCH") if tool == "fetch"
        else ~F.upper(method).isin("GET", "HEAD"))
    return (F.coalesce(body, F.lit("")) != "") & allowed


def add_content_type(headers: Column, tool: str) -> Column:
    """A default type when there is none: by exact key for fetch, by any case for raw."""
    if tool == "fetch":
        present = F.coalesce(F.try_element_at(headers, F.lit("Content-Type")), F.lit("")) != ""
        rest = F.map_filter(headers, lambda k, v: k != "Content-Type")
    else:
        present = F.exists(F.map_keys(headers), lambda k: F.lower(k) == "content-type")
        rest = headers
    return F.when(present, headers).otherwise(
        F.map_concat(rest, F.create_map(F.lit("Content-Type"), F.lit(DEFAULT_BODY_TYPE))))


def request_manifest(requests: DataFrame, tool="fetch", allow_private=False) -> DataFrame:
    """Adds headers, body, has_body, timeout_ms and error (null for a request that may go out).

    Expects url, method, headers_json, body, body_file and timeout_s. For raw requests, file_error (see
    `bodies.load_bodies`) is an error as well, and a body that was read from a file counts as the body.
    """
    given = F.coalesce(F.col("headers_json"), F.lit(""))
    bad_json = (given != "") & F.col("custom").isNull()
    json_error = F.lit(
        "invalid JSON in `headers`" if tool == "fetch" else "invalid JSON in `http_request_headers`")
    url_error = validate_url(F.col("url"), tool, allow_private)
    rows = requests.withColumn("custom", F.when(given != "", parse_headers(F.col("headers_json"))))
    if tool == "fetch":
        error = F.coalesce(url_error, F.when(bad_json, json_error))
    else:
        read = F.col("file_error") if "file_error" in requests.columns else F.lit(None).cast("string")
        from_file = F.col("from_file") if "from_file" in requests.columns else F.lit(False)
        both = (F.coalesce("body", F.lit("")) != "") & (F.coalesce("body_file", F.lit("")) != "") & ~from_file
        error = F.coalesce(
            F.when(bad_json, json_error), url_error,
            F.when(both, "Cannot specify both http_request_body and http_request_body_file"), read)
    rows = rows.select(
        *requests.columns,
        build_headers(F.col("custom")).alias("base"), error.alias("error"),
        sends_body(F.col("method"), F.col("body"), tool).alias("has_body"),
        timeout_ms(F.col("timeout_s")).alias("timeout_ms"))
    return rows.withColumn(
        "headers", F.when(F.col("has_body"), add_content_type(F.col("base"), tool)).otherwise(F.col("base"))
    ).drop("base")


def file_extension(path: Column) -> Column:
    """Lower-case extension of the last path segment with its dot; empty when there is none."""
    return F.lower(F.regexp_extract(F.substring_index(path, "/", -1), r"[^.](\.[^.]*)\z", 1))


def extension_allowed(path: Column) -> Column:
    ext = file_extension(path)
    return (ext == "") | ext.isin(BODY_EXTENSIONS)
