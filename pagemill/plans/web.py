"""Queries on requests and responses."""

from pyspark.sql import functions as F

from pagemill.fixed import BODY_EXTENSIONS
from pagemill.functions.urls import host, is_private_host, validate_url
from pagemill.operators import requests as rq, responses as rs
from pagemill.operators.clean import resolve_strip
from pagemill.plans import sql as Q
from pagemill.plans.registry import query
from pagemill.session import spread, table
from pagemill.sources.bodies import body_sink, body_source, load_bodies, scratch_folder, store_bodies, stored_bodies
from pagemill.sources.responses import response_headers, response_log

R = Q.RESPONSES


@query("response_log", f"""
select source, id, url, final_url, status, content_type, size::varchar as content_length, strlen(raw_text) as body_bytes from {R}""")
def q_response_log(spark, folder):
    return response_log(spark, folder).select(
        "source", "id", "url", "final_url", "status", "content_type",
        F.col("headers")[1]["value"].alias("content_length"),
        F.octet_length("raw_text").cast("bigint").alias("body_bytes"))


@query("response_headers", f"""
select source, id, 0 as idx, 'content-type' as key, content_type as value from {R}
union all select source, id, 1, 'content-length', size::varchar from {R}""")
def q_response_headers(spark, folder):
    return response_headers(response_log(spark, folder))


def request_table(spark, folder):
    """A crawl frontier derived from the event log: one request per event."""
    kind = F.col("event_type")
    return spread(table(spark, folder, "events", "event_id", "user_id", "event_type", "value", "props")).select(
        "event_id",
        F.when(kind == "error", F.concat(F.lit("http://10.0.0."), F.col("user_id") % 256, F.lit("/x")))
        .otherwise(F.concat(F.lit("https://api.example.net/users/"), "user_id")).alias("url"),
        F.when(kind == "view", "GET").when(kind == "click", "POST").when(kind == "signup", "PUT")
        .when(kind == "purchase", "delete").otherwise("HEAD").alias("method"),
        F.when(kind == "click", F.concat(F.lit('{"Accept": "text/html", "X-User": "'), "user_id", F.lit('"}')))
        .when(kind == "purchase", '{"content-type": "application/json"}')
        .when((kind == "signup") & (F.col("value") > 30), F.substring("props", 1, 5)).alias("headers_json"),
        F.col("props").alias("body"),
        F.when((kind == "purchase") & (F.col("value") > 50), F.concat(F.lit("bodies/"), "event_id", F.lit(".json"))).alias("body_file"),
        F.col("value").cast("int").alias("timeout_s"))


_UA = "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/144.0.0.0 Safari/537.36"
_BLOCKED = "'Access to internal/private address \"10.0.0.' || (user_id % 256) || '\" is blocked'"
_TIMEOUT = "least(120000, greatest(1000, coalesce(trunc(value)::bigint, 30) * 1000))"
_DEFAULT_TYPE = "Content-Type=text/plain; charset=utf-8"


def _manifest_sql(tool):
    fetch = tool == "fetch"
    bad = "invalid JSON in `headers`" if fetch else "invalid JSON in `http_request_headers`"
    both = "null" if fetch else "case when event_type = 'purchase' and value > 50 then 'Cannot specify both http_request_body and http_request_body_file' end"
    put_type = f"Accept=*/*;{_DEFAULT_TYPE};User-Agent={_UA}"
    return f"""
select event_id,
  case event_type
    when 'click' then 'Accept=text/html;{_DEFAULT_TYPE};User-Agent={_UA};X-User=' || user_id
    when 'signup' then '{put_type}'
    when 'purchase' then 'Accept=*/*;User-Agent={_UA};content-type=application/json'
    else 'Accept=*/*;User-Agent={_UA}' end as header_text,
  event_type in ({"'click','signup'" if fetch else "'click','signup','purchase'"}) as has_body,
  {_TIMEOUT} as timeout_ms,
  case when event_type = 'error' then {_BLOCKED}
       when event_type = 'signup' and value > 30 then '{bad}'
       else {both} end as error
from events"""


def _manifest(spark, folder, tool):
    rows = rq.request_manifest(request_table(spark, folder), tool)
    pairs = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return rows.select(
        "event_id", F.array_join(pairs, ";").alias("header_text"), "has_body",
        F.col("timeout_ms").cast("bigint").alias("timeout_ms"), "error")


@query("request_manifest", _manifest_sql("fetch"))
def q_request_manifest(spark, folder):
    return _manifest(spark, folder, "fetch")


@query("request_manifest_raw", _manifest_sql("raw"))
def q_request_manifest_raw(spark, folder):
    return _manifest(spark, folder, "raw")


@query("body_sink", f"""
select source, id, '' as body_left, strlen(raw_text) as written_bytes, md5(raw_text) as digest
from {R} where source in ('pages', 'documents')""")
def q_body_sink(spark, folder):
    bodies = response_log(spark, folder, ("pages", "documents"))
    path = scratch_folder(spark, "bodies")
    result = body_sink(bodies, "raw_text", path, "source")
    stored = spark.read.parquet(path).select(
        "source", "id", F.octet_length("raw_text").cast("bigint").alias("written_bytes"),
        F.md5(F.encode("raw_text", "UTF-8")).alias("digest"))
    return result.select("source", "id", F.col("raw_text").alias("body_left")).join(stored, ["source", "id"]).select(
        "source", "id", "body_left", "written_bytes", "digest")


@query("body_source", """
select o.o_orderkey as order_key, strlen(b.text) as body_bytes, md5(b.text) as digest,
  case when b.item_id is null then 'Failed to read body file: item-' || (o.o_custkey % 1000) end as error
from orders o left join benchmark b on o.o_custkey % 1000 = b.item_id""")
def q_body_source(spark, folder):
    """Orders name a body file; the files hold the benchmark texts."""
    path = scratch_folder(spark, "files")
    table(spark, folder, "benchmark").select("item_id", "text").write.partitionBy("item_id").text(path)
    files = body_source(spark, path).withColumn(
        "body_file", F.concat(F.lit("item-"), F.regexp_extract("path", r"item_id=(\d+)/", 1)))
    # The text writer closes a file with a newline that is not part of the body.
    files = files.withColumn("body", F.regexp_replace("body", r"\n\z", ""))
    requests = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_key"),
        F.concat(F.lit("item-"), F.col("o_custkey") % 1000).alias("body_file"))
    return requests.join(files, "body_file", "left").select(
        "order_key", F.octet_length("body").cast("bigint").alias("body_bytes"),
        F.md5(F.encode("body", "UTF-8")).alias("digest"),
        F.when(F.col("body").isNull(), F.concat(F.lit("Failed to read body file: "), "body_file")).alias("error"))


@query("body_store", f"""
select source, id, strlen(raw_text) as body_bytes, sha256(raw_text) as body_sha256, raw_text is not null as stored,
  case when raw_text is null then null else md5(raw_text) end as digest
from {R}""")
def q_body_store(spark, folder):
    """Bodies of all sources stored by content in two runs, the second of which finds the first one's bodies."""
    path = scratch_folder(spark, "store")
    log = response_log(spark, folder).select("source", "id", "raw_text")
    first = store_bodies(log.where("source in ('pages', 'documents')"), ["source", "id"], "raw_text", path)
    second = store_bodies(log.where("source not in ('pages', 'documents')"), ["source", "id"], "raw_text", path)
    held = stored_bodies(spark, path).select(
        "body_sha256", "body_path", F.md5(F.encode("body", "UTF-8")).alias("digest"))
    return first.unionByName(second).join(held, ["body_sha256", "body_path"], "left").select(
        "source", "id", "body_bytes", "body_sha256", F.col("body_path").isNotNull().alias("stored"), "digest")


_FILE_ERROR = f"""case when event_id % 7 = 3 then
  'Failed to read body file: File extension ".exe" is not allowed for read operation. Allowed: {", ".join(BODY_EXTENSIONS)}'
  when b.item_id is null then 'Failed to read body file: File not found: items/' || (user_id % 300) || '.json' end"""


@query("request_manifest_files", f"""
select event_id, strlen(b.text) as body_bytes, md5(b.text) as digest, b.text is not null and event_type <> 'view' as has_body,
  coalesce(case when event_type = 'error' then {_BLOCKED} end,
           case when event_type = 'click' then 'Cannot specify both http_request_body and http_request_body_file' end,
           {_FILE_ERROR}) as error
from events left join benchmark b on event_type <> 'click' and user_id % 300 = b.item_id and event_id % 7 <> 3""")
def q_request_manifest_files(spark, folder):
    """Raw requests that name a body file each: the files hold the benchmark texts; clicks give a body as well."""
    items = table(spark, folder, "benchmark").select(
        F.concat(F.lit("items/"), "item_id", F.lit(".json")).alias("body_file"), F.col("text").alias("body"))
    clicked = F.col("event_type") == "click"
    requests = table(spark, folder, "events", "event_id", "user_id", "event_type", "props").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.concat(F.lit("http://10.0.0."), F.col("user_id") % 256, F.lit("/x")))
        .otherwise("https://api.example.net/").alias("url"),
        F.when(F.col("event_type") == "view", "GET").otherwise("POST").alias("method"),
        F.lit(None).cast("string").alias("headers_json"), F.lit(None).cast("int").alias("timeout_s"),
        F.when(clicked, F.col("props")).alias("body"),
        F.concat(F.lit("items/"), F.col("user_id") % 300,
                 F.when(F.col("event_id") % 7 == 3, ".exe").otherwise(".json")).alias("body_file"))
    rows = rq.request_manifest(load_bodies(requests, items), "raw")
    sent = F.when(F.col("from_file"), F.col("body"))
    return rows.select(
        "event_id", F.octet_length(sent).cast("bigint").alias("body_bytes"), F.md5(F.encode(sent, "UTF-8")).alias("digest"),
        (F.col("has_body") & F.col("from_file")).alias("has_body"), "error")


# ---- URL checks ---------------------------------------------------------------------
# Each page URL and its variants: (label, Spark expression, SQL expression, SQL of the error).
_REST = "regexp_replace(url, '^https?://', '')"


def _blocked(h):
    return f"'Access to internal/private address \"' || {h} || '\" is blocked'"


def _invalid(u):
    return f"'Invalid URL: \"' || {u} || '\". Must be a valid URL (e.g. https://example.com)'"


_VARIANTS = {
    "page": ("url", "null"),
    "upper": ("'HTTPS://' || upper(regexp_replace(url, '^https?://', ''))", "null"),
    "user": ("'https://user:pw@' || regexp_replace(url, '^https?://', '')", "null"),
    "empty": ("''", "'URL is required and must be a non-empty string'"),
    "no_scheme": (_REST, _invalid(_REST)),
    "ftp": (f"'ftp://' || {_REST}", "'Invalid protocol: \"ftp:\". Only http: and https: are allowed'"),
    "mailto": ("'mailto:a@b.c'", "'Invalid protocol: \"mailto:\". Only http: and https: are allowed'"),
    "space": ("'http://bad host' || page_id || '/'", _invalid("'http://bad host' || page_id || '/'")),
    "no_host": ("'https://'", _invalid("'https://'")),
    "port": ("'http://example.com:' || (65000 + page_id) || '/'",
             "case when page_id > 535 then " + _invalid("'http://example.com:' || (65000 + page_id) || '/'") + " end"),
    "loopback": ("'http://127.0.0.' || (page_id % 256) || ':8080/'", _blocked("'127.0.0.' || (page_id % 256)")),
    "ten": ("'https://10.1.' || (page_id % 256) || '.9/a'", _blocked("'10.1.' || (page_id % 256) || '.9'")),
    "b172": ("'http://172.' || (page_id % 256) || '.0.1/'",
             "case when page_id % 256 between 16 and 31 then " + _blocked("'172.' || (page_id % 256) || '.0.1'") + " end"),
    "c192": ("'http://192.' || (page_id % 256) || '.0.1/'",
             "case when page_id % 256 = 168 then " + _blocked("'192.168.0.1'") + " end"),
    "link_local": ("'http://169.254.1.' || (page_id % 256) || '/'", _blocked("'169.254.1.' || (page_id % 256)")),
    "zero": ("'http://0.0.0.' || (page_id % 256) || '/'", _blocked("'0.0.0.' || (page_id % 256)")),
    "octet": ("'http://10.0.0.' || (256 + page_id) || '/'", _invalid("'http://10.0.0.' || (256 + page_id) || '/'")),
    "integer": ("'http://' || (2130706432 + page_id) || '/'",
                _blocked("'127.0.' || (page_id // 256) || '.' || (page_id % 256)")),
    "hex": ("'http://0x7f.' || page_id || '/'", _blocked("'127.0.' || (page_id // 256) || '.' || (page_id % 256)")),
    "octal": ("'http://012.0.0.' || (page_id % 8) || '/'", _blocked("'10.0.0.' || (page_id % 8)")),
    "v6_loopback": ("'http://[::1]:' || page_id || '/'", _blocked("'[::1]'")),
    "v6_local": ("'http://[fd00::' || (page_id % 10) || ']/'", _blocked("'[fd00::' || (page_id % 10) || ']'")),
    "v6_public": ("'http://[2001:db8::' || (page_id % 10) || ']/'", "null"),
    "fd_name": ("'http://fd' || page_id || '.example.com/'", "null"),
    "localhost": ("'http://localhost/' || page_id", "null"),
}


def _spark_text(expr):
    return expr.replace("//", "\x00").replace("\x00 256", "div 256").replace("\x00", "//")


def _url_variants(spark, folder):
    structs = ", ".join(f"struct('{k}' as variant, {_spark_text(u)} as url)" for k, (u, _) in _VARIANTS.items())
    return spread(table(spark, folder, "pages", "page_id", "url")).select(
        "page_id", F.explode(F.expr(f"array({structs})")).alias("v")).select("page_id", "v.*")


_URL_SQL = " union all ".join(
    f"select page_id, '{k}' as variant, {u} as url, {e} as error from pages" for k, (u, e) in _VARIANTS.items())


@query("url_validation", _URL_SQL)
def q_url_validation(spark, folder):
    return _url_variants(spark, folder).withColumn("error", validate_url(F.col("url")))


@query("url_validation_raw", f"""
select page_id, variant, case
  when url = '' then '`http_url` is required and must be a non-empty string'
  when error like 'Invalid URL%' then 'Invalid URL: "' || url || '"' else error end as error
from ({_URL_SQL})""")
def q_url_validation_raw(spark, folder):
    return _url_variants(spark, folder).select(
        "page_id", "variant", validate_url(F.col("url"), "raw").alias("error"))


@query("url_validation_open", f"""
select page_id, variant, case when error like 'Access to%' then null else error end as error from ({_URL_SQL})""")
def q_url_validation_open(spark, folder):
    """With private hosts allowed."""
    return _url_variants(spark, folder).select(
        "page_id", "variant", validate_url(F.col("url"), "fetch", True).alias("error"))


@query("private_hosts", f"""
select variant, count(*) as urls, count(*) filter (error like 'Access to%') as private
from ({_URL_SQL}) group by variant""")
def q_private_hosts(spark, folder):
    rows = _url_variants(spark, folder).withColumn("host", host(F.col("url")))
    return rows.groupBy("variant").agg(
        F.count("*").alias("urls"), F.count_if(is_private_host(F.col("host"))).alias("private"))


_REDIRECT_BLOCK = "source = 'events' and status = 503"


@query("redirect_check", f"""
select source, id, case when {_REDIRECT_BLOCK} then 0 else status end as status,
  case when {_REDIRECT_BLOCK} then '' else content_type end as content_type,
  case when {_REDIRECT_BLOCK} then 0 else strlen(raw_text) end as body_bytes,
  case when {_REDIRECT_BLOCK} then
    'Access to internal/private address "' || regexp_extract(final_url, 'http://([0-9.]+)/', 1) || '" is blocked' end as redirect_error,
  status >= 400 as is_error
from {R}""")
def q_redirect_check(spark, folder):
    return rs.check_redirects(response_log(spark, folder)).select(
        "source", "id", "status", "content_type",
        F.octet_length("raw_text").cast("bigint").alias("body_bytes"), "redirect_error", "is_error")


@query("text_content_gate", f"""
select source, content_type, source <> 'embeddings' as is_text, count(*) as responses from {R} group by all""")
def q_text_content_gate(spark, folder):
    return (
        response_log(spark, folder)
        .groupBy("source", "content_type").agg(F.count("*").alias("responses"))
        .select("source", "content_type", rs.is_text_content(F.col("content_type")).alias("is_text"), "responses"))


@query("binary_placeholder", f"""
select source, id, case when source = 'embeddings' then
  '[Binary content: application/octet-stream, ' || size || ' bytes. Use raw_http_request for binary downloads.]'
  else md5(raw_text) end as body,
  case when source = 'embeddings' then 'Non-text content received: application/octet-stream (' || size
    || ' bytes). in_page_search only supports text content.' end as search_error
from {R}""")
def q_binary_placeholder(spark, folder):
    rows = rs.text_or_placeholder(response_log(spark, folder))
    from pagemill.sources.responses import header
    return rows.select(
        "source", "id",
        F.when(rs.is_text_content(F.col("content_type")), F.md5(F.encode("body", "UTF-8"))).otherwise(F.col("body")).alias("body"),
        rs.search_gate_error(F.col("content_type"), header("Content-Length")).alias("search_error"))


@query("strip_mode_resolution", f"""
select content_type, mode as requested, case when source = 'pages' then mode else 'none' end as applied, count(*) as responses
from {R}, unnest(['none', 'whitespace', 'attributes', 'tags', 'html2md']) as m(mode) group by all""")
def q_strip_mode_resolution(spark, folder):
    modes = F.explode(F.array(*[F.lit(m) for m in Q.STRIP_MODES])).alias("requested")
    return (
        response_log(spark, folder).groupBy("content_type").agg(F.count("*").alias("responses"))
        .select("content_type", modes, "responses")
        .select("content_type", "requested",
                resolve_strip(F.col("requested"), F.col("content_type")).alias("applied"), "responses"))


@query("error_flag", f"""
select source, status, status >= 400 as is_error, count(*) as responses from {R} group by all""")
def q_error_flag(spark, folder):
    return response_log(spark, folder).groupBy(
        "source", "status", rs.is_error(F.col("status")).alias("is_error")).agg(F.count("*").alias("responses"))


_LIMIT = "case source when 'pages' then 3000 when 'documents' then 1000 + id % 500 when 'events' then 9 end"


@query("size_limit", f"""
select source, id, case when strlen(raw_text) > lim then
  'Response body (' || strlen(raw_text) || ' bytes) exceeds limit (' || lim || ' bytes)' end as error
from (select *, {_LIMIT} as lim from {R})""")
def q_size_limit(spark, folder):
    rows = response_log(spark, folder).withColumn("lim", F.expr(_LIMIT))
    return rows.select("source", "id", rs.size_limit_error(F.col("raw_text"), F.col("lim")).alias("error"))


@query("raw_report", f"""
select source, id, 'HTTP ' || status || chr(10) || 'Method: GET' || chr(10) || 'URL: ' || url || chr(10)
  || case when strlen(raw_text) between 1 and 5000 then
       'Body size: ' || ({Q.size('strlen(raw_text)')}) || ' bytes' || chr(10) || '---' || chr(10) || raw_text else '' end
  || chr(10) || chr(10) || 'Response Headers:' || chr(10) || '  Content-Type: ' || content_type || chr(10)
  || '  Content-Length: ' || size || chr(10)
  || case when strlen(raw_text) > 5000 then chr(10) || 'Error: Response body (' || strlen(raw_text) || ' bytes) exceeds limit (5000 bytes)' || chr(10) else '' end as report
from (select * replace (coalesce(raw_text, '') as raw_text) from {R})""")
def q_raw_report(spark, folder):
    """Raw requests of all sources; a body over the limit is refused, so the report has the error in its place."""
    from pagemill.operators.metrics import raw_report
    refused = rs.size_limit_error(F.col("raw_text"), F.lit(5000))
    rows = response_log(spark, folder).select(
        "source", "id", "status", F.lit("GET").alias("method"), "url", "headers",
        F.when(refused.isNull(), F.col("raw_text")).otherwise("").alias("body"), F.lit("").alias("body_file"),
        refused.alias("error"))
    return rows.select("source", "id", raw_report().alias("report"))
