"""Queries on the rate limit and on streams."""

from pyspark.sql import functions as F

from pagemill.fixed import RATE_MAX_REQUESTS, RATE_WINDOW_MS
from pagemill.operators import throttle as T
from pagemill.plans import sql as Q
from pagemill.plans.cleaning import _markdown_sql
from pagemill.plans.registry import query
from pagemill.session import table
from pagemill.sources.bodies import scratch_folder
from pagemill.streaming import clean as stream_clean, throttle as stream_throttle

MAX, WINDOW = 2, 86_400_000


def request_log(spark, folder):
    return table(spark, folder, "events").select(
        F.col("user_id").alias("key"), F.col("event_id").alias("request"), T.epoch_ms(F.col("ts")).alias("ms"))


def _replay_sql(columns, key="user_id", most=MAX, window=WINDOW):
    cap, cost = most * window, window
    return f"""
with recursive e as (
  select {key} as key, event_id as request, (epoch_us(ts) // 1000)::bigint as ms,
    row_number() over (partition by {key} order by epoch_us(ts) // 1000, event_id) as n from events),
r as (
  select key, request, ms, n, true as admitted, {cap - cost}::bigint as tokens_left from e where n = 1
  union all
  select e.key, e.request, e.ms, e.n, least({cap}, r.tokens_left + (e.ms - r.ms) * {most}) >= {cost},
    (least({cap}, r.tokens_left + (e.ms - r.ms) * {most})
      - case when least({cap}, r.tokens_left + (e.ms - r.ms) * {most}) >= {cost} then {cost} else 0 end)::bigint
  from r join e on e.key = r.key and e.n = r.n + 1),
d as (select key, request, ms, admitted, tokens_left,
  case when admitted then 0 else ({cost} - tokens_left + {most - 1}) // {most} end as wait_ms from r)
select {columns} from d"""


def replay(spark, folder):
    return T.rate_limit_replay(request_log(spark, folder), "key", "ms", "request", MAX, WINDOW)


@query("rate_limit_replay", _replay_sql("key, request, ms, admitted, tokens_left"))
def q_replay(spark, folder):
    return replay(spark, folder).drop("wait_ms")


@query("rate_limit_wait", _replay_sql("""request, wait_ms,
  case when wait_ms > 0 then 'Rate limit exceeded. Try again in ' || ((wait_ms + 999) // 1000) || ' seconds.' end as message"""))
def q_wait(spark, folder):
    return replay(spark, folder).select("request", "wait_ms", T.limit_message(F.col("wait_ms")).alias("message"))


@query("rate_limited_rows", _replay_sql("""request, case when not admitted then 429 end as status, not admitted as is_error,
  case when wait_ms > 0 then 'Rate limit exceeded. Try again in ' || ((wait_ms + 999) // 1000) || ' seconds.' end as error"""))
def q_limited(spark, folder):
    return T.rate_limited_rows(replay(spark, folder)).select("request", "status", "is_error", "error")


@query("rate_limit_by_type", _replay_sql("key, count(*) as requests, count(*) filter (admitted) as admitted", "event_type") + " group by key")
def q_by_type(spark, folder):
    """Five keys that each hold a fifth of the log."""
    log = table(spark, folder, "events").select(
        F.col("event_type").alias("key"), F.col("event_id").alias("request"), T.epoch_ms(F.col("ts")).alias("ms"))
    return T.rate_limit_replay(log, "key", "ms", "request", MAX, WINDOW).groupBy("key").agg(
        F.count("*").alias("requests"), F.count_if("admitted").alias("admitted"))


@query("rate_limit_default", _replay_sql("request, admitted, tokens_left, wait_ms", "event_type", RATE_MAX_REQUESTS, RATE_WINDOW_MS))
def q_default(spark, folder):
    """The default limit of 30 per minute, on keys that hold a fifth of the log each."""
    log = table(spark, folder, "events").select(
        F.col("event_type").alias("key"), F.col("event_id").alias("request"), T.epoch_ms(F.col("ts")).alias("ms"))
    return T.rate_limit_replay(log, "key", "ms", "request").select("request", "admitted", "tokens_left", "wait_ms")


def _streamed(spark, folder, keep=None, initial=None):
    """Decisions of a stream over the events; the state store that it needs is set for this query alone."""
    log = stream_clean.table_stream(spark, f"{folder}/events.parquet").select(
        F.col("user_id").alias("key"), F.col("event_id").alias("request"), T.epoch_ms(F.col("ts")).alias("ms"))
    log = log if keep is None else log.where(keep)
    path, name = scratch_folder(spark, "limited"), "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, stream_throttle.STATE_STORE)
    try:
        run = (stream_throttle.rate_limit_stream(log, MAX, WINDOW, initial=initial).writeStream.format("parquet")
               .option("path", f"{path}/out").option("checkpointLocation", f"{path}/check")
               .outputMode("append").trigger(availableNow=True).start())
    finally:
        spark.conf.set(name, before)
    run.awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query("rate_limit_stream", _replay_sql("key, request, ms, admitted, tokens_left, wait_ms"))
def q_stream(spark, folder):
    return _streamed(spark, folder)


_MIDDLE = "(min(epoch_us(ts) // 1000) + max(epoch_us(ts) // 1000)) // 2"


@query("rate_limit_resumed", _replay_sql("key, request, ms, admitted, tokens_left, wait_ms")
       + f" where ms >= (select {_MIDDLE} from events)")
def q_resumed(spark, folder):
    """The earlier half of the time as a batch, the later half as a stream that goes on from its state."""
    log = request_log(spark, folder)
    middle = log.agg(F.floor((F.min("ms") + F.max("ms")) / 2)).first()[0]
    if middle is None:
        return _streamed(spark, folder)
    history = T.rate_limit_replay(log.where(F.col("ms") < middle), "key", "ms", "request", MAX, WINDOW)
    states = stream_throttle.bucket_states(history, middle, MAX, WINDOW)
    # The states are worked out as a batch and written, so that the stream's trigger only reads them.
    path = scratch_folder(spark, "states")
    states.write.parquet(path)
    return _streamed(spark, folder, F.col("ms") >= middle, spark.read.schema(states.schema).parquet(path))


@query("stream_clean", f"select page_id, url, {Q.tags('html')} as text from pages")
def q_stream_clean(spark, folder):
    source = stream_clean.table_stream(spark, f"{folder}/pages.parquet")
    path = scratch_folder(spark, "cleaned")
    stream_clean.start_clean(source, f"{path}/out", f"{path}/check").awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query("stream_markdown", f"select page_id, {_markdown_sql()} as text from pages")
def q_stream_markdown(spark, folder):
    source = stream_clean.table_stream(spark, f"{folder}/pages.parquet")
    path = scratch_folder(spark, "markdown")
    stream_clean.start_markdown(source, f"{path}/out", f"{path}/check").awaitTermination()
    return spark.read.parquet(f"{path}/out").select("page_id", "text")
