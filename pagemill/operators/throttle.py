"""Token-bucket rate limit replayed over a request log.

A bucket holds `max_requests` tokens, starts full, refills continuously over `window_ms` and
each admitted request takes one. Tokens are counted in units of 1/window_ms, so all arithmetic
is in whole numbers.

The recurrence is sequential per key, so the log is made small first: requests are counted per
(key, millisecond), which combines before the shuffle. A key is then cut into independent islands
wherever a whole window holds no request, since the bucket is full after such a gap. A long island, as
that of a key that never pauses, is cut into parts of a bounded number of rows, which are replayed at once from
guessed states; parts whose guess proves wrong are replayed again. So no key is one task.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from pagemill.fixed import RATE_MAX_REQUESTS, RATE_WINDOW_MS
from pagemill.sources.bodies import scratch_folder

#: Rows (milliseconds with requests) of a part, one slot more at most, and slots of a window.
CHUNK_ROWS, SLOTS = 100_000, 64


def epoch_ms(ts: Column) -> Column:
    """Milliseconds of a zone-less timestamp, whatever the session time zone is."""
    return F.unix_millis(F.from_utc_timestamp(ts.cast("timestamp"), F.current_timezone()))


def take(tokens, elapsed, count, max_requests, window_ms):
    """Refill, then admit up to `count` requests: (tokens before, admitted)."""
    tokens = min(max_requests * window_ms, tokens + elapsed * max_requests)
    return tokens, min(count, tokens // window_ms)


def _replayed(max_requests, window_ms, summary):
    """Replays chunks, each from the state beside its rows: a row per (key, ms), or the state at each chunk's end."""

    def run(batches):
        import pandas as pd

        chunk_of, tokens, last = None, 0, 0
        for batch in batches:
            before, admitted, ended = [], [], []
            for *chunk, ms, n, in_tokens, in_last in zip(*(batch[c].tolist() for c in [*_CHUNK, "ms", "n", "tokens", "last"])):
                if chunk != chunk_of:
                    if chunk_of is not None:
                        ended.append((*chunk_of, tokens, last))
                    chunk_of, tokens, last = chunk, in_tokens, in_last
                tokens, taken = take(tokens, ms - last, n, max_requests, window_ms)
                before.append(tokens)
                admitted.append(taken)
                tokens, last = tokens - taken * window_ms, ms
            if summary:
                yield pd.DataFrame(ended, columns=[*_CHUNK, "out_tokens", "out_last"])
            else:
                yield pd.DataFrame({"key": batch["key"], "ms": batch["ms"], "before": before, "taken": admitted})
        if summary and chunk_of is not None:
            yield pd.DataFrame([(*chunk_of, tokens, last)], columns=[*_CHUNK, "out_tokens", "out_last"])

    return run


_CHUNK = ["key", "island", "part"]


def _dealt(placed: DataFrame, states: DataFrame) -> DataFrame:
    """Rows of the chunks in states with their entering state, each chunk whole and in order in one task."""
    joined = placed.join(states.select(*_CHUNK, "tokens", "last"), _CHUNK)
    return joined.repartition(*_CHUNK).sortWithinPartitions(*_CHUNK, "ms")


def _chunks(counts: DataFrame, max_requests, window_ms) -> tuple[DataFrame, DataFrame]:
    """counts with island and part; and (key, island, part, tokens, last): chunks with a first guess of their entering state.

    An island begins after a window without a request, where the bucket is full; that of its first part is
    known. A later part is taken to find less than one token, and of that what was refilled since the island's beginning.
    """
    slot_ms = max(1, window_ms // SLOTS)
    slotted = counts.withColumn("slot", F.floor(F.col("ms") / slot_ms).cast("bigint"))
    slots = slotted.groupBy("key", "slot").agg(F.count("*").alias("rows"), F.min("ms").alias("first_ms"), F.max("ms").alias("last_ms"))
    w = Window.partitionBy("key").orderBy("slot")
    # So many slots between two that hold requests are a whole window.
    gap = F.col("slot") - F.lag("slot").over(w) > -(-window_ms // slot_ms)
    islands = slots.withColumn("cut", F.coalesce(gap, F.lit(False)).cast("int")).withColumn("island", F.sum("cut").over(w))
    v = Window.partitionBy("key", "island").orderBy("slot")
    parts = islands.withColumn("part", F.floor((F.sum("rows").over(v) - F.col("rows")) / CHUNK_ROWS).cast("bigint"))
    placed = slotted.join(parts.select("key", "slot", "island", "part"), ["key", "slot"]).select(*_CHUNK, "ms", "n")
    chunks = parts.groupBy(*_CHUNK).agg(F.min("first_ms").alias("first_ms"), F.max("last_ms").alias("last_ms"))
    u = Window.partitionBy("key", "island").orderBy("part")
    chunks = chunks.select("*", F.lag("last_ms").over(u).alias("before_ms"), F.first("first_ms").over(u).alias("island_ms"))
    first = F.col("part") == 0
    rest = F.pmod((F.col("before_ms") - F.col("island_ms")) * max_requests, F.lit(window_ms))
    return placed, chunks.select(
        *_CHUNK, F.when(first, F.lit(max_requests * window_ms)).otherwise(rest).cast("bigint").alias("tokens"),
        F.when(first, F.col("first_ms")).otherwise(F.col("before_ms")).alias("last"))


def _settled(placed: DataFrame, states: DataFrame, max_requests, window_ms) -> DataFrame:
    """states with the true entering state of each chunk.

    All chunks are replayed at once from their guessed states. A chunk whose guess is not the state that the chunk before it
    ended in is replayed again from that one, until none is left: then each state follows from the one before, up to the known
    one of the first part. A chunk forgets its entering state where the bucket is full once, so few are replayed
    twice; in each round one more part of every island is right at least.
    """
    spark = placed.sparkSession

    def kept(df, name):
        path = scratch_folder(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def ends(of):
        return _dealt(placed, of).mapInPandas(
            _replayed(max_requests, window_ms, True), "key string, island bigint, part bigint, out_tokens bigint, out_last bigint")

    placed, states = kept(placed, "chunks"), kept(states, "states")
    states = kept(states.join(ends(states), _CHUNK), "ends")
    w = Window.partitionBy("key", "island").orderBy("part")
    while True:
        following = states.select(
            "*", F.lag("out_tokens").over(w).alias("new_tokens"), F.lag("out_last").over(w).alias("new_last"))
        wrong = (F.col("part") > 0) & ((F.col("new_tokens") != F.col("tokens")) | (F.col("new_last") != F.col("last")))
        changed = following.where(wrong).select(*_CHUNK, F.col("new_tokens").alias("tokens"), F.col("new_last").alias("last"))
        changed = kept(changed, "changed")
        if changed.isEmpty():
            return states.select(*_CHUNK, "tokens", "last")
        right = states.join(changed.select(*_CHUNK), _CHUNK, "left_anti")
        states = kept(right.unionByName(changed.join(ends(changed), _CHUNK)), "ends")


def rate_limit_replay(log: DataFrame, key: str, ms: str, request: str,
                      max_requests=RATE_MAX_REQUESTS, window_ms=RATE_WINDOW_MS) -> DataFrame:
    """log + (admitted, tokens_left, wait_ms).

    Requests of a key count in order of (ms, request). tokens_left is in 1/window_ms tokens
    after the request; wait_ms is the time until a token is there, for a refused request.
    """
    # The key as text that is never null: rows without a key are one more key, and large numbers stay exact in pandas.
    text = F.to_json(F.struct(F.col(key).alias("k")))
    counts = log.groupBy(text.alias("key"), F.col(ms).alias("ms")).agg(F.count("*").alias("n"))
    placed, states = _chunks(counts, max_requests, window_ms)
    if not states.where("part > 0").isEmpty():
        states = _settled(placed, states, max_requests, window_ms)
    decided = _dealt(placed, states).mapInPandas(
        _replayed(max_requests, window_ms, False), "key string, ms bigint, before bigint, taken bigint")
    rank = F.row_number().over(Window.partitionBy(key, ms).orderBy(request))
    ranked = log.withColumn("_rank", rank).withColumn("_key", text)
    joined = ranked.join(decided.select(
        F.col("key").alias("_key"), F.col("ms").alias(ms), "before", "taken"), ["_key", ms])
    left = F.col("before") - F.least(F.col("_rank"), F.col("taken")) * window_ms
    admitted = F.col("_rank") <= F.col("taken")
    return joined.select(
        *log.columns, admitted.alias("admitted"), left.alias("tokens_left"),
        wait_ms(left, admitted, max_requests, window_ms).alias("wait_ms"))


def wait_ms(tokens_left: Column, admitted: Column, max_requests: int, window_ms: int) -> Column:
    """Milliseconds until a whole token is there, rounded up; 0 for an admitted request."""
    missing = F.lit(window_ms) - tokens_left
    return F.when(admitted, F.lit(0)).otherwise(
        F.floor((missing + (max_requests - 1)) / max_requests)).cast("bigint")


def limit_message(wait: Column) -> Column:
    return F.when(wait > 0, F.concat(
        F.lit("Rate limit exceeded. Try again in "), F.ceil(wait / 1000).cast("bigint"), F.lit(" seconds.")))


def rate_limited_rows(decided: DataFrame) -> DataFrame:
    """Refused requests as response rows with status 429 and an error text."""
    refused = ~F.col("admitted")
    return decided.select(
        "*", F.when(refused, F.lit(429)).cast("int").alias("status"), refused.alias("is_error"),
        limit_message(F.col("wait_ms")).alias("error"))
