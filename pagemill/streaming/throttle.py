"""The token bucket on a live request stream, with one small keyed state.

A key's state is removed a whole window after its last request, by a timer in event time: its bucket is full by then, as is
that of a key never seen, so no decision changes and the store holds the keys of the last window and lateness only.
Requests older than the watermark would find a bucket that may be gone: they are marked late and take nothing.
"""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from pagemill.fixed import RATE_MAX_REQUESTS, RATE_WINDOW_MS
from pagemill.operators.throttle import take, wait_ms

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Bucket(StatefulProcessor):
    def __init__(self, max_requests, window_ms):
        self.max_requests, self.window_ms = max_requests, window_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bucket = handle.getValueState("bucket", "tokens bigint, last_ms bigint, timer bigint")

    def _keep(self, tokens, last, timer):
        """One timer a key; it is set anew when it goes off, not at each request."""
        if timer is None:
            timer = last + self.window_ms
            self.handle.registerTimer(timer)
        self.bucket.update((tokens, last, timer))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        row = initialState.iloc[0]
        self._keep(int(row["tokens"]), int(row["last_ms"]), None)

    def handleInputRows(self, key, rows, timerValues):
        import pandas as pd

        # One trigger's requests of one key; their number is bounded by the trigger size.
        batch = pd.concat(list(rows)).sort_values(["ms", "request"])
        late = (batch["ms"] < timerValues.getCurrentWatermarkInMs()).tolist()
        tokens, last, timer = self.bucket.get() if self.bucket.exists() else (None, None, None)
        left, admitted = [], []
        for ms, is_late in zip(batch["ms"].tolist(), late):
            if is_late:
                left.append(None)
                admitted.append(False)
                continue
            if tokens is None:
                tokens, last = self.max_requests * self.window_ms, ms
            # A request older than the last one seen finds the bucket as it is.
            elapsed = max(0, ms - last)
            tokens, taken = take(tokens, elapsed, 1, self.max_requests, self.window_ms)
            tokens, last = tokens - taken * self.window_ms, last + elapsed
            left.append(tokens)
            admitted.append(bool(taken))
        if tokens is not None:
            self._keep(tokens, last, timer)
        yield pd.DataFrame({
            "key": key[0], "request": batch["request"].to_numpy(), "ms": batch["ms"].to_numpy(),
            "admitted": admitted, "tokens_left": pd.array(left, dtype="Int64"), "late": late})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.bucket.exists():
            tokens, last, _ = self.bucket.get()
            if last + self.window_ms <= timerValues.getCurrentWatermarkInMs():
                self.bucket.clear()
            else:
                self._keep(tokens, last, None)
        return iter(())

    def close(self) -> None:
        pass


def bucket_states(decided: DataFrame, since=None, max_requests=RATE_MAX_REQUESTS, window_ms=RATE_WINDOW_MS) -> DataFrame:
    """(key, tokens, last_ms) after a batch replay (key, request, ms, tokens_left): initial state of a stream that goes on from it.

    With `since`, the time before which the stream has no request, buckets that are full again by then are left out: they are
    like those of keys never seen.
    """
    last = F.max_by(F.struct("tokens_left", "ms"), F.struct("ms", "request"))
    states = decided.groupBy("key").agg(last.alias("l")).select("key", F.col("l.tokens_left").alias("tokens"), F.col("l.ms").alias("last_ms"))
    if since is None:
        return states
    return states.where(F.col("tokens") + (F.lit(since) - F.col("last_ms")) * max_requests < max_requests * window_ms)


def rate_limit_stream(requests: DataFrame, max_requests=RATE_MAX_REQUESTS, window_ms=RATE_WINDOW_MS, lateness="1 hour",
                      initial: DataFrame | None = None, with_late=False) -> DataFrame:
    """Stream of (key, request, ms) -> + (admitted, tokens_left, wait_ms).

    Needs the RocksDB state store (see STATE_STORE). Fed in time order, the result equals the batch replay; `initial` is
    the state to go on from (see bucket_states). The watermark trails the newest request by `lateness`. A request older than
    the watermark is late: it is not decided on, and comes out only under `with_late`, as a row whose column
    late is true, admitted false, tokens_left and wait_ms null.
    """
    key = requests.schema["key"].dataType.simpleString()
    request = requests.schema["request"].dataType.simpleString()
    # The time column itself is left out again, or late requests would vanish before the processor sees them.
    timed = requests.withColumn("at", F.timestamp_millis("ms")).withWatermark("at", lateness).select("key", "request", "ms")
    decided = timed.groupBy("key").transformWithStateInPandas(
        statefulProcessor=_Bucket(max_requests, window_ms),
        outputStructType=f"key {key}, request {request}, ms bigint, admitted boolean, tokens_left bigint, late boolean",
        outputMode="append", timeMode="EventTime", initialState=initial.groupBy("key") if initial is not None else None)
    wait = F.when(~F.col("late"), wait_ms(F.col("tokens_left"), F.col("admitted"), max_requests, window_ms))
    decided = decided.withColumn("wait_ms", wait)
    return decided if with_late else decided.where("not late").drop("late")
