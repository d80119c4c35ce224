"""Streams over tables that are folders of part files, as every large table is."""

import compare
import pytest

from pagemill.plans import all_queries, all_sql
from pagemill.streaming import clean, throttle

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("parts")
    for name in ("pages", "events"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["stream_clean", "stream_markdown"])
def test_stream_of_part_files(spark, parts, name):
    con = compare.duck(FOLDER)
    rows, problem = compare.compare(spark, con, name, all_queries()[name], all_sql()[name], parts)
    assert problem is None, problem
    assert rows == 50


def test_limited_stream_of_part_files(spark, parts):
    """All part files come in one trigger, so the requests of a key are taken in time order."""
    con = compare.duck(FOLDER)
    rows, problem = compare.compare(spark, con, "s", all_queries()["rate_limit_stream"], all_sql()["rate_limit_stream"], parts)
    assert problem is None, problem
    assert rows == spark.read.parquet(f"{FOLDER}/events.parquet").count()


def test_idle_keys_leave_the_state(spark, tmp_path):
    """State of keys whose window is over is removed, a late request is named, and a history is gone on from."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", throttle.STATE_STORE)
    shape, start = "key string, request long, ms long", 1_700_000_000_000
    parts = [[(f"k{i}", i, start + i) for i in range(50)], [("z", 100, start + 10 * 60_000)],
             [("z", 101, start + 10 * 60_000 + 1), ("k1", 102, start + 5)]]
    states = spark.createDataFrame([("k0", 0, start - 1)], "key string, tokens long, last_ms long")
    for n, rows in enumerate(parts):
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        log = clean.page_stream(spark, f"{tmp_path}/in", shape, files_per_trigger=1)
        out = throttle.rate_limit_stream(log, 2, 60_000, "1 minute", states, with_late=True)
        run = (out.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/check")
               .outputMode("append").trigger(availableNow=True).start())
        run.awaitTermination()
        kept = [p["stateOperators"][0]["numRowsTotal"] for p in run.recentProgress if p["stateOperators"]]
        most = max(kept) if n == 0 else most
    assert kept[-1] < most / 5
    got = {r["request"]: r for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert len(got) == 53
    assert [k for k, r in got.items() if r["late"]] == [102] and not got[102]["admitted"] and got[102]["wait_ms"] is None
    assert not got[0]["admitted"] and all(got[k]["admitted"] for k in [*range(1, 50), 100, 101])
