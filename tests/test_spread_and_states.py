"""What makes the work of a query grow: rows that windows move, rows that one task reads, states that a stream takes over."""

from pyspark.sql import functions as F

from pagemill.operators import requests, structure
from pagemill.session import spread
from pagemill.streaming.throttle import bucket_states


def test_page_text_is_one_row(spark):
    """Beside the tags asked for, the page's text is one row, whatever number of texts and tags the page has."""
    html = "x<p>a</p>" * 50 + "<details><summary>s</summary>b<details>c</details>d</details><noscript><details>n</details></noscript>e"
    pages = spark.createDataFrame([(1, html), (2, ""), (None, "<details>q</details>")], "page_id int, html string")
    rows = structure._visible_events(pages, ["page_id"], "html", ["details", "summary"]).collect()
    texts = {r["page_id"]: r["text"] for r in rows if r["text"]}
    assert texts == {1: "xa" * 50 + "sbcde", None: "q"}
    assert len([r for r in rows if r["page_id"] == 1]) == 1 + 6 + 1
    found = {(r["page_id"], r["idx"], r["summary"], r["body"]) for r in structure.details_sections(pages).collect()}
    assert found == {(1, 0, "s", "bcd"), (1, 1, "", "c"), (None, 0, "", "q")}


def test_one_row_group_is_dealt_out(spark, tmp_path):
    """A file of one row group has many splits here, but one holds all rows."""
    cores, name = spark.sparkContext.defaultParallelism, "spark.sql.files.maxPartitionBytes"
    spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t")).coalesce(1).write.parquet(f"{tmp_path}/t")
    before = spark.conf.get(name)
    spark.conf.set(name, "20000")
    try:
        table = spark.read.parquet(f"{tmp_path}/t")
        assert table.rdd.getNumPartitions() >= cores
        dealt = spread(table)
        sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 20_000 and max(sizes) * cores <= 2 * 20_000
    finally:
        spark.conf.set(name, before)
    assert spread(spark.createDataFrame([], "id int")).count() == 0


def test_headers_are_parsed_once(spark):
    texts = ['{"a": "1", "b": "2", "a": "3"}', '{"a": "1"}, {"b": "2"}', "{}", None, "[", '{"a": null}']
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    parsed = rows.select("i", requests.parse_headers(F.col("t")).alias("h"))
    assert parsed._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
    assert {r["i"]: r["h"] for r in parsed.collect()} == {
        0: {"a": "3", "b": "2"}, 1: None, 2: {}, 3: None, 4: None, 5: {"a": None}}


def test_full_buckets_are_no_states(spark):
    """A stream that begins at 1,000 takes over the buckets alone that are not full by then; without a beginning, all."""
    decided = spark.createDataFrame(
        [("full", 1, 100, 100), ("open", 1, 950, 0), ("open", 2, 960, 20), ("edge", 1, 900, 0), (None, 1, 990, 100)],
        "key string, request int, ms long, tokens_left long")
    taken = bucket_states(decided, 1_000, 2, 100)
    assert {r["key"]: (r["tokens"], r["last_ms"]) for r in taken.collect()} == {"open": (20, 960), None: (100, 990)}
    assert bucket_states(decided).count() == 4
