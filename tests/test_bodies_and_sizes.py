"""Body store, body files, header texts and exact quantiles."""

import random

import pytest
from pyspark.sql import functions as F

from pagemill.operators import metrics, requests as rq
from pagemill.sources import bodies


@pytest.mark.parametrize("text,want", [
    ('{"a":"1","a":"2","b":"3"}', {"a": "2", "b": "3"}),
    (' {"a": 1} ', {"a": "1"}), ("{}", {}),
    ('{"a":1} x', None), ('{"a":1}]', None), ('{"a":1},{"b":2}', None), ('{"a":1},', None),
    ("{'a':1}", None), ("[1]", None), ('"s"', None), ("", None), ('{"a"', None),
    ('{"x\\u0041":"y\\n"}', {"xA": "y\n"}),
])
def test_header_texts(spark, text, want):
    row = spark.createDataFrame([(text,)], "s string").select(rq.parse_headers(F.col("s")).alias("h")).first()
    assert row.h == want


def test_repeated_header_is_no_dead_job(spark):
    rows = spark.createDataFrame(
        [("https://a.example/", "POST", '{"Accept":"a","Accept":"b"}', "x", None, 5)],
        "url string, method string, headers_json string, body string, body_file string, timeout_s int")
    row = rq.request_manifest(rows).first()
    assert row.error is None and row.headers["Accept"] == "b" and row.headers["Content-Type"].startswith("text/plain")


def test_store_keeps_one_copy_and_shows_no_uncommitted_run(spark, tmp_path):
    folder = str(tmp_path / "store")
    rows = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, None), (5, "")], "id int, t string")
    got = {r.id: r for r in bodies.store_bodies(rows, ["id"], "t", folder).collect()}
    assert got[1].body_path == got[2].body_path is not None and got[4].body_path is None and got[5].body_bytes == 0
    more = bodies.store_bodies(spark.createDataFrame([(6, "x"), (7, "z")], "id int, t string"), ["id"], "t", folder).collect()
    assert {r.id: r.body_path == got[1].body_path for r in more}[6]
    # A run that was killed before its commit.
    spark.createDataFrame([("d", "lost")], "body_sha256 string, body string").write.parquet(f"{folder}/bodies/run=killed")
    assert sorted(r.body for r in bodies.stored_bodies(spark, folder).collect()) == ["", "x", "y", "z"]


def test_files_that_cannot_be_read_are_error_rows(spark):
    files = spark.createDataFrame([("a.json", "A"), ("b.json", None)], "body_file string, body string")
    asked = spark.createDataFrame(
        [(1, None, "a.json"), (2, None, "no.json"), (3, None, "x.exe"), (4, "own", "a.json"), (5, "own", None), (6, None, "b.json")],
        "id int, body string, body_file string")
    rows = {r.id: (r.body, r.from_file, r.file_error) for r in bodies.load_bodies(asked, files).collect()}
    assert rows[1] == ("A", True, None) and rows[4] == ("own", False, None) and rows[5] == ("own", False, None)
    assert rows[2][2].endswith("File not found: no.json") and '".exe" is not allowed' in rows[3][2]
    assert rows[6] == (None, True, None)


@pytest.mark.parametrize("share", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_exact_quantile(spark, share):
    random.seed(7)
    data = [(k, random.choice([0, 1, 2047, 2048, 5_000_000, random.randrange(1 << 31)]), random.randint(1, 4))
            for k in (None, "a", "b") for _ in range(300)] + [("n", None, 5), ("one", 9, 1)]
    df = spark.createDataFrame(data, "k string, v bigint, n bigint")
    got = {r.k: r.q for r in metrics.exact_quantile(df, ["k"], "v", "n", share, "q").collect()}
    for k in (None, "a", "b", "one"):
        values = sorted(v for key, v, n in data if key == k for _ in range(n))
        assert got[k] == values[max(1, -int(-(len(values) * share) // 1)) - 1]
    assert "n" not in got


def test_median_of_millions(spark):
    df = spark.range(3_000_001).select(F.lit("hot").alias("k"), (F.col("id") * 7919 % 3_000_001).alias("v"), F.lit(1).alias("n"))
    assert [tuple(r) for r in metrics.exact_quantile(df, ["k"], "v", "n", 0.5, "q").collect()] == [("hot", 1_500_000)]
