"""Fetch jobs on single responses."""

from pyspark.sql import functions as F

from pagemill.operators.fetch import fetch_job

LOG = ("id int, url string, final_url string, status int, headers array<struct<key:string,value:string>>, "
       "content_type string, raw_text string, asked string, ok boolean")
HTML = "text/html; charset=utf-8"


def test_each_way_a_fetch_ends(spark):
    u = "https://a.example/"
    rows = spark.createDataFrame([
        (1, u, u, 200, [("X-A", "b")], HTML, "<p>Hi &amp; <b>bye</b></p>", "tags", True),
        (2, u, u, 200, [], HTML, "<p>Hi &amp; <b>bye</b></p>", "html2md", None),
        (3, u, "http://10.0.0.1/", 200, [("X-A", "b")], HTML, "<p>secret</p>", "html2md", True),
        (4, u, u, 200, [("X-A", "b")], HTML, "<p>never sent</p>", "tags", False),
        (5, u, u, 404, [("Content-Length", "9")], "image/png", None, "tags", True),
        (6, u, None, 200, [], None, "x", "none", True),
    ], LOG)
    got = {r.id: r for r in fetch_job(rows, "asked", ["id"], "ok").collect()}
    assert len(got) == 6
    assert got[1].report == (
        "HTTP 200 https://a.example/\nContent-Type: text/html; charset=utf-8\nRaw size: 26B (26 chars)\n"
        "Strip: tags → 8B (8 chars)\nLines: 1\n\nResponse Headers:\n  X-A: b\n---\nHi & bye")
    assert got[2].report.endswith("---\nHi & **bye**")
    assert (got[3].status, got[3].is_error, got[3].applied) == (0, True, "html2md")
    assert "secret" not in got[3].report and "X-A" not in got[3].report and "http://10.0.0.1/" in got[3].report
    assert (got[4].status, got[4].final_url, got[4].raw_bytes) == (429, u, 0) and "never" not in got[4].report
    assert got[5].is_error and got[5].applied == "none" and got[5].report.endswith(
        "[Binary content: image/png, 9 bytes. Use raw_http_request for binary downloads.]")
    assert "Strip: tags (skipped, non-HTML content)" in got[5].report
    assert got[6].final_url == u and "Binary content: unknown type" in got[6].report


def test_default_limits_cut_whole_lines(spark):
    text = "\n".join(f"line {i}" for i in range(6_000))
    log = spark.createDataFrame([(1, "https://a.example/", None, 200, [], "text/plain", text, "none", True)], LOG)
    head, tail = (fetch_job(log, "asked", ["id"], strategy=s).first() for s in ("head", "tail"))
    assert head.truncated and head.output_lines == 5_000 and "---\nline 0\n" in head.report
    assert "[Output truncated: 5000 of 6000 lines" in head.report and "---\nline 1000\n" in tail.report
    long = log.withColumn("raw_text", F.repeat(F.lit("word " * 20 + "\n"), 3_000))
    row = fetch_job(long, "asked", ["id"]).first()
    assert row.truncated and row.output_lines == 1_980
