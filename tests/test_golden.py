"""Small inputs with exact outputs."""

import pytest
from pyspark.sql import functions as F

from pagemill.fixed import ENTITIES
from pagemill.functions import html as H, text as T, urls as U
from pagemill.functions.entities import decode_entities
from pagemill.functions.sql import register
from pagemill.operators import clean, limits, metrics, requests as R, structure, tokens
from pagemill.operators.markdown import html_to_markdown

MARKDOWN = [
    ("<h1>Title</h1><p>Content</p><h2>Sub</h2><p>More</p>", "# Title\n\nContent\n\n## Sub\n\nMore"),
    ("<p><b><i>bold italic</i></b></p>", "***bold italic***"),
    ("<p><b>bold text", "**bold text**"),
    ("<pre>  indented\n    more indented</pre>", "```\n  indented\n    more indented\n```"),
    ('<a href="https://example.com">click here</a>', "[click here](https://example.com)"),
    ("<a>plain</a>", "plain"),
    ("<ul><li>Item 1<ul><li>Sub A</li></ul></li><li>Item 2</li></ul>", "- Item 1\n\n- Sub A\n- Item 2"),
    ("<ol><li>a</li><li>b</li></ol>x<hr><hr>y", "1. a\n1. b\n\nx\n\n---\n\ny"),
    ("<table><tr><th>A</th><th>B</th></tr><tr><td>1 <b>x</b></td><td></td></tr></table>",
     "| A | B |\n| --- | --- |\n| 1 **x** | |"),
    ("<blockquote>Outer<blockquote>Inner</blockquote></blockquote>", "> Outer> Inner"),
    ("<html><head><title>x</title></head><body>a<script>b</script><noscript>c<img></noscript>d</body>", "ad"),
    ('<abbr title="HyperText">HTML</abbr>', "HTML (HyperText)"),
    ('<details><summary>Sum</summary>Body</details><p>after</p>', "> **Sum**\n> Body\n\nafter"),
    ('<figure><img src="a.png" alt="A [x]"><figcaption>Cap</figcaption></figure>', "![A \\[x\\]](a.png)\n*Cap*"),
    ('<picture><source srcset="large.jpg 2x"><img src="s.jpg" alt="Responsive"></picture>', "![Responsive](large.jpg)"),
    ("<pre><code>a &lt; b\n\n\n\nc\n</code></pre><p>z</p>", "```\na < b\n\nc\n```\n\nz"),
    ("<pre>unclosed", "```\nunclosed\n```"),
    ("<p>one<br>two</p>", "one\n\ntwo"),
    ("<blockquote><p>q</p></blockquote><p>z</p>", "> q\n\nz"),
    ("<custom>x</custom> <div>y</div>", "x\n\ny"),
    ("", ""),
]


def test_markdown(spark):
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(MARKDOWN)], "id int, html string")
    got = {r["id"]: r["markdown"] for r in html_to_markdown(df, ["id"]).collect()}
    for i, (html, want) in enumerate(MARKDOWN):
        assert got[i] == want, html


def test_markdown_keeps_columns(spark):
    df = spark.createDataFrame([(1, "<p>a</p>", "x", None), (2, None, "y", 5)], "id int, html string, z string, n int")
    got = {r["id"]: r.asDict() for r in html_to_markdown(df, ["id"], carry=True).collect()}
    assert got[1] == {"id": 1, "html": "<p>a</p>", "z": "x", "n": None, "markdown": "a"}
    assert got[2] == {"id": 2, "html": None, "z": "y", "n": 5, "markdown": ""}


def one(spark, fn, value):
    return spark.createDataFrame([(value,)], "x string").select(fn(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("mode,html,want", [
    ("whitespace", "<div>  hello  </div>", "<div> hello </div>"),
    ("attributes", '<img src="photo.jpg" alt="A photo" />', "<img/>"),
    ("attributes", '<!DOCTYPE html><html lang="en">', "<!DOCTYPE html><html>"),
    ("attributes", "<style a=b>p {}</style><!-- c -->&amp;", "<style>p {}</style><!-- c -->&amp;"),
    ("tags", "<p>Bob</p>Marley", "Bob Marley"),
    ("tags", "<p>hello</p>\n\n<p>world</p>", "hello\n\nworld"),
    ("tags", "before<img src='x'/><br/>after", "before after"),
    ("tags", "fo<b>o</b>", "fo o"),
    ("tags", "a<script>x < y</script>b<textarea><i>t</i></textarea>", "ab <i>t</i>"),
    ("tags", "5 < 10 &amp; &nbsp; x", "5 < 10 & x"),
])
def test_strip(spark, mode, html, want):
    assert one(spark, clean.ROW_LOCAL[mode], html) == want


@pytest.mark.parametrize("text,want", [
    ("Price: &euro;100 &copy; 2024", "Price: €100 © 2024"), ("&#0;", "&#0;"), ("&#8364; &#x20AC;", "€ €"),
    ("&abcdefghijklmnopqrst;", "&abcdefghijklmnopqrst;"), ("&toString; &#55296; &#99999999;", "&toString; &#55296; &#99999999;"),
    ("&amp;lt;", "&lt;"), ("a & b &", "a & b &"), ("&Alpha;&lambda;&Ccaron;&szlig;", "ΑλČß"), ("&#65", "&#65"),
])
def test_entities(spark, text, want):
    assert one(spark, decode_entities, text) == want


def test_entity_names(spark):
    """All names in one text: standard ones as the HTML standard has them, the others as listed."""
    assert len(ENTITIES) == 287
    names = sorted(ENTITIES)
    got = one(spark, decode_entities, "|".join(f"&{n};" for n in names)).split("|")
    assert dict(zip(names, got)) == ENTITIES
    for name, value in {"Uogonek": "Ű", "uogonek": "ű", "Udblac": "Ų", "udblac": "ų", "Ycirc": "Ŵ", "ycirc": "ŵ"}.items():
        assert ENTITIES[name] == value


def test_whitespace(spark):
    assert one(spark, T.collapse_whitespace, "foo   bar​") == "foo bar "
    assert one(spark, T.collapse_lines, "\n foo\n\n  \n\nbar  baz \f\n") == "foo\n\nbar baz"


def test_tokens(spark):
    html = '5 < 10<div data-x="<script>alert(1)</script>" b C=d/>t<br/><!-- c --><!doctype x></DIV ><Script>a<b</script>'
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    rows = tokens.html_tokens(df).orderBy("pos").collect()
    shape = [(r["kind"], r["name"], r["is_closing"], r["self_closing"], r["data"]) for r in rows]
    assert shape == [
        ("text", None, False, False, "5 "), ("text", None, False, False, "<"), ("text", None, False, False, " 10"),
        ("tag", "div", False, False, None), ("text", None, False, False, "t"), ("tag", "br", False, True, None),
        ("comment", None, False, False, " c "), ("doctype", None, False, False, " x"), ("tag", "div", True, False, None),
        ("tag", "script", False, False, None), ("text", None, False, False, "a<b"), ("tag", "script", True, False, None)]
    attrs = [(a["name"], a["value"]) for a in rows[3]["attributes"]]
    assert attrs == [("data-x", "<script>alert(1)</script>"), ("b", None), ("C", "d/")]


def test_tokens_are_lossless(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    joined = F.array_join(H.token_array(F.col("html")), "")
    assert pages.where(joined != F.col("html")).count() == 0


@pytest.mark.parametrize("url,host", [
    ("http://user@EXAMPLE.com:80/a?b#c", "example.com"), ("http://2130706433/", "127.0.0.1"),
    ("http://0x7f.1", "127.0.0.1"), ("http://256.1.1.1/", None), ("https://[::1]:8/", "[::1]"), ("http://a b/", None),
    ("http:\\\\x.org\\p", "x.org"), ("http://1.2.3.4.5/", None),
])
def test_host(spark, url, host):
    assert one(spark, U.host, url) == host


def test_size_and_extension(spark):
    assert one(spark, lambda c: metrics.format_size(c.cast("bigint")), "1280") == "1.3KB"
    assert one(spark, lambda c: metrics.format_size(c.cast("bigint")), "1048576") == "1.0MB"
    assert one(spark, R.file_extension, "/a.b/C.JSON") == ".json"
    assert one(spark, R.extension_allowed, "/tmp/x.exe") is False


def test_truncate_against_brute_force(spark):
    texts = ["a\nbb\nccc", "é\n\nxx\n", "\nlonglonglong", "one line only", "", "aa\nbb\ncc\ndd\nee", "ü" * 5 + "\nb"]

    def brute(text, max_bytes, max_lines, tail):
        lines = text.split("\n")
        for n in range(min(max_lines, len(lines)), 0, -1):
            kept = "\n".join(lines[-n:] if tail else lines[:n])
            if len(kept.encode()) <= max_bytes:
                return kept, n
        return "", 0

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    for max_bytes in (0, 1, 2, 4, 6, 9, 50):
        for max_lines in (1, 2, 4):
            for how in ("head", "tail"):
                for r in limits.truncate(df, "t", how, max_bytes, max_lines).collect():
                    want = brute(texts[r["id"]], max_bytes, max_lines, how == "tail")
                    assert (r["content"], r["output_lines"]) == want, (texts[r["id"]], max_bytes, max_lines, how)
                    assert r["truncated"] == (r["content"] != texts[r["id"]])


def test_spans_of_unbalanced_pages(spark):
    df = spark.createDataFrame([(1, "<p><b>a <i>b</i><p>c</b> <blockquote>q<blockquote>r")], "page_id int, html string")
    spans = {(r["name"], r["text"], r["closed"]) for r in structure.emphasis_spans(df).collect()}
    assert spans == {("b", "a b", False), ("i", "b", True)}
    assert {(r["depth"], r["text"]) for r in structure.blockquotes(df).collect()} == {(1, "qr"), (2, "r")}


def test_sql_names(spark):
    register(spark)
    row = spark.sql("select collapse_whitespace('a \t b') a, collapse_lines(' a \n\n\n\n b ') b, is_text_content('TEXT/html') c").first()
    assert tuple(row) == ("a b", "a\n\nb", True)
