"""Search and rate limit against brute force on small inputs."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from pagemill.operators import search, throttle

TERMS = "term_id int, term string, context_limit int, strip string"


def overlaps(text, term):
    return [i for i in range(len(text)) if text.startswith(term, i)]


def test_matches_on_both_join_paths(spark, monkeypatch):
    random.seed(3)
    texts = ["".join(random.choice("aAb c\\E") for _ in range(random.randint(0, 60))) for _ in range(40)]
    terms = ["a", "aa", "aaa", "ab", "b c", "\\E", "aab a", "zzz", "c"]
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id int, text string")
    asked = spark.createDataFrame([(i, t, 5, "none") for i, t in enumerate(terms)], TERMS)
    want = {(p, i, n + 1, len(hits), at)
            for p, text in enumerate(texts) for i, term in enumerate(terms)
            for hits in [overlaps(text.lower(), term.lower())] for n, at in enumerate(hits)}

    def got():
        found = search.find_matches(pages, asked, ["page_id"])
        return {(r["page_id"], r["term_id"], r["match_index"], r["total_matches"], r["start"]) for r in found.collect()}

    assert got() == want
    monkeypatch.setattr(search, "BROADCAST_TERMS", 0)
    assert got() == want


def snippets(spark, html, term, limit, mode):
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    asked = spark.createDataFrame([(1, term, limit, mode)], TERMS)
    rows = search.search_snippets(pages, asked, modes=(mode,)).orderBy("match_index").collect()
    return [r["snippet"] for r in rows]


def test_snippets(spark):
    links = '<p><a href="/a">About Us</a> and <a href="/b">About Us</a>, Help&nbsp;Center</p><script>Contact</script>'
    assert snippets(spark, links, "about us", 0, "tags") == ["About Us", "About Us"]
    assert snippets(spark, links, "help center", 3, "tags") == [" , Help Center"]
    assert snippets(spark, links, "Contact", 3, "tags") == []
    assert snippets(spark, "x &euro;100 &lt; 2", "€100 <", 2, "tags") == ["x €100 < 2"]
    assert snippets(spark, links, "About Us", 4, "html2md")[0] == "[About Us](/a"
    for s in snippets(spark, links, "About Us", 3, "none"):
        assert s.count("<") == s.count(">") and "About Us" in s


def test_marks_of_the_page_are_kept(spark):
    """Pages that hold the code points that plans use as marks come out whole, with exact offsets."""
    from pagemill.fixed import MARKS
    from pagemill.functions.entities import decode_entities
    from pagemill.operators.clean import strip_tags
    from pagemill.operators.markdown import html_to_markdown
    from pagemill.operators.structure import blockquotes

    text = "".join(f"{m}a" for m in MARKS) + "\ufddf" + MARKS
    html = f"<p>{text}</p><blockquote>q{MARKS} &amp; &#xFDD0;&#64985;7</blockquote>"
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    quote = f"q{MARKS} & \ufdd0\ufdd97"
    assert pages.select(decode_entities(F.lit("&#xFDD0;&#64975;"))).first()[0] == "\ufdd0\ufdcf"
    assert pages.select(strip_tags(F.col("html"))).first()[0] == f"{text} {quote}"
    assert html_to_markdown(pages, ["page_id"]).first()["markdown"] == f"{text}\n\n> {quote}"
    assert blockquotes(pages).first()["text"] == quote
    asked = spark.createDataFrame([(1, "\ufdd0a", 0, "tags"), (2, "& \ufdd0", 3, "tags"), (3, "\ufdd6", 1, "none"), (4, "\ufddf", 2, "html2md")], TERMS)
    found = search.find_matches(pages.select("page_id", search.visible_text(F.col("html")).alias("text")), asked, ["page_id"])
    places = {(r["term_id"], r["raw_start"], r["raw_end"]) for r in search.match_context(found, pages, ["page_id"]).collect()}
    want = {(1, html.index("\ufdd0a"), html.index("\ufdd0a") + 2), (2, html.index("&amp;"), html.index("&#64985")),
            (4, html.index("\ufddf"), html.index("\ufddf") + 1), *((3, i, i + 1) for i in overlaps(html, "\ufdd6"))}
    assert places == want
    rows = search.search_snippets(pages, asked, modes=("none", "tags", "html2md")).collect()
    shown = {(r["term_id"], r["match_index"]): r["snippet"] for r in rows}
    assert shown[1, 1] == "\ufdd0a" and shown[2, 1] == MARKS[-2:] + " & \ufdd0\ufdd97"[:6]
    assert shown[3, 1] == "a\ufdd6a" and shown[3, 2] == MARKS[6] + "\ufdd6" + MARKS[8] and shown[4, 1] == MARKS[-1] + "a\ufddf" + MARKS[:2]


def brute_context(html, start, end, limit):
    low, high = max(start - 5 * limit, 0), min(end + 5 * limit, len(html))
    cut = html[:low]
    if cut.rfind("<") > cut.rfind(">"):
        low = cut.rfind("<")
    cut = html[:high]
    if cut.rfind("<") > cut.rfind(">") and ">" in html[high:]:
        high = html.index(">", high) + 1
    return low, high


def test_windows_grow_to_whole_tags(spark, monkeypatch):
    """Tags that begin or end in other blocks, stray brackets, windows that reach the ends of the page."""
    monkeypatch.setattr(search, "BLOCK", 16)
    random.seed(11)
    rows = []
    for page in range(60):
        parts = [random.choice(["needle", "x" * random.randint(1, 40), f'<a href="{"y" * random.randint(0, 60)}">', "</a>", "> ", "é" * 7])
                 for _ in range(random.randint(1, 25))]
        rows.append((page, "".join(parts)))
    pages = spark.createDataFrame(rows, "page_id int, html string")
    asked = spark.createDataFrame([(1, "needle", 3, "none"), (2, "xx", 9, "none")], TERMS)
    found = search.find_matches(pages.select("page_id", search.visible_text(F.col("html")).alias("text")), asked, ["page_id"])
    html = dict(rows)
    got = search.match_context(found, pages, ["page_id"]).collect()
    assert len(got) > 300
    for r in got:
        found = html[r["page_id"]][r["raw_start"]:r["raw_end"]]
        assert re.sub("</?a[^>]*>", "", found) == {1: "needle", 2: "xx"}[r["term_id"]]
        assert (r["low"], r["high"]) == brute_context(html[r["page_id"]], r["raw_start"], r["raw_end"], {1: 3, 2: 9}[r["term_id"]])


def test_a_page_with_very_many_matches(spark):
    """A page of 1 MB with 50,000 matches: the work per match does not grow with the page."""
    html = "<p>stone, and a &amp; b</p>" * 50_000
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    asked = spark.createDataFrame([(1, "stone", 10, "tags")], TERMS)
    start = time.time()
    rows = search.search_snippets(pages, asked, modes=("tags",)).select("match_index", "total_matches", "snippet").collect()
    assert time.time() - start < 60
    assert len(rows) == 50_000 and {r["total_matches"] for r in rows} == {50_000}
    middle = [r["snippet"] for r in rows if r["match_index"] == 25_000]
    assert middle == ["and a & b stone, and a & "]


def test_terms_are_looked_up_by_their_rarest_gram(spark):
    """A thousand terms of one common prefix: each meets only the pages that hold its own rare gram."""
    texts = spark.createDataFrame([(i, f"prefix common words {'prefix' if i % 2 else ''} prefix{i:04d}") for i in range(200)], "page_id int, text string")
    asked = spark.createDataFrame([(i, f"Prefix{i:04d}", 5, "none") for i in range(1000)], TERMS)
    keyed = asked.withColumn("lterm", F.lower("term"))
    grams = texts.select(F.explode(search._grams(F.lower("text"), [4])).alias("gram"))
    chosen = search.rarest_grams(grams, keyed, 4, True)
    pages_of = grams.groupBy("gram").count()
    assert chosen.join(pages_of, "gram").agg(F.max("count")).first()[0] <= 20
    found = search.find_matches(texts, asked, ["page_id"]).collect()
    assert {(r["page_id"], r["term_id"]) for r in found} == {(i, i) for i in range(200)}


def test_places_of_terms_in_pieces(spark, monkeypatch):
    """Terms longer than the characters kept around a place, pieces of few characters, wide characters, both join paths."""
    monkeypatch.setattr(search, "PIECE", 7)
    monkeypatch.setattr(search, "AROUND", 5)
    random.seed(8)
    texts = ["".join(random.choice("ab\U0001F600\0 ") for _ in range(random.randint(0, 50))) for _ in range(30)]
    terms = ["a", "ab", "b\0", "\U0001F600a", *[t[i:i + n] for t in texts[:12] for i, n in ((0, 9), (3, 17), (1, 6), (0, 50))]]
    terms = [t for t in terms if t]
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id int, text string")
    asked = spark.createDataFrame([(i, t, 5, "none") for i, t in enumerate(terms)], TERMS)
    want = sorted((p, i, at) for p, text in enumerate(texts) for i, term in enumerate(terms) for at in overlaps(text, term))
    for limit in (50_000, 0):
        monkeypatch.setattr(search, "BROADCAST_TERMS", limit)
        found = search.find_matches(pages, asked, ["page_id"]).collect()
        assert sorted((r["page_id"], r["term_id"], r["start"]) for r in found) == want


def test_equal_terms_and_equal_pages_are_searched_once(spark):
    """400 terms that differ in case alone stand at two places, not at 800; each of them is told, two equal page rows by key."""
    html = "<p>one word, a Word</p>"
    pages = spark.createDataFrame([(1, html), (1, html), (2, "none"), (None, html)], "page_id int, html string")
    asked = spark.createDataFrame([(i, "Word" if i % 2 else "wORD", 3, "tags") for i in range(400)], TERMS)
    texts = pages.select("page_id", search.visible_text(F.col("html")).alias("text"))
    places = search.term_places(texts, asked.withColumn("lterm", F.lower("term")), ["page_id"], True)
    assert sorted((r["copies"], r["start"]) for r in places.collect()) == [(2, 4), (2, 12)]
    found = search.find_matches(texts, asked, ["page_id"]).collect()
    assert sorted((r["term_id"], r["match_index"], r["total_matches"], r["start"]) for r in found) == sorted(
        [(i, n, 2, at) for i in range(400) for n, at in ((1, 4), (2, 12))] * 4)
    assert sorted(search.match_counts(texts, asked, ["page_id"]).collect()) == sorted([(1, i, 2) for i in range(400)] * 4)
    windows = search.match_context(search.find_matches(texts, asked, ["page_id"]), pages, ["page_id"])
    assert windows.groupBy("raw_start", "raw_end").count().orderBy("raw_start").collect() == [(7, 11, 1600), (15, 19, 1600)]
    rows = search.search_snippets(pages, asked, modes=("tags",))
    assert rows.groupBy("match_index", "snippet").count().orderBy("match_index").collect() == [
        (1, "ne word, a", 1600), (2, " a Word", 1600)]


def brute_bucket(log, most, window):
    state, out = {}, {}
    for key, ms, request in sorted(log):
        tokens, last = state.get(key, (most * window, ms))
        tokens = min(most * window, tokens + (ms - last) * most)
        ok = tokens >= window
        tokens -= window if ok else 0
        state[key] = (tokens, ms)
        wait = 0 if ok else -(-(window - tokens) // most)
        out[request] = (ok, tokens, wait)
    return out


def test_rate_limit_with_a_hot_key(spark):
    random.seed(5)
    log = [("hot" if random.random() < 0.6 else random.choice("abc"), random.choice([0, 40_000, 90_000]) + random.randint(0, 9_000), i)
           for i in range(3000)]
    df = spark.createDataFrame(log, "key string, ms bigint, request int")
    rows = throttle.rate_limit_replay(df, "key", "ms", "request", 30, 10_000).collect()
    assert {r["request"]: (r["admitted"], r["tokens_left"], r["wait_ms"]) for r in rows} == brute_bucket(log, 30, 10_000)


@pytest.mark.parametrize("most,window,span", [(2, 1_000, 40_000), (30, 60_000, 900_000), (3, 7, 6_000), (5, 1_000, 3_000_000)])
def test_a_key_that_never_pauses_is_replayed_in_parts(spark, monkeypatch, most, window, span):
    """Parts of few rows under light, heavy and changing load give what one pass over the key gives."""
    monkeypatch.setattr(throttle, "CHUNK_ROWS", 40)
    random.seed(most)
    log = [(random.choice(["hot", "hot", "hot", "cool"]), random.randrange(span // 2) + (random.random() < 0.3) * span // 2, i) for i in range(4000)]
    df = spark.createDataFrame(log, "key string, ms bigint, request int")
    counts = df.groupBy("key", "ms").agg(F.count("*").alias("n"))
    placed, states = throttle._chunks(counts, most, window)
    assert states.where("key = 'hot'").count() > 8 and placed.groupBy("key", "island", "part").count().agg(F.max("count")).first()[0] < 400
    rows = throttle.rate_limit_replay(df, "key", "ms", "request", most, window).collect()
    assert {r["request"]: (r["admitted"], r["tokens_left"], r["wait_ms"]) for r in rows} == brute_bucket(log, most, window)


def test_hot_key_is_cut_into_runs(spark):
    """One key with quiet gaps: its runs are separate groups, and the counts are combined first."""
    log = spark.range(1000).select(
        F.lit(1).alias("key"), F.expr("id % 10 * 100000 + id div 100").alias("ms"), F.col("id").alias("request"))
    decided = throttle.rate_limit_replay(log, "key", "ms", "request", 2, 1000)
    assert decided.where("admitted").count() == 20


def test_requests_without_key_are_one_key(spark):
    log = spark.createDataFrame(
        [(None, 1, 10), (None, 2, 11), (2**53 + 1, 3, 10), (2**53, 4, 10)], "key bigint, request int, ms bigint")
    rows = throttle.rate_limit_replay(log, "key", "ms", "request", 1, 1000).collect()
    assert sorted((r.request, r.key, r.admitted) for r in rows) == [
        (1, None, True), (2, None, False), (3, 2**53 + 1, True), (4, 2**53, True)]


def test_terms_of_wide_blanks_are_not_valid(spark):
    from pagemill.operators.responses import valid_terms
    terms = spark.createDataFrame([("\u2003",), ("\u00a0\n",), ("",), (None,), ("\u2003a",)], "term string")
    assert [r.term for r in valid_terms(terms).collect()] == ["\u2003a"]


def test_timeout_without_a_value_and_of_a_large_one(spark):
    from pagemill.operators.requests import timeout_ms
    rows = spark.createDataFrame([(None,), (2_000_000_000,), (0,), (45,)], "s int").select(timeout_ms(F.col("s")).alias("t"))
    assert [r.t for r in rows.collect()] == [30_000, 120_000, 1_000, 45_000]
