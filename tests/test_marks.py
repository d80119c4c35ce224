"""Marks inside plans: what is tested for them is read once, and a window needs no escapes on account of its own mark."""

from pyspark.sql import functions as F

from pagemill import fixed
from pagemill.functions import text as T
from pagemill.operators import search
from pagemill.operators.clean import strip_tags


def test_marks_are_a_range_without_the_place_mark():
    assert set(fixed.MARKS) == {chr(c) for c in range(ord(min(fixed.MARKS)), ord(max(fixed.MARKS)) + 1)}
    assert T._ANY_MARK == f"[{min(fixed.MARKS)}-{max(fixed.MARKS)}]" and fixed.PLACE_MARK not in fixed.MARKS


def test_text_is_computed_once_for_its_marks(spark):
    """The value stands once in the plan: a branch of a CASE would compute it again for each row."""
    rows = spark.createDataFrame([("a﷓b",)], "x string")
    for fn in (T.escape_marks, T.unescape_marks):
        out = rows.select(F.when(F.length("x") > 0, fn(F.reverse("x"))).alias("y"))
        plan = out._jdf.queryExecution().analyzed().toString()
        assert plan.count("reverse(") == 1
    assert rows.select(T.unescape_marks(T.escape_marks(F.col("x")))).first()[0] == "a﷓b"


def test_a_reference_to_a_mark_stays_in_the_snippet(spark):
    html = "<p>one &#xFDD6; needle ﷚ &amp; ﷖ two</p>"
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert pages.select(strip_tags(F.col("html"))).first()[0] == "one ﷖ needle ﷚ & ﷖ two"
    for mode in ("tags", "html2md"):
        asked = spark.createDataFrame([(1, "needle", 8, mode)], "term_id int, term string, context_limit int, strip string")
        assert [r["snippet"] for r in search.search_snippets(pages, asked, modes=(mode,)).collect()] == ["one ﷖ needle ﷚ & ﷖ t"]


def test_windows_of_all_modes_are_computed_in_one_pass(spark):
    """Markdown windows and others come out of one plan: a union would look for all matches twice."""
    pages = spark.createDataFrame([(1, "<ul><li>a <b>needle</b></li></ul>"), (2, "<p>needle &amp; <i>needle</i>")], "page_id int, html string")
    asked = spark.createDataFrame([(i, "Needle", 4, mode) for i, mode in enumerate(("tags", "html2md", "none", "other"))],
                                  "term_id int, term string, context_limit int, strip string")
    found = search.search_snippets(pages, asked)
    assert "Union" not in found._jdf.queryExecution().analyzed().toString()
    got = {(r["page_id"], r["term_id"], r["match_index"]): r["snippet"] for r in found.collect()}
    assert len(got) == 12
    assert got[1, 0, 1] == "a needle" and got[1, 1, 1] == " a **needle**"[-12:] and got[2, 1, 2] == " & *needle*"
    assert got[2, 0, 1] == "needle & n" and got[2, 2, 1].startswith("<p>needle")
