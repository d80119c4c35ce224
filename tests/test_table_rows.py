"""Rows of tables: cells are cut from the text of a row."""

import pagemill.operators.markdown as M
from pagemill import fixed
from pagemill.operators import structure

PAGES = [
    (1, "<p>out</p><table><tr><td>a &amp; <b>b</b></td><th></th><td> c\n d </td></tr>text between<tr>loose<td>x</td></tr></table>after"),
    (2, "<table><tr><td>outer<table><tr><td>inner</td></tr></table>rest</td></tr><tr><td>2</td></tr></table>"),
    (3, f"<table><tr><td>{fixed.CELL_MARK}own mark &#{ord(fixed.CELL_MARK)}; {fixed.MARK_ESCAPE}</td><td>y</td></tr><tr></tr></table>"),
    (4, "<table><tr><td>a<tr><td>b<td>c<p>flushed</p>no cell</table><tr><td>no table</td></tr>"),
    (5, "<table><template><tr><td>hidden</td></tr></template><tr><td><textarea><td>raw</td></textarea></td></tr></table>"),
    (6, None), (7, ""), (8, "<table><tr> <td>1</td> 2 <td>3</td> </tr></table>")]


def test_rows_and_cells(spark):
    rows = structure.table_rows(spark.createDataFrame(PAGES, "page_id int, html string")).collect()
    got = {(r["page_id"], r["table_idx"], r["row_idx"]): r["cells"] for r in rows}
    mark = fixed.CELL_MARK
    assert got[1, 0, 0] == ["a & b", "", "c d"] and got[1, 0, 1] == ["loose", "x"]
    assert got[2, 0, 0] == ["outer"] and got[2, 1, 0] == ["inner"]
    assert got[3, 0, 0] == [f"{mark}own mark {mark} {fixed.MARK_ESCAPE}", "y"] and (3, 0, 1) not in got
    assert got[4, 0, 0] == ["a"] and got[4, 0, 1] == ["b", "c"]
    assert got[5, 0, 0] == ["<td>raw</td>"] and got[8, 0, 0] == ["1 2", "3"]
    assert {k[0] for k in got} == {1, 2, 3, 4, 5, 8}


def test_no_text_outside_rows_is_moved(spark, monkeypatch):
    """What stands outside rows is gone before texts are decoded."""
    seen = []
    plain = M._with_attributes
    monkeypatch.setattr(M, "_with_attributes", lambda events: (seen.append(events), plain(events))[1])
    pages = spark.createDataFrame(PAGES[:1], "page_id int, html string")
    structure.table_rows(pages).collect()
    assert {r["text"] for r in seen[0].collect()} - {None} == {"a &amp; ", "b", " c\n d ", "loose", "x"}
