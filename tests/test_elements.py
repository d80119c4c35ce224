"""Elements inside elements of their kind, unclosed and stray tags, elements that a reader does not see."""

import pytest

from pagemill.operators import structure as S


def rows(spark, table, html):
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    return [tuple(r)[1:] for r in table(pages).orderBy("idx").collect()]


CASES = {
    "three sections deep": (S.details_sections, "<details><summary>a</summary>1<details><summary>b</summary>2<details><summary>c</summary>3"
                            "</details>4</details>5</details>6", [(0, "a", "1b2c345"), (1, "b", "2c34"), (2, "c", "3")]),
    "two summaries": (S.details_sections, "<details>x<summary>a</summary>y<summary>b</summary>z</details>", [(0, "a", "xyz")]),
    "open section": (S.details_sections, "<details><summary>a</summary>b<p>c", [(0, "a", "bc")]),
    "open summary": (S.details_sections, "<details><summary>a</details>b", [(0, "a", "")]),
    "no summary": (S.details_sections, "</details><details>a</details></summary>b", [(0, "", "a")]),
    "section in summary": (S.details_sections, "<details><summary>a<details><summary>i</summary>j</details>b</summary>c</details>",
                           [(0, "aijb", "c"), (1, "i", "j")]),
    "caption after inner figure": (S.figure_captions, "<figure><figure><img src=i><figcaption>in</figcaption></figure>"
                                   "<img src=o><figcaption>out</figcaption></figure>", [(0, "o", "out"), (1, "i", "in")]),
    "figure in caption": (S.figure_captions, "<figure><figcaption>a<figure><figcaption>b</figcaption></figure>c</figcaption></figure>",
                          [(0, "", "abc"), (1, "", "b")]),
    "no caption": (S.figure_captions, "<figure><img src=o></figure>text<figcaption>x</figcaption>", [(0, "o", "")]),
    "abbr in time": (S.time_values, "<time datetime=d>a <abbr title=t>b</abbr> c</time>", [(0, "time", "d", "a b c"), (1, "abbr", "t", "b")]),
    "open abbr": (S.time_values, "<abbr title=t>a<abbr title=u>b</abbr>c", [(0, "abbr", "t", "a"), (1, "abbr", "u", "b")]),
    "no value": (S.time_values, "<time>a</time><abbr title=t>b</abbr>", [(1, "abbr", "t", "b")]),
    "hidden headings": (S.heading_outline, "<template><template></template><h1>a</h1></template><noscript><h2>b</h2></noscript><h3>c &amp; <b>d</b></h3>",
                        [(0, 3, "c & d")]),
    "open heading": (S.heading_outline, "<h1>a<h2>b</h2>c", [(0, 1, "a"), (1, 2, "b")]),
    "hidden links": (S.page_links, "<noscript><a href=n>x</a></noscript><a>y</a><a href='&amp;'>z</a>", [(1, "&", "z")]),
    "hidden images": (S.page_images, "<template><img src=n></template><img src=s alt='[a]'>", [(0, "s", "[a]", "![\\[a\\]](s)")]),
    "pictures": (S.page_pictures, "<picture><source srcset='a 2x, b'><img src=c alt=d></picture><img src=e><picture><img src=f></picture><picture></picture>",
                 [(0, "a", "d"), (1, "f", "")]),
    "code points of marks": (S.details_sections, "<details><summary>﷐a</summary>﷯&amp;﷓</details>", [(0, "﷐a", "﷯&﷓")]),
    "marks in values": (S.page_links, "<a href='/﷐﷯'>﷑</a>", [(0, "/﷐﷯", "﷑")]),
    "empty page": (S.details_sections, "", []),
    "no page": (S.figure_captions, None, []),
}


@pytest.mark.parametrize("name", list(CASES))
def test_elements(spark, name):
    table, html, expected = CASES[name]
    assert rows(spark, table, html) == expected


def test_many_sections_of_a_long_page(spark):
    """Texts are cut from blocks, so a long page costs no more per element."""
    n = 20_000
    html = "".join(f"<details><summary>s{i}</summary>{'é' * 40}<details>{i}</details></details>" for i in range(n))
    found = S.details_sections(spark.createDataFrame([(1, html)], "page_id long, html string"))
    got = {r["idx"]: (r["summary"], r["body"]) for r in found.collect()}
    assert len(got) == 2 * n
    assert all(got[2 * i] == (f"s{i}", "é" * 40 + str(i)) and got[2 * i + 1] == ("", str(i)) for i in range(n))
