"""HTML pages that Spark derives from the documents table, rich in structure."""

from pyspark.sql import functions as F

from pagemill.session import spread, table


def escape(text):
    for char, name in (("&", "amp"), ("<", "lt"), (">", "gt")):
        text = F.replace(text, F.lit(char), F.lit(f"&{name};"))
    return text


def rich_pages(spark, folder):
    """(doc_id, html): each document as a page with every element the Markdown job knows."""
    docs = spread(table(spark, folder, "documents", "doc_id", "text", "lang", "source", "n_chars"), "doc_id")
    lines = F.split("text", "\n")
    each = F.transform(lines, escape)
    items = F.array_join(F.transform(each, lambda x: F.concat(F.lit("<li>"), x, F.lit("</li>"))), "\n")
    rows = F.array_join(F.transform(
        each, lambda x, i: F.concat(F.lit("<tr><td>"), (i + 1).cast("string"), F.lit("</td>\n<td>"), x, F.lit("</td></tr>"))), "\n")

    def text(template):
        parts = []
        for i, piece in enumerate(template.split("|")):
            parts.append(F.col(piece).cast("string") if i % 2 else F.lit(piece))
        return F.concat(*parts)

    html = F.concat(
        text('<!DOCTYPE html><html><head><title>|source|</title><script>var a="<h1>no</h1>";</script></head><body>'
             '<h1>Document |doc_id|</h1><h2>|lang| <em>from</em> |source|</h2>'),
        F.lit("<pre><code>"), escape(F.col("text")), F.lit("</code></pre>"),
        F.lit("<blockquote>"), each[0], text("<blockquote>Inner |doc_id|</blockquote></blockquote>"),
        F.lit("<ol>"), items, F.lit("</ol><ul><li>Top<ul><li>Sub</li></ul></li></ul>"),
        text("<table><caption>Lines of |doc_id|</caption><thead><tr><th>no</th><th>line</th></tr></thead><tbody>"),
        rows, F.lit("</tbody></table>"),
        text('<p>Image <img src="/i/|doc_id|.png" alt="[|lang|] |source|"></p>'
             '<picture><source srcset="/l/|doc_id|.jpg 2x, /x.jpg 3x"><img src="/s/|doc_id|.jpg" alt="P |source|"></picture>'
             '<figure><img src="/f/|doc_id|.png" alt="F"><figcaption>Fig <em>no</em> |doc_id|</figcaption></figure>'
             '<details><summary>More |doc_id|</summary>Body |source|</details>'
             '<p><strong>|lang|</strong>, <i>|source|</i>, <del>old</del>, <code>n=|n_chars|</code>, H<sub>2</sub>O, '
             'x<sup>2</sup>, <mark>m</mark>, <q>said</q>, <b>bold <em>both</em></b>, '
             '<time datetime="2024-01-0|1">first</time>, <abbr title="Language">|lang|</abbr></p><hr><hr>'
             '<noscript>none</noscript><p>End <b>open |doc_id|<br>tail</body></html>'.replace("0|1", "01")))
    return docs.select("doc_id", html.alias("html"))


def nested_pages(spark, folder):
    """(doc_id, html): a section for each line of a document, with elements inside elements of their kind and hidden ones."""
    docs = spread(table(spark, folder, "documents", "doc_id", "text"), "doc_id")
    section = (
        "<h2>|line|</h2><noscript><h2>no</h2><a href='/no'>no</a><img src='/no.png'></noscript>"
        "<template><template></template><h3>no</h3><a href='/no'>no</a><img src='/no.png'></template>"
        "<a href='/l/|i|'>|line|</a><img src='/v/|i|.png' alt='v|i|'>"
        "<details><summary>|line|</summary>A|i| <details><summary>In |i|</summary>B|i|</details> Z|i|</details>"
        "<figure><img src='/o/|i|.png'><figure><img src='/n/|i|.png'><figcaption>|line|</figcaption></figure>"
        "<figcaption>Out <b>|i|</b></figcaption></figure>"
        "<time datetime='d|i|'>T|i| <abbr title='t|i|'>|line|</abbr> end</time>")

    def filled(line, i):
        values = {"line": escape(line), "i": (i + 1).cast("string")}
        return F.concat(*[values[p] if n % 2 else F.lit(p) for n, p in enumerate(section.split("|"))])

    return docs.select("doc_id", F.array_join(F.transform(F.split("text", "\n"), filled), "\n").alias("html"))
