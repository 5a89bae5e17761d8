"""Main text of pages."""

import html
import re

from conftest import SF_DIR
from tabularium.llm import text_density
from tabularium.llm.queries import QUERIES


def article(page):
    """What the given pages hold between their article tags, read with patterns."""
    inner = re.search(r"(?s)<article>(.*)</article>", page)[1]
    inner = re.sub(r"</?(p|h1|br|div)>", " \n", inner)
    return " ".join(html.unescape(re.sub(r"</?\w+>", "", inner)).split())


def test_whole_table(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    got = QUERIES["op5_text_density"](spark, SF_DIR).collect()
    assert len(got) == len(pages)
    for r in got:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, article(pages[r.page_id].html), len(r.text))


PAGE = """<html><head><title>t</title><script>if (a<b) "</p>"</script></head><body class="has-sidebar">
<div class="cookie-notice"><p>We use cookies and a lot of other words here to fill the line.</p></div>
<nav><ul><li><a href=1>Home</a></li></ul></nav><div id="sidebar"><p>Popular posts of the week with many words</p></div>
{body}
<section id="comments"><article class="comment"><p>A reader says something rather long about all of it.</p></article></section>
<form><p>Leave your name and address here please</p><textarea>text</textarea></form><footer>&copy; all rights</footer></body></html>"""


def test_boilerplate_goes_and_short_lines_stay():
    body = "<main><h2>Head</h2><p>The first&nbsp;paragraph is\n  long <b>enou</b>gh to stand out by itself.<p>Yes.<br>No.</main>"
    assert text_density.main_text(PAGE.format(body=body)) == (
        "Head The first paragraph is long enough to stand out by itself. Yes. No.")


def test_without_article_the_cluster_is_the_region():
    body = "<div><p>One long paragraph of real text, which goes on.</p><p>Two is as long as the first one was, or so.</p></div>"
    assert text_density.main_text(PAGE.format(body=body)) == (
        "One long paragraph of real text, which goes on. Two is as long as the first one was, or so.")


def test_edges(spark):
    pages = [(1, None), (2, ""), (3, "<p>"), (4, "plain &am text &amp more"), (5, PAGE.format(body="")), (5, PAGE.format(body="")),
             (None, "<article>x &lt;y&gt; &#233;</article>"), (6, "<article>" + "<p>long words here</p>" * 5000 + "</article>"),
             (7, "<" * 1000), (8, "<article><p>a<div hidden>b</div></article></div></p>")]
    frame = spark.createDataFrame([(a, b, "clash") for a, b in pages], "page_id long, html string, text string")
    got = sorted((r.page_id or 0, r.text) for r in text_density.extract(frame).collect())
    assert got == sorted([(1, ""), (2, ""), (3, ""), (4, "plain &am text & more"), (5, ""), (5, ""), (0, "x <y> é"),
                          (6, " ".join(["long words here"] * 5000)), (7, "<" * 1000), (8, "a")])
    assert text_density.extract(frame.limit(0)).collect() == []
