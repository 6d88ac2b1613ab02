"""Main text of pages."""

import html
import re

import pytest

from tidebook.llm import html_main
from tidebook.llm.html_main import Page, extract, host_paths, main_text

DATA = "/root/testdata/sf0.01/pages.parquet"


def plain(source):
    """For the test table's layout: what stands in the article, by string operations."""
    body = source.split("<article>", 1)[1].split("</article>", 1)[0]
    return " ".join(html.unescape(x) for x in " ".join(re.sub(r"<[^>]*>", "\n", body).split("\n")).split()) if body else ""


def test_whole_table(spark):
    pages = spark.read.parquet(DATA)
    want = {r["page_id"]: " ".join(html.unescape(re.sub(r"<[^>]*>", " ", r["html"].split("<article>", 1)[1].split("</article>", 1)[0])).split()) for r in pages.collect()}
    got = extract(pages).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert {r["path"] for r in host_paths(pages).collect()} == {"/article"}


OTHER = """<html><body><header><h1>Site</h1></header><div id=menu><a href=/>Home</a> <a href=/x>Other</a></div>
<div class="cookie-notice">We use cookies, a great many of them, and like to talk about it at length.</div>
<div class="post content-12"><h2>Title &amp; more</h2><p>First  paragraph with <b>bo</b>ld and <a href=x>a link</a>.<p>Second&nbsp;one<br>line two
<ul><li>one<li>two</ul><script>if (a < b) document.write("<p>no</p>")</script><div class="advert">Buy</div>
<blockquote>Quoted &#8212; text</blockquote></div>
<div class="comments"><p>A reader says something that is much longer than the article itself, on and on and on, and again and again, until it ends.</p></div>
<aside><p>Side</p></aside><form><input name=q><p>Search</p></form><footer>&copy; foot</footer>"""


def test_other_layout():
    assert main_text(OTHER) == "Title & more First paragraph with bold and a link. Second one line two one two Quoted — text"
    assert Page(OTHER).best() == "/div.content-#.post"


def test_broken_and_empty():
    assert main_text(None) == main_text("") == main_text("<p") == main_text("<!-- open") == main_text("<script>x") == ""
    assert main_text("<article><p>a</div></p></section>b</article>c") == "a b"
    assert main_text("just text") == "just text"
    assert main_text("<div>" * 3000 + "deep") == "deep"
    assert main_text("<article><p>x</p></article>", "/div.none") == "x"
    assert main_text("<article>5 < 6 &lt; 7 <a href='>'>z</a></article>") == "5 < 6 < 7 z"


@pytest.mark.parametrize("most", [50_000, 1])
def test_votes_carry_odd_pages(spark, monkeypatch, most):
    monkeypatch.setattr(html_main, "BROADCAST", most)
    rows = [(i, "http://a.com/", f"<div class=c{i}><p>long enough text of the page {i}</p></div><div class=x><p>other</p></div>") for i in range(5)]
    # here the noise is longer, but the host's pages agree on the container
    rows.append((9, "http://A.com/9", "<div class=c9><p>short</p></div><div class=x><p>a very long text that isn't the main one at all, really</p></div>"))
    rows += [(10, None, None), (11, "no host", "<p>alone</p>"), (9, "http://A.com/9", "")]
    df = spark.createDataFrame([(*r, "t", "s") for r in rows], "page_id long, url string, html string, text string, salt string")
    got = sorted((r["page_id"], r["text"]) for r in extract(df).collect())
    assert got[:5] == [(i, f"long enough text of the page {i}") for i in range(5)]
    assert got[5:] == [(9, ""), (9, "short"), (10, ""), (11, "alone")]
    assert extract(df.limit(0)).count() == 0
