from __future__ import annotations

import re
from html import unescape

import pytest

from tidemark.llm import mainhtml

PAGES = "page_id bigint, url string, html string"


def around(article: str) -> str:
    return (f'<html><head><title>T</title><style>p{{}}</style></head><body><header class="top"><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav>'
            f'<div class="cookie-notice">We use cookies</div><div class="wrap has-sidebar"><div class="post-12">{article}<form>f<input></form></div>'
            '<div class="sidebar"><p>Other long texts that stand beside the article and go on for a while.</p></div></div>'
            '<div id="comments"><p>A reader says a great deal about this, at length, more than the article.</p></div><footer>(c)</footer></body></html>')


@pytest.mark.parametrize(("article", "text"), [
    ("<h2>Caf&eacute; &amp; bar</h2><p>One  <b>two</b>\n three", "Café & bar\nOne two three"),
    ("<p>a<br>b</p>c<ul><li>1<li>2</ul>", "a\nb\nc\n1\n2"),
    ("<p>x<script>if (a < b) '</p>'</script>y<!-- <p>z -->", "xy"),
    ("<p title='a > b'>q</p><div class=ad>buy</div><div hidden>h</div><div style='display: none'>n</div>", "q"),
    ("<table><tr><td>k<td>v</table>", "k\nv"),
    ("<p>&#65;&#x42;&nbsp;C &bogus; &lt;p&gt;", "AB C &bogus; <p>"),
    ("", ""),
])
def test_text_of_a_page(article, text):
    page = around(article)
    assert mainhtml.extract(page, "/body/div.has-sidebar.wrap/div.post-N") == text


def test_no_html_and_broken_html():
    assert mainhtml.extract("", None) == "" and mainhtml.extract("just text", None) == "just text"
    assert mainhtml.extract("<p>open <b>and <i>more<p>next</b></div></p>", "/nowhere") == "open and more\nnext"
    assert mainhtml.extract("<script>never ends <p>x", None) == "" and mainhtml.extract("<!-- never ends <p>x", None) == ""
    assert mainhtml.extract("<div>" * 3000 + "deep", None) == "deep"


LONG = "The article itself, which is the longest part of the page by far. " * 4
SHORT = LONG.strip()


@pytest.mark.parametrize("page", [
    f"<html><head><title>t</title><body><nav>menu</nav><div class=story><p>{LONG}</p></div><div class=sidebar>x</div></body></html>",
    f"<html><p>{LONG}</p><div>short</div></html>",
    f'<html><body><div class="post comments-open"><p>{LONG}</p></div><div class="comments"><p>me too</p></div></body></html>',
    f'<html><body><div class="post review"><p>{LONG}</p></div><div class="reviews"><p>nice</p></div></body></html>',
    f'<html><body><div class="side-by-side"><p>{LONG}</p></div><div class="side">x</div></body></html>',
    f'<html><body><div id="form-guide"><p>{LONG}</p></div><form>name</form></body></html>',
    f'<html><head><title>t</title><meta charset=x><p>{LONG}</p></html>',
])
def test_pages_that_keep_their_article(page):
    assert SHORT in mainhtml.extract(page, None).split("\n")
    for word in ("menu", "me too", "nice", "name"):
        assert word not in mainhtml.extract(page, None).split("\n")


def test_an_article_keeps_its_own_header():
    page = f"<html><body><header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>{LONG}</p><footer>by me</footer></article></body></html>"
    assert mainhtml.extract(page, None) == f"Title\n{SHORT}"


def plain_consensus(pages):
    """The votes of each host over whole pages, counted plainly."""
    votes, scores = {}, {}
    for host, html in pages:
        found = mainhtml.containers(html)
        for path, score in found.items():
            scores[host, path] = scores.get((host, path), 0.0) + score
            votes.setdefault((host, path), 0)
        if found:
            votes[host, max(found, key=lambda p: (found[p], p))] += 1
    best = {}
    for (host, path), n in votes.items():
        best[host] = max(best.get(host, (-1, 0.0, "")), (n, scores[host, path], path))
    return {host: b[2] for host, b in best.items()}


def test_against_a_plain_consensus(spark):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    host = lambda u: re.match(r"\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", u or "")
    named = [(i, h[1].lower() if (h := host(u)) else "", x or "") for i, u, x in pages]
    path = plain_consensus([(h, x) for _, h, x in named])
    want = sorted((i, mainhtml.extract(x, path.get(h))) for i, h, x in named)
    assert sorted((r.page_id, r.text) for r in mainhtml.op7(spark, "/root/testdata/sf0.001").collect()) == want


def test_host_outvotes_a_page(spark):
    long = "<p>" + "the article of this page " * 20 + "</p>"
    rows = [(i, f"http://A.example:80/{i}", around(long)) for i in range(4)]
    # On this page a box of the frame holds more text than the article does.
    rows.append((9, "http://a.example/9", f'<html><body><div class="box">{long}</div><div class="wrap has-sidebar"><div class="post-3"><p>Short.</p></div></div></body></html>'))
    rows += [(10, "http://b.example/", '<body><div class="box"><p>Alone here.</p></div></body>'), (11, None, None), (12, "no url", ""), (11, None, None), (None, "http://a.example/", around(long))]
    docs = spark.createDataFrame([(*r, "x") for r in rows], PAGES + ", host string")
    got = mainhtml.main_texts(docs).collect()
    by_id = {}
    for r in got:
        assert r.n_chars == len(r.text)
        by_id.setdefault(r.page_id, []).append(r.text)
    body = ("the article of this page " * 20).strip()
    assert by_id == {0: [body], 1: [body], 2: [body], 3: [body], 9: ["Short."], 10: ["Alone here."], 11: ["", ""], 12: [""], None: [body]}
    assert mainhtml.main_texts(spark.createDataFrame([], PAGES)).collect() == []


def test_query_against_the_articles_of_the_table(spark):
    got = {r.page_id: r.text for r in mainhtml.op7(spark, "/root/testdata/sf0.01").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)(</article>|<footer>|$)", r.html, re.S)[1]
        parts = [" ".join(unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", inner)]
        assert got[r.page_id] == "\n".join(p for p in parts if p)
