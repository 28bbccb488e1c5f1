"""Extraction on hand-made pages, templates against counts in plain Python."""

from __future__ import annotations

import html
import re
from collections import defaultdict

import pytest

from __spark_entry__ import queries
from tillstream.llm import htmltext
from tillstream.llm.htmltree import parse

PAGES = "page_id LONG, url STRING, html STRING, text STRING, host STRING, `key` INT"


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<p>b  \n c&nbsp;d", "a\n\nb c d"),
        ("<nav>x</nav><article><h1>T</h1><p><b>one.<br><p>two</p></article><footer>f</footer>", "T\n\none.\n\ntwo"),
        ("<body><header>H</header><main><p>m</p><aside>s</aside></main></body>", "m"),
        ("<article><header><p>by</p><h1>T</h1></header><p>x</p><footer>f</footer></article>", "T\n\nx"),
        ("<article><p>x</p><section id=comments><article class=comment>c</article></section></article>", "x"),
        ("<div class='cookie-notice'>c</div><article><p>x</p></article><div id=sideBar>s</div>", "x"),
        ("<p>a</p><script>if (a < b) '<p>no</p>'</script><style>p{}</style><!-- <p>no --><p>b</p>", "a\n\nb"),
        ("<p>a<script>never closed <p>b", "a"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", "a\n\nb\n\nc\n\nd\n\ne"),
        ("<p>1 < 2 &lt;b&gt; &#233;&#x4e2d; &copy &notit;</p>", "1 < 2 <b> é中 © ¬it;"),
        ("<div><p>a</div></p></span>b</i>", "a\n\nb"),
        ("<p title=\"a > b\" class='x'>a</p><p id=y/>b", "a\n\nb"),
        ("<form><article><p>x</p></article></form>", "x"),
        ("<article><p>x</p><form><p>no</p><button>b</button></form><p hidden>h</p>y<wbr>z</article>", "x\n\nyz"),
        ("<ARTICLE><P>x</P></ARTICLE><DIV CLASS=AD>no</DIV>", "x"),
        ("<div><ul><li><a href=/>home</a><li><a href=/x>more</a></ul><p>words of a page</p></div>", "words of a page"),
        ("<p>open <a href='x", "open"),
        ("<!DOCTYPE html><title>t</title><p>x</p><![CDATA[ y ]]>z</html> after", "x\n\nz after"),
    ],
)
def test_text_of_a_page(page, text):
    assert htmltext.main_text(page) == text


def test_deep_and_long_pages():
    deep = "<div>" * 5000 + "x" + "</div>" * 5000
    assert htmltext.main_text(deep) == "x"
    assert htmltext.main_text("<article>" + "<p>word " * 50_000).count("word") == 50_000
    assert htmltext.main_text("<a '" * 20_000 + ">x") == "x"


def _extracted(spark, rows, **options):
    frame = spark.createDataFrame([(*r, "clash", "h", 1) for r in rows], PAGES)
    got = htmltext.extract(frame, **options)
    assert got.columns == ["page_id", "url", "text"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_templates_of_a_host(spark):
    """Boxes without a telling name go where a host repeats them, and only there."""
    box = "<div class=q7>Read our great stories every day</div>"

    def page(k, host="a", article=None):
        body = article or f"<p>text {k} of the page</p><p>the same closing words</p>"
        tail = box if host == "a" else ""
        return (k, f"http://{host}.org/{k}", f"<html><body>{box if k % 2 else ''}<article>{body}{tail}</article></body>")

    rows = [page(k) for k in range(12)] + [page(20 + k, "b") for k in range(3)]
    rows += [(40, None, "<div>no host</div>"), (None, "bad url", None), (41, "http://a.org/x", "")]
    rows += [page(50, "a")] * 4  # repeated rows
    want = []
    for k, url, markup in rows:
        # The closing words are a paragraph of the article: they stay however often they recur.
        text = "" if not markup else "no host" if k == 40 else f"text {k} of the page\n\nthe same closing words"
        want.append((k, url, text))
    assert _extracted(spark, rows) == sorted(want, key=repr)


def test_copied_articles_are_no_template(spark):
    """A third of the host's pages are copies of one article in boxes, another third near copies."""
    def page(k, text):
        return (k, f"https://H.org/{k}", f"<nav>n{k}</nav><article>{text}</article>")

    copy = "<div>The first part of it.</div><div>The second part.</div>"
    rows = [page(k, copy) for k in range(30)]
    rows += [page(100 + k, f"<p>All but one word the same {k}</p><p>and this all the same</p>") for k in range(30)]
    rows += [page(200 + k, f"<p>Other {k}</p>") for k in range(30)]
    got = dict((r[0], r[2]) for r in _extracted(spark, rows))
    assert all(got[k] == "The first part of it.\n\nThe second part." for k in range(30))
    assert all(got[100 + k] == f"All but one word the same {k}\n\nand this all the same" for k in range(30))


def test_pages_without_an_article(spark):
    menu = "<div class=z><span>Start</span> <span>Shop</span></div>"
    rows = [(k, f"http://s.org/{k}", f"{menu}<div><p>Page number {k}</p></div>") for k in range(8)]
    # A page that is nothing but the template keeps it.
    rows.append((99, "http://s.org/99", menu))
    got = dict((r[0], r[2]) for r in _extracted(spark, rows))
    assert got == {**{k: f"Page number {k}" for k in range(8)}, 99: "Start Shop"}


def test_template_counts(spark):
    rows = []
    for k in range(40):
        host = "hot" if k % 3 else f"h{k % 4}"
        rows.append((k, f"http://{host}/{k}", f"<div>d{k % 5}</div><p>p{k % 20}</p><article>{k % 13}</article>"))
    frame = spark.createDataFrame([(*r, "", "", 1) for r in rows], PAGES)
    pages, on = defaultdict(set), defaultdict(set)
    for _, url, page in rows:
        host = url.split("/")[2]
        main, hashes = htmltext.marks(parse(page))
        pages[host].add(main)
        for h in hashes:
            on[host, h].add(main)
    want = {(h, x, len(m) >= 0.2 * len(pages[h])) for (h, x), m in on.items() if len(m) >= 3}
    marked = frame.select(
        "page_id", htmltext.host(frame.url).alias("host"), "html", frame.url.cast("binary").alias("key")
    ).mapInArrow(htmltext._marked, "key binary, host string, main long, hashes array<long>")
    got = {tuple(r) for r in htmltext.templates(marked, many=3).collect()}
    assert got == want and want


def test_empty_table(spark):
    assert _extracted(spark, []) == []


def test_query_keeps_articles_whole(spark, folder):
    """The given pages: the article, tags out, one block per paragraph or heading."""
    rows = spark.read.parquet(f"{folder}/pages.parquet").collect()
    got = {r.page_id: r for r in queries()["op13_html_text"](spark, folder).collect()}
    assert len(got) == len(rows)
    for row in rows:
        article = re.search(r"<article>(.*?)</article>", row.html, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", article)
        texts = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", p)).split()) for p in parts]
        text = "\n\n".join(t for t in texts if t)
        assert (got[row.page_id].text, got[row.page_id].n_chars) == (text, len(text))
        assert got[row.page_id].url == row.url
