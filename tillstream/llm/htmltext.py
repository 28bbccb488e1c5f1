"""Main text of web pages, by removal of what a site repeats.

Tasks parse each page into a tree and hash its element subtrees. Spark counts, per host, on how many pages
of different main text each subtree stands: copies of one article count once, so that a copied article is
no template. A page gets the hashes of its own subtrees that recur, never a host's whole list, and is read
again without them. Inside the page's article or main element only boxes (lists, sections, tables ...)
that stand on a fifth of the host's pages go; paragraphs and headings there stay however often they recur.
What recurs too rarely to be told from counts, as on hosts of few pages, goes by its tag, role, or the
words of its class and id: menus, headers, footers, sidebars, notices, adverts, forms, reader comments.

The text is that of the article elements, else of the main element, else of what is left of the page.
Headings in an article's header stay. Blocks are joined by two line feeds; white space inside a block,
line breaks and no-break spaces included, becomes one space; character references are decoded.

Defined results: null and empty pages have an empty text. Pages without a host in their URL are counted
with no other. A page that would lose all its text to templates is read without removing them. Broken
markup is read as browsers do in the common cases (unclosed, stray and misnested tags); nothing is capped,
elements nested deeper than 512 count as siblings. Repeated rows have equal results, whatever their ids,
null ones too. An empty table gives no rows. Other columns are left out. Subtree hashes have 64 bits and
are compared within a host only.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import pieces, settled
from tillstream.llm.htmltree import BLOCK, HEADINGS, Node, parse

# A subtree recurs from so many pages on; it is everywhere from that share of the host's pages on.
MANY_PAGES, EVERYWHERE = 5, 0.2
# Without an article: a named box that holds more of the text is the page itself; a box whose text is
# mostly links is a menu.
WHOLE_PAGE, MOSTLY_LINKS = 0.6, 0.6

BOXES = frozenset(
    "nav header footer aside div section ul ol dl menu form table details dialog fieldset center "
    "search figure".split()
)
DROPPED = frozenset(
    "head nav footer aside form button select option optgroup input label fieldset dialog menu search svg "
    "math object audio video canvas map template datalist progress meter legend".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar "
    "toolbar tablist".split()
)
NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense adsbygoogle adslot adbox "
    "sponsor sponsored sponsors promo promos promotion banner banners nav navbar navigation menu menus "
    "breadcrumb breadcrumbs masthead footer sidebar sidebars aside widget widgets toolbar skip pagination "
    "pager notice notices cookie cookies consent gdpr alert alerts popup modal overlay announcement "
    "newsletter subscribe subscription signup login search social share sharing related recommended "
    "recommendations comment comments commentlist disqus respond replies form".split()
)
# Names that also tell an article element from the page's own.
SIDE_ARTICLES = frozenset(
    "ad ads advert advertisement sponsored promo related recommended comment comments teaser".split()
)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _names(node: Node) -> set[str]:
    text = f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}"
    return {w.lower() for w in _WORD.findall(text)} if len(text) > 1 else set()


def _hidden(node: Node) -> bool:
    attrs = node.attrs
    style = attrs.get("style", "").replace(" ", "").lower()
    return "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in style


def _is_side(node: Node) -> bool:
    """An element that its tag, role or name tells from the main text."""
    if node.tag in DROPPED or _hidden(node):
        return True
    if not node.attrs or node.tag in HEADINGS or node.tag in ("html", "body"):
        return False
    if node.attrs.get("role", "").lower() in ROLES:
        return True
    names = _names(node)
    if node.tag in ("article", "main"):
        return bool(names & SIDE_ARTICLES)
    return bool(names & NAMES)


def _is_header(node: Node) -> bool:
    return node.tag == "header" or (node.tag in BOXES and "header" in _names(node))


def containers(root: Node) -> list[Node]:
    """The outermost article elements, else main ones, that stand in no side element."""
    found: dict[str, list[Node]] = {"article": [], "main": []}
    stack = [root]
    while stack:
        node = stack.pop()
        is_main = node.tag == "main" or node.attrs.get("role") == "main"
        if node.tag == "article" and not _is_side(node):
            found["article"].append(node)
            continue
        # A form or a named box may be the whole page's wrapper, so only plain side elements end the search.
        if node is not root and node.tag != "form" and _is_side(node) and not is_main:
            continue
        if is_main:
            found["main"].append(node)
        stack.extend(c for c in reversed(node.children) if not isinstance(c, str))
    if found["article"]:
        return found["article"]
    mains = found["main"]
    inner = {id(n) for m in mains for n in m.elements() if n is not m}
    return [m for m in mains if id(m) not in inner]


def marks(root: Node) -> tuple[int, list[int]]:
    """Hash of the page's main text, and of every element with text that can be a template: any block,
    but with an article only boxes, as paragraphs there are never one."""
    inside = containers(root)
    main = inside[0].hash if len(inside) == 1 else root.hash
    kinds = BOXES if inside else BLOCK
    hashes = {n.hash for n in root.elements() if n.chars and (n.tag in kinds or "-" in n.tag)}
    return main, sorted(hashes)


def blocks(root: Node, recurring: frozenset[int], everywhere: frozenset[int]) -> list[str]:
    """Texts of the page's blocks without templates and side elements."""
    inside = containers(root)
    out: list[str] = []
    buffer: list[str] = []

    def flush() -> None:
        words = " ".join("".join(buffer).split())
        if words:
            out.append(words)
        buffer.clear()

    def goes(node: Node) -> bool:
        if inside:
            return node.tag in BOXES and node.hash in everywhere or _is_side(node)
        if node.hash in (recurring if node.tag in BOXES else everywhere):
            return True
        if node.tag in DROPPED or node.tag == "header":
            return node.tag != "form" or node.chars <= WHOLE_PAGE * root.chars
        if node.tag in BOXES and node.chars and node.linked > MOSTLY_LINKS * node.chars:
            return True
        return (_is_side(node) or _is_header(node)) and node.chars <= WHOLE_PAGE * root.chars

    for top in inside or [root]:
        stack: list = [top]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                buffer.append(item)
                continue
            if item is None:
                flush()
                continue
            if item is not top and goes(item):
                if item.tag in BLOCK:
                    flush()
                continue
            if item.tag in ("br", "hr", "wbr"):
                flush() if item.tag == "hr" else buffer.append("" if item.tag == "wbr" else " ")
                continue
            children = item.children
            if inside and item is not top and _is_header(item):
                children = [n for n in item.elements() if n.tag in HEADINGS]
            if item.tag in BLOCK:
                flush()
                stack.append(None)
            stack.extend(reversed(children))
        flush()
    return out


def main_text(page: str, recurring: Iterable[int] = (), everywhere: Iterable[int] = ()) -> str:
    root = parse(page)
    often, most = frozenset(recurring), frozenset(everywhere)
    found = blocks(root, often, most)
    if not found and (often or most):
        found = blocks(root, frozenset(), frozenset())
    return "\n\n".join(found)


def _marked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "html"):
        found = [marks(parse(page)) for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("key"),
                batch.column("host"),
                pa.array([m for m, _ in found], pa.int64()),
                pa.array([h for _, h in found], pa.list_(pa.int64())),
            ],
            ["key", "host", "main", "hashes"],
        )


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "html"):
        rows = zip(*(batch.column(c).to_pylist() for c in ("html", "recurring", "everywhere")))
        texts = [main_text(page or "", often or (), most or ()) for page, often, most in rows]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
            ["page_id", "url", "text"],
        )


def host(url: Column) -> Column:
    """Host of a URL in lower case, null without one."""
    found = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


def templates(marked: DataFrame, *, many: int = MANY_PAGES, everywhere: float = EVERYWHERE) -> DataFrame:
    """`host, hash, most` of the subtrees that recur on a host; `most` where they are everywhere.

    Rows are distinct by main text before they are counted, so copies of a page count once and a hot
    host's work is spread over its subtrees.
    """
    pages = marked.select("host", "main").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    stands = marked.select("host", "main", F.explode("hashes").alias("hash")).distinct()
    counted = stands.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("on")).filter(F.col("on") >= many)
    return counted.join(pages, "host").select(
        "host", "hash", (F.col("on") >= F.col("pages") * everywhere).alias("most")
    )


def extract(
    pages: DataFrame, *, many: int = MANY_PAGES, everywhere: float = EVERYWHERE
) -> DataFrame:
    """`page_id, url, text` of every page."""
    # Equal pages of one URL share a key, and what it brings.
    key = F.unhex(F.md5(F.concat_ws("\n", F.coalesce("url", F.lit("")), F.coalesce("html", F.lit("")))))
    rows = pages.select("page_id", "url", "html", key.alias("key"), host(F.col("url")).alias("host"))
    named = rows.filter(F.col("host").isNotNull() & (F.length("html") > 0))
    schema = "key binary, host string, main long, hashes array<long>"
    marked = settled(named.select("key", "host", "html").mapInArrow(_marked, schema), "marks")
    found = settled(templates(marked, many=many, everywhere=everywhere), "templates")
    own = marked.select("key", "host", F.explode("hashes").alias("hash")).join(found, ["host", "hash"])
    # Per page at most its own elements.
    lists = settled(
        own.groupBy("key").agg(
            F.collect_set("hash").alias("recurring"),
            F.collect_set(F.when(F.col("most"), F.col("hash"))).alias("everywhere"),
        ),
        "page-templates",
    )
    kind = rows.schema
    out = f"page_id {kind['page_id'].dataType.simpleString()}, url string, text string"
    joined = rows.join(lists, "key", "left").select("page_id", "url", "html", "recurring", "everywhere")
    return joined.mapInArrow(_read, out)
