"""A small tree builder for web pages: tags, implied ends, text and subtree hashes."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from hashlib import blake2b

# Element kinds of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript iframe xmp noembed noframes title textarea".split())
HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center colgroup dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li listing "
    "main menu nav ol optgroup option p plaintext pre search section summary table tbody td tfoot th thead "
    "tr ul xmp".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TABLE = frozenset("table caption colgroup tbody thead tfoot tr td th".split())
# A start tag ends an open element of these kinds, not looking beyond the scope after the slash.
ENDS = {
    **{tag: ({"p"}, {"td", "th", "caption", "button", "table"}) for tag in BLOCK - {"tr", "td", "th"}},
    "li": ({"li", "p"}, {"ul", "ol", "menu", "table"}),
    "dd": ({"dd", "dt", "p"}, {"dl", "table"}),
    "dt": ({"dd", "dt", "p"}, {"dl", "table"}),
    "option": ({"option"}, {"select", "optgroup"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
}
# Elements nested deeper than this become siblings, as in browsers; no text is lost by it.
DEEPEST = 512

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"
    r"|<[!?][^>]*>?|</(?![a-zA-Z])[^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s/=\"'>][^\s/=>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I) for tag in RAW}


class Node:
    """An element: its tag, the attributes that are looked at, children and, once closed, its hash."""

    __slots__ = ("tag", "attrs", "children", "parent", "hash", "chars", "linked")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.hash = self.chars = self.linked = 0

    def close(self) -> None:
        """Hash of tag, class, id, texts and children; counts of text and of text in links."""
        state = blake2b(digest_size=8)
        names = (self.tag, self.attrs.get("class", ""), self.attrs.get("id", ""))
        state.update("\x00".join(names).encode("utf-8", "surrogatepass"))
        for child in self.children:
            if isinstance(child, str):
                words = " ".join(child.split())
                if words:
                    state.update(b"\x01" + words.encode("utf-8", "surrogatepass"))
                    self.chars += len(words)
            else:
                state.update(b"\x02" + child.hash.to_bytes(8, "little", signed=True))
                self.chars += child.chars
                self.linked += child.linked
        if self.tag == "a":
            self.linked = self.chars
        self.hash = int.from_bytes(state.digest(), "little", signed=True)

    def elements(self) -> Iterator[Node]:
        """This element and all below it, in page order."""
        stack = [self]
        while stack:
            node = stack.pop()
            yield node
            stack.extend(c for c in reversed(node.children) if not isinstance(c, str))


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(next((v for v in values if v), "")))
    return found


def parse(page: str) -> Node:
    """The tree of a page; any text makes one. Scripts, styles and other raw elements stay empty."""
    root = Node("html", {}, None)
    stack, at = [root], 0
    while at < len(page):
        found = _TOKEN.search(page, at)
        _text(stack, page[at : found.start()] if found else page[at:])
        if not found:
            break
        at = found.end()
        closing, tag = found.group(1), (found.group(2) or "").lower()
        if not tag or not found.group(4):
            continue
        if closing:
            _end(stack, tag)
            continue
        self_closed = _start(stack, tag, found.group(3))
        if tag in RAW and not self_closed:
            stop = _RAW_END[tag].search(page, at)
            at = stop.end() if stop else len(page)
            _pop(stack, 1)
        elif tag == "plaintext":
            _text(stack, page[at:], decode=False)
            break
    _pop(stack, len(stack))
    return root


def _text(stack: list[Node], text: str, decode: bool = True) -> None:
    if not text:
        return
    if stack[-1].tag == "head" and text.strip():
        _pop(stack, 1)
    stack[-1].children.append(html.unescape(text) if decode and "&" in text else text)


def _pop(stack: list[Node], count: int) -> None:
    for _ in range(count):
        stack.pop().close()


def _start(stack: list[Node], tag: str, attributes: str) -> bool:
    if tag in ("html", "body") and any(n.tag == tag for n in stack[:3]):
        return True
    if stack[-1].tag == "head" and tag not in HEAD:
        _pop(stack, 1)
    ended, scope = ENDS.get(tag, ((), ()))
    for depth in range(1, len(stack)):
        open_ = stack[-depth].tag
        if open_ in ended:
            _pop(stack, depth)
            # A list item ends the paragraph inside it and then the item before.
            again = open_ == "p" and tag in ("li", "dd", "dt")
            if not again:
                break
            return _start(stack, tag, attributes)
        if open_ in scope:
            break
    if tag in HEADINGS and stack[-1].tag in HEADINGS:
        _pop(stack, 1)
    if len(stack) >= DEEPEST and tag not in VOID:
        _pop(stack, 1)
    node = Node(tag, _attributes(attributes) if attributes else {}, stack[-1])
    stack[-1].children.append(node)
    if tag in VOID:
        node.close()
        return True
    stack.append(node)
    return False


def _end(stack: list[Node], tag: str) -> None:
    """Close the nearest open element of a tag. An inline end tag does not reach out of a block."""
    if tag in ("html", "body"):
        return
    for depth in range(1, len(stack)):
        open_ = stack[-depth].tag
        if open_ == tag or (tag in HEADINGS and open_ in HEADINGS):
            _pop(stack, depth)
            return
        if open_ in BLOCK and tag not in BLOCK or open_ in TABLE and tag not in TABLE:
            return
