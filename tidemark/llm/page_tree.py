"""A light element tree of a web page: what of HTML's tree rules the extraction needs.

Elements are told by their path of tag and class names. Unclosed tags, implied ends of
paragraphs, list items and cells, raw-text elements, comments and broken markup are handled;
nothing raises. A raw-text element without an end tag reaches to the end of the page, as in HTML,
unless it is self-closed: then it is empty, as any self-closed one inside an ``<svg>`` is.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea iframe title".split())
EMBEDDED = frozenset("svg canvas object noscript template".split())
INLINE = frozenset(
    (
        "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s "
        "samp small span strike strong sub sup time tt u var wbr"
    ).split()
)
# a start tag of the first kind ends an open element of the second, up to the boundary
_IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_KEEPS_P = INLINE | VOID | EMBEDDED | {"option", "td", "th", "tr", "tbody", "thead", "body", "html", "head"}

_MARKUP = re.compile(
    r"<!--(?:.*?--!?>|.*)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>",
    re.S,
)
# read one after the other, so that neither data-id nor a quoted value counts as a name
_ATTRIBUTE = re.compile(r"(?<![^\s\"'/])([^\s\"'/=]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_CLOSE = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I) for tag in RAW}
_SPACE = re.compile(r"[\x20\x09-\x0D]+")


@dataclass(slots=True)
class Node:
    tag: str
    names: str  # lower-cased class, id and role, in order
    parent: Node | None
    path: str
    children: list[Node] = field(default_factory=list)
    ended: bool = False  # by its own end tag


def _names(attributes: str) -> str:
    if not attributes:
        return ""
    found = _ATTRIBUTE.findall(attributes)
    return " ".join("".join(m[1:]) for m in found if m[0].lower() in ("class", "id", "role")).lower()


def parse(page: str) -> tuple[Node, list[tuple[Node, str]]]:
    """The root and the text blocks in page order, each with its innermost block element.
    Blocks are white-space normalised and never empty; raw-text elements have no blocks."""
    root = Node("", "", None, "")
    here, block_of = root, root
    blocks: list[tuple[Node, str]] = []
    held: list[str] = []

    def flush() -> None:
        if held:
            text = _SPACE.sub(" ", "".join(held)).strip(" ")
            held.clear()
            if text:
                blocks.append((block_of, text))

    def block(node: Node) -> Node:
        while node.tag in INLINE and node.parent is not None:
            node = node.parent
        return node

    def in_svg(node: Node | None) -> bool:
        while node is not None and node.tag != "svg":
            node = node.parent
        return node is not None

    def to(node: Node) -> None:
        nonlocal here, block_of
        inner = block(node)
        if inner is not block_of:
            flush()
            block_of = inner
        here = node

    at, end = 0, len(page)
    while at < end:
        found = _MARKUP.search(page, at)
        if found is None:
            held.append(html.unescape(page[at:]))
            break
        if found.start() > at:
            held.append(html.unescape(page[at : found.start()]))
        at = found.end()
        if found[2] is None:
            continue
        tag = found[2].lower()
        if found[1]:
            node = here
            while node is not None and node.tag != tag:
                node = node.parent
            if node is not None and node.parent is not None:
                if tag not in INLINE:
                    flush()
                node.ended = True
                to(node.parent)
            continue
        if tag == "br":
            held.append(" ")
        if tag not in _KEEPS_P:
            node = here
            while node.tag in INLINE and node.parent is not None:
                node = node.parent
            if node.tag == "p":
                flush()
                to(node.parent)
        if tag in _IMPLIED:
            ends, bounds = _IMPLIED[tag]
            node, last = here, None
            while node is not None and node.tag not in bounds:
                if node.tag in ends:
                    last = node
                node = node.parent
            if last is not None:
                flush()
                to(last.parent)
        names = _names(found[3])
        made = Node(tag, names, here, f"{here.path}/{tag}" + (f".{names}" if names else ""))
        here.children.append(made)
        closed = found[3].endswith("/")
        if tag in RAW:
            flush()
            if not (closed and in_svg(here)):
                close = _CLOSE[tag].search(page, at)
                at = close.end() if close else at if closed else end
        elif tag not in VOID and not closed:
            if tag not in INLINE:
                flush()
            to(made)
        elif tag not in INLINE:
            flush()
    flush()
    return root, blocks
