"""Leaf blocks of a page: runs of text between block-level tags, with the open elements around them."""

from __future__ import annotations

import html
import re
from collections import Counter
from typing import NamedTuple

#: Elements that don't end a block.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr math mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup mover munder munderover mfenced mstyle mpadded mphantom semantics".split()
)
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Controls of forms, in a form or not: what stands in them is no text of the page.
CONTROLS = frozenset("button select datalist option optgroup meter progress output".split())
#: Elements that an element of the same kind ends, within the nearest of the second.
ENDS_ITSELF = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
#: Elements that end each other.
SAME_KIND = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}
_TOKEN = re.compile(
    r"<!--(?:(?!-->).)*+(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|svg|iframe|title|textarea|canvas|audio|video|annotation(?:-xml)?)(?=[\s/>])[^>]*+>(?:(?!</(?P=raw)(?=[\s/>])).)*+(?:</(?P=raw)[^>]*+>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|<[a-z][^>]*+\Z",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
#: The mark of an element that isn't shown; no word of a class can be it.
GONE = "-hidden"
_PART = re.compile(r"[a-z]+|\d+", re.IGNORECASE)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Element:
    """An open element, with what is known of all elements around its content.

    Inline elements without marks share the `around` of the element outside of them, so it grows with what the elements
    say and not with their number.
    """

    __slots__ = ("around", "tag")

    def __init__(self, tag: str, around: Around):
        self.tag, self.around = tag, around


class Around:
    """The elements around a block: their distinct tags and marks, the last three that have any kind, and their number."""

    __slots__ = ("control", "depth", "gone", "outer", "said", "tag")

    def __init__(self, tag: str, said: tuple[str, ...], outer: Around | None):
        self.tag, self.outer, self.said = tag, outer, said
        self.depth = (outer.depth if outer else 0) + (tag not in ("html", "body", ""))
        self.control = tag in CONTROLS or bool(outer and outer.control)
        self.gone = GONE in said or bool(outer and outer.gone)


class Leaf(NamedTuple):
    text: str
    around: Around
    linked: int


def marks(rest: str) -> tuple[str, ...]:
    """The words of an element's class, id and role, and whether it is hidden."""
    found: list[str] = []
    for name, value in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE)):
            found.append(GONE)
        elif name == "aria-hidden" and value.lower() == "true":
            found.append("hidden")
        elif name in ("class", "id", "role", "itemprop", "aria-label"):
            for part in _PART.findall(_CAMEL.sub(" ", value)):
                found.append(part.lower())
    return tuple(dict.fromkeys(found))


def leaves(page: str) -> list[Leaf]:
    """All blocks with text, in page order; the cost grows with the page's length, however deep it is nested."""
    out: list[Leaf] = []
    root = Around("", (), None)
    stack: list[Element] = []
    open_ = Counter()  # of each tag
    parts: list[str] = []
    linked = at = 0

    def around() -> Around:
        return stack[-1].around if stack else root

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            here = around()
            if text and not here.control:
                out.append(Leaf(text, here, min(linked, len(text))))
            parts.clear()
        linked = 0

    def pop(to: int) -> None:
        for e in stack[to:]:
            open_[e.tag] -= 1
        del stack[to:]

    def last(tag: str) -> int:
        """Where the innermost open element of a tag is; it is open, and what lies above it is about to go."""
        return next(k for k in range(len(stack) - 1, -1, -1) if stack[k].tag == tag)

    def add(piece: str) -> None:
        nonlocal linked
        if around().gone:  # nobody sees it
            return
        piece = html.unescape(piece) if "&" in piece else piece
        parts.append(piece)
        if open_["a"]:
            linked += len(piece.strip())

    for token in _TOKEN.finditer(page):
        if token.start() > at:
            add(page[at : token.start()])
        at = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            parts.append(" ")
            continue
        inline = tag in INLINE
        if not inline:
            close()
        if token["end"]:
            if open_[tag]:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].tag == tag:
                        pop(k)
                        break
                    if inline and stack[k].tag not in INLINE:
                        break
            continue
        if tag in VOID:
            continue
        if not inline:
            if open_["p"]:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].tag == "p":
                        pop(k)
                        break
                    if stack[k].tag not in INLINE:
                        break
            if tag in ENDS_ITSELF and any(open_[t] for t in SAME_KIND.get(tag, (tag,))):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k].tag in ENDS_ITSELF[tag]:
                        break
                    if stack[k].tag in SAME_KIND.get(tag, (tag,)):
                        pop(k)
                        break
        elif tag == "a" and open_["a"]:
            pop(last("a"))
        rest = token["rest"]
        said = marks(rest) if rest.strip() else ()
        outer = around()
        stack.append(Element(tag, outer if inline and not said else Around(tag, said, outer)))
        open_[tag] += 1
    if at < len(page):
        add(page[at:])
    close()
    return out
