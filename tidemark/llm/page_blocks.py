"""Leaf blocks of a web page: the text between two block boundaries, with the elements around it.

One pass of a tag pattern over the page. Inline elements do not end a block,
everything else does. An end tag closes the elements up to its start tag, or is
ignored; a paragraph, list item, table part or option also ends where its like
begins. Scripts, styles, the head, comments and other content that a page does
not show are skipped. An unfinished tag at the end of a page is dropped, as
browsers do. White space inside a block becomes one space.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

#: Elements of running text.
INLINE = frozenset((
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
    "label", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
    "var", "wbr",
))
#: Elements without content.
VOID = frozenset((
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
))
#: Elements whose content is no markup, and those whose content is not shown as text.
RAW = frozenset((
    "script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes",
))
HIDDEN = frozenset((
    "script", "style", "title", "head", "template", "iframe", "noembed", "noframes", "noscript", "svg", "math", "object", "canvas",
    "audio", "video", "map", "datalist",
))
#: Elements that end where one of the listed elements begins.
_PARAGRAPH_ENDS = frozenset((
    "address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure",
    "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "search",
    "section", "table", "ul", "li", "dd", "dt", "td", "th", "tr",
))
ENDED_BY = {
    "p": _PARAGRAPH_ENDS,
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "td": frozenset((
    "td", "th", "tr", "tbody", "thead", "tfoot",
)),
    "th": frozenset((
    "td", "th", "tr", "tbody", "thead", "tfoot",
)),
    "tr": frozenset((
    "tr", "tbody", "thead", "tfoot",
)),
    "option": frozenset(["option", "optgroup"]),
    "head": frozenset((
    "body", "div", "p", "article", "main", "header", "nav", "section", "table", "ul", "h1", "h2", "h3",
)),
}
#: Elements that keep an open list item or table part inside them from being ended by one outside.
_FENCES = frozenset((
    "ul", "ol", "menu", "dl", "table",
))

_OPEN = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
_COMMENT_END = re.compile(r"--!?>")
_TAG_END = re.compile(r"""(?>[^>"']|"[^"]*"|'[^']*')*+>""")
_NAMES = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")

#: An element around a block: its name, and the words of its class, id and role.
Element = tuple[str, tuple[str, ...]]


@dataclass(frozen=True)
class Block:
    """``linked`` of the ``len(text)`` code points, about, are links; ``around`` lists the elements from the outermost one."""

    text: str
    linked: int
    around: tuple[Element, ...]


def name_words(attributes: str) -> tuple[str, ...]:
    """The lower-case words in the class, id, role and itemprop of a tag."""
    found = [w.lower() for parts in _NAMES.findall(attributes) for w in _WORDS.findall("".join(parts))]
    return tuple(dict.fromkeys(found))


class _Page:
    def __init__(self) -> None:
        self.open: list[Element] = []
        self.hidden = 0
        self.links = 0
        self.pieces: list[str] = []
        self.linked = 0
        self.blocks: list[Block] = []

    def text(self, raw: str) -> None:
        if raw and not self.hidden:
            said = html.unescape(raw) if "&" in raw else raw
            self.pieces.append(said)
            if self.links:
                self.linked += len("".join(said.split()))

    def end_block(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.blocks.append(Block(text, self.linked, tuple(self.open)))
            self.pieces, self.linked = [], 0

    def _drop_to(self, at: int) -> None:
        for name, _ in self.open[at:]:
            self.hidden -= name in HIDDEN
        del self.open[at:]

    def begin(self, name: str, attributes: str) -> None:
        if name in INLINE:
            if name == "br":
                self.pieces.append(" ")
            elif name == "a":
                self.links = 1
            return
        self.end_block()
        for at in range(len(self.open) - 1, -1, -1):
            inside = self.open[at][0]
            if name in ENDED_BY.get(inside, ()):
                self._drop_to(at)
            elif inside in _FENCES or inside not in ENDED_BY and inside != "tbody" and inside != "thead":
                break
        if name not in VOID and not attributes.endswith("/"):
            self.open.append((name, name_words(attributes) if "=" in attributes else ()))
            self.hidden += name in HIDDEN

    def end(self, name: str) -> None:
        if name in INLINE:
            self.links = 0 if name == "a" else self.links
            return
        self.end_block()
        self.links = 0
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == name:
                self._drop_to(at)
                break


def blocks(page: str | None) -> list[Block]:
    """The blocks of a page in order; none for null."""
    found, at, page, quoted = _Page(), 0, page or "", True
    while True:
        tag = _OPEN.search(page, at)
        if not tag:
            found.text(page[at:])
            break
        found.text(page[at : tag.start()])
        if tag[1]:
            # "<!-->" and "<!--->" are whole comments
            short = re.compile(r"-?>").match(page, tag.end())
            end = short or _COMMENT_END.search(page, tag.end())
            if not end:
                break
            at = end.end()
            continue
        if tag[2]:
            close = page.find(">", tag.end())
            if close < 0:
                break
            at = close + 1
            continue
        name = tag[4].lower()
        end = _TAG_END.match(page, tag.end()) if quoted else None
        if end:
            at = end.end()
        else:
            # an odd quote: no later tag is looked at for quotes, so that a page is scanned once
            quoted = False
            at = page.find(">", tag.end()) + 1
            if not at:
                break
        if tag[3]:
            found.end(name)
            continue
        found.begin(name, page[tag.end() : at - 1])
        if name in RAW and not page[tag.end() : at - 1].endswith("/"):
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(page, at)
            if not end:
                if name not in HIDDEN:
                    found.text(page[at:])
                break
            if name not in HIDDEN:
                found.text(page[at : end.start()])
            at = end.start()
    found.end_block()
    return found.blocks
