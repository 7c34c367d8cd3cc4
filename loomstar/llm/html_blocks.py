"""Blocks of text of a web page, with the elements they lie in. One pass over the page, linear in its length."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

#: Elements that begin and end a block of text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
#: Elements whose inside is no text of the page, or that of a control.
UNREAD_TAGS = frozenset("script style textarea title noscript iframe xmp noembed noframes template svg math canvas audio video object select button datalist".split())
#: Of these, the ones that an unclosed start tag carries to the end of the page.
RAW_TAGS = frozenset("script style textarea title iframe xmp noembed noframes".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: What a start tag ends if it is open: tags, and the elements beyond which no one looks.
_CELL, _SECTION = frozenset(("td", "th", "caption", "table")), frozenset(("table",))
ENDS = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu", "dir")) | _CELL),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",)) | _CELL),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",)) | _CELL),
    "tr": (frozenset(("tr",)), _SECTION),
    "td": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "th": (frozenset(("td", "th")), frozenset(("tr", "table"))),
    "thead": (frozenset(("thead", "tbody", "tfoot")), _SECTION),
    "tbody": (frozenset(("thead", "tbody", "tfoot")), _SECTION),
    "tfoot": (frozenset(("thead", "tbody", "tfoot")), _SECTION),
    "option": (frozenset(("option",)), frozenset(("select", "datalist", "optgroup"))),
}

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""")
_COMMENT_END = re.compile("--!?>")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: Attributes that say what an element is for.
TOLD = frozenset(("class", "id", "role", "itemprop", "hidden", "aria-hidden", "style"))


@dataclass
class Element:
    tag: str
    parent: int
    depth: int
    told: dict[str, str]


@dataclass
class Block:
    element: int
    text: str
    linked: int  # characters inside links


@dataclass
class Page:
    elements: list[Element] = field(default_factory=lambda: [Element("", -1, 0, {})])
    blocks: list[Block] = field(default_factory=list)
    headlines: list[int] = field(default_factory=list)


def told(raw: str) -> dict[str, str]:
    """Attributes that count, of the text behind a tag's name."""
    if not raw or raw.isspace():
        return {}
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(raw) if m[1].lower() in TOLD}


class _Builder:
    def __init__(self):
        self.page = Page()
        self.open = [0]
        self.opened: dict[str, int] = {}
        self.text: list[str] = []
        self.linked = 0
        self.link_depth = 0  # how many elements were open where the link began; 0 outside links

    def add_text(self, text: str) -> None:
        if text:
            text = unescape(text) if "&" in text else text
            self.text.append(text)
            if self.link_depth:
                self.linked += len(text)

    def flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                self.page.blocks.append(Block(self.open[-1], text, min(self.linked, len(text))))
            self.text, self.linked = [], 0

    def push(self, tag: str, attributes: str) -> None:
        elements = self.page.elements
        elements.append(Element(tag, self.open[-1], len(self.open), told(attributes)))
        self.open.append(len(elements) - 1)
        self.opened[tag] = self.opened.get(tag, 0) + 1
        if tag == "h1":
            self.page.headlines.append(len(elements) - 1)

    def pop(self) -> None:
        tag = self.page.elements[self.open.pop()].tag
        self.opened[tag] -= 1
        if len(self.open) < self.link_depth:
            self.link_depth = 0

    def close(self, tags: frozenset[str], within: frozenset[str]) -> None:
        """Close the innermost open element of ``tags``, if it is not beyond one of ``within``."""
        if not any(self.opened.get(t) for t in tags):
            return
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.page.elements[self.open[k]].tag
            if tag in tags:
                while len(self.open) > k:
                    self.pop()
                return
            if tag in within:
                return

    def start(self, tag: str, attributes: str) -> None:
        if tag in BLOCK_TAGS:
            self.flush()
            self.close(_P, _CELL)
            if tag in ENDS:
                self.close(*ENDS[tag])
            if tag not in VOID_TAGS:
                self.push(tag, attributes)
        elif tag == "a":
            self.link_depth = len(self.open)
        elif tag == "br":
            self.add_text(" ")

    def end(self, tag: str) -> None:
        if tag in BLOCK_TAGS:
            self.flush()
            self.close(_HEADINGS if tag in _HEADINGS else frozenset((tag,)), frozenset() if tag == "table" or tag in ("body", "html") else _SECTION)
        elif tag == "a":
            self.link_depth = 0


_P, _HEADINGS = frozenset(("p",)), frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_END_OF = {tag: re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE) for tag in UNREAD_TAGS}


def read_page(html: str) -> Page:
    """Blocks of text in page order: white space is one space, character references are decoded, markup and controls are left out."""
    made, at, missing = _Builder(), 0, set()
    while at < len(html):
        place = html.find("<", at)
        if place < 0 or place + 1 >= len(html):
            made.add_text(html[at:])
            break
        if place > at:
            made.add_text(html[at:place])
        sign = html[place + 1]
        if sign == "!" or sign == "?" or (sign == "/" and not html[place + 2 : place + 3].isalpha()):
            if html.startswith("<!--", place):
                end = _COMMENT_END.search(html, place + 2)
                at = end.end() if end else len(html)
            else:
                end = html.find(">", place)
                at = end + 1 if end >= 0 else len(html)
            continue
        tag = _TAG.match(html, place) if sign == "/" or sign.isascii() and sign.isalpha() else None
        if tag is None:
            if sign == "/" or sign.isascii() and sign.isalpha():
                break  # a tag that never ends: the page is over
            made.add_text("<")
            at = place + 1
            continue
        name, at = tag[2].lower(), tag.end()
        if tag[1]:
            made.end(name)
        elif name in UNREAD_TAGS:
            end = None if name in missing else _END_OF[name].search(html, at)
            if end:
                at = html.find(">", end.end()) + 1 or len(html)
            elif name in RAW_TAGS:
                break
            else:
                missing.add(name)
        else:
            made.start(name, tag[3])
    made.flush()
    return made.page
