"""Leaf blocks of a web page: runs of text between block-level tags, with their ancestors.

Work and memory grow with the page, however deep its tags are nested: what a block needs of its
ancestors is handed down from one to the next, and sets that an element doesn't change are shared.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from html.parser import HTMLParser

# Kinds of elements in HTML.
BLOCK = set(
    "address article aside blockquote body button canvas caption center dd details dialog dir div "
    "dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html "
    "iframe legend li main menu nav ol optgroup option p pre search section select summary table "
    "tbody td textarea tfoot th thead title tr ul video audio".split()
)
VOID = set("area base br col embed hr img input link meta source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark output q s "
    "samp small span strike strong sub sup time tt u var".split()
)
UNSEEN = set("script style template noscript title svg math object iframe head".split())
#: What a start tag closes, if it is open and nothing of the second set lies between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
#: A paragraph ends at the next block, unless one of these was opened inside it.
PARAGRAPH = ({"p"}, {"td", "th", "li", "div", "article", "section", "body"})
NAMED = ("class", "id", "role")
NAME = re.compile("[a-z0-9]+")


#: Only these are told apart among a block's ancestors; pages can make up any number of others.
KNOWN = BLOCK | VOID | INLINE | UNSEEN


@dataclass
class Block:
    """Text with single blanks; the innermost tag and the known ones among all of them; what the
    words in their class, id and role hint at; the part of the text that is in links."""

    text: str
    leaf: str
    inside: frozenset[str]
    names: frozenset[str]
    linked: float


@dataclass(slots=True)
class Element:
    """An open element with what it and its ancestors say."""

    tag: str
    inside: frozenset[str]
    names: frozenset[str]


ROOT = Element("", frozenset(), frozenset())


class Page(HTMLParser):
    """Collects the blocks of a page. Wrong nesting is taken as browsers mostly do.

    ``hints`` says what a word of a class, id or role stands for; others are left out.
    """

    def __init__(self, hints: Mapping[str, str]) -> None:
        super().__init__(convert_charrefs=True)
        self.hints = hints
        self.open: list[Element] = []
        self.count: dict[str, int] = {}
        self.unseen = 0
        self.blocks: list[Block] = []
        self.links: list[str] = []
        self.title = ""
        self._text: list[str] = []
        self._linked = 0

    def flush(self) -> None:
        words = " ".join("".join(self._text).split())
        if words:
            top = self.open[-1] if self.open else ROOT
            linked = min(1.0, self._linked / len(words))
            self.blocks.append(Block(words, top.tag, top.inside, top.names, linked))
        self._text, self._linked = [], 0

    def _close(self, wanted: set[str], fence: set[str]) -> None:
        if not any(map(self.count.get, wanted)):
            return
        for at in range(len(self.open) - 1, -1, -1):
            tag = self.open[at].tag
            if tag in wanted:
                for element in self.open[at:]:
                    self.count[element.tag] -= 1
                    self.unseen -= element.tag in UNSEEN
                del self.open[at:]
                return
            if tag in fence:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self._text.append(" ")
        if tag == "a":
            self.links += [value for name, value in attrs if name == "href" and value]
        if tag in BLOCK:
            self.flush()
            if self.count.get("p"):
                self._close(*PARAGRAPH)
            if tag in CLOSES:
                self._close(*CLOSES[tag])
            if tag == "body":
                self._close({"head"}, set())
        if tag not in VOID:
            top = self.open[-1] if self.open else ROOT
            inside, names = top.inside, top.names
            if tag in KNOWN and tag not in inside:
                inside = inside | {tag}
            if attrs and self.hints:
                said = " ".join(v or "" for n, v in attrs if n in NAMED)
                more = {self.hints[word] for word in NAME.findall(said.lower()) if word in self.hints}
                names = names if more <= names else names | more
            self.open.append(Element(tag, inside, names))
            self.count[tag] = self.count.get(tag, 0) + 1
            self.unseen += tag in UNSEEN

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        if self.count.get(tag):
            self._close({tag}, set())

    def handle_data(self, data: str) -> None:
        if not self.title and self.count.get("title"):
            self.title = " ".join(data.split())
        if self.unseen:
            return
        self._text.append(data)
        if self.count.get("a"):
            self._linked += len(" ".join(data.split()))


def read_page(html: str | None, hints: Mapping[str, str] | None = None) -> Page:
    page = Page(hints or {})
    page.feed(html or "")
    page.close()
    page.flush()
    return page
