"""Leaf blocks of a web page, and the features by which a block is judged."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

#: Elements of HTML that begin a block of their own, that hold no text of the page (code, the head, and what a form
#: offers to choose or holds typed in), that embed something beside or instead of text, and that have no end.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td"
    " tfoot th thead title tr ul".split()
)
SILENT = frozenset("script style template head title textarea select datalist".split())
EMBEDDED = frozenset("noscript svg math iframe object canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What can stand in the head; anything else that begins there, and text, ends it.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: An element that is still open when one of these begins ends there.
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
#: What a search for such an element does not look beyond.
SCOPES = frozenset("table ul ol dl div section article aside main nav body form td th".split())

#: Elements that say what part of a page they are.
ZONES = frozenset("article main nav header footer aside form".split())

_TOKEN = re.compile(r"[a-z]+|[A-Z][a-z]*")
_SENTENCE = re.compile(r"[.!?:;,]")


@dataclass
class Block:
    text: str
    tags: tuple[str, ...]  # ancestors, outermost first
    names: frozenset[str]  # words of their class, id and role
    linked: float  # share of characters inside links
    hidden: bool


@dataclass
class _Open:
    tag: str
    names: frozenset[str] = field(default_factory=frozenset)
    hidden: bool = False


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[_Open] = []
        self.silent = 0
        self.links = 0
        self.parts: list[str] = []
        self.linked = 0
        self.blocks: list[Block] = []

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            names = frozenset().union(*(x.names for x in self.stack))
            share = min(1.0, self.linked / len(text))
            self.blocks.append(Block(text, tuple(x.tag for x in self.stack), names, share, any(x.hidden for x in self.stack)))
        self.parts, self.linked = [], 0

    def close_to(self, at: int) -> None:
        for x in self.stack[at:]:
            self.silent -= x.tag in SILENT
            self.links -= x.tag == "a"
        del self.stack[at:]

    def end_head(self) -> None:
        if self.stack and self.stack[-1].tag == "head":
            self.close_to(len(self.stack) - 1)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in IN_HEAD:
            self.end_head()
        if tag in BLOCKS:
            self.flush()
            for at in range(len(self.stack) - 1, -1, -1):
                above = self.stack[at].tag
                if (above == "p" and tag in BLOCKS) or tag in ENDED_BY.get(above, ()):
                    self.close_to(at)
                    break
                if above in SCOPES or above in SILENT or above in EMBEDDED:
                    break
        elif tag == "br":
            self.parts.append(" ")
        if tag == "body" and any(x.tag == "head" for x in self.stack):
            self.close_to(next(n for n, x in enumerate(self.stack) if x.tag == "head"))
        if tag in VOID:
            return
        given = {k: v or "" for k, v in attrs}
        words = " ".join(given.get(k, "") for k in ("class", "id", "role", "aria-label"))
        hidden = "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", "").lower()
        self.stack.append(_Open(tag, frozenset(w.lower() for w in _TOKEN.findall(words)), hidden))
        self.silent += tag in SILENT
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in SILENT:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at].tag == tag:
                if any(x.tag in BLOCKS for x in self.stack[at:]):
                    self.flush()
                self.close_to(at)
                return
            if tag not in BLOCKS and tag not in SILENT and tag not in EMBEDDED and self.stack[at].tag in BLOCKS:
                return

    def handle_data(self, data: str) -> None:
        if not data.isspace():
            self.end_head()
        if not self.silent:
            self.parts.append(data)
            if self.links:
                self.linked += len(data)


def blocks_of(html: str) -> list[Block]:
    """The leaf blocks of a page with text, in page order; white space is brought down to single spaces."""
    reader = _Reader()
    reader.feed(html)
    reader.close()
    reader.flush()
    return reader.blocks


def _step(value: float, *limits: float) -> int:
    return sum(value >= x for x in limits)


def features(blocks: list[Block]) -> list[list[str]]:
    """Per block the names of its features: ancestors and what they are called, and the make of its text."""
    found = []
    for b in blocks:
        words = b.text.split(" ")
        first = b.text[:1]
        own = [
            "bias",
            f"tag:{b.tags[-1] if b.tags else ''}",
            f"words:{_step(len(words), 2, 5, 10, 20, 50)}",
            f"linked:{_step(b.linked, 0.01, 0.3, 0.7, 0.95)}",
            f"stops:{_step(len(_SENTENCE.findall(b.text)) / len(words), 0.01, 0.05, 0.15)}",
            f"ends:{b.text[-1] in '.!?:;\"»”’'}",
            f"begins:{'sign' if not first.isalnum() else 'upper' if first.isupper() else 'other'}",
        ]
        # The tag itself has a feature already; "zone" tells an article's aside from an aside.
        own += [f"in:{t}" for t in set(b.tags[:-1])]
        own.append("zone:" + "/".join(t for t in b.tags if t in ZONES)[-40:])
        own += [f"name:{w}" for w in b.names]
        if "\xa9" in b.text:
            own.append("copyright")
        if b.hidden:
            own.append("hidden")
        found.append(own)
    return found
