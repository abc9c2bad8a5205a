"""Leaf blocks of an HTML page: runs of text between block-level borders, with their ancestors."""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass

# Element groups of the HTML language (fixed values).
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol option p pre search section"
    " summary table tbody td tfoot th thead tr ul".split()
)
BOXES = frozenset("article main section aside nav header footer form div body details dialog".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Content that is never page text.
SKIPPED = frozenset("script style title textarea noscript template iframe svg select object canvas audio video".split())
# An opening tag of the key closes an open element of the values, up to the nearest listed border.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
_NO_PARAGRAPH = BLOCK - {"button", "label", "option", "legend", "html", "head", "body"}

# Without their end tag these swallow the rest of the page (fixed value).
_RAW = frozenset({"script", "style", "title", "textarea"})
_CLOSING = {tag: re.compile(f"</{tag}(?=[\\s/>])[^>]*>?", re.IGNORECASE) for tag in SKIPPED}
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(slots=True)
class Block:
    text: str
    leaf: str
    box: tuple[str, ...]
    signs: frozenset[str]
    linked: int
    marked: bool


def _tag_end(page: str, at: int) -> int:
    """Position after the ``>`` that closes a tag, or -1. Quotes count where they open an attribute value."""
    while True:
        close = page.find(">", at)
        if close < 0:
            return -1
        quote = min((q for q in (page.find('="', at, close), page.find("='", at, close)) if q >= 0), default=-1)
        if quote < 0:
            return close + 1
        end = page.find(page[quote + 1], quote + 2)
        if end < 0:
            return -1
        at = end + 1


class _Page:
    def __init__(self) -> None:
        self.blocks: list[Block] = []
        # Name, signs of the element and its ancestors, marked, own signs.
        self.stack: list[tuple[str, frozenset[str], bool, set[str]]] = [("", frozenset(), False, set())]
        self.parts: list[str] = []
        self.linked = 0
        self.links = 0

    def text(self, raw: str) -> None:
        if raw:
            value = entities.unescape(raw) if "&" in raw else raw
            self.parts.append(value)
            if self.links:
                self.linked += len(value.strip())

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                _, signs, marked, _ = self.stack[-1]
                leaf = next((e[0] for e in reversed(self.stack) if e[0] in BLOCK), "")
                box = next((e[3] for e in reversed(self.stack) if e[0] in BOXES), ())
                self.blocks.append(Block(text, leaf, tuple(box), signs, self.linked, marked))
            self.parts, self.linked = [], 0

    def pop_to(self, index: int) -> None:
        for name, *_ in self.stack[index:]:
            self.links -= name == "a"
        del self.stack[index:]

    def open(self, name: str, attributes: str, mark: str | None) -> None:
        if name in BLOCK:
            self.flush()
            if name in _NO_PARAGRAPH:
                self.close_open({"p"}, {"button", "table", "td", "th"})
        if name in CLOSES:
            closed, borders = CLOSES[name]
            self.close_open(closed, borders)
        if name == "a":
            self.close_open({"a"}, BLOCK - {"p"})
        if name == "br":
            self.parts.append(" ")
        if name in VOID:
            return
        _, signs, marked, _ = self.stack[-1]
        own = {f"in:{name}"}
        if "=" in attributes:
            for key, *values in _ATTRIBUTE.findall(attributes):
                key = key.lower()
                if key in ("class", "id", "role", "itemprop"):
                    own.update("is:" + t.lower() for t in _TOKEN.findall(" ".join(values)))
                elif key == mark:
                    marked = "".join(values) == "1"
        self.links += name == "a"
        self.stack.append((name, signs if own <= signs else signs | own, marked, own))

    def close_open(self, names: set[str], borders: frozenset[str] | set[str]) -> None:
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] in names:
                self.pop_to(i)
                return
            if self.stack[i][0] in borders:
                return

    def close(self, name: str) -> None:
        if name in BLOCK:
            self.flush()
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == name:
                self.pop_to(i)
                return
            # An inline end tag does not close blocks.
            if name not in BLOCK and self.stack[i][0] in BLOCK:
                return


def leaf_blocks(page: str | None, mark: str | None = None) -> list[Block]:
    """Blocks in page order. Tag soup is accepted; a tag never closed swallows the rest, as in browsers.

    ``mark`` names an attribute that labels training pages: ``1`` marks the element's blocks, anything else unmarks.
    """
    page = page or ""
    out, at, n = _Page(), 0, len(page)
    while at < n:
        start = page.find("<", at)
        if start < 0:
            out.text(page[at:])
            break
        after = page[start + 1 : start + 2]
        if after == "!" or after == "?":
            out.text(page[at:start])
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                at = n if end < 0 else end + 3
            else:
                end = page.find(">", start)
                at = n if end < 0 else end + 1
            continue
        closing = after == "/"
        name = _NAME.match(page, start + 1 + closing)
        if not name:
            # A lone sign is text; "</" before anything else is dropped to the next ">".
            if closing:
                out.text(page[at:start])
                end = page.find(">", start)
                at = n if end < 0 else end + 1
            else:
                out.text(page[at : start + 1])
                at = start + 1
            continue
        out.text(page[at:start])
        end = _tag_end(page, name.end())
        if end < 0:
            break
        tag = name[0].lower()
        at = end
        if closing:
            if tag == "br":
                out.parts.append(" ")
            else:
                out.close(tag)
        elif tag in SKIPPED:
            if page[end - 2 : end] != "/>":
                stop = _CLOSING[tag].search(page, end)
                if stop:
                    at = stop.end()
                elif tag in _RAW:
                    break
        else:
            out.open(tag, page[name.end() : end - 1], mark)
    out.flush()
    return out.blocks
