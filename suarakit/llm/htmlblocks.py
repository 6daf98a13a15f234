"""Text blocks of an HTML page in page order, each with the path of tags above it.

Tolerant of what pages on the web are like: tags left open or closed twice, quotes in odd places,
markup that ends in the middle of a tag. Time is in proportion to the page's length.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import Counter
from typing import NamedTuple

BUCKETS = 4096  # of tag-path features

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))"  # a comment, to the end of the page if it is not closed
    r"|<[!?][^>]*+>"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>",
    re.S,
)
_NAMED = re.compile(r"\b(class|id|role|itemprop)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_OPENS = re.compile(r"<[a-zA-Z/!?]")

# Fixed values of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
_SKIP = frozenset("select svg template button canvas audio video object datalist".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody "
    "td tfoot th thead tr ul".split()
)
# What an opening tag closes if it is open, and where the search for it stops.
_CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
}
_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
_P_STOPS = frozenset("td th caption button object template".split())


class Block(NamedTuple):
    text: str
    path: int  # number of its path in the page
    linked: int  # characters within links


class Path(NamedTuple):
    parent: int
    names: tuple[str, ...]  # of tag and attributes, such as ``t:div`` and ``c:sidebar``
    above: frozenset[str]  # names of all tags above it and its own


def feature(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "replace")) % BUCKETS


def _names(tag: str, rest: str) -> tuple[str, ...]:
    out = [f"t:{tag}"]
    if rest:
        for m in _NAMED.finditer(rest):
            value = m[2] or m[3] or m[4] or ""
            out += [f"c:{part.lower()}" for part in _PART.findall(value)[:32]]
        if "hidden" in rest:
            out.append("a:hidden")
    return tuple(dict.fromkeys(out))


class _Reader:
    def __init__(self) -> None:
        self.paths = [Path(-1, (), frozenset())]
        self.known: dict[tuple[int, tuple[str, ...]], int] = {}
        self.stack: list[tuple[str, int]] = [("", 0)]
        self.open: Counter[str] = Counter()
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked = self.skipped = 0

    def push(self, tag: str, rest: str) -> None:
        parent, names = self.stack[-1][1], _names(tag, rest)
        path = self.known.get((parent, names))
        if path is None:
            path = self.known[parent, names] = len(self.paths)
            above = self.paths[parent].above
            # Deep nesting of the same tags shares one set.
            self.paths.append(Path(parent, names, above if above.issuperset(names) else above.union(names)))
        self.stack.append((tag, path))
        self.open[tag] += 1
        self.skipped += tag in _SKIP

    def drop(self, at: int) -> None:
        """Close the tag at this place of the stack and all that are open within it."""
        for tag, _ in self.stack[at:]:
            self.open[tag] -= 1
            self.skipped -= tag in _SKIP
        del self.stack[at:]

    def close_open(self, tags: tuple[str, ...], stops) -> None:
        if any(self.open[t] for t in tags):
            for at in range(len(self.stack) - 1, 0, -1):
                if self.stack[at][0] in tags:
                    return self.drop(at)
                if self.stack[at][0] in stops:
                    return None
        return None

    def start(self, tag: str, rest: str) -> None:
        if tag in _BLOCK:
            self.flush()
            self.close_open(("p",), _P_STOPS)
            if tag in _CLOSES:
                self.close_open(*_CLOSES[tag])
            elif tag in _HEADINGS and self.stack[-1][0] in _HEADINGS:
                self.drop(len(self.stack) - 1)
        elif tag == "br":
            self.parts.append(" ")
        if tag not in _VOID and tag not in ("html", "body"):
            self.push(tag, rest)

    def end(self, tag: str) -> None:
        if tag in _BLOCK:
            self.flush()
        if tag in _HEADINGS:  # closes one of any level
            self.close_open(_HEADINGS, ("td", "th", "table"))
            return
        if not self.open[tag]:
            return
        at = len(self.stack) - 1
        while self.stack[at][0] != tag:
            at -= 1
        if tag in _BLOCK or tag in _SKIP:
            self.drop(at)
        else:  # blocks within an inline tag stay open
            self.open[tag] -= 1
            del self.stack[at]

    def text(self, raw: str) -> None:
        if raw and not self.skipped:
            decoded = entities.unescape(raw) if "&" in raw else raw
            self.parts.append(decoded)
            if self.open["a"]:
                self.linked += len(decoded)

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                # The nearest block decides; inline tags around all of it count as its path too.
                self.blocks.append(Block(text, self.stack[-1][1], min(self.linked, len(text))))
            self.parts = []
        self.linked = 0


def read(page: str) -> tuple[list[Block], list[Path]]:
    """Blocks of a page without empty ones, and its paths.

    A block is the text between two tags of block level, references decoded and white space as
    one blank. Scripts, styles, titles, controls and comments are no text. A tag left unfinished at
    the end of the page is dropped.
    """
    reader = _Reader()
    stop = page.rfind(">") + 1
    at = 0
    while True:
        m = _TOKEN.search(page, at, stop) if at < stop else None
        if m is None:
            break
        reader.text(page[at : m.start()])
        at = m.end()
        if m["name"] is None:
            continue
        tag = m["name"].lower()
        if m["close"]:
            reader.end(tag)
        elif tag in _RAW:
            closing = re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I).search(page, at)
            at = closing.end() if closing else len(page)
        else:
            reader.start(tag, m["rest"])
    rest = page[at:]
    opens = _OPENS.search(rest)
    reader.text(rest[: opens.start()] if opens else rest)
    reader.flush()
    return reader.blocks, reader.paths
