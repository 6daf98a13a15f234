"""Field and link extraction from stored web pages."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from suarakit import constants as K
from suarakit.schemas import PAGE_FIELDS

# Elements without content, and elements whose text is not page text.
_VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen "
    "link menuitem meta nextid param source spacer track wbr".split()
)
_HIDDEN = frozenset("script style template rt rp".split())


@dataclass
class _Element:
    index: int
    tag: str
    attrs: dict[str, str]
    first_text: int
    end_text: int = -1
    end_element: int = -1


class _Page(HTMLParser):
    """Flat list of elements, each with the range of texts and elements inside it.

    Unclosed elements reach to the end of the closest closed ancestor.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.elements: list[_Element] = []
        self.texts: list[str] = []
        self._open: list[int] = []
        self._pending: list[str] = []
        self.feed(html)
        self.close()
        self._close_down_to(0)

    def _flush(self) -> None:
        if self._pending:
            self.texts.append("".join(self._pending))
            self._pending.clear()

    def _close_down_to(self, depth: int) -> None:
        self._flush()
        for i in self._open[depth:]:
            self.elements[i].end_text = len(self.texts)
            self.elements[i].end_element = len(self.elements)
        del self._open[depth:]

    def handle_starttag(self, tag, attrs):
        self._flush()
        index = len(self.elements)
        self._open.append(index)
        self.elements.append(
            _Element(index, tag, {k: v or "" for k, v in attrs}, len(self.texts))
        )
        if tag in _VOID:
            self._close_down_to(len(self._open) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self._close_down_to(len(self._open) - 1)

    def handle_endtag(self, tag):
        for depth in range(len(self._open) - 1, -1, -1):
            if self.elements[self._open[depth]].tag == tag:
                self._close_down_to(depth)
                return

    def handle_data(self, data):
        if not any(self.elements[i].tag in _HIDDEN for i in self._open):
            self._pending.append(data)

    def handle_comment(self, data):
        self._flush()

    handle_decl = handle_pi = unknown_decl = handle_comment

    def find(self, inside: _Element | None = None, tag=None, css_classes=(), href_contains=None):
        """Matching elements in document order."""
        lo = 0 if inside is None else inside.index + 1
        hi = len(self.elements) if inside is None else inside.end_element
        for i in range(lo, hi):
            e = self.elements[i]
            if tag and e.tag != tag:
                continue
            if css_classes and not set(css_classes) <= set(e.attrs.get("class", "").split()):
                continue
            if href_contains is not None and not (
                "href" in e.attrs and href_contains in e.attrs["href"]
            ):
                continue
            yield e

    def text(self, e: _Element) -> str:
        """Texts inside the element, each stripped, joined without a gap."""
        return "".join(t.strip() for t in self.texts[e.first_text : e.end_text])

    def holds(self, e: _Element, needle: str) -> bool:
        return needle in "".join(self.texts[e.first_text : e.end_text])


def _field(page: _Page, rule: dict) -> str | None:
    classes = (rule["css_class"],) if "css_class" in rule else ()
    for e in page.find(tag=rule["tag"], css_classes=classes, href_contains=rule.get("href_contains")):
        if "contains" in rule and not page.holds(e, rule["contains"]):
            continue
        if "inner" in rule:
            e = next(page.find(e, rule["inner"]), None)
        elif "prefer" in rule:
            e = next(page.find(e, rule["prefer"]), e)
        return None if e is None else page.text(e)
    return None


def _fields_of(html: str, rules: dict[str, dict], names: Sequence[str]) -> list[str | None]:
    """Fields of one page. The parsed page takes many times the room of its text and goes at once."""
    page = _Page(html)
    return [_field(page, rules[n]) if n in rules and n != "url" else None for n in names]


def page_fields(
    pages: DataFrame, rules: dict[str, dict] | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """``id, judul, isi, kategori, url`` per page; pages without HTML are skipped.

    ``keep`` names columns of ``pages`` that come along, such as the order of the crawl.

    A rule names a ``tag`` and may ask for a ``css_class``, an address part
    (``href_contains``) or a text the element ``contains``. ``inner`` takes the text of the
    first such element inside, ``prefer`` does so only if there is one.
    """
    rules = K.DETAIL_RULES if rules is None else rules
    names = PAGE_FIELDS.fieldNames()

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_fields_of(html.as_py(), rules, names) for html in batch.column(1)]
            made = [
                batch.column(0) if n == "url" else pa.array([f[i] for f in found], pa.string())
                for i, n in enumerate(names)
            ]
            yield pa.RecordBatch.from_arrays([*made, *batch.columns[2:]], names=[*names, *keep])

    fetched = pages.filter(F.col("html").isNotNull()).select("url", "html", *keep)
    fields = fetched.mapInArrow(extract, T.StructType([*PAGE_FIELDS.fields, *fetched.schema.fields[2:]]))
    return fields.withColumn("id", F.replace("id", F.lit("#"), F.lit("")))


def page_links(
    pages: DataFrame, base_url: str, card: dict | None = None
) -> DataFrame:
    """``url, position, link``: the first address in each list card, made absolute."""
    card = K.LIST_CARD if card is None else card
    schema = T.StructType(
        [T.StructField("url", T.StringType()), T.StructField("hrefs", T.ArrayType(T.StringType()))]
    )

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = []
            for html in pdf["html"]:
                page = _Page(html)
                cards = page.find(tag=card["tag"], css_classes=card.get("css_classes", ()))
                firsts = (next(page.find(c, "a", href_contains=""), None) for c in cards)
                found.append([a.attrs["href"] for a in firsts if a is not None])
            yield pd.DataFrame({"url": pdf["url"], "hrefs": found})

    fetched = pages.filter(F.col("html").isNotNull()).select("url", "html")
    links = fetched.mapInPandas(extract, schema).select(
        "url", F.posexplode("hrefs").alias("position", "href")
    )
    absolute = F.when(F.startswith("href", F.lit("http")), F.col("href")).otherwise(
        F.concat(F.lit(base_url), F.col("href"))
    )
    return links.select("url", "position", absolute.alias("link"))
