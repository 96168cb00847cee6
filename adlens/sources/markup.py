"""What pages and feeds hold, read once a page: links, forms, embedded documents, scripts and feed entries, with references decoded."""

from __future__ import annotations

from html.parser import HTMLParser
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Where the address of each kind of element stands, and which of them end without an end tag.
ADDRESS = {"a": "href", "link": "href", "form": "action", "iframe": "src", "embed": "src", "object": "data", "script": "src"}
VOID = ("link", "embed")
FIELDS = ("tag", "url", "text", "rel", "type", "title", "label")
ELEMENTS = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in FIELDS]))
ENTRIES = T.ArrayType(T.StructType([T.StructField("title", T.StringType()), T.StructField("url", T.StringType())]))


class _Elements(HTMLParser):
    """Collects the elements of ADDRESS in order, each with the text inside it."""

    def __init__(self) -> None:
        super().__init__()
        self.found: list[dict] = []
        self.open: list[dict] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag not in ADDRESS:
            return
        if tag == "a":  # a link ends where the next begins
            self.handle_endtag("a")
        values = dict(reversed(attrs))
        value = lambda n: (values[n] or "") if n in values else None
        one = {"tag": tag, "url": value(ADDRESS[tag]), "text": [], "rel": value("rel"), "type": value("type"), "title": value("title"), "label": value("aria-label")}
        self.found.append(one)
        if tag not in VOID:
            self.open.append(one)

    def handle_endtag(self, tag: str) -> None:
        at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i]["tag"] == tag), None)
        if at is not None:
            del self.open[at]

    def handle_data(self, data: str) -> None:
        script = self.open and self.open[-1]["tag"] == "script"
        for one in self.open[-1:] if script else self.open:
            one["text"].append(data)


@F.arrow_udf(ELEMENTS)
def _elements(html: pa.Array) -> pa.Array:
    out = []
    for x in html.to_pylist():
        page = _Elements()
        page.feed(x or "")
        page.close()
        out.append([{**one, "text": " ".join(one["text"])} for one in page.found])
    return pa.array(out, pa.list_(pa.struct([(n, pa.string()) for n in FIELDS])))


def elements(html: Column) -> Column:
    """The links, forms, frames, objects and scripts of a page in order: tag, url (null without one), text, rel, type, title, label. A page of null has none."""
    return _elements(html)


@F.arrow_udf(ENTRIES)
def _entries(xml: pa.Array) -> pa.Array:
    def one(text: str | None) -> list[dict]:
        try:
            root = ElementTree.fromstring((text or "").strip())
        except (ElementTree.ParseError, ValueError):
            return []
        out = []
        for e in root.iter():
            name = e.tag.rpartition("}")[2] if isinstance(e.tag, str) else ""
            if name not in ("item", "entry", "url"):
                continue
            inner = {}
            for c in e:
                key = c.tag.rpartition("}")[2] if isinstance(c.tag, str) else ""
                inner.setdefault(key, "".join(c.itertext()).strip() or c.get("href") or "")
            out.append({"title": inner.get("title", ""), "url": inner.get("link") or inner.get("loc") or ""})
        return out

    return pa.array([one(x) for x in xml.to_pylist()], pa.list_(pa.struct([("title", pa.string()), ("url", pa.string())])))


def entries(xml: Column) -> Column:
    """The entries of a feed or site map in order: title and url of each item, entry or url element. What isn't XML has none."""
    return _entries(xml)
