"""What a listing's own page says: its description, the parts set apart for pay, sections, and words around the title."""

from __future__ import annotations

from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.functions.text import compact, once, stable_hash

#: Parts of classes that mark descriptions, in order of preference, and pay; headings of sections.
DESCRIPTION_CLASSES = ("description", "details", "content", "overview")
DESCRIPTION_TAGS = ("main", "article")
PAY_CLASSES = ("salary", "salery", "remuneration", "package")
SECTION = r"(?i)\b(about the role|key responsibilities|selection criteria|what you will do|about you|how to apply|position description)\b"
#: Left out of descriptions; and never text.
CHROME, CODE = frozenset(("script", "style", "nav", "footer", "header", "form")), frozenset(("script", "style", "template"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
#: Shortest description; sections of one; parts set apart for pay of one kind.
LEAST, MOST_SECTIONS, MOST_PAY = 40, 8, 4


class _Page(HTMLParser):
    """Collects the text of the first element of each kind of description, and of elements for pay."""

    def __init__(self) -> None:
        super().__init__()
        self.stack: list[tuple[str, list[str]]] = []  # open elements and what they collect
        self.found: dict[str, list[str]] = {}
        self.pay: dict[str, int] = {}

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in VOID:
            return
        values = {k: v or "" for k, v in attrs}
        kinds = [f"class:{c}" for c in DESCRIPTION_CLASSES if c in values.get("class", "")] + [f"tag:{tag}"] * (tag in DESCRIPTION_TAGS)
        mine = [k for k in kinds if k not in self.found]
        for c in [c for c in PAY_CLASSES if c in values.get("class", "")] + ["item"] * ("baseSalary" in values.get("itemprop", "")):
            self.pay[c] = self.pay.get(c, 0) + 1
            if self.pay[c] <= MOST_PAY:
                mine.append(f"pay:{c}:{self.pay[c]}")
        for k in mine:
            self.found[k] = []
        self.stack.append((tag, mine))

    def handle_endtag(self, tag: str) -> None:
        at = next((i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i][0] == tag), None)
        if at is not None:
            del self.stack[at:]

    def handle_data(self, data: str) -> None:
        if any(tag in CODE for tag, _ in self.stack):
            return
        chrome = False
        for tag, mine in reversed(self.stack):
            for k in mine:
                if k.startswith("pay:") or not chrome:
                    self.found[k].append(data)
            chrome = chrome or tag in CHROME

    def texts(self) -> tuple[str | None, str]:
        order = [f"class:{c}" for c in DESCRIPTION_CLASSES] + [f"tag:{t}" for t in DESCRIPTION_TAGS]
        own = next((" ".join(self.found[k]) for k in order if k in self.found), None)
        return own, " ".join(" ".join(self.found[f"pay:{c}:{i}"]) for c in (*PAY_CLASSES, "item") for i in range(1, min(self.pay.get(c, 0), MOST_PAY) + 1))


@F.arrow_udf(T.StructType([T.StructField("description", T.StringType()), T.StructField("pay", T.StringType())]))
def _parts(html: pa.Array) -> pa.Array:
    own, pay = [], []
    for x in html.to_pylist():
        page = _Page()
        page.feed(x or "")
        page.close()
        a, b = page.texts()
        own.append(a)
        pay.append(b)
    return pa.StructArray.from_arrays([pa.array(own, pa.string()), pa.array(pay, pa.string())], ["description", "pay"])


def _attributes(html: Column, pattern: str) -> Column:
    return F.array_join(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)), " ")


def plain(html: Column) -> Column:
    """Text without markup and code."""
    return compact(F.regexp_replace(F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)\b.*?</\1>", " "), "<[^>]*>", " "))


def search_text(html: Column) -> Column:
    """All that a page says: text, meta data, labels and structured data."""
    more = (r"""(?is)<meta\b[^>]*\bcontent\s*=\s*["']([^"']*)["']""", r"""(?is)<[a-z][^>]*\b(?:aria-label|title)\s*=\s*["']([^"']*)["']""", r"""(?is)<script\b[^>]*json[^>]*>(.*?)</script>""")
    return once(F.coalesce(html, F.lit("")), lambda h: compact(F.concat_ws(" ", plain(h), *[_attributes(h, p) for p in more])))


def parts(html: Column) -> Column:
    """description and structured: the page's description, null without one, and what it sets apart for pay and dates."""
    meta = r"""(?is)<meta\b[^>]*\b(?:name|property)\s*=\s*["'](?:og:)?description["'][^>]*\bcontent\s*=\s*["']([^"']*)["']"""
    linked = lambda h: _attributes(_attributes(h, r"(?is)<script\b[^>]*ld\+json[^>]*>(.*?)</script>"), r"""(?i)"(?:title|validThrough|employmentType)"\s*:\s*"([^"]+)\"""")
    both = F.struct(_parts(html).alias("p"), F.coalesce(html, F.lit("")).alias("h"))
    own = lambda b: F.when(b["p"]["description"].isNotNull(), compact(b["p"]["description"]))
    return once(both, lambda b: F.struct(own(b).alias("description"), compact(F.concat_ws(" ", b["p"]["pay"], _attributes(b["h"], meta), linked(b["h"]))).alias("structured")))


def sections(description: Column) -> Column:
    """heading and text of the first eight sections of a description that have text."""
    heads = lambda t: F.regexp_extract_all(t, F.lit(SECTION), F.lit(0))
    bodies = lambda t: F.transform(F.slice(F.split(t, SECTION, -1), F.lit(2), F.size(heads(t))), lambda b: compact(b))
    zipped = lambda t: F.transform(F.arrays_zip(heads(t).alias("h"), bodies(t).alias("b")), lambda x: F.struct(F.initcap(x["h"]).alias("heading"), x["b"].alias("text")))
    return once(compact(description), lambda t: F.slice(F.filter(zipped(t), lambda x: x["text"] != ""), 1, MOST_SECTIONS))


def description(text: Column) -> Column:
    """text, status (missing, sparse or fetched), hash and sections of a description; null is missing."""
    full = lambda t: F.length(t) >= LEAST
    status = lambda t: F.when(t.isNull(), "missing").when(full(t), "fetched").otherwise("sparse")
    made = lambda t: F.struct(F.nullif(t, F.lit("")).alias("text"), status(t).alias("status"), F.when(full(t), stable_hash(t, length=32)).alias("hash"), F.when(full(t), sections(t)).alias("sections"))
    return once(F.when(text.isNotNull(), compact(text)), made)


def window(title: Column, body: Column, after: int = 1400) -> Column:
    """The body around the first place of the title: a third of `after` before, and `after` behind; empty without the title."""
    at = lambda b: F.instr(F.lower(b["b"]), F.lower(b["t"]))
    start = lambda b: F.greatest(at(b) - after // 3, F.lit(1))
    cut = lambda b: F.substring(b["b"], start(b), at(b) - start(b) + F.length(b["t"]) + after)
    return once(F.struct(compact(title).alias("t"), compact(body).alias("b")), lambda b: F.when((F.length(b["t"]) >= 4) & (at(b) > 0), cut(b)).otherwise(""))
