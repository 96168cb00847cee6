"""What a source's listing page leads to: addresses of data, postings in structured data, feeds, and documents of its details."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlens.functions import text, urls
from adlens.functions.text import compact, once
from adlens.sources import adapters, files, markup

#: Words of data addresses in links, how an address stands in a script, and endings of what is no data.
LINK_WORDS = r"(?i)(api|json|xml|rss|feed|sitemap|graphql|ajax|service|odata|endpoint)"
DATA_WORDS = r"(?i)(api|jobs?|careers?|vacanc|position|recruit|requisition|graphql|feed|rss|sitemap)"
LITERAL = r"""(?i)(['"])((?:https?://|/|\.\.?/)[^'"]{1,360}?(?:api|jobs?|careers?|vacanc|position|recruit|requisition|graphql|feed|rss|sitemap)[^'"]{0,360}?)\1"""
NOISE = r"(?i)\.(css|gif|ico|jpg|jpeg|png|svg|webp|woff|woff2)$"
FEED_WORDS = r"(?i)(rss|feed|sitemap|xml)"
#: Hints of a page, scripts that it links to and that are read, feeds that are noted and read, links and details of a feed, characters of evidence.
MOST_HINTS, MOST_SCRIPTS, MOST_FEEDS, READ_FEEDS, MOST_LINKS, MOST_DETAILS, EVIDENCE = 12, 3, 5, 2, 40, 25, 240
#: Endings of documents, words that tell one, parameters in which a viewer has its address, and documents read of a detail.
DOCUMENT_ENDS, DOCUMENT_WORDS, VIEWER_KEYS, MOST_DOCUMENTS = r"(?i)\.(pdf|docx)$", r"(?i)(position description|job specification|pd |download|document)", ("file", "src", "url"), 2
#: What addresses of JSON hold, and endings that rule them out.
STRUCTURED, NOT_STRUCTURED = r"(?i)(api|json|jobs|job|vacanc|position|recruit|requisition|graphql)", r"(?i)\.(js|css|png|jpg|svg|ico)$"


def looks_structured(url: Column) -> Column:
    """Whether an address may be one of JSON."""
    return ~urls.part(url, 3).rlike(NOT_STRUCTURED) & F.concat_ws(" ", urls.part(url, 3), urls.part(url, 4)).rlike(STRUCTURED)


def clean(base: Column, raw: Column) -> Column:
    """An address of data found on a page, made absolute, its host in lower case; empty for other schemes, pictures and styles."""
    link = urls.resolved(base, F.replace(compact(raw), F.lit("\\/"), F.lit("/")))
    lower = once(link, lambda u: F.concat(urls.part(u, 1), F.lit("://"), F.lower(urls.part(u, 2)), F.regexp_extract(u, r"^[^:]*://[^/?]*(.*)$", 1)))
    return once(lower, lambda u: F.when(u.rlike("^(?i)https?://[^/?]") & ~urls.part(u, 3).rlike(NOISE), u).otherwise(""))


def _elements(pages: DataFrame, *keep: str) -> DataFrame:
    return pages.select(*keep, "url", F.posexplode(markup.elements(F.col("html"))).alias("pos", "e"))


def _literals(rows: DataFrame, kind: str) -> DataFrame:
    """Rows (…, body, part, pos, base) as hints of what stands in quotes in their bodies."""
    quoted = F.arrays_zip(F.regexp_extract_all("body", F.lit(LITERAL), F.lit(2)).alias("raw"), F.regexp_extract_all("body", F.lit(LITERAL), F.lit(0)).alias("evidence"))
    each = rows.select("*", F.posexplode(quoted).alias("nth", "q"))
    return each.select("page_id", "base", "part", "pos", "nth", F.lit(kind).alias("kind"), F.col("q.raw").alias("raw"), F.col("q.evidence").alias("evidence"))


def hints(pages: DataFrame, scripts: DataFrame | None = None, most: int = MOST_HINTS) -> DataFrame:
    """Addresses of data on a page's own site (page_id, url, html): of links and forms, then of inline scripts, then of the first
    three scripts of the site that it links to, as far as `scripts` (url, body) has them: page_id, nth, kind, url, evidence, id.

    Of addresses that differ in case alone the first counts; `most` a page. Scripts join by address: each is read once,
    for however many pages link to it.
    """
    every = _elements(pages, "page_id").withColumnRenamed("url", "base").select("page_id", "base", "pos", "e.*")
    label = compact(F.concat_ws(" ", "rel", "type", "text", "title", "label"))
    linked = every.where("tag in ('a', 'link', 'form') and url is not null").withColumn("evidence", label)
    linked = linked.where((F.col("tag") == "form") | F.concat_ws(" ", "url", "evidence").rlike(LINK_WORDS))
    linked = linked.select("page_id", "base", F.lit(0).alias("part"), "pos", F.lit(0).alias("nth"), F.when(F.col("tag") == "form", "form_action").otherwise("feed_or_link").alias("kind"), F.col("url").alias("raw"), "evidence")
    inline = _literals(every.where("tag = 'script' and url is null").select("page_id", "base", F.lit(1).alias("part"), "pos", F.col("text").alias("body")), "inline_script")
    found = linked.unionByName(inline)
    if scripts is not None:
        asked = every.where("tag = 'script' and url is not null").withColumn("src", clean(F.col("base"), F.col("url")))
        asked = asked.where((F.col("src") != "") & urls.same_origin(F.col("base"), F.col("src")))
        asked = asked.withColumn("k", F.row_number().over(Window.partitionBy("page_id").orderBy("pos"))).where(F.col("k") <= MOST_SCRIPTS)
        bodies = scripts.groupBy(F.col("url").alias("src")).agg(F.min("body").alias("body"))
        found = found.unionByName(_literals(asked.join(bodies, "src").select("page_id", "base", F.lit(2).alias("part"), "pos", "body"), "linked_script"))
    found = found.withColumns({"url": clean(F.col("base"), F.col("raw")), "evidence": compact(F.col("evidence"))})
    ok = found.where((F.col("url") != "") & urls.same_origin(F.col("base"), F.col("url")) & F.concat_ws(" ", "url", "evidence").rlike(DATA_WORDS))
    first = ok.groupBy("page_id", F.lower("url").alias("low")).agg(F.min(F.struct("part", "pos", "nth", "kind", "url", "evidence")).alias("h"))
    ranked = first.withColumn("nth", F.row_number().over(Window.partitionBy("page_id").orderBy("h"))).where(F.col("nth") <= most)
    own = text.stable_hash(F.col("h.kind"), F.col("h.url"), F.col("h.evidence"), length=16)
    return ranked.select("page_id", "nth", "h.kind", "h.url", F.substring("h.evidence", 1, EVIDENCE).alias("evidence"), own.alias("id"))


def feed_urls(pages: DataFrame) -> DataFrame:
    """The first five feeds and site maps of its own site that a page (page_id, url, html) links to: page_id, nth, url."""
    every = _elements(pages, "page_id").where("e.tag in ('a', 'link') and e.url is not null")
    named = every.where(F.concat_ws(" ", "e.url", "e.type", "e.rel", "e.text").rlike(FEED_WORDS)).select("page_id", F.col("url").alias("base"), "pos", clean(F.col("url"), F.col("e.url")).alias("url"))
    own = named.where((F.col("url") != "") & urls.same_origin(F.col("base"), F.col("url")))
    first = own.groupBy("page_id", F.lower("url").alias("low")).agg(F.min(F.struct("pos", "url")).alias("f"))
    return first.withColumn("nth", F.row_number().over(Window.partitionBy("page_id").orderBy("f.pos"))).where(F.col("nth") <= MOST_FEEDS).select("page_id", "nth", "f.url")


def feed_candidates(listings: DataFrame, pages: DataFrame, entries: bool = False) -> DataFrame:
    """Candidates of the first two feeds of each source's listing page (source_id, url, html): the details that feeds link to, as `pages` (url, html) has them.

    Feeds are read as pages with anchors; with `entries`, items of feeds and addresses of site maps count as links too, after the anchors.
    A feed's first 40 links, and 25 of their details, are followed. Each source's detail counts once, at its first place.
    """
    site = adapters.answered(pages)
    feeds = feed_urls(listings.withColumn("page_id", F.col("source_id"))).where(F.col("nth") <= READ_FEEDS).withColumnRenamed("nth", "feed").withColumn("at", urls.canonical(F.col("url")))
    read = feeds.join(site, "at").select(F.struct(F.col("page_id").alias("source_id"), "feed").alias("page_id"), "url", "html")
    found = files.links(read)
    if entries:
        listed = read.select("page_id", "url", F.posexplode(markup.entries(F.col("html"))).alias("pos", "e"))
        listed = listed.select("page_id", (F.col("pos") + 1_000_000).alias("pos"), compact(F.col("e.title")).alias("title"), urls.resolved(F.col("url"), F.col("e.url")).alias("link"))
        # an address without a title, as in site maps, speaks for itself
        found = found.unionByName(listed.withColumn("title", F.when(F.col("title") == "", F.col("link")).otherwise(F.col("title"))))
    jobs = files.job_links(found).withColumn("k", F.row_number().over(Window.partitionBy("page_id").orderBy("pos"))).where(F.col("k") <= min(MOST_LINKS, MOST_DETAILS))
    placed = jobs.select("page_id.source_id", "page_id.feed", "k", "link", urls.canonical(F.col("link")).alias("at"))
    first = placed.groupBy("source_id", "at").agg(F.min(F.struct("feed", "k", "link")).alias("f"))
    return adapters.details(first.join(site, "at").select("source_id", F.col("f.link").alias("url"), "html"))


def _postings(value: object) -> list[dict]:
    """Objects at any depth whose type is that of a job posting, those around others first."""
    out, stack = [], [value]
    while stack:
        v = stack.pop()
        if isinstance(v, dict):
            kind = v.get("@type") or v.get("type")
            if {"jobposting", "job posting"} & {" ".join(str(k).split()).lower() for k in (kind if isinstance(kind, list) else [kind])}:
                out.append(v)
            stack += reversed(list(v.values()))
        elif isinstance(v, list):
            stack += reversed(v)
    return out


def _said(value: object) -> str:
    return " ".join(" ".join(files._scalars(value)).split())


def _posting(item: dict) -> tuple[str, ...]:
    place = item.get("jobLocation") or item.get("applicantLocationRequirements")
    told = lambda k: _said(item.get(k))
    return told("title") if item.get("title") else told("name"), told("url"), _said(place[:2] if isinstance(place, list) else place), told("employmentType"), told("validThrough"), told("description"), _said(item)


POSTING = ("title", "link", "location_text", "work_type", "closing_text", "description", "body")


def postings(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Job postings in pages' structured data (key, url, html): key, base, pos, title (or name), link, location_text, work_type, closing_text, description, and body, all its words.

    Types may be lists; blocks that aren't JSON have none; a posting without a title or a name isn't one.
    """
    blocks = _elements(pages, key).where("e.tag = 'script' and e.type like '%ld+json%'").select(F.col(key).alias("key"), F.col("url").alias("base"), "pos", F.col("e.text").alias("body"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for k, base, pos, body in zip(pdf["key"], pdf["base"], pdf["pos"], pdf["body"], strict=True):
                try:
                    found = _postings(json.loads(body))
                except (TypeError, ValueError, RecursionError):
                    continue
                out += [(k, base, pos, nth, *_posting(x)) for nth, x in enumerate(found)]
            yield pd.DataFrame(out, columns=["key", "base", "block", "nth", *POSTING])

    kind = blocks.schema["key"].dataType.simpleString()
    rows = blocks.mapInPandas(read, f"key {kind}, base string, block int, nth int, " + ", ".join(f"{n} string" for n in POSTING)).where("title <> ''")
    numbered = rows.withColumn("pos", F.row_number().over(Window.partitionBy("key").orderBy("block", "nth")) - 1)
    return numbered.select(F.col("key").alias(key), "base", "pos", *POSTING)


def json_ld_candidates(pages: DataFrame) -> DataFrame:
    """Candidates out of the structured data of listing pages (source_id, url, html), with band, pay, closing date and place; an address that is missing is the page's."""
    items = postings(pages, "source_id")
    link = F.when(F.col("link") == "", F.col("base")).otherwise(urls.resolved(F.col("base"), F.col("link")))
    told = F.when(F.col("description") == "", F.col("body")).otherwise(F.col("description"))
    rows = items.select("source_id", "pos", "title", link.alias("url"), "location_text", "work_type", "closing_text", F.when(F.col("description") == "", "missing").otherwise("fetched").alias("description_status"), text.excerpt(told, 300).alias("description_excerpt"), "body")
    return adapters.with_fields(rows, [F.col("title"), F.col("body")], [F.col("body")], [F.col("closing_text"), F.col("body")]).drop("body")


def document_urls(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Documents that pages (key, url, html) link to or embed, each once a page: key, nth, url. A viewer's address gives way to that of the document in it."""
    every = _elements(pages, key).where("e.tag in ('a', 'iframe', 'embed', 'object') and e.url is not null").select(F.col(key).alias("key"), F.col("url").alias("base"), "pos", "e.*")
    raw = compact(F.col("url"))
    values = lambda u: [F.try_url_decode(F.regexp_extract(u, rf"[?&]{k}=([^&#]*)", 1)) for k in VIEWER_KEYS]
    shown = once(raw, lambda u: F.coalesce(*[F.when(F.substring_index(v, "?", 1).rlike(DOCUMENT_ENDS), v) for v in values(u)], u))
    link = every.where(raw != "").withColumn("link", urls.resolved(F.col("base"), shown))
    label = compact(F.concat_ws(" ", "text", "title", "label"))
    good = link.where((F.col("link") != "") & (urls.part(F.col("link"), 3).rlike(DOCUMENT_ENDS) | F.concat_ws(" ", F.col("link"), label).rlike(DOCUMENT_WORDS)))
    first = good.groupBy("key", "link").agg(F.min("pos").alias("pos"))
    return first.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("pos", "link"))).select(F.col("key").alias(key), "nth", F.col("link").alias("url"))


def document_texts(pages: DataFrame, root: str, key: str = "page_id", most: int = MOST_DOCUMENTS) -> DataFrame:
    """The text of each page's first two documents, in order, with their addresses, as far as files under root have them: key, document_text, document_urls."""
    asked = document_urls(pages, key).where(F.col("nth") <= most)
    told = asked.join(files.document_texts(asked, root), "url").withColumn("text", compact(F.col("text"))).where("text <> ''")
    by_place = F.array_sort(F.collect_list(F.struct("nth", "url", "text")))
    return told.groupBy(key).agg(by_place.alias("d")).select(key, F.array_join(F.transform("d", lambda x: x["text"]), " ").alias("document_text"), F.transform("d", lambda x: x["url"]).alias("document_urls"))


def detail_candidates(pages: DataFrame, root: str) -> DataFrame:
    """Candidates out of detail pages (source_id, url, html) and the documents that they link to, as ``adapters.details`` reads both, with document_urls and has_document."""
    told = document_texts(pages.withColumn("page_id", F.struct("source_id", "url")), root)
    return adapters.details(pages.join(told.select("page_id.*", "document_text", "document_urls"), ["source_id", "url"], "left"))
