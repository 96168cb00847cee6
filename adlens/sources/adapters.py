"""From pages and payloads of job boards to candidates, and from candidates to observations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlens.functions import band, dates, salary, text, titles, urls
from adlens.functions.details import description, parts, plain, search_text, window
from adlens.functions.text import compact, once
from adlens.operators import gates
from adlens.sources import files


def with_fields(items: DataFrame, texts: list[Column], pay: list[Column] | None = None, closing: list[Column] | None = None) -> DataFrame:
    """items with band, pay and closing date out of the texts, each in its own order where one is given, and the status that they allow."""
    found = F.struct(band.extract(*texts).alias("band"), salary.extract(*(pay or texts)).alias("s"), dates.closing_date(*(closing or texts)).alias("closing"))
    rows = items.select("*", F.explode(F.array(found)).alias("f_"))
    status = F.when(F.col("f_.band").isNotNull(), "explicit_band").when(F.col("f_.s").isNotNull(), "salary_only").otherwise("unclassified")
    return rows.select(
        *items.columns, F.col("f_.band").alias("band"), F.col("f_.s.text").alias("advertised_salary_text"), F.col("f_.s.minimum").alias("advertised_salary_min"), F.col("f_.s.maximum").alias("advertised_salary_max"),
        F.col("f_.s.period").alias("advertised_salary_period"), F.col("f_.closing").cast("string").alias("closing_date"), status.alias("classification_status"),
    )


def _objects(payloads: DataFrame, *paths: str) -> DataFrame:
    v = payloads.withColumn("v", F.try_parse_json("body")).where("v is not null")
    lists = [F.try_variant_get("v", p, "array<variant>") for p in paths]
    return v.select("source_id", "url", F.posexplode(F.coalesce(*lists, F.array().cast("array<variant>"))).alias("pos", "v"))


def _first(*names: str) -> Column:
    return compact(F.coalesce(*[F.nullif(F.try_variant_get("v", f"$.{n}", "string"), F.lit("")) for n in names]))


def pulse(payloads: DataFrame) -> DataFrame:
    """Candidates of a board that lists {"Jobs": [{"LinkId", "JobInfo": {…}}]}. payloads: source_id, url, body."""
    items = _objects(payloads, "$.Jobs", "$.jobs")
    slug = F.regexp_replace(F.regexp_replace("title", "[^A-Za-z0-9]+", "-"), "^-+|-+$", "")
    origin = F.concat(urls.part(F.col("url"), 1), F.lit("://"), urls.part(F.col("url"), 2))
    rows = items.select("source_id", "pos", "url", _first("LinkId").alias("link"), _first("JobInfo.Title", "Title").alias("title"), _first("JobInfo.Compensation").alias("pay"), plain(_first("JobInfo.Description")).alias("description_excerpt"), _first("JobInfo.Location", "Location").alias("location_text"), _first("JobInfo.EmploymentType", "JobInfo.WorkArrangement", "WorkType").alias("work_type"), _first("JobInfo.ClosingDate").alias("closing_text"))
    rows = rows.where("title <> ''").withColumn("url", F.when(F.col("link") == "", F.col("url")).otherwise(F.concat(origin, F.lit("/Pulse/job/"), F.col("link"), F.lit("/"), slug, F.lit("?source=public"))))
    return with_fields(rows, [F.col("title"), F.col("pay"), F.col("description_excerpt"), F.col("closing_text")]).drop("link", "pay")


def oracle_hcm(payloads: DataFrame) -> DataFrame:
    """Candidates of a board that lists {"items": [{"Title", "Id", …}]}. payloads: source_id, url, body."""
    items = _objects(payloads, "$.items", "$.Items", "$.jobs")
    site = F.coalesce(F.nullif(F.regexp_extract("url", "/sites/([^/?#]+)", 1), F.lit("")), F.lit("CX_1001"))
    origin = F.concat(urls.part(F.col("url"), 1), F.lit("://"), urls.part(F.col("url"), 2))
    own = F.concat(origin, F.lit("/hcmUI/CandidateExperience/en/sites/"), site, F.lit("/job/"), _first("Id", "RequisitionId", "JobId", "jobId"))
    rows = items.select("source_id", "pos", _first("Title", "title", "Name").alias("title"), F.coalesce(F.nullif(_first("ExternalUrl", "externalUrl"), F.lit("")), own).alias("url"), _first("PrimaryLocation", "Location", "primaryLocation").alias("location_text"), _first("WorkerType", "JobSchedule").alias("work_type"), F.to_json("v").alias("body"))
    rows = rows.where("title <> ''").withColumn("description_excerpt", text.excerpt(F.regexp_replace("body", r'[{}"\[\]]', " "), 300))
    return with_fields(rows, [F.col("title"), F.col("body")]).drop("body")


def merged_with_detail(listing: DataFrame, detail: DataFrame, key: str = "url") -> DataFrame:
    """Listing rows with their detail pages: place, kind of work and closing date from the detail first, pay from the listing first, the longer description."""
    mine = ("location_text", "work_type", "closing_date", "closing_text")
    pay = ("advertised_salary_text", "advertised_salary_min", "advertised_salary_max", "advertised_salary_period", "band")
    d = detail.select(F.col(key).alias("k_"), *[F.col(c).alias(f"d_{c}") for c in (*mine, *pay, "description_excerpt")])
    j = listing.join(d, F.col(key) == F.col("k_"), "left")
    some = lambda c: F.when(F.col(c).cast("string") != "", F.col(c))
    out = {c: F.coalesce(some(f"d_{c}"), F.col(c)) for c in mine} | {c: F.coalesce(some(c), F.col(f"d_{c}")) for c in pay}
    out["description_excerpt"] = F.when(F.coalesce(F.length("d_description_excerpt"), F.lit(0)) > F.coalesce(F.length("description_excerpt"), F.lit(0)), F.col("d_description_excerpt")).otherwise(F.col("description_excerpt"))
    out["classification_status"] = F.when(out["band"].isNotNull(), "explicit_band").when(some("advertised_salary_text").isNotNull(), "salary_only").otherwise(F.col("classification_status"))
    return j.withColumns(out).select(*listing.columns)


def details(pages: DataFrame) -> DataFrame:
    """Candidates out of detail pages (source_id, url, html): the band from title, document, description, what is set apart, and around the title; pay from what is set apart first.

    With document_text and document_urls, what the documents that a page links to say counts too, and has_document tells of it.
    """
    heading = plain(F.regexp_extract("html", r"(?is)<h[12]\b[^>]*>(.*?)</h[12]>", 1))
    read = F.struct(heading.alias("heading"), search_text(F.col("html")).alias("body"), parts(F.col("html")).alias("p"))
    more = ["document_urls"] if "document_urls" in pages.columns else []
    document = F.coalesce("document_text", F.lit("")) if more else F.lit("")
    rows = pages.select("source_id", "url", *more, document.alias("document"), F.explode(F.array(read)).alias("r"))
    rows = rows.select("source_id", "url", *more, "document", "r.heading", "r.body", "r.p.structured", F.explode(F.array(description(F.col("r.p.description")))).alias("d"))
    some = lambda c: F.nullif(c, F.lit(""))
    own = F.coalesce(F.col("d.text"), some(F.col("document")))
    told = F.coalesce(own, some(F.col("structured")), F.col("body"))
    status = F.when((F.col("document") != "") & F.col("d.status").isin("missing", "sparse"), "document").otherwise(F.col("d.status"))
    none = F.lit("")
    rows = rows.select(
        "source_id", "url", *more, "heading", "body", "structured", "document", F.col("d.text").alias("own"), status.alias("description_status"), F.col("d.hash").alias("description_hash"), titles.best(F.col("heading"), F.col("url"), body=told).alias("title"),
        none.alias("location_text"), none.alias("work_type"), none.alias("closing_text"), text.excerpt(told, 300).alias("description_excerpt"), *([(F.col("document") != "").alias("has_document")] if more else []),
    )
    body, set_apart, own, document = F.col("body"), F.col("structured"), F.col("own"), F.col("document")
    return with_fields(rows, [F.col("heading"), document, own, set_apart, window(F.col("heading"), body)], [set_apart, own, document, body], [set_apart, body, own, document]).drop("heading", "body", "structured", "own", "document")


def observations(candidates: DataFrame, sources: DataFrame, run_id: str, observed_at: str) -> DataFrame:
    """Candidates with their sources as rows of the log. sources: source_id, platform, council_name, short_name, source_url."""
    j = candidates.join(sources, "source_id")  # broadcast by Spark where it is small
    name = F.coalesce(F.nullif(compact(F.col("short_name")), F.lit("")), compact(F.col("council_name")))
    url = urls.canonical(F.coalesce(F.nullif(F.col("url"), F.lit("")), F.col("source_url")))
    paid = salary.normalised(F.when(F.length("advertised_salary_text") <= 360, text.excerpt(F.col("advertised_salary_text"), 300)), F.col("advertised_salary_min"), F.col("advertised_salary_max"), F.col("advertised_salary_period"))
    made = F.struct(url.alias("url"), titles.best(F.col("title"), url, council=name).alias("title"), paid.alias("pay"))
    rows = j.select("*", F.explode(F.array(made)).alias("m_"))
    job = text.stable_hash(text.key(F.col("council_name")), F.col("m_.title"), F.col("m_.url"))
    empty = lambda c: F.nullif(compact(F.col(c)), F.lit(""))
    return rows.select(
        job.alias("job_id"), text.stable_hash(F.lit(run_id), job, F.col("source_id"), F.col("m_.url"), length=24).alias("observation_id"), F.lit(run_id).alias("run_id"), F.lit(observed_at).alias("observed_at"), "source_id", F.col("platform").alias("source_platform"),
        text.key(name).alias("council_key"), F.col("m_.title").alias("title"), F.col("m_.url").alias("url"), empty("location_text").alias("location_text"), empty("work_type").alias("work_type"), empty("closing_date").alias("closing_date"), empty("closing_text").alias("closing_text"),
        F.col("m_.pay.text").alias("advertised_salary_text"), F.col("m_.pay.minimum").alias("advertised_salary_min"), F.col("m_.pay.maximum").alias("advertised_salary_max"), F.col("m_.pay.period").alias("advertised_salary_period"), "classification_status", "band", empty("description_excerpt").alias("description_excerpt"),
    )


def endpoint_candidates(payloads: DataFrame) -> DataFrame:
    """Candidates out of JSON payloads (source_id, url, body) of any shape."""
    items = files.endpoint_items(payloads)
    link = once(F.struct(F.col("base").alias("b"), F.col("link").alias("l")), lambda x: F.when(x["l"] == "", x["b"]).otherwise(urls.resolved(x["b"], x["l"])))
    rows = items.select("source_id", "pos", titles.best(F.col("title"), F.lit(""), body=F.col("body")).alias("title"), link.alias("url"), "location_text", "work_type", "closing_text", F.when(F.col("description") == "", "missing").otherwise("fetched").alias("description_status"), text.excerpt(F.when(F.col("description") == "", F.col("body")).otherwise(F.col("description")), 300).alias("description_excerpt"), "body")
    return with_fields(rows, [F.col("title"), F.col("body")], [F.col("body")], [F.col("closing_text"), F.col("body")]).drop("body")


#: Links of one listing page that are followed, and links and details of a page of a board whose data can't be had.
MOST_LINKS, MOST_STUBS, MOST_DETAILS = 40, 60, 40


def _followed(listings: DataFrame, most: int) -> DataFrame:
    """The first `most` links of each listing page (source_id, url, html) that may lead to listings: source_id, nth, title, url, at; each address once a source."""
    found = files.job_links(files.links(listings.withColumn("page_id", F.struct("source_id", "url"))))
    nth = F.row_number().over(Window.partitionBy("page_id").orderBy("pos"))
    some = found.withColumn("nth", nth).where(F.col("nth") <= most).select(F.col("page_id.source_id").alias("source_id"), "nth", "title", F.col("link").alias("url"), urls.canonical(F.col("link")).alias("at"))
    return some.groupBy("source_id", "at").agg(F.min(F.struct("nth", "title", "url")).alias("f")).select("source_id", "f.*", "at")


def answered(pages: DataFrame) -> DataFrame:
    """Pages by canonical address (at), one an address, without those whose site refused to answer."""
    good = pages.where(~F.coalesce(files.is_blocked(F.col("status"), F.col("html")), F.lit(False))) if "status" in pages.columns else pages
    return good.select(urls.canonical(F.col("url")).alias("at"), "html").groupBy("at").agg(F.min("html").alias("html"))


def crawled(listings: DataFrame, pages: DataFrame, most: int = MOST_LINKS) -> DataFrame:
    """Candidates out of the pages that listing pages (source_id, url, html) lead to, among pages (url, html, and status where it is known).

    Each listing page's first `most` links that may lead to listings are followed; of pages with one address one is
    read; pages whose site refused to answer, and details that can't be listings, are left out.
    """
    rows = details(_followed(listings, most).join(answered(pages), "at").select("source_id", "url", "html"))
    return rows.where(gates.is_probable())


def pulse_pages(listings: DataFrame, pages: DataFrame) -> DataFrame:
    """Candidates of boards that give a page in the place of data: the details of its first 40 links, and the next 20 as they are, with a warning."""
    followed = _followed(listings, MOST_STUBS)
    read = details(followed.where(F.col("nth") <= MOST_DETAILS).join(answered(pages), "at").select("source_id", "url", "html"))
    stubs = followed.where(F.col("nth") > MOST_DETAILS).select("source_id", "url", "title", F.lit("parse_warning").alias("classification_status"), F.lit("detail_skipped").alias("description_status"))
    return read.unionByName(stubs, allowMissingColumns=True)


def any_platform(payloads: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Candidates of all boards, each by its platform's adapter (payloads with `platform`).

    Boards of other platforms, or of none, are listing pages, which are followed among `pages`, as are boards of pulse that answer with a page.
    """
    known = ("pulse", "oracle_hcm")
    data = F.ltrim("body").startswith("{")
    parts = [pulse(payloads.where("platform = 'pulse'")), oracle_hcm(payloads.where("platform = 'oracle_hcm'"))]
    if pages is not None:
        listed = lambda rows: rows.select("source_id", "url", F.col("body").alias("html"))
        parts.append(crawled(listed(payloads.where(~F.coalesce("platform", F.lit("")).isin(*known))), pages))
        parts.append(pulse_pages(listed(payloads.where((F.col("platform") == "pulse") & ~F.coalesce(data, F.lit(False)))), pages))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
