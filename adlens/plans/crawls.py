"""Queries over pages and what they lead to: links, structured data, scripts, feeds and documents, and the plan of what a run tries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.operators import strategy
from adlens.operators.staging import spread
from adlens.plans import lens
from adlens.plans.registry import query
from adlens.sources import adapters, discovery, files, seeds

#: Pages of parts, in either dialect: links with references and without quotes on a host whose name says careers.
REFERENCES = """concat('<a href=/jobs/', CAST(p_partkey AS VARCHAR(9)), '?a=1&amp;b=2>R&amp;D Offic&#101;r ', CAST(p_size AS VARCHAR(9)), '</a><A HREF="/about?x=&quot;">Our lovely team</A><a href="/openings">All roles &lt;new&gt;</a><a name="jobs">Job anchor</a>')"""
#: Structured data: a list of types, a posting with a name and no address, one in a graph, one without a title, and what is no JSON.
POSTINGS = """concat('<script type="application/ld+json">[{"@type": ["Thing", "JobPosting"], "title": "Parks Officer", "url": "/jobs/', CAST(p_partkey AS VARCHAR(9)), '", "validThrough": "2026-06-14", "jobLocation": [{"address": {"city": "Town"}}, "North", "South"],
 "description": "Band ', CAST(1 + p_partkey % 8 AS VARCHAR(9)), ' role"}, {"@type": "JobPosting", "url": "/jobs/none"}]</script><script type=''application/ld+json''>{"@graph": [{"@type": "Organization", "name": "X"}, {"type": " jobposting ", "name": "Nurse &amp; Carer",
 "baseSalary": {"value": "$', CAST(40000 + p_partkey % 1000 AS VARCHAR(9)), ' per annum"}, "employmentType": ["FULL_TIME", "PART_TIME"]}]}</script><script type="application/ld+json">{broken</script>')"""
#: Pages that link to scripts of their own site, another's, and more than are read.
SCRIPTED = """concat('<script src="/s/', CAST(p_partkey % 5 AS VARCHAR(9)), '.js"></script><script src="https://other.example/s/1.js"></script><script>x("/API/jobs/shared")</script><script src="/s/none.js"></script><script src="/s/9.js"></script><script src="/s/8.js"></script>')"""


def _pages(spark: SparkSession, sf_dir: str, html: str, url: str = "'https://careers.x.example/list/all'") -> DataFrame:
    return spread(lens.table(spark, sf_dir, "part")).selectExpr("p_partkey AS page_id", f"{url} AS url", f"{html} AS html")


@query(
    "SELECT p_partkey AS page_id, CAST(k.pos AS INT) AS pos, CASE k.pos WHEN 0 THEN concat('R&D Officer ', p_size) ELSE k.title END AS title, CASE k.pos WHEN 0 THEN concat('https://careers.x.example/jobs/', p_partkey, '?a=1&b=2') ELSE k.link END AS link, k.pos <> 1 AS followed"
    " FROM part, (VALUES (0, '', ''), (1, 'Our lovely team', 'https://careers.x.example/about?x=\"'), (2, 'All roles <new>', 'https://careers.x.example/openings')) k(pos, title, link)"
)
def entity_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links with references decoded, quoted or not, and which of them are followed: the host doesn't count."""
    found = files.links(_pages(spark, sf_dir, REFERENCES))
    return found.join(files.job_links(found).select("page_id", "pos", F.lit(True).alias("followed")), ["page_id", "pos"], "left").withColumn("followed", F.coalesce("followed", F.lit(False)))


BODIES = ("<p>Challenge yourself in a captcha team</p>", "<script>window.gokuProps = {}</script>", "var AwsWafCookieDomainList = []", "")


@query(
    "SELECT p_partkey AS page_id, p_partkey % 4 AS body, CASE p_partkey % 5 WHEN 0 THEN 200 WHEN 1 THEN 202 WHEN 2 THEN 403 WHEN 3 THEN 429 END AS status,"
    " p_partkey % 5 IN (2, 3) OR (p_partkey % 5 = 1 AND p_partkey % 4 IN (1, 2)) AS blocked FROM part"
)
def blocked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose site refused to answer."""
    status = F.expr("CASE p_partkey % 5 WHEN 0 THEN 200 WHEN 1 THEN 202 WHEN 2 THEN 403 WHEN 3 THEN 429 END").alias("status")
    body = F.element_at(F.array(*map(F.lit, BODIES)), (F.col("p_partkey") % 4 + 1).cast("int"))
    return lens.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("page_id"), (F.col("p_partkey") % 4).alias("body"), status, body.alias("html")).withColumn("blocked", files.is_blocked(F.col("status"), F.col("html"))).drop("html")


@query(
    "SELECT p_partkey AS source_id, CAST(k AS INT) AS pos, CASE k WHEN 0 THEN 'Parks Officer' ELSE 'Nurse &amp; Carer' END AS title, CASE k WHEN 0 THEN concat('https://careers.x.example/jobs/', p_partkey) ELSE 'https://careers.x.example/list/all' END AS url,"
    " CASE k WHEN 0 THEN 'Town North' ELSE '' END AS location_text, CASE k WHEN 1 THEN 'FULL_TIME PART_TIME' ELSE '' END AS work_type, CASE k WHEN 0 THEN '2026-06-14' ELSE '' END AS closing_text,"
    " CASE k WHEN 0 THEN CAST(1 + p_partkey % 8 AS INT) END AS band, CASE k WHEN 1 THEN (40000 + p_partkey % 1000)::double END AS advertised_salary_min, CASE k WHEN 0 THEN 'explicit_band' ELSE 'salary_only' END AS classification_status,"
    " CASE k WHEN 0 THEN 'fetched' ELSE 'missing' END AS description_status FROM part, range(2) r(k)"
)
def json_ld_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates in pages' structured data, with band, pay and place."""
    pages = _pages(spark, sf_dir, POSTINGS).withColumnRenamed("page_id", "source_id")
    return discovery.json_ld_candidates(pages).select("source_id", "pos", "title", "url", "location_text", "work_type", "closing_text", "band", "advertised_salary_min", "classification_status", "description_status")


@query(
    "WITH h AS (SELECT p_partkey AS page_id, 0 AS o, 0 AS i, 'inline_script' AS kind, 'https://careers.x.example/API/jobs/shared' AS url FROM part UNION ALL"
    " SELECT p_partkey, 1, CAST(i AS INT), 'linked_script', concat('https://careers.x.example/v1/feed/', p_partkey % 5, '/', i) FROM part, range(p_partkey % 5 * 4) r(i) UNION ALL SELECT p_partkey, 2, 0, 'linked_script', 'https://careers.x.example/v1/api/nine' FROM part)"
    " SELECT page_id, CAST(nth AS INT) AS nth, kind, url FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY o, i) AS nth FROM h) WHERE nth <= 12"
)
def linked_script_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of data in scripts that pages link to: three of their own site, after what pages say themselves, under one bound."""
    part = lens.table(spark, sf_dir, "part")
    some = part.select((F.col("p_partkey") % 5).alias("k")).distinct()
    calls = F.array_join(F.transform(F.sequence(F.lit(0), F.col("k").cast("int") * 4), lambda i: F.when(i == 0, 'get("/api/jobs/SHARED");').otherwise(F.concat(F.lit("get('/v1/feed/"), F.col("k").cast("string"), F.lit("/"), (i - 1).cast("string"), F.lit("');")))), "\n")
    scripts = some.select(F.concat(F.lit("https://careers.x.example/s/"), F.col("k").cast("string"), F.lit(".js")).alias("url"), calls.alias("body"))
    nine = part.agg(F.lit("https://careers.x.example/s/9.js").alias("url"), F.concat(F.lit("go('/v1/api/nine', '/v1/jobs/x.png', '"), F.lit("https://other.example/v1/api'"), F.lit(")")).alias("body"))
    eight = nine.select(F.lit("https://careers.x.example/s/8.js"), F.lit("go('/v1/api/eight')"))
    return discovery.hints(_pages(spark, sf_dir, SCRIPTED), scripts.union(nine).union(eight)).select("page_id", "nth", "kind", "url")


#: Sources are fifty groups of parts. A listing page links to three feeds, of which two are read; even parts are linked from the first, all from the second.
FEED_LISTING = '<link rel="alternate" type="application/rss+xml" href="/one.xml"><a href="/TWO.xml#x">Job feed</a><a href="/one.XML">again</a><a href="https://other.example/rss">other</a><a href="/three/sitemap">map</a>'
FEED_DETAIL = """concat('<h1>Civil Engineer ', CAST(p_partkey AS VARCHAR(9)), '</h1><article>Band ', CAST(1 + p_partkey % 8 AS VARCHAR(9)), ' role of the shire. This permanent position is based in town.</article>')"""
_FEEDS = (
    "WITH l AS (SELECT p_partkey % 50 AS s, p_partkey, row_number() OVER (PARTITION BY p_partkey % 50 ORDER BY p_partkey) AS k2, CASE WHEN p_partkey // 50 % 2 = 0 THEN row_number() OVER (PARTITION BY p_partkey % 50, p_partkey // 50 % 2 ORDER BY p_partkey) END AS k1 FROM part)"
)


def _feed_pages(spark: SparkSession, sf_dir: str, entry: Column | None = None) -> tuple[DataFrame, DataFrame]:
    part = lens.table(spark, sf_dir, "part").withColumn("s", F.col("p_partkey") % 50)
    site = F.concat(F.lit("https://s"), F.col("s").cast("string"), F.lit(".example"))
    link = F.concat(F.lit('<item><title>Civil Engineer</title><link>/jobs/'), F.col("p_partkey").cast("string"), F.lit('</link><a href="/jobs/'), F.col("p_partkey").cast("string"), F.lit('">Civil Engineer</a></item>'))
    lists = lambda df: df.groupBy("s").agg(F.concat(F.lit("<rss><channel>"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", (entry if entry is not None else link).alias("a")))), lambda x: x["a"]), ""), F.lit("</channel></rss>")).alias("html"))
    one, two = lists(part.where(F.floor(F.col("p_partkey") / 50) % 2 == 0)).withColumn("url", F.concat(site, F.lit("/one.xml"))), lists(part).withColumn("url", F.concat(site, F.lit("/TWO.xml")))
    listings = part.select("s").distinct().select(F.concat(F.lit("s"), F.col("s").cast("string")).alias("source_id"), F.concat(site, F.lit("/careers")).alias("url"), F.lit(FEED_LISTING).alias("html"))
    details = part.select(F.concat(site, F.lit("/jobs/"), F.col("p_partkey").cast("string")).alias("url"), F.expr(FEED_DETAIL).alias("html"))
    return listings, details.unionByName(one.select("url", "html")).unionByName(two.select("url", "html"))


_FEED_ROWS = " SELECT concat('s', s) AS source_id, concat('https://s', s, '.example/jobs/', p_partkey) AS url, concat('Civil Engineer ', p_partkey) AS title, CAST(1 + p_partkey % 8 AS INT) AS band FROM l WHERE k1 <= 25 OR k2 <= 25"


@query(_FEEDS + _FEED_ROWS)
def feed_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of each source's first two feeds, read as pages with anchors."""
    return discovery.feed_candidates(*_feed_pages(spark, sf_dir)).select("source_id", "url", "title", "band")


@query(_FEEDS + _FEED_ROWS)
def feed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same out of the items of feeds and the addresses of site maps, without anchors."""
    entry = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("<item><title>A role</title><link>/jobs/"), F.col("p_partkey").cast("string"), F.lit("</link></item>"))).otherwise(F.concat(F.lit("<url><loc>/jobs/"), F.col("p_partkey").cast("string"), F.lit("</loc></url>")))
    return discovery.feed_candidates(*_feed_pages(spark, sf_dir, entry), entries=True).select("source_id", "url", "title", "band")


DOCUMENTS = """concat('<a href="/files/', CAST(p_partkey AS VARCHAR(9)), '.PDF?v=1">One</a><iframe src="https://v.example/viewer?file=%2Fdocs%2Fa%20', CAST(p_partkey AS VARCHAR(9)), '.docx&amp;x=1"></iframe><a href="/files/', CAST(p_partkey AS VARCHAR(9)), '.PDF?v=1">Again</a>
<object data="/plain.html" title="Position Description"></object><embed src="/picture.png"><a href="/about">About us</a>')"""


@query(
    "SELECT p_partkey AS page_id, CAST(k.nth AS INT) AS nth, replace(k.url, '{}', CAST(p_partkey AS VARCHAR)) AS url, sha256(replace(k.url, '{}', CAST(p_partkey AS VARCHAR))) AS name FROM part,"
    " (VALUES (1, 'https://careers.x.example/files/{}.PDF?v=1'), (2, 'https://careers.x.example/docs/a {}.docx'), (3, 'https://careers.x.example/plain.html')) k(nth, url)"
)
def document_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that pages link to, embed, or show in a viewer, and the names under which they are kept."""
    return discovery.document_urls(_pages(spark, sf_dir, DOCUMENTS)).withColumn("name", files.document_name(F.col("url")))


@query(
    "WITH s AS (SELECT s_suppkey AS source_id, s_suppkey % 4 = 0 AS endpoint, s_suppkey % 3 = 0 AS preferred, s_suppkey % 2 = 0 AS accepted FROM supplier),"
    " k AS (SELECT source_id, i, CASE WHEN i > 0 AND accepted THEN 'accepted' ELSE 'candidate' END AS status, accepted FROM s, range(4) r(i) WHERE preferred),"
    " t AS (SELECT source_id, 'known_endpoint' AS strategy, row_number() OVER (PARTITION BY source_id ORDER BY i) - 1 AS strategy_index, concat('https://k.example/', i) AS url FROM k WHERE NOT accepted OR status = 'accepted'"
    " UNION ALL SELECT source_id, CASE WHEN endpoint THEN 'platform:pulse' ELSE 'platform:generic_html' END, 10, NULL FROM s"
    " UNION ALL SELECT source_id, 'discovered_endpoint', 20 + i, concat('https://h.example/', i) FROM s, range(5) r(i) WHERE i < 3 AND source_id % 5 = 0 AND (endpoint OR (preferred AND accepted))"
    " UNION ALL SELECT source_id, 'json_ld', 30, NULL FROM s WHERE source_id % 5 = 0 OR source_id % 7 = 0 UNION ALL SELECT source_id, 'sitemap_feed', 40, NULL FROM s WHERE source_id % 6 = 0)"
    " SELECT source_id, strategy, CAST(strategy_index AS BIGINT) AS strategy_index, url, strategy = 'platform:pulse' AND source_id % 8 = 0 AS failed FROM t WHERE strategy <> 'known_endpoint' OR strategy_index < 2"
)
def strategy_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run tries for each source, in order."""
    s = lens.table(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "source_id")
    sources = s.selectExpr("source_id", "CASE WHEN source_id % 4 = 0 THEN 'pulse' ELSE '' END AS platform", "CASE WHEN source_id % 3 = 0 THEN 'known_endpoint' END AS preferred_strategy")
    known = s.where("source_id % 3 = 0").selectExpr("source_id", "explode(sequence(0, 3)) AS place").selectExpr("source_id", "place", "concat('https://k.example/', place) AS url", "CASE WHEN place > 0 AND source_id % 2 = 0 THEN 'accepted' ELSE 'candidate' END AS status")
    hints = s.where("source_id % 5 = 0").selectExpr("source_id", "explode(sequence(1, 5)) AS nth").selectExpr("source_id", "nth", "concat('https://h.example/', nth - 1) AS url")
    failed = s.where("source_id % 8 = 0").selectExpr("source_id", "'platform:pulse' AS strategy")
    return strategy.attempts(sources, known, hints, s.where("source_id % 7 = 0").select("source_id"), s.where("source_id % 6 = 0").select("source_id"), failed)


@query(
    "SELECT p_partkey AS page_id, regexp_matches(u, '^[^?]*(api|json|job|vacanc|position|recruit|requisition|graphql)') AND NOT regexp_matches(u, '[.](js|svg)([?]|$)') OR regexp_matches(u, '[?].*api') AND NOT regexp_matches(u, '[.](js|svg)[?]') AS structured"
    " FROM (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN '/data/list?api=1' WHEN 1 THEN '/api/jobs.js' WHEN 2 THEN '/v1/vacancies' WHEN 3 THEN '/news' WHEN 4 THEN '/icons/job.svg?v=2' ELSE '/x/graphql' END AS u FROM part)"
)
def structured_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which addresses may be of JSON."""
    path = F.expr("CASE p_partkey % 6 WHEN 0 THEN '/data/list?api=1' WHEN 1 THEN '/api/jobs.js' WHEN 2 THEN '/v1/vacancies' WHEN 3 THEN '/news' WHEN 4 THEN '/icons/job.svg?v=2' ELSE '/x/graphql' END")
    return lens.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("page_id"), discovery.looks_structured(F.concat(F.lit("https://careers.x.example"), path)).alias("structured"))


@query(
    "SELECT p_partkey, concat('Parks Officer ', p_partkey) AS title, CASE WHEN p_partkey % 4 = 1 THEN CAST(1 + p_partkey % 8 AS INT) END AS band, CASE WHEN p_partkey % 3 = 0 THEN (40000 + p_partkey % 1000)::double WHEN p_partkey % 5 = 0 THEN 51000::double END AS advertised_salary_min,"
    " CASE WHEN p_partkey % 4 = 1 THEN 'explicit_band' WHEN p_partkey % 3 = 0 THEN 'salary_only' WHEN p_partkey % 4 = 2 THEN 'description_only' ELSE 'unclassified' END AS classification_status, CASE WHEN p_partkey % 2 = 0 THEN '2026-06-14' END AS closing_date,"
    " CASE WHEN p_partkey % 4 IN (1, 2) THEN 'excerpt' ELSE 'missing' END AS description_status FROM part WHERE p_partkey % 7 <> 0"
)
def seed_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of an imported snapshot as candidates, those with a title and an address."""
    rows = lens.table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "CAST(p_partkey AS STRING) AS source_id", "CASE WHEN p_partkey % 2 = 0 THEN concat('Parks Officer ', p_partkey) ELSE '' END AS job_title", "concat('Parks  Officer ', p_partkey) AS title", "CASE WHEN p_partkey % 7 <> 0 THEN 'https://c.example/1' END AS job_url",
        "CASE WHEN p_partkey % 3 = 0 THEN concat('$', 40000 + p_partkey % 1000, ' per annum') END AS advertised_salary_text", "CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 5 = 0 THEN 51000D END AS advertised_salary_min",
        "CASE p_partkey % 4 WHEN 1 THEN concat('A band ', 1 + p_partkey % 8, ' role') WHEN 2 THEN 'Some words' END AS description_text", "CASE WHEN p_partkey % 2 = 0 THEN 'Applications close 14 June 2026' END AS closing_at_text",
    )
    return seeds.candidates(rows).select(F.col("source_id").cast("long").alias("p_partkey"), "title", "band", "advertised_salary_min", "classification_status", "closing_date", "description_status")


@query(
    "WITH l AS (SELECT p_partkey, p_partkey % 3 AS s, row_number() OVER (PARTITION BY p_partkey % 3 ORDER BY p_partkey) AS nth FROM part)"
    " SELECT concat('s', s) AS source_id, concat('https://s', s, '.example/jobs/', p_partkey) AS url, CASE WHEN nth <= 40 THEN concat('Civil Engineer ', p_partkey) ELSE 'Officer role' END AS title, CASE WHEN nth <= 40 THEN CAST(1 + p_partkey % 8 AS INT) END AS band,"
    " CASE WHEN nth <= 40 THEN 'explicit_band' ELSE 'parse_warning' END AS classification_status FROM l WHERE nth <= 60"
)
def pulse_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boards that give a page in the place of data: details of the first links, warnings for the next."""
    part = lens.table(spark, sf_dir, "part").withColumn("s", F.col("p_partkey") % 3)
    site = F.concat(F.lit("https://s"), F.col("s").cast("string"), F.lit(".example"))
    link = F.concat(F.lit('<a href="/jobs/'), F.col("p_partkey").cast("string"), F.lit('">Officer role</a>'))
    listed = part.groupBy("s").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", link.alias("a")))), lambda x: x["a"]), "").alias("body"))
    payloads = listed.select(F.concat(F.lit("s"), F.col("s").cast("string")).alias("source_id"), F.concat(site, F.lit("/Pulse/jobs")).alias("url"), F.lit("pulse").alias("platform"), "body")
    pages = part.select(F.concat(site, F.lit("/jobs/"), F.col("p_partkey").cast("string")).alias("url"), F.expr(FEED_DETAIL).alias("html"))
    return adapters.any_platform(payloads, pages).select("source_id", "url", "title", "band", "classification_status")
