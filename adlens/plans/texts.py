"""Queries over free text, addresses, pages and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.functions import band, dates, details, money, salary, text, titles, urls
from adlens.operators import board, explore, gates, report
from adlens.operators.staging import spread, written
from adlens.plans import lens, listings
from adlens.plans.registry import query
from adlens.sources import adapters, discovery, files

#: An advertisement's text with known band, pay and date, in either dialect.
AD = "concat('Band ', CAST(p_size % 10 AS VARCHAR(9)), ' salary $', CAST(40000 + (p_partkey * 37) % 60000 AS VARCHAR(9)), ' - $', CAST(40000 + (p_partkey * 37) % 60000 + p_size * 100 AS VARCHAR(9)), ' per annum. Applications close ', CAST(1 + p_partkey % 35 AS VARCHAR(9)), ' June 2026')"


def _ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(lens.table(spark, sf_dir, "part")).selectExpr("p_partkey", f"{AD} AS ad", "p_name")


@query("SELECT p_partkey, CASE WHEN p_size % 10 BETWEEN 1 AND 8 THEN CAST(p_size % 10 AS INT) END AS band FROM part")
def band_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands from advertisements."""
    return _ads(spark, sf_dir).select("p_partkey", band.extract(F.col("ad")).alias("band"))


@query("SELECT p_partkey, (40000 + (p_partkey * 37) % 60000)::double AS minimum, (40000 + (p_partkey * 37) % 60000 + p_size * 100)::double AS maximum, 'year' AS period FROM part")
def salary_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pay from advertisements."""
    s = salary.extract(F.col("ad"))
    return _ads(spark, sf_dir).select("p_partkey", s.alias("s")).select("p_partkey", "s.minimum", "s.maximum", "s.period")


@query(
    "SELECT p_partkey, (40000 + (p_partkey * 37) % 60000)::double AS minimum, CASE WHEN p_partkey % 4 = 0 THEN (40000 + (p_partkey * 37) % 60000 + p_size * 100)::double ELSE (40000 + (p_partkey * 37) % 60000)::double END AS maximum, 'year' AS period FROM part"
)
def salary_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored pay, some of it missing, checked against the text."""
    low = (F.lit(40000) + (F.col("p_partkey") * 37) % 60000).cast("double")
    n = salary.normalised(F.col("ad"), F.when(F.col("p_partkey") % 4 != 0, low), F.when(F.col("p_partkey") % 4 != 0, low), F.lit("hour"))
    return _ads(spark, sf_dir).select("p_partkey", n.alias("n")).select("p_partkey", "n.minimum", "n.maximum", "n.period")


@query("SELECT p_partkey, CASE WHEN p_partkey % 35 < 30 THEN concat('2026-06-', lpad(CAST(1 + p_partkey % 35 AS VARCHAR), 2, '0')) END AS closing FROM part")
def closing_date_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closing dates from advertisements; there is no 31 June."""
    return _ads(spark, sf_dir).select("p_partkey", dates.closing_date(F.col("ad")).cast("string").alias("closing"))


@query("SELECT p_partkey, concat('Senior ', p_name, ' Officer') AS title FROM part")
def title_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles without pay, months and the council's name."""
    raw = F.concat(F.lit("Search jobs Senior "), F.col("p_name"), F.lit(" Officer Yarra "), F.lit("March 2026"))
    return _ads(spark, sf_dir).select("p_partkey", titles.clean(raw, F.lit("YARRA")).alias("title"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'Project and Crew Leader' ELSE '' END AS title FROM part")
def title_from_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles that addresses spell."""
    url = F.concat(F.lit("https://x.example/jobs/"), F.when(F.col("p_partkey") % 2 == 0, "project-and-crew-leader-victoria-").otherwise("blue-sky-"), F.lit("0a1b2c3d4e/"))
    return _ads(spark, sf_dir).select("p_partkey", titles.from_url(url).alias("title"))


@query(
    r"SELECT page_id, concat(regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '^(https?://[^/]+)$', '\1/'), CASE WHEN regexp_extract(url, '\?([^#]*)', 1) IN ('') OR regexp_extract(url, '\?([^#]*)', 1) LIKE 'utm_%' THEN '' ELSE concat('?', regexp_extract(url, '\?([^#]*)', 1)) END) AS canonical FROM pages"
)
def canonical_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses without fragments, final slashes and tracking."""
    return lens.table(spark, sf_dir, "pages").select("page_id", urls.canonical(F.col("url")).alias("canonical"))


@query(r"SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', ''), '^https?://(www\.)?', '') AS path, split_part(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^https?://(www\.)?', ''), '/', 1) AS host FROM pages")
def url_host_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts and paths for comparison."""
    return lens.table(spark, sf_dir, "pages").select("page_id", urls.path_key(F.col("url")).alias("path"), urls.host(F.col("url")).alias("host"))


@query(r"SELECT doc_id, CASE WHEN length(t) <= 300 THEN t ELSE concat(regexp_replace(regexp_replace(substr(t, 1, 300), ' [^ ]*$', ''), '[ ,.;:]+$', ''), '...') END AS excerpt FROM (SELECT doc_id, trim(regexp_replace(regexp_replace(text, '\?{3,}', ' ', 'g'), '\s+', ' ', 'g')) AS t FROM documents)")
def text_excerpt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 300 characters of texts, cut between words."""
    return lens.table(spark, sf_dir, "documents").select("doc_id", text.excerpt(F.col("text"), 300).alias("excerpt"))


@query("SELECT p_partkey, trim(regexp_replace(upper(concat(p_name, ' & ', p_brand)).replace('&', ' AND '), '[^A-Z0-9]+', ' ', 'g')) AS k FROM part")
def normalise_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as keys."""
    return lens.table(spark, sf_dir, "part").select("p_partkey", text.key(F.concat_ws(" & ", "p_name", "p_brand")).alias("k"))


@query(
    "WITH w AS (SELECT p_partkey, list_distinct(string_split(concat(p_name, ' officer'), ' ')) AS a, list_distinct(string_split(concat('the blue ', split_part(p_name, ' ', 2), ' officer may'), ' ')) AS b0 FROM part), v AS (SELECT p_partkey, a, list_filter(b0, lambda x: x NOT IN ('the', 'may')) AS b FROM w)"
    " SELECT p_partkey, 5 * len(list_intersect(a, b)) >= 4 * least(len(a), len(b)) AS same FROM v"
)
def title_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether two titles mean the same listing."""
    a, b = F.concat(F.col("p_name"), F.lit(" Officer")), F.concat(F.lit("The Blue "), F.element_at(F.split("p_name", " "), 2), F.lit(" Officer May"))
    return lens.table(spark, sf_dir, "part").select("p_partkey", text.alike(text.title_words(a), text.title_words(b)).alias("same"))


@query(r"SELECT page_id, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"[^\"]*\">[^<]*</a>')) AS a FROM pages) GROUP BY 1")
def link_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many anchors pages have."""
    return files.links(lens.table(spark, sf_dir, "pages")).groupBy("page_id").agg(F.count("*").alias("n"))


#: Pages with anchors of all sorts, one a part, in either dialect.
ANCHORS = """concat('<p><a href="/jobs/', CAST(p_partkey AS VARCHAR(9)), '#top">', CASE p_partkey % 3 WHEN 0 THEN 'Parks <b>Officer</b>' WHEN 1 THEN 'Privacy Policy' ELSE 'Depot' END,
 '</a><a href="mailto:a@b">Mail officer</a><a href="../about">About us</a><a href="/jobs/x/../', CAST(p_partkey AS VARCHAR(9)), '">Again officer</a><a href="https://www.facebook.com/jobs">Jobs page</a>')"""
#: Pages that name addresses of data.
HINTS = """concat('<link rel="alternate" type="application/rss+xml" href="/jobs/feed', CAST(p_partkey AS VARCHAR(9)), '.xml"><img src="/jobs/a.png"><script>fetch("/api/jobs?x=', CAST(p_partkey AS VARCHAR(9)),
 '"); var s = "https://other.example/api/jobs", t = "/jobs/style.css";</script><script src="/api/jobs.js"></script><form action="search/positions"></form>')"""
#: Listing pages of fifty sources, each with all of its parts' listings, and those listings' pages.
ROLES = "CASE p_partkey % 4 WHEN 0 THEN 'Parks Officer' WHEN 1 THEN 'Civil Engineer' WHEN 2 THEN 'Nurse Manager' ELSE 'Project Coordinator' END"
DETAIL = f"""concat('<html><body><h1>', {ROLES}, '</h1><div class="salary">$', CAST(40000 + (p_partkey * 37) % 60000 AS VARCHAR(9)), ' per annum</div><article>Band ', CAST(1 + p_partkey % 8 AS VARCHAR(9)), ' role of the shire. This permanent position is based in town.</article></body></html>')"""


def _part_pages(spark: SparkSession, sf_dir: str, html: str) -> DataFrame:
    return spread(lens.table(spark, sf_dir, "part")).selectExpr("p_partkey AS page_id", "'https://c.example/list/all?page=1' AS url", f"{html} AS html")


@query("SELECT p_partkey AS page_id, CAST(CASE WHEN p_partkey % 3 = 1 THEN 3 ELSE 0 END AS INT) AS pos, CASE p_partkey % 3 WHEN 0 THEN 'Parks Officer' WHEN 1 THEN 'Again officer' ELSE 'Depot' END AS title, concat('https://c.example/jobs/', p_partkey) AS link FROM part")
def job_link_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links that may lead to listings."""
    return files.job_links(files.links(_part_pages(spark, sf_dir, ANCHORS)))


@query(
    "WITH h AS (SELECT p_partkey AS page_id, k.kind, replace(k.url, '{}', CAST(p_partkey AS VARCHAR)) AS url, replace(k.said, '{}', CAST(p_partkey AS VARCHAR)) AS said FROM part, (VALUES ('feed_or_link', 'https://c.example/jobs/feed{}.xml', 'alternate application/rss+xml'),"
    " ('form_action', 'https://c.example/list/search/positions', ''), ('inline_script', 'https://c.example/api/jobs?x={}', '\"/api/jobs?x={}\"')) k(kind, url, said))"
    " SELECT page_id, kind, url, substr(sha256(concat(kind, chr(31), url, chr(31), said)), 1, 16) AS id FROM h"
)
def endpoint_hints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of data that pages name."""
    return discovery.hints(_part_pages(spark, sf_dir, HINTS)).select("page_id", "kind", "url", "id")


def _listing_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    part = spread(lens.table(spark, sf_dir, "part")).withColumn("s", F.col("p_partkey") % 50)
    anchor = F.expr(f"concat('<li><a href=\"/jobs/', p_partkey, '\">', {ROLES}, '</a>')")
    listed = part.groupBy("s").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", anchor.alias("a")))), lambda x: x["a"]), "").alias("html"))
    site = F.concat(F.lit("https://s"), F.col("s").cast("string"), F.lit(".example"))
    listings = listed.select(F.concat(F.lit("s"), F.col("s").cast("string")).alias("source_id"), F.concat(site, F.lit("/careers")).alias("url"), "html")
    pages = part.select(F.concat(site, F.lit("/jobs/"), F.col("p_partkey").cast("string"), F.lit("/?utm_source=x")).alias("url"), F.expr(DETAIL).alias("html"), F.when(F.col("p_partkey") % 9 == 0, 403).otherwise(200).alias("status"))
    return listings, pages


@query(
    f"WITH r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey % 50 ORDER BY p_partkey) AS nth FROM part) SELECT concat('s', p_partkey % 50) AS source_id, concat('https://s', p_partkey % 50, '.example/jobs/', p_partkey) AS url, {ROLES} AS title, CAST(1 + p_partkey % 8 AS INT) AS band,"
    " (40000 + (p_partkey * 37) % 60000)::double AS advertised_salary_min, 'year' AS advertised_salary_period, 'explicit_band' AS classification_status FROM r WHERE nth <= 40 AND p_partkey % 9 <> 0"
)
def crawl_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages followed to the pages of their listings, and these read."""
    got = adapters.crawled(*_listing_pages(spark, sf_dir))
    return got.select("source_id", "url", "title", "band", "advertised_salary_min", "advertised_salary_period", "classification_status")


@query(
    "WITH s AS (SELECT * FROM (SELECT p_partkey, p_brand, unnest(range(0, p_partkey % 4 + 1)) AS i FROM part) WHERE i < 3)"
    " SELECT p_partkey AS source_id, CAST(i AS INT) AS pos, CASE i WHEN 0 THEN 'Parks Officer' WHEN 1 THEN 'Civil Engineer' ELSE 'Nurse Manager' END AS title, CASE i WHEN 1 THEN 'https://c.example/jobs/1' ELSE 'https://c.example/api/jobs' END AS url,"
    " CASE i WHEN 0 THEN CAST(1 + p_partkey % 8 AS INT) END AS band, CASE i WHEN 1 THEN (40000 + p_partkey % 1000)::double END AS advertised_salary_min, CASE i WHEN 2 THEN '2026-05-03' END AS closing_date FROM s"
)
def endpoint_json_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings in JSON of any shape, at any depth."""
    inner = [
        """concat('{"JobTitle": "Parks Officer", "details": {"classification": "Band ', 1 + p_partkey % 8, '", "live": true}, "Location": "Town"}')""",
        """concat('{"name": "Civil Engineer", "Link": "/jobs/1", "pay": ["$', 40000 + p_partkey % 1000, ' per annum"]}')""",
        """'{"Title": "Nurse Manager", "closingDate": "Applications close 3 May 2026", "description": "Care"}'""",
        """'{"title": "Nothing besides a title"}'""",
    ]
    items = "array_join(slice(array(" + ", ".join(inner) + "), 1, cast(p_partkey % 4 + 1 as int)), ', ')"
    payloads = spread(lens.table(spark, sf_dir, "part")).selectExpr("p_partkey AS source_id", "'https://c.example/api/jobs' AS url", f"""concat('{{"meta": {{"name": 3}}, "result": [[], {{"rows": [', {items}, ']}}]}}') AS body""")
    return adapters.endpoint_candidates(payloads).select("source_id", "pos", "title", "url", "band", "advertised_salary_min", "closing_date")


@query("SELECT p_partkey AS job_id FROM part WHERE p_partkey % 400 <= 200 AND p_partkey % 3 <> 0 OR p_partkey % 7 = 0")
def band_pay_coupling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advertisements whose text puts pay within reach of the band's name."""
    from adlens.operators import report

    k = F.col("p_partkey")
    far = F.expr("repeat('.', cast(p_partkey % 400 + if(p_partkey % 400 > 200, 40, 0) as int))")  # no window ends within the pay
    after = F.concat(F.lit("A role at band "), F.when(k % 3 == 0, 5).otherwise(4).cast("string"), far, F.lit(" $91,000 per annum"))
    before = F.when(k % 7 == 0, "Pay is $91,000 per annum. See Band 4b.").otherwise("Band 4, band 14 and husband 4, whose pay is not told")
    rows = spread(lens.table(spark, sf_dir, "part")).select(k.alias("job_id"), F.lit(4).alias("band"), F.array(after, before).alias("texts"))
    return report.coupled(rows)


@query(None)
def page_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages read as detail pages of their hosts, as rows of the log."""
    pages = spread(lens.table(spark, sf_dir, "pages")).select(urls.host(F.col("url")).alias("source_id"), "url", "html")
    sources = pages.select("source_id", F.lit("generic").alias("platform"), F.col("source_id").alias("council_name"), F.col("source_id").alias("short_name"), F.lit("").alias("source_url")).distinct()
    return adapters.observations(adapters.details(pages), sources, "r1", "2026-01-01T00:00:00Z")


@query("SELECT event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS k, count(*) AS n FROM events GROUP BY 1, 2")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values out of nested JSON."""
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return lens.table(spark, sf_dir, "events").select("event_type", (k % 10).alias("k")).groupBy("event_type", "k").agg(F.count("*").alias("n"))


@query("SELECT user_id, arg_max(event_type, ts) AS event_type, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_ts, count(*) AS n FROM events GROUP BY 1")
def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest event of each user, with first, last and count."""
    return lens.table(spark, sf_dir, "events").groupBy("user_id").agg(F.max_by("event_type", "ts").alias("event_type"), F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss").alias("first_ts"), F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("last_ts"), F.count("*").alias("n"))


@query("SELECT p_partkey, list_aggregate(list_filter([CASE WHEN p_size % 2 = 0 THEN 'json_ld' END, CASE WHEN p_size % 3 = 0 THEN 'own' WHEN TRUE THEN 'json_ld' END], lambda x: x IS NOT NULL), 'string_agg', ',') AS e FROM part")
def evidence_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence that rows have, filled in where it is missing."""
    own = F.when(F.col("p_size") % 3 == 0, F.create_map(F.lit("title"), F.lit("own"))).otherwise(F.create_map().cast("map<string,string>"))
    none = F.lit(None).cast("string")
    rows = lens.table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_name").alias("job_title"), F.lit("json_ld").alias("source_strategy"), F.lit("generic").alias("source_family"), none.alias("description_status"), F.when(F.col("p_size") % 2 == 0, 4).alias("standard_band_number"), none.alias("classification_band"),
        none.alias("advertised_salary_text"), F.lit(None).cast("double").alias("advertised_salary_min"), F.lit(None).cast("double").alias("advertised_salary_max"), none.alias("closing_at"), none.alias("closing_at_text"), none.alias("description_text"), own.alias("field_evidence"),
    )
    e = board.with_evidence(rows)
    return e.select("p_partkey", F.concat_ws(",", F.try_element_at("field_evidence", F.lit("band")), F.try_element_at("field_evidence", F.lit("title"))).alias("e"))


def _jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings in their latest state, as the board takes them."""
    none = F.lit(None).cast("string")
    s = listings.snapshot(spark, sf_dir, "title", "council_key", "source_id", "run_id", "classification_status", "band", "salary_lo", "salary_hi")
    return s.select(
        "job_id", F.concat(F.lit("Officer "), F.col("title")).alias("title"), F.concat(F.lit("https://jobs.example/"), F.col("job_id").cast("string")).alias("url"), "council_key", F.lit("generic").alias("source_platform"), F.col("source_id").cast("string").alias("source_id"), none.alias("source_strategy"),
        F.when(F.col("run_id") >= "199801", "seen_latest_run").otherwise("not_seen_latest_run").alias("observed_status"), "classification_status", F.when(F.col("band").between(1, 8), F.col("band")).alias("band"),
        F.when(F.col("band") == 9, none).otherwise(F.concat(F.lit("$"), F.col("salary_lo").cast("string"), F.lit(" - $"), F.col("salary_hi").cast("string"), F.lit(" per annum"))).alias("advertised_salary_text"),
        F.when(F.col("band") != 9, F.col("salary_lo").cast("double")).alias("advertised_salary_min"), F.when(F.col("band") != 9, F.col("salary_hi").cast("double")).alias("advertised_salary_max"), F.when(F.col("band") != 9, "year").alias("advertised_salary_period"),
        none.alias("location_text"), none.alias("work_type"), none.alias("closing_date"), none.alias("closing_text"), none.alias("description_excerpt"), none.alias("description_status"), "observed_at", "first_seen_at", "last_seen_at", "run_id", "sighting_count",
        F.create_map().cast("map<string,string>").alias("field_evidence"), F.lit(False).alias("conflict"), F.col("job_id").alias("seq"),
    )


@query(listings.LATEST + "SELECT job_id AS job_uid, CASE WHEN band BETWEEN 1 AND 8 THEN 'explicit_band' WHEN classification_status = '' THEN 'unclassified' ELSE classification_status END AS classification_status FROM snap WHERE band <> 9")
def board_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings that may be published, with their status."""
    return board.board_rows(_jobs(spark, sf_dir)).where(gates.is_listing()).select("job_uid", "classification_status")


@query(None)
def board_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The board: rows, gate, duplicates."""
    return board.build(_jobs(spark, sf_dir)).drop("field_evidence")


def _contradicted(samples: str, name: str) -> str:
    """A CTE with the job_ids of samples (job_id, council_key, band, low, high) whose pay lies with the peers of another band, and not with those of their own."""
    shared = "greatest(0.0::double, least(high, p_high) - greatest(low, p_low))"
    return (
        f", {name}0 AS (SELECT j.job_id, j.band, j.low, j.high, s.band AS b, min(s.low) AS p_low, max(s.high) AS p_high FROM {samples} j JOIN {samples} s ON s.council_key = j.council_key AND s.job_id <> j.job_id GROUP BY ALL),"
        f" {name} AS (SELECT job_id FROM {name}0 GROUP BY 1 HAVING coalesce(bool_or(b = band AND {shared} <= 0), false) AND coalesce(bool_or(b <> band AND ({shared} / greatest(1.0::double, high - low) >= 0.5 OR (low + high) / 2 BETWEEN p_low AND p_high)), false))"
    )


#: Listings whose titles tell them apart; a third say in their texts what their band pays.
_REPORT = (
    listings.LATEST + ", s1 AS (SELECT job_id, council_key, CAST(band AS INT) AS band, CAST(salary_lo AS DOUBLE) AS low, CAST(salary_hi AS DOUBLE) AS high FROM snap WHERE band BETWEEN 1 AND 8)" + _contradicted("s1", "k1")
    + ", r AS (SELECT snap.job_id, CASE WHEN clash THEN NULL WHEN band BETWEEN 1 AND 8 THEN CAST(band AS INT) END AS band, CASE WHEN clash THEN 'salary_band_conflict' WHEN band BETWEEN 1 AND 8 THEN 'explicit_band' WHEN classification_status = '' THEN 'unclassified' ELSE classification_status END AS classification_status"
    " FROM (SELECT *, job_id IN (SELECT job_id FROM k1) AND job_id % 3 <> 0 AS clash FROM snap) snap WHERE band <> 9)"
)


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = _jobs(spark, sf_dir).drop("conflict")
    told = F.when(F.col("job_id") % 3 == 0, F.concat(F.lit("A band "), F.col("band").cast("string"), F.lit(" role at "), F.col("advertised_salary_text")))
    # written once: conflicts, rows and the report each read it
    return report.normalised(written(jobs.withColumns({"title": F.concat("title", F.lit(" "), F.col("job_id").cast("string")), "description_excerpt": told})))


@query(_REPORT + " SELECT job_id, band, classification_status FROM r")
def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a snapshot: listings that may be published, those that their peers contradict without a band."""
    return _report(spark, sf_dir).select("job_id", "band", "classification_status")


@query(
    _REPORT + ", s2 AS (SELECT s1.* FROM s1 JOIN r USING (job_id) WHERE r.band IS NOT NULL)" + _contradicted("s2", "k2")
    + ", f AS (SELECT *, classification_status = 'salary_band_conflict' OR (job_id IN (SELECT job_id FROM k2) AND job_id % 3 <> 0) AS clash FROM r)"
    " SELECT job_id AS job_uid, CASE WHEN NOT clash THEN band END AS standard_band_number, CASE WHEN clash THEN 'salary_band_conflict' ELSE classification_status END AS classification_status FROM f"
)
def board_of_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The board of the report: judged again among what is left, conflicts staying."""
    rows = written(_report(spark, sf_dir))
    return board.build(report.with_conflict(rows)).select("job_uid", "standard_band_number", "classification_status")


@query(listings.LATEST + ", b AS (SELECT * FROM snap WHERE band <> 9) SELECT count(*) AS report_jobs, count(*) AS salary_signal_jobs, 0::BIGINT AS description_jobs, count(DISTINCT council_key) AS covered_councils, (SELECT count(*) FROM supplier) AS configured_sources, CAST(round_even(100.0 * count(DISTINCT council_key) / (SELECT count(*) FROM supplier), 0) AS BIGINT) AS coverage_rate FROM b")
def board_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is published, and how many councils it covers."""
    rows = board.board_rows(_jobs(spark, sf_dir)).where(gates.is_listing())
    return board.board_summary(rows, lens.table(spark, sf_dir, "supplier"))


@query(listings.LATEST + "SELECT 0::BIGINT AS compensation_rows, 0::BIGINT AS quality_rows, 0::BIGINT AS evidence_rows, (SELECT count(*) FROM (SELECT council_key, run_id FROM snap WHERE band <> 9 GROUP BY 1, 2 HAVING count(*) > 50)) AS outlier_rows")
def board_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows of the gated board fail each check."""
    return gates.violations(board.board_rows(_jobs(spark, sf_dir)).where(gates.is_listing())).select("compensation_rows", "quality_rows", "evidence_rows", "outlier_rows")


@query(listings.LATEST + "SELECT job_id, greatest(1.5::double, least(98.5::double, 100 * (salary_lo - 40000) / 60000.0::double)) AS x FROM snap WHERE salary_hi >= 30000")
def salary_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where listings stand on the chart of pay."""
    r = money.annual_range(F.col("salary_lo").cast("double"), F.col("salary_hi").cast("double"), F.col("period"))
    return listings.snapshot(spark, sf_dir, "salary_lo", "salary_hi", "period").select("job_id", r.alias("r")).where("r is not null").select("job_id", money.clamp(F.lit(100) * (F.col("r.low") - 40000) / 60000.0, 1.5, 98.5).alias("x"))


@query("SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1, 2")
def stream_day_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by day and type, counted by a stream over the table until it is read."""
    from adlens.streaming import log

    return log.counted_to_end(spark, f"{sf_dir}/events.parquet").withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(
    "SELECT p_partkey, CAST(pos AS INT) AS pos, CASE pos WHEN 0 THEN 'About The Role' ELSE 'How To Apply' END AS heading, CASE pos WHEN 0 THEN p_name ELSE concat(': ', p_brand) END AS body FROM part, (SELECT unnest([0, 1]) AS pos)"
)
def section_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of descriptions; one without text is none."""
    said = F.concat(F.lit("First ABOUT THE ROLE "), F.col("p_name"), F.lit("  how to apply: "), F.col("p_brand"), F.lit(" Selection Criteria"))
    return lens.table(spark, sf_dir, "part").select("p_partkey", F.posexplode(details.sections(said)).alias("pos", "s")).select("p_partkey", "pos", "s.heading", F.col("s.text").alias("body"))


@query(
    "WITH b AS (SELECT p_partkey, p_name AS t, concat(repeat('x', 1 + CAST(p_partkey % 900 AS INT)), ' ', upper(p_name), ' ', repeat('y', CAST(p_partkey % 3000 AS INT) + 1)) AS body FROM part), w AS (SELECT *, instr(lower(body), lower(t)) AS i FROM b)"
    " SELECT p_partkey, substr(body, greatest(i - 466, 1), i - greatest(i - 466, 1) + length(t) + 1400) AS around FROM w"
)
def body_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stands around titles."""
    body = F.expr("concat(repeat('x', 1 + CAST(p_partkey % 900 AS INT)), ' ', upper(p_name), ' ', repeat('y', CAST(p_partkey % 3000 AS INT) + 1))")
    return lens.table(spark, sf_dir, "part").select("p_partkey", details.window(F.col("p_name"), body).alias("around"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'Parks and Trees Officer' WHEN 1 THEN 'Civil Engineer' WHEN 2 THEN 'Nurse Manager' ELSE '' END AS title FROM part")
def title_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles with which texts begin."""
    k = F.col("p_partkey") % 4
    said = F.when(k == 0, "Page 1 POSITION DESCRIPTION PARKS AND TREES OFFICER Created 1/2/2026 by").when(k == 1, "New to you Civil Engineer Full-time Band 5").when(k == 2, "Nurse Manager | Town Closing on: 3 May").otherwise(F.concat(F.lit("About "), "p_name"))
    return lens.table(spark, sf_dir, "part").select("p_partkey", titles.from_text(said).alias("title"))


@query("SELECT p_partkey, p_partkey % 3 <> 1 AND (p_size % 10 BETWEEN 1 AND 8 OR p_partkey % 2 = 0) AND NOT p_partkey % 7 = 0 AS probable FROM part")
def probable_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether candidates may be listings."""
    none, k = F.lit(None).cast("string"), F.col("p_partkey")
    rows = lens.table(spark, sf_dir, "part").select(
        "p_partkey", F.when(k % 3 == 1, "Privacy Policy").otherwise("Parks Officer").alias("title"), F.when(k % 7 == 0, "https://www.employmenthero.com/about").otherwise("https://jobs.example/1").alias("url"), F.when((F.col("p_size") % 10).between(1, 8), F.col("p_size") % 10).alias("band"),
        none.alias("advertised_salary_text"), F.lit(None).cast("double").alias("advertised_salary_min"), F.lit(None).cast("double").alias("advertised_salary_max"), F.lit("").alias("closing_date"), none.alias("closing_text"),
        F.when(k % 2 == 0, "A permanent position.").alias("description_excerpt"), none.alias("work_type"), none.alias("location_text"),
    )
    return rows.select("p_partkey", gates.is_probable().alias("probable"))


@query(
    listings.LATEST + ", r AS (SELECT council_key, min(salary_lo) AS a, max(salary_hi) AS b FROM snap GROUP BY 1) SELECT council_key, CAST(floor(a / 10000.0) * 10000 AS BIGINT) AS low, CAST(greatest(ceil(b / 10000.0) * 10000, floor(a / 10000.0) * 10000 + 20000) AS BIGINT) AS high,"
    " concat('$', CAST(CAST(round(a / 1000.0) AS BIGINT) AS VARCHAR), 'k') AS label FROM r"
)
def salary_axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ends of the axis of pay for each council."""
    ends = listings.snapshot(spark, sf_dir, "council_key", "salary_lo", "salary_hi").groupBy("council_key").agg(F.min("salary_lo").alias("a"), F.max("salary_hi").alias("b"))
    return ends.select("council_key", explore.axis(F.col("a"), F.col("b")).alias("x"), money.compact_label(F.col("a")).alias("label")).select("council_key", F.col("x.low").cast("long").alias("low"), F.col("x.high").cast("long").alias("high"), "label")


@query("SELECT p_partkey, round(list_reduce(list_concat([2166136261::BIGINT], list_transform(string_split(p_name, ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda h, x: xor(h, x) * 16777619 % 4294967296) / 4294967295.0::double, 9) AS jitter FROM part")
def point_jitter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where names stand within their lane of a chart."""
    return lens.table(spark, sf_dir, "part").select("p_partkey", F.round(text.unit_hash(F.col("p_name")), 9).alias("jitter"))


@query(None)
def page_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Descriptions of pages: how they were found, their hash and how many sections they have."""
    d = details.description(details.parts(F.col("html"))["description"])
    return lens.table(spark, sf_dir, "pages").select("page_id", F.explode(F.array(d)).alias("d")).select("page_id", "d.status", "d.hash", F.length("d.text").cast("long").alias("n_chars"), F.size("d.sections").cast("long").alias("n_sections"))
