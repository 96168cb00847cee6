"""The public board: rows, their evidence, and what is reported about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlens.functions import band, dates, money, salary, text, titles
from adlens.operators import dedupe, gates
from adlens.operators.staging import written

CONFLICT = "salary_band_conflict"


def evidence_source(strategy: Column, platform: Column) -> Column:
    """What kind of page or feed a strategy reads."""
    s, p = F.lower(text.compact(strategy)), F.lower(text.compact(platform))
    return (
        F.when(s.rlike("known_endpoint|discovered_endpoint|endpoint_json"), "endpoint_json")
        .when(s.contains("json_ld"), "json_ld")
        .when(s.rlike("sitemap|feed"), "sitemap_feed")
        .when(s.rlike("pulse|oracle_hcm") | p.isin("pulse", "oracle_hcm"), "endpoint_json")
        .when(s.rlike("^(historical:)?platform:") | (p != ""), "detail_html")
        .otherwise("deterministic_rule")
    )


def strategy_label(strategy: Column, platform: Column) -> Column:
    s, p = text.compact(strategy), text.compact(platform)
    return F.when(s != "", s).when(p != "", F.concat(F.lit("historical:platform:"), p)).otherwise("historical:deterministic_rule")


def with_evidence(rows: DataFrame) -> DataFrame:
    """rows with field_evidence: what is there stays; other fields that a row has get their source."""
    base = evidence_source(F.col("source_strategy"), F.col("source_family"))
    document = F.when(text.compact(F.col("description_status")) == "document", "pdf_or_docx").otherwise(base)
    banded = F.col("standard_band_number").isNotNull() | F.lower(text.compact(F.col("classification_band"))).startswith("band ")
    own = F.coalesce(F.map_filter("field_evidence", lambda k, v: (k != "") & (v != "")), F.create_map().cast("map<string,string>"))
    parts = {
        "title": (gates.filled(F.col("job_title")), base),
        "salary": (gates.has_salary(), document),
        "band": (banded, document),
        "closing_date": (gates.filled(F.col("closing_at"), F.col("closing_at_text")), document),
        "description": (gates.filled(F.col("description_text"), F.col("description_status")), document),
        "strategy": (F.lit(True), text.compact(F.col("source_strategy"))),
    }
    entries = F.array_compact(F.array(*[F.when(when & ~F.coalesce(F.map_contains_key(own, F.lit(k)), F.lit(False)), F.struct(F.lit(k).alias("key"), v.alias("value"))) for k, (when, v) in parts.items()]))
    return rows.withColumn("field_evidence", F.map_from_entries(F.concat(F.map_entries(own), entries)))


def board_rows(jobs: DataFrame) -> DataFrame:
    """Jobs in the shape of the board. jobs have `conflict` from operators.conflict, or a stored conflict status."""
    s = salary.normalised(F.when(F.length(text.compact(F.col("advertised_salary_text"))) > 360, money.range_label(F.col("advertised_salary_min"), F.col("advertised_salary_max"), F.col("advertised_salary_period"))).otherwise(text.excerpt(F.col("advertised_salary_text"), 300)), F.col("advertised_salary_min"), F.col("advertised_salary_max"), F.col("advertised_salary_period"))
    clash = F.col("conflict") | (F.col("classification_status") == CONFLICT)
    number = F.when(~clash, F.coalesce(band.parse(F.col("band")), band.extract(F.col("title"), F.col("classification_status"), F.col("advertised_salary_text"), F.col("description_excerpt"))))
    title = titles.clean(F.col("title"), F.col("council_key"))
    spelt = titles.from_url(F.col("url"), F.col("council_key"))
    title = text.once(title, lambda t: F.when(F.lower(t).isin(*titles.JUNK) | titles.is_shell(t), F.coalesce(F.nullif(spelt, F.lit("")), t)).otherwise(t))
    # one exploded struct a row: what is costly is worked out there once, and no filter above it repeats it
    worked = F.struct(s.alias("salary_"), number.alias("number_"), title.alias("title_"), clash.alias("clash_"))
    rows = jobs.select("*", F.explode(F.array(worked)).alias("w_")).select("*", "w_.*")
    status = F.when(F.col("clash_"), CONFLICT).otherwise(band.upgraded(F.col("classification_status"), F.col("number_")))
    yearly = F.col("salary_.period") == "year"
    out = rows.select(
        F.col("job_id").alias("job_uid"), text.excerpt(F.col("title_"), 140).alias("job_title"), F.col("url").alias("job_url"), "council_key", F.col("source_platform").alias("source_family"), F.coalesce("source_id", "source_platform").alias("source_name"),
        strategy_label(F.col("source_strategy"), F.col("source_platform")).alias("source_strategy"), F.when(F.col("observed_status") == "seen_latest_run", "current").otherwise("historical").alias("board_status"),
        status.alias("classification_status"), F.when(F.col("number_").isNotNull(), F.concat(F.lit("Band "), F.col("number_").cast("string"))).otherwise(status).alias("classification_band"), F.col("number_").alias("standard_band_number"),
        F.col("salary_.text").alias("advertised_salary_text"), F.col("salary_.minimum").alias("advertised_salary_min"), F.col("salary_.maximum").alias("advertised_salary_max"), F.col("salary_.period").alias("advertised_salary_period"),
        F.when(yearly, F.col("salary_.minimum")).alias("annual_salary_min"), F.when(yearly, F.col("salary_.maximum")).alias("annual_salary_max"), F.when(yearly, "advertised").alias("annual_salary_source"), "location_text", "work_type",
        F.col("closing_date").alias("closing_at"), F.nullif(text.excerpt(F.col("closing_text"), 140), F.lit("")).alias("closing_at_text"), F.nullif(text.excerpt(F.col("description_excerpt"), 300), F.lit("")).alias("description_text"), "description_status",
        F.nullif(F.substring(text.compact(F.col("observed_at")), 1, 7), F.lit("")).alias("canonical_reference_month"), "first_seen_at", "last_seen_at", F.col("run_id").alias("last_seen_run_id"), "sighting_count", "observed_status", "field_evidence", "seq",
    )
    return with_evidence(out)


def build(jobs: DataFrame) -> DataFrame:
    """The board of judged jobs: rows, gate, duplicates."""
    return dedupe.dedupe(written(board_rows(jobs).where(gates.is_listing())), "seq")


def month_counts(board: DataFrame) -> DataFrame:
    return board.select(dates.month_key(F.col("canonical_reference_month")).alias("month")).groupBy("month").agg(F.count("*").alias("n")).orderBy("month")


def board_summary(board: DataFrame, sources: DataFrame) -> DataFrame:
    """One row: listings, those with pay and descriptions, councils, and the share of sources that they cover."""
    n = sources.agg(F.count("*").alias("configured_sources"))
    told = board.select("council_key", gates.has_salary().alias("paid_"), gates.filled(F.col("description_text")).alias("described_"))
    b = told.agg(F.count("*").alias("report_jobs"), F.count_if("paid_").alias("salary_signal_jobs"), F.count_if("described_").alias("description_jobs"), F.countDistinct(F.nullif(F.col("council_key"), F.lit(""))).alias("covered_councils"))
    return b.crossJoin(n).withColumn("coverage_rate", F.coalesce(F.bround(F.try_divide(F.col("covered_councils") * 100.0, F.col("configured_sources"))), F.lit(0.0)).cast("long"))


def councils(sources: DataFrame, metro: tuple[str, ...], *seq: str) -> DataFrame:
    """The first source of each council, by short name."""
    named = F.upper(text.compact(F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("council_key", "short_name", "council_name")])))
    first = Window.partitionBy("spatial_key").orderBy(*seq)
    rows = sources.withColumn("spatial_key", named).where("spatial_key <> ''").withColumn("nth_", F.row_number().over(first)).where("nth_ = 1")
    return rows.withColumn("council_category", F.when(F.col("spatial_key").isin(*metro), "Metropolitan").otherwise("Regional")).drop("nth_").orderBy("short_name")


def rss_items(jobs: DataFrame, most: int = 250) -> DataFrame:
    """The first listings in report order as feed items: id, title with the council's name, address, what is known, and when it was seen."""
    have = lambda c: F.col(c) if c in jobs.columns else F.lit(None)
    some = lambda *cs: F.coalesce(*[F.nullif(have(c).cast("string"), F.lit("")) for c in cs])
    e = lambda c: text.escape(F.coalesce(c, F.lit("")))
    said = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"<p><strong>{name}:</strong> "), value, F.lit("</p>")))
    body = F.concat_ws("", said("Council", F.coalesce(some("council_name"), F.lit(""))), said("Status", F.coalesce(some("classification_status"), F.lit("unclassified"))), said("Band", some("band")), said("Salary", some("advertised_salary_text")), said("Closes", some("closing_text", "closing_date")))
    date = F.date_format(F.to_timestamp(some("observed_at", "last_seen_at")), "EEE, dd MMM yyyy HH:mm:ss Z")
    title = F.concat(e(F.coalesce(some("title"), F.lit("Untitled role"))), F.lit(" - "), e(F.coalesce(some("short_name", "council_name"), F.lit("Council"))))
    item = F.concat(F.lit("<item><guid>"), e(some("job_id", "url")), F.lit("</guid><title>"), title, F.lit("</title><link>"), e(some("url")), F.lit("</link><description><![CDATA["), body, F.lit("]]></description><pubDate>"), F.coalesce(date, F.lit("")), F.lit("</pubDate></item>"))
    order = [F.coalesce("council_key", F.lit("")), F.coalesce("title", F.lit("")), "job_id"]
    return jobs.orderBy(*order).limit(most).select("job_id", item.alias("item"))


def rss(jobs: DataFrame, title: str, link: str, about: str, most: int = 250) -> DataFrame:
    """A whole feed as one row: the channel with the first listings in report order."""
    ordered = rss_items(jobs, most).withColumn("place_", F.monotonically_increasing_id())
    items = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place_", "item"))), lambda x: x["item"]), "\n")
    head = f'<?xml version="1.0" encoding="UTF-8"?>\n<rss version="2.0">\n<channel>\n<title>{title}</title>\n<link>{link}</link>\n<description>{about}</description>\n<language>en</language>\n'
    return ordered.agg(F.concat(F.lit(head), items, F.lit("\n</channel>\n</rss>\n")).alias("xml"))
