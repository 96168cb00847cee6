"""From a snapshot to what is published: listings whose pay contradicts their band, the report, and the board."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions import band, salary, text, urls
from adlens.operators import board, conflict, dedupe, gates, history
from adlens.operators.staging import written

#: How far before and after a band's name pay is looked for, and the texts in which it is.
BEFORE, AFTER = 160, 220
TEXTS = ("advertised_salary_text", "description_excerpt", "description_text")


def identity(url: Column, job_id: Column) -> Column:
    """What tells a listing from its peers: its page with its query, or else its id."""
    return F.coalesce(F.nullif(urls.path_key(url, keep_query=True), F.lit("")), text.compact(job_id))


def paid(jobs: DataFrame) -> DataFrame:
    """Listings with a council, a band and a year's pay: job_id, council_key, band, low, high, identity, and their texts."""
    declared = band.existing(*[F.col(c) for c in ("standard_band_number", "band", "classification_band") if c in jobs.columns])
    year = salary.annual_interval(*[F.col(f"advertised_salary_{c}") for c in ("text", "min", "max", "period")])
    own = F.struct(F.upper(text.compact(F.col("council_key"))).alias("council_key"), declared.alias("band"), year.alias("year"), identity(F.col("url"), F.col("job_id")).alias("identity"))
    rows = jobs.select("job_id", F.explode(F.array(own)).alias("o"), F.array(*[text.compact(F.col(c)) for c in TEXTS if c in jobs.columns]).alias("texts"))
    some = rows.where("o.band is not null and o.year is not null and o.council_key <> ''")
    return some.select("job_id", "o.council_key", "o.band", F.col("o.year.low").alias("low"), F.col("o.year.high").alias("high"), "o.identity", "texts")


def coupled(rows: DataFrame) -> DataFrame:
    """job_id of rows (job_id, band, texts) in one of whose texts pay stands around the name of the band."""
    named = F.concat(F.lit(r"(?i)\bband\s*"), F.col("band").cast("string"), F.lit(r"[a-d]?\b"))
    each = rows.select("job_id", named.alias("pattern"), F.explode("texts").alias("t")).where(F.col("t").rlike(r"(?i)\bband"))
    hits = each.select("job_id", "t", F.split("t", F.col("pattern"), -1).alias("around"), F.regexp_extract_all("t", F.col("pattern"), F.lit(0)).alias("hits")).where("size(hits) > 0")
    spans = F.aggregate(
        F.arrays_zip(F.slice("around", F.lit(1), F.size("hits")).alias("gap"), F.col("hits").alias("hit")),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out")),
        lambda s, x: F.struct(
            (s["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("at"),
            F.concat(s["out"], F.array(F.struct((s["at"] + F.length(x["gap"])).alias("start"), (s["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("end")))).alias("out"),
        ),
        lambda s: s["out"],
    )
    start = F.greatest(F.col("s.start") - BEFORE, F.lit(0))
    windows = hits.select("job_id", "t", F.explode(spans).alias("s")).select("job_id", F.substring(F.col("t"), start + 1, F.col("s.end") + AFTER - start).alias("w"))
    return windows.where(salary.extract(F.col("w")).isNotNull()).select("job_id").distinct()


def with_conflict(jobs: DataFrame) -> DataFrame:
    """Jobs (job_id tells them apart) with `conflict`, judged by peers among these very jobs.

    Only jobs that their peers contradict have their texts searched for pay that goes with the band.
    """
    rows = written(paid(jobs))
    apart = conflict.conflicts(rows.drop("texts").withColumn("coupled", F.lit(False)), rows).where("conflict").select("job_id")
    found = rows.join(apart, "job_id", "left_semi")
    clash = found.select("job_id").join(coupled(found), "job_id", "left_anti").select("job_id", F.lit(True).alias("clash_"))
    return jobs.join(clash, "job_id", "left").withColumn("conflict", F.coalesce("clash_", F.lit(False))).drop("clash_")


def ordered(jobs: DataFrame, *by: Column) -> DataFrame:
    """Jobs with `seq`, numbers that grow in this order: a sort by ranges, numbered within each."""
    return written(jobs.orderBy(*by).withColumn("seq", F.monotonically_increasing_id()))


def normalised(jobs: DataFrame) -> DataFrame:
    """The jobs (with seq) that may be published, without duplicates, their fields as the board has them."""
    rows = board.build(with_conflict(jobs))
    names = {
        "title": "job_title", "url": "job_url", "classification_status": "classification_status", "band": "standard_band_number", "advertised_salary_text": "advertised_salary_text", "advertised_salary_min": "advertised_salary_min",
        "advertised_salary_max": "advertised_salary_max", "advertised_salary_period": "advertised_salary_period", "location_text": "location_text", "work_type": "work_type", "closing_date": "closing_at", "closing_text": "closing_at_text",
        "description_excerpt": "description_text", "description_status": "description_status", "field_evidence": "field_evidence", "source_strategy": "source_strategy",
    }
    new = rows.select(F.col("job_uid").alias("job_id"), *[F.col(v).alias(f"new_{k}") for k, v in names.items()])
    rest = [F.col(c) for c in jobs.columns if c not in names and c != "job_id"]
    return jobs.join(new, "job_id").select("job_id", *rest, *[F.col(f"new_{k}").alias(k) for k in names])


REPORT_ORDER = ("council_key", "title")


@dataclass
class Published:
    """What a rebuild publishes, each a table."""

    all: DataFrame
    current: DataFrame
    report: DataFrame
    board: DataFrame
    summary: DataFrame


def published(observations: DataFrame, failed: DataFrame, sources: DataFrame, *seq: str, previous: DataFrame | None = None, run_id: str | None = None) -> Published:
    """A log's snapshot, the jobs seen in its latest run, the report of all, the board, and a summary.

    Peers are those of the jobs at hand: of the current ones for these, of all for the report, and of the report, whose
    conflicting jobs have lost their band, for the board.
    """
    log = history.log_of(observations, *seq, previous=previous)
    everything = ordered(history.rebuild(observations, failed, *seq, previous=previous, run_id=run_id), F.col("first_order"), F.col("job_id")).drop("first_order")
    current, report = (written(normalised(j)) for j in (everything.where(F.col("observed_status") == history.SEEN), everything))
    by = [F.coalesce(F.col(c), F.lit("")) for c in REPORT_ORDER]
    rows = written(board.build(with_conflict(ordered(report.withColumnRenamed("seq", "place_"), *by, F.col("place_")).drop("place_"))))
    return Published(everything, current, report, rows, history.run_summary(current, report, everything, log, sources))


def validated(rows: DataFrame) -> DataFrame:
    """The board, unless one of its checks fails."""
    gates.validate(rows)
    return rows
