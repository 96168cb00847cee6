"""From files of a log to what is published."""

import json

import pytest
from pyspark.sql import functions as F

from adlens import sinks
from adlens.sinks import versions
from adlens.operators import board, history, report
from adlens.sources import files

CLASH = "salary_band_conflict"
TITLES = ["Parks Officer", "Civil Engineer", "Nurse Manager", "Project Coordinator", "Library Officer", "Rates Officer"]


def seen(job, run, council, band, low, high, text=None, title=0, source="s1", day="01", **more):
    pay = text if text is not None else f"${low:,} - ${high:,} per annum"
    return {
        "job_id": job, "run_id": run, "observed_at": f"2026-05-{day}T00:00:00Z", "council_key": council, "council_name": f"{council} & Co", "source_id": source, "source_platform": "generic", "title": TITLES[title], "url": f"https://{council.lower()}.example/jobs/{job}",
        "classification_status": "explicit_band", "band": band, "advertised_salary_text": pay, "advertised_salary_min": low, "advertised_salary_max": high, "advertised_salary_period": "year", "description_excerpt": "A permanent position in town.",
    } | more


@pytest.fixture
def made(spark, tmp_path):
    """A log of two runs with a broken line, an earlier snapshot that overlaps it, sources, and what a rebuild publishes."""
    first = [
        seen("p1", "r1", "YARRA", 4, 60000, 65000), seen("p2", "r1", "YARRA", 4, 61000, 66000, title=1), seen("q1", "r1", "YARRA", 6, 90000, 96000, title=2), seen("q2", "r1", "YARRA", 6, 91000, 97000, title=3),
        seen("a1", "r1", "HUME", 4, 60000, 65000, source="s2"), seen("b1", "r1", "HUME", 6, 90000, 96000, title=2, source="s2"), seen("shell", "r1", "YARRA", None, None, None, text="", classification_status="unclassified"),
    ]
    second = [seen("p1", "r2", "YARRA", 4, 60000, 65000, day="02"), seen("x", "r2", "YARRA", 4, 92000, 95000, title=4, day="02"), seen("y", "r2", "HUME", 4, 92000, 95000, text="Band 4 $92,000 - $95,000 per annum", title=4, source="s2", day="02")]
    log = tmp_path / "log"
    log.mkdir()
    (log / "2026-05-01.jsonl").write_text("\n".join(map(json.dumps, first)) + "\nbroken\n")
    (log / "2026-05-02.jsonl").write_text("\n".join(map(json.dumps, second)))
    old = [seen("old", "r0", "HUME", 5, 70000, 75000, title=5, source="s2", day="01", observed_at="2026-04-01T00:00:00Z"), first[0], {"title": "no id"}]
    (tmp_path / "previous.json").write_text(json.dumps({"jobs": old}))
    (tmp_path / "sources.json").write_text(json.dumps({"sources": [{"source_id": "s1", "council_name": "Yarra", "platform": "generic", "url": "u"}, {"council_name": "Hume", "platform": "generic", "url": "v", "short_name": "Hume"}, {"council_name": "Off", "enabled": False}]}))
    observations, previous = files.observations(spark, str(log)), files.previous_jobs(spark, str(tmp_path / "previous.json"))
    failed = spark.createDataFrame([("s2",)], "source_id string")
    return observations, failed, previous, report.published(observations, failed, files.registry(spark, str(tmp_path / "sources.json")), "seq", previous=previous)


def test_published(spark, tmp_path, made):
    observations, failed, previous, got = made
    jobs = {r["job_id"]: r for r in got.all.collect()}
    assert {k: (r["observed_status"], r["sighting_count"], r["first_seen_at"][:10]) for k, r in jobs.items()} == {
        "old": ("source_unavailable_latest_run", 1, "2026-04-01"), "p1": (history.SEEN, 2, "2026-05-01"), "x": (history.SEEN, 1, "2026-05-02"), "y": (history.SEEN, 1, "2026-05-02"),
        **{k: ("not_seen_latest_run", 1, "2026-05-01") for k in ("p2", "q1", "q2", "shell")}, **{k: ("source_unavailable_latest_run", 1, "2026-05-01") for k in ("a1", "b1")},
    }
    found = {r["job_id"]: (r["band"], r["classification_status"]) for r in got.report.collect()}
    assert found == {"p1": (4, "explicit_band"), "p2": (4, "explicit_band"), "q1": (6, "explicit_band"), "q2": (6, "explicit_band"), "a1": (4, "explicit_band"), "b1": (6, "explicit_band"), "old": (5, "explicit_band"), "x": (None, "salary_band_conflict"), "y": (4, "explicit_band")}
    assert {r["job_id"]: r["band"] for r in got.current.collect()} == {"p1": 4, "x": 4, "y": 4}  # among these alone no peers contradict x
    assert {r["job_uid"]: r["classification_band"] for r in got.board.collect()} == {k: f"Band {b}" if b else s for k, (b, s) in found.items()} | {"y": CLASH}
    s = got.summary.first()
    assert (s["all_jobs"], s["current_jobs"], s["report_jobs"], s["observations"], s["sources_configured"], s["councils_with_report_jobs"], s["councils_with_current_jobs"]) == (10, 3, 9, 11, 2, 2, 2)
    assert s["classification_status_counts"] == {"explicit_band": 8, "salary_band_conflict": 1} and s["current_source_platform_counts"] == {"generic": 3}
    assert report.validated(got.board).count() == 9

    feed = board.rss(got.report, "Jobs", "https://x.example", "All jobs")
    assert sinks.write_published(got, str(tmp_path / "out"), "v1", feed) and not sinks.write_published(got, str(tmp_path / "out"), "v1", feed)
    read = lambda name, schema: versions.current(spark, str(tmp_path / "out"), name, schema, f"{name}.v1")
    assert read("report", "job_id string").count() == 9 and read("board", "job_uid string").count() == 9 and read("summary", "report_jobs long").first()["report_jobs"] == 9
    xml = "\n".join(r["xml"] for r in read("feed", "xml string").collect())
    assert xml.count("<item>") == 9 and "<guid>x</guid><title>Library Officer - YARRA &amp; Co</title>" in xml and xml.rstrip().endswith("</rss>")
    assert xml.index("<guid>a1</guid>") < xml.index("<guid>p1</guid>")


def test_imported_log_stands_alone(spark, made):
    observations, failed, previous, _ = made
    seeded = observations.withColumn("run_id", F.when(F.col("run_id") == "r1", "seed-1").otherwise(F.col("run_id")))
    twice = seeded.unionByName(seeded.withColumn("seq", F.struct(F.col("seq.suffix"), F.lit("zz later").alias("path"), F.col("seq.block"), F.col("seq.row"))))
    jobs = {r["job_id"]: r["sighting_count"] for r in history.rebuild(twice, failed, "seq", previous=previous).collect()}
    assert "old" not in jobs and jobs["p1"] == 4 and jobs["x"] == 2
    assert {r["observed_status"] for r in history.rebuild(observations, failed, "seq", run_id="r1").where("job_id = 'q1'").collect()} == {history.SEEN}


def test_conflict_of_repeated_rows(spark):
    """Rows alike are judged each."""
    from adlens.operators import conflict

    rows = [("x", "C", 4, 90000.0, 95000.0, "u1", False)] * 3 + [("y", "C", 4, 60000.0, 65000.0, "u2", False), ("z", "C", 6, 90000.0, 96000.0, "u3", False), ("n", None, 6, 1.0, 2.0, "u4", False)]
    jobs = spark.createDataFrame(rows, "job string, council_key string, band int, low double, high double, identity string, coupled boolean")
    assert sorted((r["job"], r["conflict"]) for r in conflict.conflicts(jobs, jobs).collect()) == [("n", False), ("x", True), ("x", True), ("x", True), ("y", False), ("z", False)]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a" * 32, "text", 1)], "hash string, text string, n int")
    for _ in range(2):
        sinks.append_log(rows, str(tmp_path / "log"), "2026-05-01")
        sinks.append_quarantine(rows, str(tmp_path / "quarantine"), "2026-05-01")
    assert spark.read.json(str(tmp_path / "log")).count() == spark.read.json(str(tmp_path / "quarantine")).count() == 2
    sinks.insert_descriptions(rows, str(tmp_path / "d"), "n")
    assert spark.read.json(str(tmp_path / "d")).first()["shard"] == "aa"
    sinks.write_snapshot(rows, str(tmp_path / "s"), "v1")
    assert spark.read.json(str(tmp_path / "s/v1")).count() == 1
