"""Adapters, links, hints, logs and streams on small files."""

import bz2
import gzip
import hashlib
import io
import json
import zipfile

from pyspark.sql import functions as F

from adlens.operators import explore
from adlens.sources import adapters, discovery, files, markup
from adlens.streaming import log


def test_boards_to_observations(spark):
    pulse = {"Jobs": [{"LinkId": "Q1", "JobInfo": {"Title": "Parks Officer", "Compensation": "Band 5 $80,000 - $90,000 pa", "Description": "<p>Look after parks</p>", "EmploymentType": "Full time"}}, {"JobInfo": {}}]}
    hcm = {"items": [{"Title": "Civil Engineer", "Id": 7, "PrimaryLocation": "Town", "Notes": "Applications close 3 May 2026"}]}
    rows = [("a", "https://p.example/Pulse/jobs", "pulse", json.dumps(pulse)), ("b", "https://o.example/hcmUI/sites/CX_2/x", "oracle_hcm", json.dumps(hcm)), ("c", "https://o.example/", "pulse", "not json")]
    got = {r["source_id"]: r for r in adapters.any_platform(spark.createDataFrame(rows, "source_id string, url string, platform string, body string")).collect()}
    assert (got["a"]["band"], got["a"]["advertised_salary_min"], got["a"]["url"]) == (5, 80000.0, "https://p.example/Pulse/job/Q1/Parks-Officer?source=public")
    assert (got["b"]["closing_date"], got["b"]["url"]) == ("2026-05-03", "https://o.example/hcmUI/CandidateExperience/en/sites/CX_2/job/7")
    sources = spark.createDataFrame([("a", "pulse", "Shire of A", "A", "https://p.example"), ("b", "oracle_hcm", "B City", "B", "https://o.example")], "source_id string, platform string, council_name string, short_name string, source_url string")
    cand = adapters.any_platform(spark.createDataFrame(rows, "source_id string, url string, platform string, body string"))
    obs = {r["source_id"]: r for r in adapters.observations(cand, sources, "r1", "2026-05-01T00:00:00Z").collect()}
    assert obs["a"]["council_key"] == "A" and len(obs["a"]["job_id"]) == 20 and obs["a"]["advertised_salary_period"] == "year" and obs["b"]["title"] == "Civil Engineer"


def test_links_and_hints(spark):
    html = "<a href='/jobs/1'>Parks Officer</a><a href='mailto:x'>Mail officer</a><a href='https://facebook.com/job'>Job page</a><link rel='alternate' type='application/rss+xml' href='/jobs/feed.xml'><script>fetch(\"/api/jobs?x=1\")</script>"
    pages = spark.createDataFrame([(1, "https://c.example/list", html), (2, None, None)], "page_id long, url string, html string")
    assert [r["link"] for r in files.job_links(files.links(pages)).collect()] == ["https://c.example/jobs/1"]
    hints = discovery.hints(pages)
    assert {r["url"] for r in hints.collect()} == {"https://c.example/jobs/feed.xml", "https://c.example/api/jobs?x=1"}
    assert [r["url"] for r in discovery.feed_urls(pages).collect()] == ["https://c.example/jobs/feed.xml"]
    ld = "<script type='application/ld+json'>{\"@type\": \"JobPosting\", \"title\": \"Nurse\", \"url\": \"u\"}</script>"
    assert [(r["title"], r["link"]) for r in discovery.postings(pages.withColumn("html", F.lit(ld)).limit(1)).collect()] == [("Nurse", "u")]
    doc = spark.createDataFrame([("https://v.example/viewer.html?file=%2Fa%20b.pdf",)], "u string").select(files.embedded_document(F.col("u")).alias("d")).first()["d"]
    assert doc == "https://v.example/a b.pdf"


def test_detail_wins_place_and_listing_wins_pay(spark):
    s = "url string, location_text string, work_type string, closing_date string, closing_text string, advertised_salary_text string, advertised_salary_min double, advertised_salary_max double, advertised_salary_period string, band int, description_excerpt string, classification_status string"
    a = spark.createDataFrame([("u", "x", "", "", "", "$1", 1.0, 1.0, "year", None, "short", "unclassified")], s)
    b = spark.createDataFrame([("u", "y", "w", "", "", "$2", 2.0, 2.0, "hour", 4, "much longer", "")], s)
    r = adapters.merged_with_detail(a, b).first()
    assert (r["location_text"], r["advertised_salary_text"], r["band"], r["description_excerpt"], r["classification_status"]) == ("y", "$1", 4, "much longer", "explicit_band")


def test_detail_page_prefers_what_is_set_apart(spark):
    html = "<h1>Parks Officer</h1><div class='salary'>$80,000 - $90,000 per annum</div><article>Band 5 role. Pay was $50,000 per annum once, said someone who keeps on talking.</article><p>Applications close 3 May 2026</p>"
    page = spark.createDataFrame([("s", "https://a.example/1", html), ("s", "https://a.example/2", None)], "source_id string, url string, html string")
    got = {r["url"][-1]: r for r in adapters.details(page).collect()}
    assert (got["1"]["band"], got["1"]["advertised_salary_min"], got["1"]["closing_date"], got["1"]["description_status"]) == (5, 80000.0, "2026-05-03", "fetched")
    assert got["2"]["title"] == "" and got["2"]["description_status"] == "missing" and got["2"]["band"] is None


def test_log_skips_what_it_cannot_read(spark, tmp_path):
    (tmp_path / "2026-01-01.jsonl").write_text('{"job_id": "a", "title": "x"}\n\nbroken\n{"title": "no id"}\n')
    (tmp_path / "2026-01-02.jsonl.bz2").write_bytes(bz2.compress(b'{"job_id": "b"}\n'))
    assert {r["job_id"] for r in files.observations(spark, str(tmp_path)).collect()} == {"a", "b"}
    (tmp_path / "r.json").write_text(json.dumps({"sources": [{"council_name": "A", "platform": "p", "url": "u"}, {"source_id": "s", "enabled": False}]}))
    assert [(len(r["source_id"]), r["council_key"]) for r in files.registry(spark, str(tmp_path / "r.json")).collect()] == [(16, "A")]


def test_word_files(spark, tmp_path):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:p><w:t>Band </w:t><w:t>6</w:t></w:p></w:document>')
    (tmp_path / "a.docx").write_bytes(b.getvalue())
    (tmp_path / "b.docx").write_bytes(b"no zip")
    assert {r["text"] for r in files.documents(spark, str(tmp_path)).collect()} == {"Band 6", None}


def test_streamed_snapshot_equals_batch(spark, tmp_path):
    schema = "job_id string, run_id string, observed_at string, title string, seq long"
    days = [[("a", "r1", "d1", "t", 1), ("b", "r1", "d1", "t", 2)], [("a", "r2", "d2", "u", 3)], [("b", "r0", "d0", "late", 4)]]
    for i, rows in enumerate(days):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "log" / f"day={i}"))
    keep = log.keep_snapshot(str(tmp_path / "s"), "seq")
    stream = log.read_log(spark, str(tmp_path / "log"), spark.createDataFrame([], schema).schema)
    stream = stream.select(*schema.replace(" string", "").replace(" long", "").split(", "))
    stream.writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    got = {r["job_id"]: (r["title"], r["first_seen_at"], r["last_seen_at"], r["sighting_count"]) for r in log.snapshot(spark, str(tmp_path / "s")).collect()}
    assert got == {"a": ("u", "d1", "d2", 2), "b": ("t", "d0", "d1", 2)}


def test_explorer(spark):
    assert [tuple(r) for r in explore.lower_quantiles(spark.createDataFrame([(i,) for i in (5, 1, 3, 2, 4)], "x int"), "x", {"m": 0.5, "q": 0.9}).collect()] == [(3, 4)]


def test_odd_markup(spark):
    html = "<a href=/x?a=1&amp;b=2 title='t'>R&amp;D <b>role</b><a href='/y'>open to the end <script>var a = '</a>';</script>"
    got = spark.createDataFrame([(html,), (None,), ("",), ("<a><A HREF>",)], "html string").select(markup.elements(F.col("html")).alias("e")).collect()
    assert [[(x["tag"], x["url"], " ".join(x["text"].split())) for x in r["e"]] for r in got] == [[("a", "/x?a=1&b=2", "R&D role"), ("a", "/y", "open to the end"), ("script", None, "var a = '</a>';")], [], [], [("a", None, ""), ("a", "", "")]]
    feed = "<feed xmlns='http://www.w3.org/2005/Atom'><entry><title>A &amp; B</title><link href='/a'/></entry><url><loc> /b </loc></url></feed>"
    got = spark.createDataFrame([(feed,), ("no xml",), (None,)], "xml string").select(markup.entries(F.col("xml")).alias("e")).collect()
    assert [[tuple(x) for x in r["e"]] for r in got] == [[("A & B", "/a"), ("", "/b")], [], []]


def test_log_order_is_by_suffix_and_whole_path(spark, tmp_path):
    for name, data in (("d=1/z.jsonl", b"1"), ("d=2/a.jsonl", b"2"), ("d=0/a.jsonl.bz2", b"4"), ("d=0/b.jsonl.gz", b"3")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        line = b'{"job_id": "' + data + b'"}\n'
        (tmp_path / name).write_bytes(bz2.compress(line) if name.endswith("bz2") else gzip.compress(line) if name.endswith("gz") else line)
    assert [r["job_id"] for r in files.observations(spark, str(tmp_path)).orderBy("seq").collect()] == ["1", "2", "3", "4"]


def test_previous_snapshot_falls_back(spark, tmp_path):
    every, current = tmp_path / "all-jobs.json", tmp_path / "current-jobs.json"
    assert files.previous_jobs(spark, str(every), str(current)).count() == 0
    current.write_text(json.dumps({"jobs": [{"job_id": "c"}, {"job_id": ""}]}))
    assert [r["job_id"] for r in files.previous_jobs(spark, str(every), str(current)).collect()] == ["c"]
    every.write_text("{broken")
    assert [r["job_id"] for r in files.previous_jobs(spark, str(every), str(current)).collect()] == ["c"]
    every.write_text(json.dumps({"jobs": [{"job_id": "a"}]}))
    assert [r["job_id"] for r in files.previous_jobs(spark, str(every), str(current)).collect()] == ["a"]


def word_file(*paragraphs):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main">' + "".join(f"<w:p><w:t>{p}</w:t></w:p>" for p in paragraphs) + "</w:document>")
    return b.getvalue()


def test_documents_of_a_crawl(spark, tmp_path):
    """Documents fill the details of pages; only folders that are asked for are read."""
    kept = {"https://c.example/files/a.docx": word_file("Position Description", "Band 6 role"), "https://c.example/files/b.docx": word_file("Salary $80,000 - $90,000 per annum"), "https://c.example/files/c.docx": word_file("Band 1"), "https://c.example/x.pdf": b"%PDF", "https://c.example/other.docx": word_file("not asked for")}
    for url, data in kept.items():
        name = hashlib.sha256(url.encode()).hexdigest()
        folder = tmp_path / f"shard={name[:2]}"
        folder.mkdir(exist_ok=True)
        (folder / f"{name}.docx").write_bytes(data)
    html = "<h1>Parks Officer</h1><p>Short.</p><a href='/files/a.docx'>PD</a><iframe src='/viewer?file=%2Ffiles%2Fb.docx'></iframe><a href='/files/c.docx'>third is not read</a>"
    pages = spark.createDataFrame([("s", "https://c.example/1", html), ("s", "https://c.example/2", "<h1>Nurse</h1><a href='/x.pdf'>PD</a>"), ("t", "https://c.example/3", None)], "source_id string, url string, html string")
    got = {r["url"][-1]: r for r in discovery.detail_candidates(pages, str(tmp_path)).collect()}
    one = got["1"]
    assert (one["band"], one["advertised_salary_min"], one["description_status"], one["has_document"]) == (6, 80000.0, "document", True)
    assert one["document_urls"] == ["https://c.example/files/a.docx", "https://c.example/files/b.docx"] and one["description_excerpt"].startswith("Position Description Band 6 role Salary")
    assert (got["2"]["band"], got["2"]["has_document"], got["2"]["document_urls"]) == (None, False, None) and got["3"]["title"] == ""
    asked = spark.createDataFrame([("https://c.example/files/a.docx",)], "url string")
    plan = files.document_texts(asked, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    name = hashlib.sha256(b"https://c.example/files/a.docx").hexdigest()
    assert "PartitionFilters" in plan and f"= {name[:2]}" in plan
    assert files.document_texts(asked.limit(0), str(tmp_path)).count() == 0
