"""Scalar rules on pinned examples."""

import datetime
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from adlens.functions import band, dates, details, money, salary, text, titles, urls


@pytest.fixture
def value(spark):
    """The value of f over one text."""
    return lambda f, x: spark.createDataFrame([(x,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("x", "y"),
    [("Classification: Band 6 role", 6), ("Municipal Employee Level 4A", 4), ("Remuneration band six", 6), ("Level 7 under the Local Government Award", 7), ("Band 9", None), ("", None), (None, None)],
)
def test_band(value, x, y):
    assert value(band.extract, x) == y


@pytest.mark.parametrize(
    ("x", "low", "high", "period"),
    [
        ("$91,000 - $102,000 per annum plus super", 91000, 102000, "year"),
        ("$133k-$149k + super", 133000, 149000, "year"),
        ("Band 7A 36 Hour Week AUD $108,150.75 - $120,323.65", 108150.75, 120323.65, "year"),
        ("Reference number 35-2026. Casual at $50.94 per hour plus loading", 50.94, 50.94, "hour"),
        ("$127K?$143K package", 127000, 143000, "year"),
        ("Band 4 - Starting at $72,735 pa ($36.80 per hour) + Super", 72735, 72735, "year"),
    ],
)
def test_salary(value, x, low, high, period):
    s = value(salary.extract, x)
    assert (s["minimum"], s["maximum"], s["period"]) == (low, high, period)


def test_salary_none(value):
    assert value(salary.extract, "no pay here 12") is None
    assert value(salary.extract, None) is None


def test_closing_date(value):
    assert value(dates.closing_date, "Applications close 5pm, Sunday 14 June 2026") == datetime.date(2026, 6, 14)
    assert value(dates.closing_date, "closing 31/02/2026 or 3 March 2026") is None
    assert value(dates.closing_date, "posted 1/1/2026, closes 05/07/26") == datetime.date(2026, 7, 5)
    assert value(dates.closing_date, "") is None


def test_titles(value):
    assert value(titles.clean, "Theatre Technician (") == "Theatre Technician"
    assert value(titles.clean, "Rapid Response Officer May") == "Rapid Response Officer"
    assert value(titles.is_role, "Rapid Response Officer") is True
    assert value(titles.is_role, "Careers") is False
    assert value(titles.is_shell, "Current Vacancies") is True
    assert value(titles.from_url, "https://x.org/jobs/multi-purpose-crew-leader-vic-australia/") == "Multi Purpose Crew Leader"


def test_text(value):
    assert value(text.compact, "Band 4 ?????????????") == "Band 4"
    assert value(text.compact, "ﬁve  ½") == "five 1⁄2"
    assert value(lambda c: text.excerpt(c, 12), "one two, three four") == "one two..."
    assert value(text.key, "Arts & Parks") == "ARTS AND PARKS"
    a = value(lambda c: text.stable_hash(c, F.lit(None).cast("string"), F.lit("B")), "A")
    assert a == value(lambda c: text.stable_hash(c, F.lit("b")), "a") and len(a) == 20


def test_urls(value):
    assert value(urls.canonical, "HTTPS://Ab.C/d/?utm_source=x&q=1#top") == "https://ab.c/d?q=1"
    assert value(urls.canonical, "https://ab.c") == "https://ab.c/"
    assert value(urls.host, "https://www.Seek.com.au/job/1") == "seek.com.au"
    assert value(urls.is_mirror, "https://www.seek.com.au/job/1") is True
    assert value(urls.holds_no_listing, "https://au.jora.com/") is True
    assert value(lambda c: urls.resolved(F.lit("https://a.b/c/d?e"), c), "../f") == "https://a.b/f"
    for href, to in [("./g", "https://a.b/c/g"), ("/x/./y/../z?q=../r", "https://a.b/x/z?q=../r"), ("../../../h", "https://a.b/h"), ("k/..", "https://a.b/c/"), ("..", "https://a.b/"), ("a..b", "https://a.b/c/a..b")]:
        assert value(lambda c: urls.resolved(F.lit("https://a.b/c/d?e"), c), href) == to, href
    assert value(lambda c: urls.resolved(F.lit("https://a.b/c/d?e"), c), "mailto:x@y") == ""


def test_money(spark):
    row = spark.createDataFrame([(1234.0, 1234.5, "year")], "a double, b double, p string").select(money.range_label(F.col("a"), F.col("b"), F.col("p")).alias("x"), money.range_label(F.col("a"), F.lit(None).cast("double"), F.lit(None)).alias("y")).first()
    assert (row["x"], row["y"]) == ("$1,234-$1,234.50/year", "$1,234")


def test_salary_repair(spark):
    df = spark.createDataFrame([("$70,9374", 70.0, None, "hour"), ("$91,000 pa", 91000.0, 91000.0, "hour"), (None, None, None, None), ("35-2026", 35.0, 2026.0, None)], "t string, a double, b double, p string")
    got = [r["n"] for r in df.select(salary.normalised(F.col("t"), F.col("a"), F.col("b"), F.col("p")).alias("n")).collect()]
    assert got[0]["minimum"] == 70937 and got[1]["period"] == "year"
    assert got[2]["minimum"] is None and got[3]["minimum"] is None


def test_title_from_text(value):
    assert value(titles.from_text, "Page 2 position description TEAM LEADER PARKS Classification: Band 7") == "Team Leader Parks"
    assert value(titles.from_text, "Civil Engineer $91,000") == "Civil Engineer"
    assert value(titles.from_text, "Nothing of the kind") == "" and value(titles.from_text, None) == ""


def test_sections(value):
    got = value(details.sections, "Intro about the role do this ABOUT YOU  be that selection criteria")
    assert [tuple(x) for x in got] == [("About The Role", "do this"), ("About You", "be that")]
    assert value(details.sections, "none") == [] and value(details.sections, None) == []


def test_window(value):
    assert value(lambda c: details.window(F.lit("Officer"), c, after=6), "0123456789 OFFICER abcdefgh") == "9 OFFICER abcde"
    assert value(lambda c: details.window(F.lit("Off"), c), "off") == "" and value(lambda c: details.window(F.lit("Officer"), c), None) == ""


def test_page_parts(value):
    html = """<head><meta name='description' content='Band 4'></head><nav class='x'>Menu</nav><main>Main<div class='job-details'>Look after &amp; keep parks<script>var x</script><form>Apply</form>
    <p class='salery'>$80,000 pa</p> for all the people of this town</div></main><script type='application/ld+json'>{"validThrough": "2026-05-03"}</script>"""
    got = value(lambda c: details.parts(c), html)
    assert got["description"] == "Look after & keep parks $80,000 pa for all the people of this town" and got["structured"] == "$80,000 pa Band 4 2026-05-03"
    d = value(lambda c: details.description(details.parts(c)["description"]), html)
    assert d["status"] == "fetched" and len(d["hash"]) == 32 and d["sections"] == []
    assert value(lambda c: details.description(details.parts(c)["description"]), "<p>no</p>")["status"] == "missing"
    assert value(lambda c: details.description(details.parts(c)["description"]), "<main>few</main>")["status"] == "sparse"
    assert value(lambda c: details.parts(c), None)["description"] is None
    assert "Shown" in value(details.search_text, "<a aria-label='Shown'>x</a>")


def test_compatible_forms(spark):
    """Against the character database: every character that it knows, and random strings of letters, marks, jamo and compatible forms."""
    rng = random.Random(8)
    known = [c for c in map(chr, range(1, 0x110000)) if not 0xD800 <= ord(c) <= 0xDFFF and unicodedata.category(c) != "Cn"]
    marks = [c for c in known if unicodedata.combining(c)]
    forms = [c for c in known if unicodedata.normalize("NFKC", c) != c]
    pools = ["aeiounAEO", marks, forms, [chr(x) for x in range(0x1100, 0x11FF)], "Band IV ???"]
    some = ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randint(1, 8))) for _ in range(100_000)]
    rows = [(x,) for x in ["oﬃcer", "Band Ⅳ", "Cafe\u0301", "¼", "a\u0323\u0307", "a\u0307\u0323", "\u1100\u1161\u11a8", *known, *some]]
    want = lambda x: re.sub(r"\s+", " ", re.sub("[?]{3,}|\ufffd+", " ", unicodedata.normalize("NFKC", x).replace("\xa0", " "))).strip()
    got = spark.createDataFrame(rows, "x string").select("x", text.compact(F.col("x")).alias("y")).collect()
    assert [(r["x"], r["y"]) for r in got if r["y"] != want(r["x"])] == [] and len(got) == len(rows)


def test_salary_by_signs_of_two_units(value):
    """Signs outside the basic plane before an amount hide it no longer."""
    s = value(salary.extract, "\U0001f600 " * 40 + "Salary $91,000 - $102,000 per annum")
    assert (s["minimum"], s["maximum"], s["period"], s["evidence_text"]) == (91000, 102000, "year", "$91,000 - $102,000")


def test_pay_is_read_by_all_tasks(spark, tmp_path):
    """A table in one file is dealt to all tasks before its texts are read."""
    from adlens.plans import texts

    spark.range(50).selectExpr("id AS p_partkey", "'a b' AS p_name", "CAST(id % 10 AS INT) AS p_size").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    for q in (texts.salary_extract, texts.salary_normalise):
        assert q(spark, str(tmp_path)).rdd.getNumPartitions() == 4


def test_texts_are_worked_out_once(spark):
    x = F.col("x")
    # each look at a text stands for itself: nested ones add up and don't multiply
    assert str(text.compact(text.compact(text.compact(x)))).count("Normalizer") == 3
    assert str(titles.clean(titles.clean(x))).count("Normalizer") == 2 * str(titles.clean(x)).count("Normalizer")
    assert str(urls.canonical(text.excerpt(x, 300))).count("Normalizer") == 2
    assert len(str(titles.best(x, x, body=x))) < 60_000
    assert len(str(salary.extract(x))) < 30_000
