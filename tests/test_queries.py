"""Every registered query against its SQL, and invariants of order-sensitive operators."""

import hashlib
import html
import re

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401
from adlens.functions.text import TITLE_STOP_WORDS
from adlens.operators import board, conflict, dedupe, gates, history, strategy
from adlens.plans import listings, registry, texts

SF, NEXT = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle_at(folder):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return c


@pytest.fixture(scope="module")
def oracle():
    return oracle_at(SF)


def plain(v):
    return round(v, 6) if isinstance(v, float) else v


def alike(a, b):
    return bool(a and b) and 5 * len(a & b) >= 4 * min(len(a), len(b))


def deduped(rows):
    """The greedy steps over whole councils, in plain lists. rows are board rows in order, on one site that is no mirror."""
    text = lambda v: " ".join(str(v or "").split()).lower()
    kept = {}
    for i, r in enumerate(rows):
        title = re.sub("[^a-z0-9]+", " ", r["job_title"].lower()).strip()
        pay = (r["advertised_salary_min"], r["advertised_salary_max"], r["advertised_salary_period"])
        detail = (text(r["work_type"]), text(r["location_text"]), text(r["closing_at"]), text(r["closing_at_text"]), pay if pay[0] is not None else "")
        path = re.sub(r"[?#].*$", "", r["job_url"])
        score = 40 * (r["standard_band_number"] is not None) + 30 * (r["classification_status"] == "explicit_band") + 20 * (pay[0] is not None) + 10 * bool(text(r["description_text"])) + 5 * (r["observed_status"] == "seen_latest_run")
        one = {"row": r, "score": score, "title": set(title.split()) - set(TITLE_STOP_WORDS), "path": path, "detail": detail, "council": r["council_key"].upper()}
        key = (one["council"], title, path, detail)
        if key not in kept or score > kept[key][1]["score"]:
            kept[key] = (kept[key][0] if key in kept else i, one)
    first = [one for _, one in sorted(kept.values(), key=lambda x: x[0])]

    def greedy(some, same):
        out = []
        for one in some:
            at = next((k for k, other in enumerate(out) if same(one, other)), None)
            if at is None:
                out.append(one)
            elif one["score"] > out[at]["score"]:
                out[at] = one
        return out

    pages = {}
    for one in first:
        pages.setdefault((one["council"], one["path"]), []).append(one)
    second = [x for some in pages.values() for x in greedy(some, lambda a, b: alike(a["title"], b["title"]))]
    same = lambda a, b: a["council"] == b["council"] and alike(a["title"], b["title"]) and (a["path"] == b["path"] or any(x and x == y for x, y in zip(a["detail"], b["detail"], strict=True)))
    return [x["row"] for x in greedy(second, same)]


def of_columns(df, rows):
    return [tuple(plain(r[c]) for c in sorted(df.columns)) for r in rows]


def brute_mirror(spark, df):
    rows = listings._vacancies(spark, SF).groupBy("job_id").agg(F.max_by(F.struct("*"), "seq").alias("r")).select("r.*").orderBy("job_id").collect()
    out = deduped(rows)
    assert len(out) < len(rows)
    return of_columns(df, out)


def brute_board(spark, df):
    rows = board.board_rows(texts._jobs(spark, SF)).where(gates.is_listing()).orderBy("seq").drop("field_evidence").collect()
    return of_columns(df, deduped(rows))


def articles():
    for r in duckdb.sql(f"SELECT page_id, url, html FROM '{SF}/pages.parquet'").fetchall():
        inner = re.search(r"<article>(.*)</article>", r[2], re.S)[1]
        yield r[0], r[1], " ".join(html.unescape(re.sub("<[^>]*>", " ", inner)).split()), html.unescape(re.sub("<[^>]*>", " ", re.search(r"<h1>(.*?)</h1>", r[2], re.S)[1]))


def brute_descriptions(spark, df):
    rows = []
    for i, _, said, _ in articles():
        full = len(said) >= 40
        rows.append({"page_id": i, "status": "fetched" if full else "sparse", "hash": hashlib.sha256(said.lower().encode()).hexdigest()[:32] if full else None, "n_chars": len(said), "n_sections": 0 if full else None})
    return of_columns(df, rows)


def brute_observations(spark, df):
    """Addresses, councils, titles and ids of the pages' rows; the fields that extractors find have tests of their own."""
    got = df.collect()
    hosts = {}
    for _, url, _, _ in articles():
        scheme, rest = re.sub("#.*$", "", url).split("://")
        path, _, query = rest.partition("?")
        query = "&".join(x for x in query.split("&") if x and not x.startswith("utm_"))
        host, _, tail = path.partition("/")
        full = f"{scheme}://{host.lower()}/{tail.rstrip('/')}" + (f"?{query}" if query else "")
        hosts.setdefault((re.sub("[^A-Z0-9]+", " ", re.sub("^www[.]", "", host).upper()).strip(), full), 0)
        hosts[re.sub("[^A-Z0-9]+", " ", re.sub("^www[.]", "", host).upper()).strip(), full] += 1
    count = {}
    for r in got:
        count[r["council_key"], r["url"]] = count.get((r["council_key"], r["url"]), 0) + 1
        parts = "\x1f".join([r["council_key"].lower(), " ".join((r["title"] or "").lower().split()), r["url"].lower()])
        assert r["job_id"] == hashlib.sha256(parts.encode()).hexdigest()[:20] and (r["run_id"], r["source_platform"]) == ("r1", "generic")
    assert count == hosts
    return of_columns(df, got)


BRUTE = {"mirror_dedupe": brute_mirror, "board_build": brute_board, "page_descriptions": brute_descriptions, "page_observations": brute_observations}


def test_all_queries_are_held_against_something():
    assert set(registry.QUERIES) == set(registry.ORACLE) | set(BRUTE)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, oracle, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in registry.ORACLE:
        want = BRUTE[name](spark, df)
        assert want and got == sorted(want, key=repr)
        return
    res = oracle.execute(registry.ORACLE[name])
    names = [d[0] for d in res.description]
    want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in res.fetchall()), key=repr)
    assert sorted(names) == columns
    assert got == want
    if not want:  # the right answer at this size; at the next it is some rows
        assert oracle_at(NEXT).execute(registry.ORACLE[name]).fetchone() is not None
        got = sorted((tuple(plain(r[c]) for c in columns) for r in registry.QUERIES[name](spark, NEXT).collect()), key=repr)
        want = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in oracle_at(NEXT).execute(registry.ORACLE[name]).fetchall()), key=repr)
        assert got == want


def test_latest_is_independent_of_partitions(spark):
    rows = spark.createDataFrame([("a", "2026-01-01", "r1", 1), ("a", "2026-01-01", "r1", 2), ("b", "2026-01-02", "r2", 3), ("a", "2026-01-02", "r2", 4)], "job_id string, observed_at string, run_id string, seq int")
    one = sorted(map(tuple, history.rebuild(rows.withColumn("source_id", F.lit("s")), spark.createDataFrame([("s",)], "source_id string"), "seq").collect()))
    assert one == sorted(map(tuple, history.rebuild(rows.withColumn("source_id", F.lit("s")).repartition(7), spark.createDataFrame([("s",)], "source_id string"), "seq").collect()))
    named = history.rebuild(rows.withColumn("source_id", F.lit("s")), spark.createDataFrame([("s",)], "source_id string"), "seq").select("job_id", "seq", "sighting_count", "observed_status")
    assert {tuple(r) for r in named.collect()} == {("a", 4, 2, "seen_latest_run"), ("b", 3, 1, "seen_latest_run")}


def test_conflict_leaves_out_own_address(spark):
    rows = [("x", "C", 4, 90000.0, 95000.0, "u1", False), ("y", "C", 4, 60000.0, 65000.0, "u2", False), ("z", "C", 6, 90000.0, 96000.0, "u3", False), ("w", "C", 4, 90000.0, 95000.0, "u1", False)]
    jobs = spark.createDataFrame(rows, "job string, council_key string, band int, low double, high double, identity string, coupled boolean")
    assert {r["job"] for r in conflict.conflicts(jobs, jobs).where("conflict").collect()} == {"x", "w"}


def test_spike_falls_back_and_keeps_baseline(spark):
    rows = spark.range(60).selectExpr("'s' AS source_id", "'json_ld' AS strategy", "1L AS strategy_index", "concat('Officer ', id) AS title", "concat('u', id) AS url", "true AS paid", "true AS probable", "true AS has_band", "false AS has_salary", "false AS has_description", "false AS has_closing", "false AS failed")
    none = spark.createDataFrame([], "source_id string, title string")
    profiles = spark.createDataFrame([("s", "", 4, 100, "r0", 0, "ok")], "source_id string, preferred_strategy string, last_good_count long, last_good_score long, last_good_run_id string, failure_streak int, health string").withColumn("quality_history", F.array().cast("array<struct<run_id:string,strategy:string,accepted_count:bigint,score:bigint,codes:string>>"))
    judged = strategy.judged(rows, none.select("title"), none)
    health = strategy.drift(strategy.choose(strategy.metrics(judged), profiles))
    h = health.first()
    assert h["fallback_used"] and h["status"] == "degraded" and strategy.emitted(judged, health).count() == 0
    new = strategy.updated_profiles(profiles, health, "r1").first()
    assert (new["last_good_count"], new["failure_streak"], new["health"], len(new["quality_history"])) == (4, 1, "degraded", 1)
    assert [r["reason"] for r in strategy.quarantine(judged, health, "title").collect()] == ["severe_drift"]


def test_mirror_is_dropped(spark):
    base = {c: "" for c in "location_text work_type closing_at closing_at_text description_text classification_status classification_band observed_status advertised_salary_period".split()}
    rows = [base | {"council_key": "C", "job_title": "Parks Officer", "job_url": "https://c.vic.gov.au/jobs/1", "standard_band_number": 5, "seq": 1}, base | {"council_key": "c", "job_title": "Parks Officer June", "job_url": "https://au.jora.com/job/9", "standard_band_number": None, "seq": 2}]
    schema = "council_key string, job_title string, job_url string, standard_band_number int, seq long, " + ", ".join(f"{c} string" for c in base)
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in rows], schema).withColumns({"advertised_salary_text": F.lit(None).cast("string"), "advertised_salary_min": F.lit(None).cast("double"), "advertised_salary_max": F.lit(None).cast("double")})
    assert [r["seq"] for r in dedupe.dedupe(df, "seq").select("seq").collect()] == [1]
