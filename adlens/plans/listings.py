"""Queries over the log of listings: snapshots, summaries, facets, conflicts and duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.functions import dates, money, text
from adlens.operators import conflict, dedupe, explore, history
from adlens.operators.staging import written
from adlens.plans import lens
from adlens.plans.registry import query

OBS, SEQ = f"WITH obs AS ({lens.OBS_SQL}) ", ", ".join(lens.SEQ)
DESC = ", ".join(f"{c} DESC" for c in lens.SEQ)
LATEST = f"{OBS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY observed_at DESC, {DESC}) AS nth, min(observed_at) OVER (PARTITION BY job_id) AS first_seen_at, max(observed_at) OVER (PARTITION BY job_id) AS last_seen_at, count(*) OVER (PARTITION BY job_id) AS sighting_count FROM obs), snap AS (SELECT * FROM ranked WHERE nth = 1) "
RUN = f", run AS (SELECT run_id AS latest_run FROM obs ORDER BY observed_at DESC, {SEQ} LIMIT 1) "
STATUS = "CASE WHEN run_id = latest_run THEN 'seen_latest_run' WHEN source_id % 7 = 0 THEN 'source_unavailable_latest_run' ELSE 'not_seen_latest_run' END"


def snapshot(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The latest sightings; with columns, carrying those alone besides keys and order."""
    obs = lens.observations(spark, sf_dir)
    some = [c for c in obs.columns if c in columns or c in ("job_id", "observed_at", *lens.SEQ)]
    return history.latest(obs.select(*some) if columns else obs, *lens.SEQ)


def failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lens.table(spark, sf_dir, "supplier").where("s_suppkey % 7 = 0").select(F.col("s_suppkey").alias("source_id"))


@query(LATEST + "SELECT job_id, source_id, council_key, run_id, observed_at, band, salary_lo, salary_hi, l_orderkey, first_seen_at, last_seen_at, sighting_count FROM snap")
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest row of each listing with first and last sighting and their count."""
    return snapshot(spark, sf_dir, "source_id", "council_key", "run_id", "band", "salary_lo", "salary_hi").select("job_id", "source_id", "council_key", "run_id", "observed_at", "band", "salary_lo", "salary_hi", "l_orderkey", "first_seen_at", "last_seen_at", "sighting_count")


@query(f"{OBS} SELECT job_id, observed_at, run_id, source_id, l_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY job_id, observed_at, run_id ORDER BY {SEQ}) AS nth FROM obs) WHERE nth = 1")
def observation_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replayed sightings dropped, the first kept."""
    return history.dedupe(lens.observations(spark, sf_dir), *lens.SEQ).select("job_id", "observed_at", "run_id", "source_id", "l_orderkey")


@query(f"{OBS} {RUN} SELECT latest_run, (SELECT max(observed_at) FROM obs) AS latest_at FROM run")
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run of the newest sighting."""
    return history.latest_run(lens.observations(spark, sf_dir), *lens.SEQ)


@query(
    f"{OBS}, logged AS (SELECT 0 AS part, NULL::BIGINT AS l_orderkey_, * FROM obs WHERE run_id < '199501' AND l_linenumber < 3 UNION ALL SELECT 1, l_orderkey, * FROM obs WHERE run_id >= '199401'),"
    f" firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job_id, observed_at, run_id ORDER BY part, {SEQ}) AS k FROM logged) WHERE k = 1),"
    f" snap AS (SELECT *, min(observed_at) OVER (PARTITION BY job_id) AS first_seen_at, count(*) OVER (PARTITION BY job_id) AS sighting_count, row_number() OVER (PARTITION BY job_id ORDER BY observed_at DESC, part DESC, {DESC}) AS nth FROM firsts),"
    f" run AS (SELECT run_id AS latest_run FROM firsts ORDER BY observed_at DESC, part, {SEQ} LIMIT 1)"
    f" SELECT job_id, run_id, observed_at, l_orderkey, first_seen_at, sighting_count, {STATUS} AS observed_status FROM snap CROSS JOIN run WHERE nth = 1"
)
def snapshot_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier snapshot and a log that overlaps it, ordered by structs, as listings with their status."""
    obs = lens.observations(spark, sf_dir).select("job_id", "observed_at", "run_id", "source_id", *lens.SEQ).withColumn("seq", F.struct(*lens.SEQ))
    # of rows of one job, time and run in the snapshot the first counts, as in a log
    old = history.dedupe(obs.where("run_id < '199501' and l_linenumber < 3"), "seq")
    jobs = history.rebuild(obs.where("run_id >= '199401'"), failed(spark, sf_dir), "seq", previous=old)
    return jobs.select("job_id", "run_id", "observed_at", "l_orderkey", "first_seen_at", "sighting_count", "observed_status")


@query(LATEST + RUN + f"SELECT job_id, run_id, {STATUS} AS observed_status FROM snap CROSS JOIN run")
def status_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each listing's status: seen, source unavailable, or not seen."""
    obs = lens.observations(spark, sf_dir)
    return history.with_status(snapshot(spark, sf_dir, "run_id", "source_id"), history.latest_run(obs, *lens.SEQ), failed(spark, sf_dir)).select("job_id", "run_id", "observed_status")


@query(
    LATEST + RUN + f", st AS (SELECT *, {STATUS} AS s FROM snap CROSS JOIN run) SELECT count(*) AS all_jobs, count(*) FILTER (s = 'seen_latest_run') AS current_jobs, count(DISTINCT council_key) AS councils,"
    " count(DISTINCT council_key) FILTER (s = 'seen_latest_run') AS councils_current, (SELECT count(*) FROM obs) AS observations, (SELECT count(*) FROM supplier) AS sources_configured FROM st"
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over snapshot, log and sources, as one row."""
    obs = lens.observations(spark, sf_dir)
    jobs = history.with_status(snapshot(spark, sf_dir, "run_id", "source_id", "council_key"), history.latest_run(obs, *lens.SEQ), failed(spark, sf_dir))
    return history.summary(jobs, None, lens.table(spark, sf_dir, "supplier"))


@query(LATEST + "SELECT CASE WHEN classification_status = '' THEN 'unclassified' ELSE classification_status END AS value, count(*) AS n FROM snap GROUP BY 1")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings by classification status, empty ones as unclassified."""
    return history.group_counts(snapshot(spark, sf_dir, "classification_status"), "classification_status", "unclassified")


@query(f"{OBS} SELECT substr(observed_at, 1, 7) AS month, count(*) AS n FROM obs GROUP BY 1")
def month_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sightings by month."""
    return lens.observations(spark, sf_dir).select(dates.month_key(F.col("observed_at")).alias("month")).groupBy("month").agg(F.count("*").alias("n"))


@query(LATEST + "SELECT council_key, count(*) AS n FROM snap WHERE band = 3 AND salary_lo > 50000 GROUP BY 1")
def council_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings of one band by council."""
    return explore.by_council(snapshot(spark, sf_dir, "council_key", "band", "salary_lo").where("salary_lo > 50000"), explore.State(band=3))


@query(
    LATEST + ", c AS (SELECT council_key, count(*) AS n FROM snap WHERE salary_lo > 45000 GROUP BY 1), q AS (SELECT greatest(2, coalesce(v[1 + CAST(floor((len(v) - 1) * 0.9::double) AS BIGINT)], 0)) AS domain FROM (SELECT list_sort(list(n)) AS v FROM c))"
    " SELECT n_name AS council_key, CAST(n_nationkey * 7 AS INT) AS x, coalesce(n, 0) AS n, least(greatest(coalesce(n, 0)::double / domain, 0.08::double), 1.0::double) AS scale, n_name IN ('FRANCE', 'CHINA', 'KENYA') AS metro,"
    " CAST(coalesce((SELECT sum(n) FROM c WHERE council_key IN ('FRANCE', 'CHINA', 'KENYA')), 0) AS BIGINT) AS metro_total FROM nation LEFT JOIN c ON council_key = n_name CROSS JOIN q WHERE n_nationkey % 6 <> 0"
)
def council_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings on a map of councils, with the scale of their colour and the total of a city's."""
    features = lens.table(spark, sf_dir, "nation").where("n_nationkey % 6 <> 0").select(F.col("n_name").alias("council_key"), (F.col("n_nationkey") * 7).cast("int").alias("x"))
    jobs = snapshot(spark, sf_dir, "council_key", "salary_lo").where("salary_lo > 45000")
    return explore.on_map(jobs, explore.State(), features, ("FRANCE", "CHINA", "KENYA"))


@query(
    "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-01') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d') END AS d FROM orders"
)
def job_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of listings out of what they have: a month, a time after an empty text, a day, or no date."""
    day, month = F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format("o_orderdate", "yyyy-MM")
    first = F.expr("CASE WHEN o_orderkey % 4 = 1 THEN '' WHEN o_orderkey % 4 = 3 THEN 'soon' END")
    last = F.when(F.col("o_orderkey") % 4 == 1, F.concat(day, F.lit("T10:00:00Z"))).when(F.col("o_orderkey") % 4 == 2, day)
    return lens.table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(explore.job_date(first, last, month), "yyyy-MM-dd").alias("d"))


@query(
    LATEST + ", a AS (SELECT band, CASE WHEN (period IN ('', 'year') OR salary_hi >= 30000) AND salary_hi >= 30000 THEN CASE WHEN salary_lo < 30000 THEN salary_hi ELSE salary_lo END END AS low FROM snap)"
    " SELECT CAST(b.band AS INT) AS band, count(a.band) AS n, avg(low)::double AS average, min(low)::double AS least, max(low)::double AS greatest FROM range(1, 9) b(band) LEFT JOIN a ON a.band = b.band GROUP BY 1"
)
def band_salary_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands 1 to 8 with counts and yearly minimum pay."""
    jobs = snapshot(spark, sf_dir, "band", "salary_lo", "salary_hi", "period").select("band", F.col("salary_lo").cast("double").alias("salary_min"), F.col("salary_hi").cast("double").alias("salary_max"), "period")
    return explore.band_chart(jobs)


@query(LATEST + ", l AS (SELECT council_key, list_sort(list(salary_hi)) AS v FROM snap GROUP BY 1) SELECT council_key, v[1 + CAST(floor((len(v) - 1) * 0.5::double) AS BIGINT)] AS median, v[1 + CAST(floor((len(v) - 1) * 0.9::double) AS BIGINT)] AS q90 FROM l")
def quantile_lower(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower quantiles of pay for each council."""
    return explore.lower_quantiles(snapshot(spark, sf_dir, "council_key", "salary_hi"), "salary_hi", {"median": 0.5, "q90": 0.9}, "council_key")


_SAMPLES = "samples AS (SELECT council_key, band, CAST(salary_lo AS DOUBLE) AS low, CAST(salary_hi AS DOUBLE) AS high, CAST(job_id AS VARCHAR) AS identity FROM snap WHERE band BETWEEN 1 AND 8)"


@query(
    LATEST + f", {_SAMPLES}, jobs AS (SELECT job_id, council_key, band, CAST(salary_lo AS DOUBLE) AS low, CAST(salary_hi AS DOUBLE) AS high, CAST(job_id AS VARCHAR) AS identity FROM snap WHERE band BETWEEN 1 AND 8),"
    " peers AS (SELECT j.job_id, j.band, j.low, j.high, s.band AS b, min(s.low) AS p_low, max(s.high) AS p_high FROM jobs j JOIN samples s ON s.council_key = j.council_key AND s.identity <> j.identity GROUP BY ALL),"
    " judged AS (SELECT job_id, coalesce(bool_or(b = band AND greatest(0.0::double, least(high, p_high) - greatest(low, p_low)) <= 0), false) AS apart,"
    " coalesce(bool_or(b <> band AND (greatest(0.0::double, least(high, p_high) - greatest(low, p_low)) / greatest(1.0::double, high - low) >= 0.5 OR (low + high) / 2 BETWEEN p_low AND p_high)), false) AS elsewhere FROM peers GROUP BY 1)"
    " SELECT jobs.job_id, coalesce(apart AND elsewhere, false) AS conflict FROM jobs LEFT JOIN judged USING (job_id)"
)
def peer_band_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings whose pay lies with the peers of another band."""
    jobs = snapshot(spark, sf_dir, "council_key", "band", "salary_lo", "salary_hi").where("band between 1 and 8").select("job_id", "council_key", "band", F.col("salary_lo").cast("double").alias("low"), F.col("salary_hi").cast("double").alias("high"), F.col("job_id").cast("string").alias("identity"), F.lit(False).alias("coupled"))
    return conflict.conflicts(jobs, jobs).select("job_id", "conflict")


@query(f"{OBS} SELECT council_key, run_id, count(*) AS n FROM obs GROUP BY 1, 2 HAVING count(*) > 50")
def council_run_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Councils with more sightings in a run than a board may hold."""
    from adlens.operators import gates

    return gates.crowded(lens.observations(spark, sf_dir).withColumnRenamed("run_id", "last_seen_run_id"))


@query(f"{OBS}, old AS (SELECT * FROM obs WHERE run_id < '199501'), new AS (SELECT * FROM obs WHERE run_id >= '199501') SELECT run_id, count(*) AS n, min(source) AS first FROM (SELECT run_id, 'old' AS source FROM old UNION ALL SELECT run_id, 'new' FROM new) GROUP BY 1")
def union_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An earlier snapshot and new sightings as one log."""
    obs = lens.observations(spark, sf_dir)
    both = history.union_history(obs.where("run_id < '199501'").withColumn("source", F.lit("old")), obs.where("run_id >= '199501'").withColumn("source", F.lit("new")))
    return both.groupBy("run_id").agg(F.count("*").alias("n"), F.min("source").alias("first"))


@query(
    "WITH r AS (SELECT md5(text) AS hash, doc_id, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS nth FROM documents), stored AS (SELECT DISTINCT md5(text) AS hash FROM documents WHERE doc_id % 3 = 0) SELECT hash, doc_id FROM r WHERE nth = 1 AND hash NOT IN (SELECT hash FROM stored)"
)
def description_insert_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that aren't stored yet, the first of equal ones."""
    rows = lens.table(spark, sf_dir, "documents").select(F.md5(F.col("text").cast("binary")).alias("hash"), "doc_id")
    return history.new_descriptions(rows, rows.where("doc_id % 3 = 0").select("hash").distinct(), "doc_id").select("hash", "doc_id")


@query(LATEST + ", d AS (SELECT doc_id, length(text) AS n FROM documents) SELECT snap.job_id, d.n AS n_chars FROM snap LEFT JOIN d ON d.doc_id = snap.job_id")
def description_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings with the length of their description, where there is one."""
    texts = lens.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("hash"), "text")
    jobs = snapshot(spark, sf_dir, "title").select("job_id", F.col("job_id").cast("string").alias("description_hash"))
    return history.with_descriptions(jobs, texts).select("job_id", F.length("description_text").cast("long").alias("n_chars"))


def _vacancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sightings as board rows; the key leaves a few ties and many duplicates."""
    obs = lens.observations(spark, sf_dir)
    return obs.select(
        "job_id",
        "council_key",
        F.concat(F.lit("Officer "), F.col("title")).alias("job_title"),
        F.concat(F.lit("https://jobs.example/"), (F.col("job_id") % 50).cast("string"), F.lit("?ref="), F.col("source_id").cast("string")).alias("job_url"),
        F.lit("").alias("location_text"),
        F.col("period").alias("work_type"),
        F.lit("").alias("closing_at"),
        F.lit("").alias("closing_at_text"),
        F.lit("").alias("description_text"),
        F.when(F.col("source_id") % 2 == 0, "seen_latest_run").otherwise("not_seen_latest_run").alias("observed_status"),
        "classification_status",
        F.lit("").alias("classification_band"),
        F.when(F.col("band").between(1, 8), F.col("band")).alias("standard_band_number"),
        F.lit(None).cast("string").alias("advertised_salary_text"),
        F.col("salary_lo").cast("double").alias("advertised_salary_min"),
        F.col("salary_lo").cast("double").alias("advertised_salary_max"),
        F.lit("year").alias("advertised_salary_period"),
        F.struct(*lens.SEQ, "job_id").alias("seq"),
    )


@query(
    f"{OBS}, v AS (SELECT *, CASE WHEN band BETWEEN 1 AND 8 THEN 40 ELSE 0 END + CASE WHEN classification_status = 'explicit_band' THEN 30 ELSE 0 END + 20 + CASE WHEN source_id % 2 = 0 THEN 5 ELSE 0 END AS score FROM obs),"
    f" k AS (SELECT job_id, source_id, l_orderkey, row_number() OVER (PARTITION BY council_key, trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g')), job_id % 50, period, salary_lo ORDER BY score DESC, {SEQ}, job_id) AS nth FROM v) SELECT job_id, l_orderkey FROM k WHERE nth = 1"
)
def exact_vacancy_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best of the rows that are the same vacancy."""
    return dedupe.best_of_exact(_vacancies(spark, sf_dir), "seq", ["job_id", "seq"]).select("job_id", F.col("seq.l_orderkey").alias("l_orderkey"))


@query(
    f"{OBS}, k AS (SELECT job_id, l_orderkey, row_number() OVER (PARTITION BY council_key, trim(regexp_replace(lower(title), '[^a-z0-9]+', ' ', 'g')), job_id % 50, period, salary_lo ORDER BY {SEQ}, job_id) AS nth FROM obs) SELECT job_id, l_orderkey FROM k WHERE nth = 1"
)
def explore_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of the rows that are the same vacancy, as the explorer shows them."""
    return explore.distinct_listings(_vacancies(spark, sf_dir), "seq", ["job_id", "seq"]).select("job_id", F.col("seq.l_orderkey").alias("l_orderkey"))


@query(None)
def mirror_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vacancies without exact, same-page and mirrored duplicates."""
    rows = _vacancies(spark, sf_dir).groupBy("job_id").agg(F.max_by(F.struct("*"), "seq").alias("r")).select("r.*").withColumn("seq", F.col("job_id"))
    return dedupe.dedupe(rows, "seq").select("job_id", "council_key", "job_title", "job_url")


@query(LATEST + "SELECT job_id, concat('$', format('{:,}', salary_lo), '-$', format('{:,}', salary_hi), CASE WHEN period = '' THEN '' ELSE concat('/', period) END) AS label FROM snap WHERE salary_hi > salary_lo")
def money_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pay as text."""
    jobs = snapshot(spark, sf_dir, "salary_lo", "salary_hi", "period").where("salary_hi > salary_lo")
    return jobs.select("job_id", money.range_label(F.col("salary_lo").cast("double"), F.col("salary_hi").cast("double"), F.col("period")).alias("label"))


@query(LATEST + "SELECT job_id, observed_at FROM snap WHERE CAST(observed_at AS DATE) >= date_trunc('month', DATE '1998-06-15') - INTERVAL 2 MONTH")
def date_range_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings from the quarter that ends with a month on."""
    jobs = snapshot(spark, sf_dir, "council_key").withColumn("job_date", F.to_date("observed_at"))
    return explore.searched(jobs, explore.State(range="quarter", reference="1998-06-15")).select("job_id", "observed_at")


@query(LATEST + "SELECT job_id, title FROM snap WHERE contains(lower(concat_ws(' ', title, council_key)), 'blue') AND contains(lower(concat_ws(' ', title, council_key)), 'an')")
def token_and_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings that hold all words of a query."""
    return snapshot(spark, sf_dir, "title", "council_key").where(explore.has_tokens(explore.search_text("title", "council_key"), "an BLUE")).select("job_id", "title")


@query(LATEST + "SELECT job_id, council_key, title, CAST(rank() OVER (ORDER BY lower(council_key), lower(title)) AS BIGINT) AS place FROM snap")
def explore_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings in the explorer's order, with their places in it; those that sort alike share the first."""
    # written before it is numbered, so that all that reads the numbers sees the same ranges
    rows = written(explore.listed(snapshot(spark, sf_dir, "title", "council_key")).select("job_id", "council_key", "title"))
    placed = rows.withColumn("id", F.monotonically_increasing_id()).withColumn("part", F.shiftright("id", 33))
    counts = placed.groupBy("part").count()
    before = counts.alias("x").join(counts.alias("y"), F.col("y.part") < F.col("x.part"), "left").groupBy(F.col("x.part").alias("part")).agg(F.coalesce(F.sum("y.count"), F.lit(0)).alias("before"))
    numbered = placed.join(before, "part").withColumn("nth", F.col("before") + F.col("id").bitwiseAND((1 << 33) - 1) + 1)
    first = numbered.groupBy("council_key", "title").agg(F.min("nth").alias("place"))
    return numbered.join(first, ["council_key", "title"]).select("job_id", "council_key", "title", "place")


@query(
    LATEST + "SELECT job_id, concat('<item><guid>', job_id, '</guid><title>', replace(title, '&', '&amp;'), ' - ', council_key, ' &amp; Co</title><link>https://jobs.example/', job_id, '</link><description><![CDATA[<p><strong>Council:</strong> ', council_key, ' & Co</p><p><strong>Status:</strong> ',"
    " CASE classification_status WHEN '' THEN 'unclassified' ELSE classification_status END, '</p><p><strong>Band:</strong> ', band, '</p>]]></description><pubDate>', strftime(CAST(observed_at AS DATE), '%a, %d %b %Y 00:00:00 +0000'), '</pubDate></item>') AS item FROM snap ORDER BY council_key, title, job_id LIMIT 250"
)
def rss_top250(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 250 listings as feed items."""
    from adlens.operators import board

    return board.rss_items(snapshot(spark, sf_dir, "council_key", "title", "band", "classification_status").withColumns({"url": F.concat(F.lit("https://jobs.example/"), F.col("job_id").cast("string")), "council_name": F.concat("council_key", F.lit(" & Co"))}))


@query(
    "WITH s AS (SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey), f AS (SELECT n_name AS spatial_key, min(s_suppkey) AS source_id FROM s GROUP BY 1)"
    " SELECT spatial_key, s_name AS short_name, CASE WHEN spatial_key IN ('FRANCE', 'CHINA') THEN 'Metropolitan' ELSE 'Regional' END AS council_category FROM f JOIN s ON s_suppkey = source_id"
)
def council_dim_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first source of each council."""
    from adlens.operators import board

    s, n = lens.table(spark, sf_dir, "supplier"), lens.table(spark, sf_dir, "nation")
    sources = s.join(n, s.s_nationkey == n.n_nationkey).select("s_suppkey", F.col("n_name").alias("council_key"), F.col("s_name").alias("short_name"), F.lit("").alias("council_name"))
    return board.councils(sources, ("FRANCE", "CHINA"), "s_suppkey").select("spatial_key", "short_name", "council_category")


@query(
    "WITH l AS (SELECT n_name AS k, max(s_suppkey) AS source_id FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 5 <> 0 GROUP BY 1)"
    " SELECT c_custkey, coalesce(CAST(l.source_id AS VARCHAR), concat('seed-', substr(sha256(lower(trim(regexp_replace(upper(n_name), '[^A-Z0-9]+', ' ', 'g')))), 1, 16))) AS source_id FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN l ON l.k = n_name"
)
def seed_source_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed rows with the last source of their name, or one of their own."""
    from adlens.sources import files

    s, n, c = (lens.table(spark, sf_dir, x) for x in ("supplier", "nation", "customer"))
    sources = s.where("s_suppkey % 5 <> 0").join(n, s.s_nationkey == n.n_nationkey).select(F.col("s_suppkey").cast("string").alias("source_id"), F.col("n_name").alias("short_name"), F.lit("").alias("council_name"), F.col("s_suppkey").alias("seq"))
    seed = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", F.col("n_name").alias("short_name"), F.lit("").alias("council_name"))
    return files.seed_sources(seed, sources, "seq").select("c_custkey", "source_id")


@query("SELECT CAST(p_partkey AS BIGINT) AS p_partkey, substr(sha256(concat(lower(p_name), chr(31), lower(p_brand))), 1, 20) AS h FROM part")
def stable_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys from hashed parts."""
    return lens.table(spark, sf_dir, "part").select("p_partkey", text.stable_hash(F.col("p_name"), F.lit(None).cast("string"), F.col("p_brand")).alias("h"))
