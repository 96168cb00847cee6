"""Queries over candidates of strategies: judged rows, measures, choices, drift, rules and health."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.operators import strategy
from adlens.plans import lens
from adlens.plans.registry import query



def _metrics(rows: str, name: str) -> str:
    """CTEs with the measures of each source's strategies."""
    return (
        f", {name}0 AS (SELECT source_id, strategy, strategy_index, count(*) AS candidate_count, count(*) FILTER (reason IS NULL) AS accepted_count, count(*) FILTER (reason IS NOT NULL) AS rejected_count,"
        " count(*) FILTER (reason IS NULL AND has_band) AS band_count, count(*) FILTER (reason IS NULL AND has_salary) AS salary_count, count(*) FILTER (reason IS NULL AND has_description) AS description_count,"
        f" count(*) FILTER (reason IS NULL AND has_closing) AS closing_count, bool_or(failed) AS failed, count(DISTINCT CASE WHEN reason IS NULL THEN concat(lower(title), '|', lower(url)) END) AS d FROM {rows} GROUP BY 1, 2, 3),"
        f" {name} AS (SELECT *, accepted_count - d AS duplicate_count, accepted_count * 45 + band_count * 18 + salary_count * 12 + description_count * 8 + closing_count * 5 - rejected_count * 45 - (accepted_count - d) * 20 - CASE WHEN failed THEN 100 ELSE 0 END AS score FROM {name}0) "
    )


def _chosen(measured: str, name: str) -> str:
    """A CTE with the best strategy of each source."""
    return (
        f", {name}1 AS (SELECT m.*, p.platform, p.preferred_strategy, p.last_good_count, p.last_good_score, row_number() OVER (PARTITION BY m.source_id ORDER BY"
        f" score + CASE WHEN strategy = preferred_strategy THEN 8 ELSE 0 END + CASE WHEN strategy IN ('known_endpoint', 'discovered_endpoint') AND accepted_count > 0 THEN 5 ELSE 0 END DESC, strategy_index) AS nth FROM {measured} m LEFT JOIN p USING (source_id)),"
        f" {name} AS (SELECT * FROM {name}1 WHERE nth = 1) "
    )


def _drift(chosen: str) -> str:
    """CTEs with the drift of what was chosen; the last, g, says who falls back."""
    return (
        ", f AS (SELECT *, list_filter([CASE WHEN failed THEN 'strategy_failed' END, CASE WHEN candidate_count >= 5 AND 2 * rejected_count > candidate_count THEN 'junk_inflation' END, CASE WHEN accepted_count > 50 THEN 'source_count_spike' END,"
        " CASE WHEN last_good_count >= 3 AND accepted_count > greatest(50, last_good_count * 4) THEN 'historical_count_spike' END, CASE WHEN last_good_count >= 5 AND accepted_count = 0 AND candidate_count >= 5 THEN 'historical_count_drop' END,"
        f" CASE WHEN candidate_count >= 10 AND 2 * duplicate_count > accepted_count THEN 'duplicate_inflation' END], lambda x: x IS NOT NULL) AS codes FROM {chosen}),"
        " h AS (SELECT *, len(list_filter(codes, lambda x: x IN ('junk_inflation', 'source_count_spike', 'historical_count_spike', 'historical_count_drop') OR (x = 'strategy_failed' AND last_good_count > 0))) > 0 AS severe FROM f),"
        " g AS (SELECT *, severe OR (failed AND last_good_count > 0) AS fallback_used, CASE WHEN failed AND accepted_count = 0 THEN 'failed' WHEN severe THEN 'degraded' ELSE 'ok' END AS status FROM h) "
    )


JUDGED = f"WITH j AS ({lens.JUDGED_SQL}) "
METRICS = JUDGED + _metrics("j", "m")
CHOSEN = METRICS + f", p AS ({lens.PROFILES_SQL})" + _chosen("m", "c")
DRIFT = CHOSEN + _drift("c")
#: Orders as sources: strategies compared by the sources' own rules, the chosen one's rows judged by all.
CONTEST = (
    f"WITH p AS ({lens.ORDER_PROFILES_SQL}), j0 AS ({lens.judged_sql(lens.ORDER_CANDIDATES_SQL, by_all=False)})" + _metrics("j0", "a") + _chosen("a", "b")
    + f", j AS (SELECT x.* FROM ({lens.judged_sql(lens.ORDER_CANDIDATES_SQL)}) x SEMI JOIN b ON b.source_id = x.source_id AND b.strategy = x.strategy)" + _metrics("j", "m") + _chosen("m", "c") + _drift("c")
)


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strategy.judged(lens.candidates(spark, sf_dir), lens.global_rules(spark, sf_dir), lens.source_rules(spark, sf_dir))


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strategy.drift(strategy.choose(strategy.metrics(judged(spark, sf_dir)), lens.profiles(spark, sf_dir)))


@query(JUDGED + "SELECT coalesce(reason, 'accepted') AS reason, strategy, count(*) AS n FROM j GROUP BY 1, 2")
def reject_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and rejected candidates by reason and strategy."""
    return judged(spark, sf_dir).groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason"), "strategy").agg(F.count("*").alias("n"))


@query(JUDGED + "SELECT source_id, title, count(*) AS n FROM j WHERE reason IN ('global_reject_title', 'source_reject_title') GROUP BY 1, 2")
def reject_rule_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates that a rule rejects by title."""
    return judged(spark, sf_dir).where(F.col("reason").endswith("_reject_title")).groupBy("source_id", "title").agg(F.count("*").alias("n"))


@query(METRICS + "SELECT source_id, strategy, candidate_count, accepted_count, rejected_count, duplicate_count, band_count, salary_count, description_count, closing_count, CAST(score AS BIGINT) AS score FROM m")
def strategy_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each strategy of each source found, and its score."""
    return strategy.metrics(judged(spark, sf_dir)).select("source_id", "strategy", "candidate_count", "accepted_count", "rejected_count", "duplicate_count", "band_count", "salary_count", "description_count", "closing_count", "score")


@query(CHOSEN + "SELECT source_id, strategy, CAST(score AS BIGINT) AS score, accepted_count FROM c")
def choose_strategy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best strategy of each source."""
    return strategy.choose(strategy.metrics(judged(spark, sf_dir)), lens.profiles(spark, sf_dir)).select("source_id", "strategy", "score", "accepted_count")


@query(DRIFT + "SELECT source_id, array_to_string(codes, ',') AS codes, severe, fallback_used, status FROM g")
def drift_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift of each source against its baseline, and whether it falls back."""
    return health(spark, sf_dir).select("source_id", F.array_join(F.transform("drift_flags", lambda f: f["code"]), ",").alias("codes"), "severe", "fallback_used", "status")


def contest(spark: SparkSession, sf_dir: str) -> strategy.Contest:
    profiles = lens.order_profiles(spark, sf_dir).withColumns({"last_good_run_id": F.lit("seed"), "failure_streak": F.lit(0), "health": F.lit("ok"), "quality_history": F.array().cast(HISTORY)})
    return strategy.contest(lens.order_candidates(spark, sf_dir), profiles, lens.global_rules(spark, sf_dir), lens.source_rules(spark, sf_dir), "r1", "strategy_index", "l_suppkey", "l_extendedprice", "title", "url")


HISTORY = "array<struct<run_id:string,strategy:string,accepted_count:bigint,score:bigint,codes:string>>"


@query(CONTEST + "SELECT j.source_id, j.strategy, count(*) AS n FROM j JOIN g ON g.source_id = j.source_id AND g.strategy = j.strategy WHERE j.reason IS NULL AND NOT g.fallback_used GROUP BY 1, 2")
def emitted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows each source adds to the log."""
    return contest(spark, sf_dir).rows.groupBy("source_id", "strategy").agg(F.count("*").alias("n"))


@query(
    CONTEST + "SELECT j.source_id, j.strategy, title, url, CASE WHEN j.strategy IN ('known_endpoint', 'discovered_endpoint') THEN 'endpoint_json' WHEN j.strategy = 'json_ld' THEN 'json_ld' ELSE 'detail_html' END AS of_title,"
    " CASE WHEN has_document THEN 'pdf_or_docx' WHEN j.strategy IN ('known_endpoint', 'discovered_endpoint') THEN 'endpoint_json' WHEN j.strategy = 'json_ld' THEN 'json_ld' ELSE 'detail_html' END AS of_band, j.strategy AS of_strategy"
    " FROM j JOIN g ON g.source_id = j.source_id AND g.strategy = j.strategy WHERE j.reason IS NULL AND NOT g.fallback_used"
)
def contest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that a run of all strategies adds to the log, with their evidence."""
    of = lambda f: F.col("field_evidence")[f].alias(f"of_{f}")
    return contest(spark, sf_dir).rows.select("source_id", "strategy", "title", "url", of("title"), of("band"), of("strategy"))


@query(CONTEST + "SELECT source_id, strategy, accepted_count, rejected_count, CAST(score AS BIGINT) AS score, array_to_string(codes, ',') AS codes, fallback_used, status FROM g")
def contest_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each source's chosen strategy came to in the contest."""
    return contest(spark, sf_dir).health.select("source_id", "strategy", "accepted_count", "rejected_count", "score", F.array_join(F.transform("drift_flags", lambda f: f["code"]), ",").alias("codes"), "fallback_used", "status")


@query(
    CONTEST + "SELECT p.source_id, CASE WHEN g.source_id IS NOT NULL AND NOT severe AND accepted_count > 0 AND (p.last_good_score = 0 OR score >= p.last_good_score) THEN strategy ELSE p.preferred_strategy END AS preferred_strategy,"
    " CASE WHEN g.source_id IS NOT NULL AND NOT severe THEN accepted_count ELSE p.last_good_count END AS last_good_count, CASE WHEN severe THEN 1 ELSE 0 END AS failure_streak FROM p LEFT JOIN g USING (source_id)"
)
def contest_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is remembered of each source after the contest."""
    return contest(spark, sf_dir).profiles.select("source_id", "preferred_strategy", "last_good_count", "failure_streak")


#: All orders as sources, also those without lines: each has tried a platform's strategy, every seventh in vain, besides those it has candidates of.
_ZERO = (
    CONTEST.split(", a0 AS ")[0] + _metrics("j0", "s") + ", t AS (SELECT source_id, strategy, strategy_index, max(failed) AS f FROM (SELECT DISTINCT source_id, strategy, strategy_index, false AS failed FROM j0 UNION ALL SELECT o_orderkey, 'platform:generic_html', 10, o_orderkey % 7 = 0 FROM orders) GROUP BY 1, 2, 3)"
)


def _zeros(measured: str, tried: str, name: str) -> str:
    """A CTE with the measures of all that was tried."""
    counts = "candidate_count accepted_count rejected_count band_count salary_count description_count closing_count duplicate_count".split()
    zero = ", ".join(f"coalesce({c}, 0) AS {c}" for c in counts)
    return f", {name} AS (SELECT t.source_id, t.strategy, t.strategy_index, {zero}, coalesce(failed, false) OR f AS failed, CASE WHEN score IS NULL THEN 0 ELSE score END - CASE WHEN f AND NOT coalesce(failed, false) THEN 100 ELSE 0 END AS score FROM {tried} t LEFT JOIN {measured} x USING (source_id, strategy, strategy_index)) "


ALL_SOURCES = (
    _ZERO + _zeros("s", "t", "a") + _chosen("a", "b") + f", j AS (SELECT x.* FROM ({lens.judged_sql(lens.ORDER_CANDIDATES_SQL)}) x SEMI JOIN b ON b.source_id = x.source_id AND b.strategy = x.strategy)" + _metrics("j", "m0")
    + ", t2 AS (SELECT t.* FROM t SEMI JOIN b ON b.source_id = t.source_id AND b.strategy = t.strategy)" + _zeros("m0", "t2", "m") + _chosen("m", "c") + _drift("c")
)


def all_sources(spark: SparkSession, sf_dir: str) -> strategy.Contest:
    orders, rows = lens.table(spark, sf_dir, "orders"), lens.order_candidates(spark, sf_dir)
    tried = rows.select("source_id", "strategy", "strategy_index", F.lit(False).alias("failed")).distinct()
    own = orders.select(F.col("o_orderkey").alias("source_id"), F.lit("platform:generic_html").alias("strategy"), F.lit(10).cast("long").alias("strategy_index"), (F.col("o_orderkey") % 7 == 0).alias("failed"))
    profiles = lens.order_profiles(spark, sf_dir).withColumns({"last_good_run_id": F.lit("seed"), "failure_streak": F.lit(2), "health": F.lit("degraded"), "quality_history": F.array().cast(HISTORY)})
    return strategy.contest(rows, profiles, lens.global_rules(spark, sf_dir), lens.source_rules(spark, sf_dir), "r1", "strategy_index", "l_suppkey", "l_extendedprice", "title", "url", attempts=tried.unionByName(own))


@query(ALL_SOURCES + "SELECT source_id, strategy, candidate_count, accepted_count, CAST(score AS BIGINT) AS score, array_to_string(codes, ',') AS codes, fallback_used, status FROM g")
def contest_of_all_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health of every source that was tried, measured as zero where nothing has a candidate."""
    return all_sources(spark, sf_dir).health.select("source_id", "strategy", "candidate_count", "accepted_count", "score", F.array_join(F.transform("drift_flags", lambda f: f["code"]), ",").alias("codes"), "fallback_used", "status")


@query(
    ALL_SOURCES + "SELECT p.source_id, CASE WHEN NOT severe AND accepted_count > 0 AND (p.last_good_score = 0 OR score >= p.last_good_score) THEN strategy ELSE p.preferred_strategy END AS preferred_strategy,"
    " CASE WHEN NOT severe THEN accepted_count ELSE p.last_good_count END AS last_good_count, CASE WHEN severe THEN 3 ELSE 0 END AS failure_streak, CASE WHEN severe THEN 'degraded' ELSE 'ok' END AS health FROM p JOIN g USING (source_id)"
)
def contest_resets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is remembered of every source: one that found nothing starts from zero again, unless that is severe."""
    return all_sources(spark, sf_dir).profiles.select("source_id", "preferred_strategy", "last_good_count", "failure_streak", "health")


@query(
    DRIFT + ", r AS (SELECT j.*, row_number() OVER (PARTITION BY j.source_id ORDER BY j.l_orderkey, j.l_extendedprice, j.title, j.url) AS k FROM j JOIN g ON g.source_id = j.source_id AND g.strategy = j.strategy WHERE j.reason IS NOT NULL)"
    " SELECT source_id, strategy, reason, title, url FROM r WHERE k <= 200 UNION ALL SELECT source_id, strategy, 'severe_drift', '', '' FROM g WHERE severe AND rejected_count = 0"
)
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows set aside, and sources whose rows were dropped whole."""
    return strategy.quarantine(judged(spark, sf_dir), health(spark, sf_dir), "l_orderkey", "l_extendedprice", "title", "url")


@query(
    DRIFT + ", r AS (SELECT j.*, row_number() OVER (PARTITION BY j.source_id ORDER BY j.l_orderkey, j.l_extendedprice, j.title, j.url) AS k FROM j JOIN g ON g.source_id = j.source_id AND g.strategy = j.strategy WHERE j.reason IS NOT NULL),"
    " q AS (SELECT source_id, reason, title, url FROM r WHERE k <= 200 UNION ALL SELECT source_id, 'severe_drift', NULL, concat('https://s.example/', source_id) FROM g WHERE severe AND rejected_count = 0)"
    " SELECT q.source_id, reason, title, url, n_name AS council_name, CASE WHEN failed THEN 'failed' ELSE 'ok' END AS strategy_status, array_to_string(codes, ',') AS codes, CASE WHEN reason = 'severe_drift' THEN candidate_count END AS candidates"
    " FROM q JOIN g USING (source_id) JOIN supplier ON s_suppkey = q.source_id JOIN nation ON n_nationkey = s_nationkey"
)
def quarantine_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is set aside, with its source and nested evidence."""
    s, n = lens.table(spark, sf_dir, "supplier"), lens.table(spark, sf_dir, "nation")
    sources = s.join(n, s.s_nationkey == n.n_nationkey).select(F.col("s_suppkey").alias("source_id"), F.upper("n_name").alias("council_key"), F.col("n_name").alias("council_name"), F.lit("p").alias("platform"), F.concat(F.lit("https://s.example/"), F.col("s_suppkey").cast("string")).alias("url"))
    found = health(spark, sf_dir)
    rows = strategy.audited(strategy.quarantine(judged(spark, sf_dir), found, "l_orderkey", "l_extendedprice", "title", "url"), found, sources, "r1", "2026-01-01T00:00:00Z")
    return rows.select("source_id", "reason", "title", "url", "council_name", "evidence.strategy_status", F.array_join("evidence.drift_flags", ",").alias("codes"), F.col("evidence.candidate_count").alias("candidates"))


@query(
    JUDGED + f", p AS ({lens.PROFILES_SQL}), w AS (SELECT lower(title) AS title, count(DISTINCT source_id) AS sources, count(DISTINCT platform) AS platforms FROM j JOIN p USING (source_id) WHERE reason = 'weak_vacancy_signal' AND title <> '' GROUP BY 1)"
    f" SELECT * FROM w WHERE (sources >= 3 OR platforms >= 2) AND title NOT IN (SELECT {lens.GLOBAL_RULE} FROM nation)"
)
def global_rule_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles that many sources reject and no rule names yet."""
    rejected = judged(spark, sf_dir).where("reason is not null").join(lens.profiles(spark, sf_dir).select("source_id", "platform"), "source_id")
    return strategy.mined_global_rules(rejected, lens.global_rules(spark, sf_dir))


@query(JUDGED + "SELECT source_id, lower(title) AS title, count(*) AS n FROM j WHERE reason IS NOT NULL AND title <> '' GROUP BY 1, 2 HAVING count(*) >= 3")
def source_rule_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles that one source rejects again and again."""
    return strategy.mined_source_rules(judged(spark, sf_dir).where("reason is not null"))


@query(
    DRIFT + ", b2 AS (SELECT platform, count(*) AS sources, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'degraded') AS degraded, count(*) FILTER (status = 'failed') AS failed, CAST(sum(candidate_count) AS BIGINT) AS candidate_count, CAST(sum(accepted_count) AS BIGINT) AS accepted_count FROM g GROUP BY 1),"
    " s AS (SELECT platform, string_agg(concat(strategy, '=', n), ',' ORDER BY concat(strategy, '=', n)) AS chosen_strategies FROM (SELECT platform, strategy, count(*) AS n FROM g GROUP BY 1, 2) GROUP BY 1),"
    " k AS (SELECT platform, string_agg(concat(code, '=', n), ',' ORDER BY concat(code, '=', n)) AS drift_codes FROM (SELECT platform, code, count(*) AS n FROM (SELECT platform, unnest(codes) AS code FROM g) GROUP BY 1, 2) GROUP BY 1)"
    " SELECT b2.*, chosen_strategies, coalesce(drift_codes, '') AS drift_codes FROM b2 LEFT JOIN s USING (platform) LEFT JOIN k USING (platform)"
)
def platform_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health of the sources of each platform."""
    return strategy.platform_health(health(spark, sf_dir)).select("platform", "sources", "ok", "degraded", "failed", "candidate_count", "accepted_count", "chosen_strategies", "drift_codes")


@query(
    DRIFT + "SELECT p.source_id, CASE WHEN g.source_id IS NOT NULL AND NOT severe AND accepted_count > 0 AND (p.last_good_score = 0 OR score >= p.last_good_score) THEN strategy ELSE p.preferred_strategy END AS preferred_strategy,"
    " CASE WHEN g.source_id IS NOT NULL AND NOT severe THEN accepted_count ELSE p.last_good_count END AS last_good_count, CASE WHEN severe THEN 1 ELSE 0 END AS failure_streak FROM p LEFT JOIN g USING (source_id)"
)
def profile_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles of the sources after a run."""
    old = lens.profiles(spark, sf_dir).withColumns({"last_good_run_id": F.lit("seed"), "failure_streak": F.lit(0), "health": F.lit("ok"), "quality_history": F.array().cast(HISTORY)})
    return strategy.updated_profiles(old, health(spark, sf_dir), "r1").select("source_id", "preferred_strategy", "last_good_count", "failure_streak")


@query(
    "WITH e AS (SELECT l_suppkey AS source_id, concat('https://API.example/', CAST(l_partkey % 30 AS VARCHAR)) AS url, l_linenumber = 1 AS confirmed, CAST(l_partkey % 30 AS BIGINT) AS score FROM lineitem),"
    " s AS (SELECT source_id, lower(url) AS low, min(url) AS s_url, bool_or(confirmed) AS confirmed, max(score) AS s_score FROM e GROUP BY 1, 2),"
    " k AS (SELECT s_suppkey AS source_id, concat('https://api.example/', CAST(i AS VARCHAR)) AS url, CASE WHEN i % 2 = 0 THEN 'accepted' ELSE 'candidate' END AS status FROM supplier, range(25, 35) t(i)),"
    " m AS (SELECT coalesce(k.source_id, s.source_id) AS source_id, coalesce(url, s_url) AS url, CASE WHEN coalesce(confirmed, false) OR status = 'accepted' THEN 'accepted' ELSE 'candidate' END AS status, CASE WHEN k.url IS NOT NULL THEN 'r0' ELSE 'r1' END AS first_seen_at, CASE WHEN s_url IS NOT NULL THEN 'r1' ELSE 'r0' END AS last_seen_at,"
    " CASE WHEN coalesce(confirmed, false) THEN s_score ELSE 0 END AS last_score FROM k FULL JOIN s ON k.source_id = s.source_id AND lower(k.url) = low)"
    " SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY status <> 'accepted', url) AS nth FROM m) WHERE nth <= 12"
)
def endpoint_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known endpoints of each source after those of a run are merged in."""
    seen = lens.table(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS source_id", "concat('https://API.example/', cast(l_partkey % 30 AS string)) AS url", "l_linenumber = 1 AS confirmed", "l_partkey % 30 AS score")
    known = lens.table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS source_id", "explode(sequence(25L, 34L)) AS i").selectExpr("source_id", "concat('https://api.example/', cast(i AS string)) AS url", "CASE WHEN i % 2 = 0 THEN 'accepted' ELSE 'candidate' END AS status", "'r0' AS first_seen_at", "'r0' AS last_seen_at", "0L AS last_score")
    return strategy.merged_endpoints(known, seen, F.lit("r1"))


@query(
    "WITH a AS (SELECT l_suppkey AS source_id, concat('HTTPS://h.example/', CAST(l_partkey % 40 AS VARCHAR)) AS url, CASE WHEN l_linenumber = 1 THEN 0 ELSE 1 END AS later, l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem),"
    " f AS (SELECT *, row_number() OVER (PARTITION BY source_id, lower(url) ORDER BY later, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS n1 FROM a),"
    " t AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY later, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS n2 FROM f WHERE n1 = 1) SELECT source_id, url, l_orderkey FROM t WHERE n2 <= 12"
)
def endpoint_hint_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source's first hints, those of the selected strategy before others'."""
    hints = lens.table(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS source_id", "concat('HTTPS://h.example/', cast(l_partkey % 40 AS string)) AS url", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return strategy.merged_hints(hints.where("l_linenumber = 1"), hints.where("l_linenumber <> 1"), "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice").select("source_id", "url", "l_orderkey")


@query(DRIFT + "SELECT count(*) AS sources, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'degraded') AS degraded, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (fallback_used) AS fallback_used FROM g")
def health_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health of all sources in one row."""
    return strategy.health_summary(health(spark, sf_dir))
