"""The contest of extraction strategies for each source: accept or reject rows, measure, choose, watch for drift, learn rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Points of a strategy, bonuses, and limits.
POINTS = {"accepted": 45, "band": 18, "salary": 12, "description": 8, "closing": 5, "rejected": -45, "duplicate": -20}
PREFERRED, ENDPOINT, FAILED = 8, 5, -100
ENDPOINTS = ("known_endpoint", "discovered_endpoint")
SOURCE_LIMIT, QUARANTINE_LIMIT, ENDPOINT_LIMIT = 50, 200, 12
#: Entries of a profile's history that a run reads, and that it writes at most.
READ_HISTORY, KEPT_HISTORY = 12, 20


def judged(candidates: DataFrame, global_rules: DataFrame, source_rules: DataFrame) -> DataFrame:
    """candidates (source_id, strategy, title, paid, probable, …) with `reason`, null where accepted.

    global_rules has title; source_rules source_id and title; titles in lower case.
    """
    g = global_rules.select(F.lower("title").alias("g_title")).distinct()
    s = source_rules.select(F.col("source_id").alias("s_source"), F.lower("title").alias("s_title")).distinct()
    title = F.lower("title")
    joined = candidates.join(g, title == F.col("g_title"), "left").join(s, (F.col("source_id") == F.col("s_source")) & (title == F.col("s_title")), "left")
    named = F.col("title") != ""
    reason = (
        F.when(named & F.col("g_title").isNotNull(), "global_reject_title").when(named & F.col("s_title").isNotNull(), "source_reject_title").when(~F.col("paid"), "missing_salary_or_band").when(~F.col("probable"), "weak_vacancy_signal")
    )
    return joined.withColumn("reason", reason).drop("g_title", "s_source", "s_title")


def metrics(rows: DataFrame, attempts: DataFrame | None = None) -> DataFrame:
    """Per source and strategy (index): counts, rates and score. rows have reason, title, url, and the flags has_* and failed.

    attempts (source_id, strategy, strategy_index, failed) are all that were tried: those without rows count as zeros, and
    what was not tried doesn't count.
    """
    ok = F.col("reason").isNull()
    flags = {f"{f}_count": F.count_if(ok & F.col(f"has_{f}")) for f in ("band", "salary", "description", "closing")}
    m = rows.groupBy("source_id", "strategy", "strategy_index").agg(
        F.count("*").alias("candidate_count"),
        F.count_if(ok).alias("accepted_count"),
        F.count_if(~ok).alias("rejected_count"),
        F.countDistinct(F.when(ok, F.struct(F.lower("title"), F.lower("url")))).alias("distinct_"),
        *[c.alias(n) for n, c in flags.items()],
        F.max("failed").alias("failed"),
    )
    if attempts is not None:
        keys = ["source_id", "strategy", "strategy_index"]
        tried = attempts.groupBy(*keys).agg(F.max("failed").alias("tried_failed_"))
        counts = [c for c in m.columns if c not in (*keys, "failed")]
        failed = F.coalesce("failed", F.lit(False)) | F.coalesce("tried_failed_", F.lit(False))
        m = tried.join(m, keys, "left").select(*keys, *[F.coalesce(c, F.lit(0)).alias(c) for c in counts], failed.alias("failed"))
    m = m.withColumn("duplicate_count", F.greatest(F.lit(0), F.col("accepted_count") - F.col("distinct_"))).drop("distinct_")
    score = sum((F.col(f"{n}_count") * p for n, p in POINTS.items()), F.lit(0)) + F.when(F.col("failed"), FAILED).otherwise(0)
    rate = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return m.withColumns({"score": score, "junk_rate": rate(F.col("rejected_count"), F.col("candidate_count")), "duplicate_rate": rate(F.col("duplicate_count"), F.col("accepted_count"))})


def choose(measured: DataFrame, profiles: DataFrame) -> DataFrame:
    """The best strategy of each source, with the source's profile (preferred_strategy, last_good_count, …); ties go to the earliest."""
    joined = measured.join(profiles, "source_id", "left")
    bonus = F.when(F.col("strategy") == F.col("preferred_strategy"), PREFERRED).otherwise(0) + F.when(F.col("strategy").isin(*ENDPOINTS) & (F.col("accepted_count") > 0), ENDPOINT).otherwise(0)
    best = Window.partitionBy("source_id").orderBy(F.desc("total"), "strategy_index")
    return joined.withColumn("total", F.col("score") + bonus).withColumn("nth_", F.row_number().over(best)).where("nth_ = 1").drop("nth_", "total")


def _flags() -> list[tuple[str, Column, Column]]:
    n, c = F.col("accepted_count"), F.col("candidate_count")
    base = F.coalesce("last_good_count", F.lit(0))
    severe = F.lit("severe")
    return [
        ("strategy_failed", F.col("failed"), F.when(base > 0, "severe").otherwise("moderate")),
        ("junk_inflation", (c >= 5) & (2 * F.col("rejected_count") > c), severe),
        ("source_count_spike", n > SOURCE_LIMIT, severe),
        ("historical_count_spike", (base >= 3) & (n > F.greatest(F.lit(SOURCE_LIMIT), base * 4)), severe),
        ("historical_count_drop", (base >= 5) & (n == 0) & (c >= 5), severe),
        ("duplicate_inflation", (c >= 10) & (2 * F.col("duplicate_count") > n), F.lit("moderate")),
    ]


def drift(chosen: DataFrame) -> DataFrame:
    """chosen with drift_flags (code, severity), severe, fallback_used and status."""
    flags = F.array_compact(F.array(*[F.when(when, F.struct(F.lit(code).alias("code"), how.alias("severity"))) for code, when, how in _flags()]))
    out = chosen.withColumn("drift_flags", flags).withColumn("severe", F.exists("drift_flags", lambda f: f["severity"] == "severe"))
    fallback = F.col("severe") | F.col("failed") & (F.coalesce("last_good_count", F.lit(0)) > 0)
    nothing = F.col("failed") & (F.col("accepted_count") == 0)
    return out.withColumns({"fallback_used": fallback, "status": F.when(nothing, "failed").when(F.col("severe"), "degraded").otherwise("ok")})


def emitted(rows: DataFrame, health: DataFrame) -> DataFrame:
    """The accepted rows of each source's chosen strategy; none where it fell back."""
    return rows.where("reason is null").join(health.where("not fallback_used").select("source_id", "strategy"), ["source_id", "strategy"], "left_semi")


def updated_profiles(profiles: DataFrame, health: DataFrame, run_id: str, read: int = READ_HISTORY) -> DataFrame:
    """Profiles after a run. Severe drift keeps the baseline; a strategy becomes preferred only if it is no worse than the last good one (a score of 0 or none being no bar).

    A run reads the last `read` entries of a history and adds its own; 20 are kept at most.
    """
    h = health.select("source_id", F.col("strategy"), "accepted_count", F.col("score"), "severe", F.array_join(F.transform("drift_flags", lambda f: f["code"]), ",").alias("codes"))
    j = profiles.join(h, "source_id", "full")
    ran, good = F.col("score").isNotNull(), F.col("score").isNotNull() & ~F.col("severe")
    better = good & (F.col("accepted_count") > 0) & ((F.coalesce("last_good_score", F.lit(0)) == 0) | (F.col("score") >= F.col("last_good_score")))
    entry = F.struct(F.lit(run_id).alias("run_id"), "strategy", "accepted_count", "score", "codes")
    history = F.coalesce("quality_history", F.array().cast("array<struct<run_id:string,strategy:string,accepted_count:bigint,score:bigint,codes:string>>"))
    past = min(read, KEPT_HISTORY - 1)
    kept = F.slice(history, F.greatest(F.size(history) - past + 1, F.lit(1)), past)
    return j.select(
        "source_id",
        F.when(better, F.col("strategy")).otherwise(F.col("preferred_strategy")).alias("preferred_strategy"),
        F.when(good, F.col("accepted_count")).otherwise(F.col("last_good_count")).alias("last_good_count"),
        F.when(good, F.col("score")).otherwise(F.col("last_good_score")).alias("last_good_score"),
        F.when(good, F.lit(run_id)).otherwise(F.col("last_good_run_id")).alias("last_good_run_id"),
        F.when(~ran, F.col("failure_streak")).when(F.col("severe"), F.coalesce("failure_streak", F.lit(0)) + 1).otherwise(0).alias("failure_streak"),
        F.when(~ran, F.col("health")).when(F.col("severe"), "degraded").otherwise("ok").alias("health"),
        F.when(ran, F.concat(kept, F.array(entry))).otherwise(history).alias("quality_history"),
    )


def quarantine(rows: DataFrame, health: DataFrame, *seq: str) -> DataFrame:
    """Up to 200 rejected rows of each source's chosen strategy, and one row for severe drift that rejected nothing."""
    chosen = rows.where("reason is not null").join(health.select("source_id", "strategy"), ["source_id", "strategy"], "left_semi")
    first = Window.partitionBy("source_id").orderBy(*seq)
    some = chosen.withColumn("nth_", F.row_number().over(first)).where(F.col("nth_") <= QUARANTINE_LIMIT).select("source_id", "strategy", "reason", "title", "url")
    whole = health.where(F.col("severe") & (F.col("rejected_count") == 0)).select("source_id", "strategy", F.lit("severe_drift").alias("reason"), F.lit("").alias("title"), F.lit("").alias("url"))
    return some.unionByName(whole)


def audited(set_aside: DataFrame, health: DataFrame, sources: DataFrame, run_id: str, observed_at: str) -> DataFrame:
    """What ``quarantine`` sets aside as rows of the audit, with the run, the source and nested evidence: the strategy's status, the codes of drift, and how many candidates there were.

    sources: source_id, council_key, council_name, platform, url. A row for a whole source has no title and the source's address.
    """
    told = health.select("source_id", F.when(F.col("failed"), "failed").otherwise("ok").alias("strategy_status"), F.transform("drift_flags", lambda f: f["code"]).alias("drift_flags"), "candidate_count")
    own = sources.select("source_id", "council_key", "council_name", "platform", F.col("url").alias("source_url"))
    rows = set_aside.join(told, "source_id").join(own, "source_id", "left")
    whole = F.col("reason") == "severe_drift"
    evidence = F.struct("strategy_status", "drift_flags", F.when(whole, F.col("candidate_count")).alias("candidate_count"))
    return rows.select(
        F.lit(observed_at).alias("observed_at"), F.lit(run_id).alias("run_id"), "source_id", "council_key", "council_name", "platform", "strategy", "reason",
        F.when(~whole, F.col("title")).alias("title"), F.when(whole, F.col("source_url")).otherwise(F.col("url")).alias("url"), evidence.alias("evidence"),
    )


def mined_global_rules(rejected: DataFrame, rules: DataFrame) -> DataFrame:
    """Titles that three sources or two platforms reject as weak, and aren't rules yet: title, sources, platforms."""
    weak = rejected.where(F.col("reason").isin("weak_vacancy_signal", "quality_rejected") & (F.col("title") != ""))
    found = weak.groupBy(F.lower("title").alias("title")).agg(F.countDistinct("source_id").alias("sources"), F.countDistinct("platform").alias("platforms"))
    return found.where((F.col("sources") >= 3) | (F.col("platforms") >= 2)).join(rules.select(F.lower("title").alias("title")), "title", "left_anti")


def mined_source_rules(rejected: DataFrame) -> DataFrame:
    """Titles that one source has rejected three times in a run: source_id, title, n."""
    return rejected.where(F.col("title") != "").groupBy("source_id", F.lower("title").alias("title")).agg(F.count("*").alias("n")).where("n >= 3")


def merged_hints(selected: DataFrame, others: DataFrame, *seq: str) -> DataFrame:
    """A source's first twelve endpoint hints of different addresses, those of the selected strategy first."""
    both = selected.withColumn("later_", F.lit(0)).unionByName(others.withColumn("later_", F.lit(1))).where(F.col("url") != "")
    each = Window.partitionBy("source_id", F.lower("url")).orderBy("later_", *seq)
    firsts = both.withColumn("nth_", F.row_number().over(each)).where("nth_ = 1")
    return firsts.withColumn("nth_", F.row_number().over(Window.partitionBy("source_id").orderBy("later_", *seq))).where(F.col("nth_") <= ENDPOINT_LIMIT).drop("later_", "nth_")


def merged_endpoints(known: DataFrame, seen: DataFrame, at: Column) -> DataFrame:
    """Known endpoints after a run: first seen is kept, accepted stays accepted, the first twelve by status and address.

    known: source_id, url, status, first_seen_at, last_seen_at, last_score; seen: source_id, url, confirmed, score. Of seen
    addresses that differ in case alone the least is taken.
    """
    k = known.withColumn("low_", F.lower("url"))
    s = seen.groupBy("source_id", F.lower("url").alias("low_")).agg(F.min("url").alias("s_url"), F.max("confirmed").alias("confirmed"), F.max("score").alias("s_score"))
    j = k.join(s, ["source_id", "low_"], "full")
    new = F.col("s_url").isNotNull()
    sure = F.coalesce("confirmed", F.lit(False))
    merged = j.select(
        "source_id",
        F.coalesce("url", "s_url").alias("url"),
        F.when(sure | (F.col("status") == "accepted"), "accepted").otherwise("candidate").alias("status"),
        F.coalesce("first_seen_at", at).alias("first_seen_at"),
        F.when(new, at).otherwise(F.col("last_seen_at")).alias("last_seen_at"),
        F.when(sure, F.col("s_score")).otherwise(F.coalesce("last_score", F.lit(0))).alias("last_score"),
    )
    rank = Window.partitionBy("source_id").orderBy(F.col("status") != "accepted", "url")
    return merged.withColumn("nth_", F.row_number().over(rank)).where(F.col("nth_") <= ENDPOINT_LIMIT).drop("nth_")


def platform_health(health: DataFrame) -> DataFrame:
    """Per platform: sources by status, counts, coverage rates, and how often each strategy and drift flag occurs."""
    h = health.withColumn("platform", F.coalesce(F.nullif(F.col("platform"), F.lit("")), F.lit("unknown")))
    total = lambda c: F.sum(F.coalesce(c, F.lit(0))).alias(c)
    base = h.groupBy("platform").agg(
        F.count("*").alias("sources"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("ok", "degraded", "failed")],
        F.count_if("fallback_used").alias("fallback_used"),
        *[total(c) for c in ("candidate_count", "accepted_count", "rejected_count", "band_count", "salary_count", "description_count")],
    )
    named = lambda rows, name: rows.groupBy("platform").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "name", F.col("n").cast("string")))), ",").alias(name))
    strategies = named(h.groupBy("platform", F.coalesce("strategy", F.lit("unknown")).alias("name")).agg(F.count("*").alias("n")), "chosen_strategies")
    flags = named(h.select("platform", F.explode("drift_flags").alias("f")).groupBy("platform", F.col("f.code").alias("name")).agg(F.count("*").alias("n")), "drift_codes")
    rate = lambda a, b: F.bround(F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0)), 4)
    out = base.join(strategies, "platform", "left").join(flags, "platform", "left")
    return out.withColumns(
        {
            "status": F.when(F.col("degraded") + F.col("failed") > 0, "degraded").otherwise("ok"),
            "junk_rate": rate("rejected_count", "candidate_count"),
            "band_coverage": rate("band_count", "accepted_count"),
            "salary_coverage": rate("salary_count", "accepted_count"),
            "description_coverage": rate("description_count", "accepted_count"),
            "drift_codes": F.coalesce("drift_codes", F.lit("")),
        }
    )


def health_summary(health: DataFrame) -> DataFrame:
    """One row over all sources: how many are well, degraded or failed, and how many fell back."""
    is_ = lambda x: F.count_if(F.col("status") == x)
    return health.agg(F.count("*").alias("sources"), is_("ok").alias("ok"), is_("degraded").alias("degraded"), is_("failed").alias("failed"), F.count_if("fallback_used").alias("fallback_used"))


def health_report(health: DataFrame) -> DataFrame:
    """Sources in the order of a report: degraded ones first, then by id."""
    return health.orderBy(F.col("status") != "degraded", "source_id")


#: Fields that rows give evidence for, those a document may tell, and what strategies read.
FIELDS, TOLD = ("title", "salary", "band", "closing_date", "description"), ("salary", "band", "closing_date", "description")
READS = {"known_endpoint": "endpoint_json", "discovered_endpoint": "endpoint_json", "endpoint_json": "endpoint_json", "json_ld": "json_ld", "sitemap_feed": "sitemap_feed"}


def field_evidence(strategy: Column, has_document: Column) -> Column:
    """Where a strategy's rows have their fields from."""
    base = F.lit("detail_html")
    base = F.when(strategy.contains("oracle_hcm") | strategy.contains("pulse"), "endpoint_json").otherwise(base)
    for name, source in READS.items():
        base = F.when(strategy == name, source).otherwise(base)
    told = F.when(has_document, "pdf_or_docx").otherwise(base)
    pairs = [x for f in FIELDS for x in (F.lit(f), told if f in TOLD else base)]
    return F.create_map(*pairs, F.lit("strategy"), strategy)


@dataclass
class Contest:
    """What a run of all strategies of all sources comes to, each a table."""

    rows: DataFrame
    health: DataFrame
    profiles: DataFrame
    quarantine: DataFrame


def contest(candidates: DataFrame, profiles: DataFrame, global_rules: DataFrame, source_rules: DataFrame, run_id: str, *seq: str, attempts: DataFrame | None = None) -> Contest:
    """Choose each source's strategy, judge its rows, and say what is emitted, set aside and remembered.

    Strategies are compared by a source's own rules; the rows of the chosen one are judged by all. candidates may have
    has_document and their own field_evidence, which stays. With attempts (source_id, strategy, strategy_index, failed),
    all that was tried, a source none of whose strategies has a row is measured as zero and remembered as such.
    """
    keys = ["source_id", "strategy", "strategy_index"]
    first = choose(metrics(judged(candidates, global_rules.limit(0), source_rules), attempts), profiles).select(*keys)
    rows = judged(candidates, global_rules, source_rules).join(first, keys, "left_semi")
    health = drift(choose(metrics(rows, None if attempts is None else attempts.join(first, keys, "left_semi")), profiles))
    out = emitted(rows, health).drop("reason")
    has = F.coalesce("has_document", F.lit(False)) if "has_document" in out.columns else F.lit(False)
    made = field_evidence(F.col("strategy"), has)
    out = out.withColumns({"field_evidence": F.coalesce("field_evidence", made) if "field_evidence" in out.columns else made, "source_strategy": F.col("strategy")})
    return Contest(out, health, updated_profiles(profiles, health, run_id), quarantine(rows, health, *seq))


#: Platforms whose discovered addresses are always read, how many known and discovered ones are, and the order of strategies.
ENDPOINT_PLATFORMS = ("oracle_hcm", "pulse", "pageup", "applynow", "successfactors", "elmo_talent", "t1cloud", "bigredsky", "recruitmenthub")
MOST_KNOWN, MOST_DISCOVERED = 2, 3
KNOWN, PLATFORM, DISCOVERED, JSON_LD, FEED = 0, 10, 20, 30, 40


def attempts(sources: DataFrame, known: DataFrame, hints: DataFrame, discovered: DataFrame, feeds: DataFrame, failed: DataFrame) -> DataFrame:
    """What is tried for each source in a run: source_id, strategy, strategy_index (the order), url (of an address of data), failed.

    sources: source_id, platform, preferred_strategy; known: source_id, url, status, place; hints: source_id, nth, url; discovered and
    feeds: source_id of sources whose listing page has postings, and whose feeds have candidates; failed: source_id, strategy.

    Known addresses come first where one was preferred before: the accepted ones, or else all, two at most. The platform's own
    strategy is always tried. Discovered addresses follow, three at most, on platforms that are known for them and where one was
    accepted before; then what the listing page holds, if it has postings or hints; then feeds, if they have candidates.
    Every source thus has a row, whether or not anything has candidates.
    """
    each = sources.select("source_id", F.coalesce(F.nullif("platform", F.lit("")), F.lit("generic_html")).alias("platform"), F.coalesce("preferred_strategy", F.lit("")).alias("preferred"))
    accepted = known.groupBy("source_id").agg(F.max(F.col("status") == "accepted").alias("any_accepted"))
    each = each.join(accepted, "source_id", "left").withColumn("any_accepted", F.coalesce("any_accepted", F.lit(False)))
    used = known.join(each.where(F.col("preferred").rlike("^(known|discovered)_endpoint")).select("source_id", "any_accepted"), "source_id").where(~F.col("any_accepted") | (F.col("status") == "accepted"))
    nth = F.row_number().over(Window.partitionBy("source_id").orderBy("place", "url"))
    of = lambda df, name, index, url=None: df.select("source_id", F.lit(name).alias("strategy") if isinstance(name, str) else name.alias("strategy"), index.cast("long").alias("strategy_index"), (F.lit(None).cast("string") if url is None else F.col(url)).alias("url"))
    tried = [
        of(used.withColumn("nth", nth).where(F.col("nth") <= MOST_KNOWN), "known_endpoint", F.col("nth") - 1 + KNOWN, "url"),
        of(each, F.concat(F.lit("platform:"), F.col("platform")), F.lit(PLATFORM)),
        of(hints.where(F.col("nth") <= MOST_DISCOVERED).join(each.where(F.col("platform").isin(*ENDPOINT_PLATFORMS) | F.col("any_accepted")).select("source_id"), "source_id", "left_semi"), "discovered_endpoint", F.col("nth") - 1 + DISCOVERED, "url"),
        of(each.join(hints.select("source_id").union(discovered.select("source_id")).distinct(), "source_id", "left_semi"), "json_ld", F.lit(JSON_LD)),
        of(each.join(feeds.select("source_id").distinct(), "source_id", "left_semi"), "sitemap_feed", F.lit(FEED)),
    ]
    every = tried[0]
    for t in tried[1:]:
        every = every.unionByName(t)
    bad = failed.select("source_id", "strategy", F.lit(True).alias("failed")).distinct()
    return every.join(bad, ["source_id", "strategy"], "left").withColumn("failed", F.coalesce("failed", F.lit(False)))
