"""From the log of observations to the latest state of each listing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEEN, UNAVAILABLE, NOT_SEEN = "seen_latest_run", "source_unavailable_latest_run", "not_seen_latest_run"


#: Runs of an imported log; where it has one, there is no earlier snapshot to go on from.
SEED = "seed-"


def union_history(previous: DataFrame, observations: DataFrame) -> DataFrame:
    """The previous snapshot before new observations; columns that one lacks are null."""
    return previous.unionByName(observations, allowMissingColumns=True)


def _extreme(rows: DataFrame, greatest: bool, by: list[str], columns: list[str]) -> Column:
    """The columns of the row with the greatest, or least, values of `by`, as a struct that holds each once, in which those of `by` come first.

    Structs with maps don't sort: these are chosen by a struct beside them.
    """
    row = F.struct(*by, *[c for c in columns if c not in by])
    kinds = rows.select(row.alias("r")).schema["r"].dataType.simpleString()
    if "map<" in kinds or "variant" in kinds:
        return (F.max_by if greatest else F.min_by)(row, F.struct(*by))
    return (F.max if greatest else F.min)(row)


def dedupe(observations: DataFrame, *seq: str) -> DataFrame:
    """The first row, by seq, of each job, time and run; a replayed log adds nothing."""
    keys = ["job_id", "observed_at", "run_id"]
    rest = [c for c in observations.columns if c not in keys]
    first = observations.groupBy(*keys).agg(_extreme(observations, False, list(seq), rest).alias("row_"))
    return first.select(*[F.col(c if c in keys else f"row_.{c}") for c in observations.columns])


def latest_run(observations: DataFrame, *seq: str) -> DataFrame:
    """The run of the newest observation, the first loaded of equally new ones, as one row. seq may be of any type that sorts."""
    each = observations.groupBy(F.col("observed_at").alias("latest_at")).agg(F.min_by("run_id", F.struct(*seq)).alias("latest_run"))
    return each.agg(F.max_by("latest_run", F.struct("latest_at")).alias("latest_run"), F.max("latest_at").alias("latest_at"))


def latest(observations: DataFrame, *seq: str, **more: Column) -> DataFrame:
    """The newest row of each job, the last loaded of equally new ones, with first_seen_at, last_seen_at, sighting_count, and more aggregates by name.

    One partial aggregation, so that a job with very many sightings sends one row a task; it keeps a struct, for which tasks
    sort by job. Columns that aren't wanted should go before: Spark can't prune what a struct holds.
    """
    rest = [c for c in observations.columns if c not in ("job_id", "first_seen_at", "last_seen_at", "sighting_count")]
    newest = _extreme(observations, True, ["observed_at", *seq], rest)
    found = observations.groupBy("job_id").agg(newest.alias("r"), F.min("observed_at").alias("first_seen_at"), F.count("*").alias("sighting_count"), *[c.alias(n) for n, c in more.items()])
    # the newest row's time is the last
    return found.select("job_id", *[F.col(f"r.{c}") for c in rest], "first_seen_at", F.col("r.observed_at").alias("last_seen_at"), "sighting_count", *more)


def with_status(snapshot: DataFrame, run: DataFrame, failed: DataFrame) -> DataFrame:
    """observed_status: seen in the latest run, else source unavailable, else not seen. `failed` has source_id."""
    bad = failed.select(F.col("source_id").alias("failed_id")).distinct()  # broadcast by Spark where it is small
    joined = snapshot.drop("observed_status").crossJoin(F.broadcast(run.select("latest_run"))).join(bad, F.col("source_id") == F.col("failed_id"), "left")
    status = F.when(F.col("run_id") == F.col("latest_run"), SEEN).when(F.col("failed_id").isNotNull(), UNAVAILABLE).otherwise(NOT_SEEN)
    return joined.withColumn("observed_status", status).drop("latest_run", "failed_id")


def log_of(observations: DataFrame, *seq: str, previous: DataFrame | None = None) -> DataFrame:
    """What a snapshot is made from, with `order_`, in which rows were loaded.

    An imported log (with a seed run) stands as it is. Another follows the previous snapshot, whose rows come first, and
    of rows that repeat job, time and run the first counts.
    """
    order = lambda part, *c: F.struct(F.lit(part).alias("part"), F.struct(*c).alias("seq"))
    new = observations.withColumn("order_", order(1, *seq))
    seeded = observations.agg(F.coalesce(F.max(F.col("run_id").startswith(SEED)), F.lit(False)).alias("seeded_"))
    if previous is not None:
        old = previous.drop("first_seen_at", "last_seen_at", "sighting_count", "observed_status").withColumn("order_", order(0, *[F.lit(None).cast(observations.schema[c].dataType).alias(c) for c in seq]))
        new = union_history(old, new)
    rows = new.crossJoin(F.broadcast(seeded)).where("not seeded_ or order_.part = 1")
    # in an imported log every row is a key of its own
    keys = ["job_id", "observed_at", "run_id"]
    first = _extreme(rows, False, ["order_"], [c for c in new.columns if c not in keys])
    found = rows.groupBy(*keys, F.when(F.col("seeded_"), F.col("order_")).alias("own_")).agg(first.alias("row_"))
    return found.select(*[F.col(c if c in keys else f"row_.{c}") for c in new.columns])


def rebuild(observations: DataFrame, failed: DataFrame, *seq: str, previous: DataFrame | None = None, run_id: str | None = None) -> DataFrame:
    """All listings in their latest state with their status, seen in the run that is given or else in the newest; first_order tells which were loaded first."""
    log = log_of(observations, *seq, previous=previous)
    run = latest_run(log, "order_")
    if run_id is not None:
        run = run.withColumn("latest_run", F.lit(run_id))
    return with_status(latest(log, "order_", first_order=F.min("order_")).drop("order_"), run, failed)


def with_descriptions(jobs: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Jobs with the text of their description, where there is one. `descriptions` has hash and text."""
    texts = descriptions.groupBy(F.col("hash").alias("description_hash")).agg(F.first("text").alias("description_text"))
    return jobs.join(texts, "description_hash", "left")


def new_descriptions(rows: DataFrame, stored: DataFrame, *seq: str) -> DataFrame:
    """The first row of each hash that isn't stored yet."""
    first = Window.partitionBy("hash").orderBy(*seq)
    return rows.where("hash is not null").withColumn("nth_", F.row_number().over(first)).where("nth_ = 1").drop("nth_").join(stored.select("hash"), "hash", "left_anti")


def group_counts(jobs: DataFrame, column: str, default: str = "unknown") -> DataFrame:
    """How many jobs have each value, null and empty under the default."""
    return jobs.groupBy(F.coalesce(F.nullif(F.col(column).cast("string"), F.lit("")), F.lit(default)).alias("value")).agg(F.count("*").alias("n"))


def counts_map(jobs: DataFrame, column: str, default: str, name: str) -> DataFrame:
    """One row with a map from the values of a column, sorted, to how many jobs have them."""
    pairs = F.array_sort(F.collect_list(F.struct("value", "n")))
    return group_counts(jobs, column, default).agg(F.map_from_entries(pairs).alias(name))


def summary(jobs: DataFrame, observations: DataFrame | None, sources: DataFrame) -> DataFrame:
    """One row of counts over a snapshot, its log and the sources. Without the log, its rows are those that the snapshot's jobs have counted."""
    counted_log = [] if observations is not None else [F.coalesce(F.sum("sighting_count"), F.lit(0)).alias("observations")]
    counted = [
        jobs.agg(
            F.count("*").alias("all_jobs"),
            F.count_if(F.col("observed_status") == SEEN).alias("current_jobs"),
            F.countDistinct(F.nullif(F.col("council_key"), F.lit(""))).alias("councils"),
            F.countDistinct(F.when(F.col("observed_status") == SEEN, F.nullif(F.col("council_key"), F.lit("")))).alias("councils_current"),
            *counted_log,
        ),
        *([] if observations is None else [observations.agg(F.count("*").alias("observations"))]),
        sources.agg(F.count("*").alias("sources_configured")),
    ]
    return reduce(lambda a, b: a.crossJoin(b), counted)


def run_summary(current: DataFrame, report: DataFrame, jobs: DataFrame, observations: DataFrame, sources: DataFrame) -> DataFrame:
    """One row about a published snapshot: how many rows and councils, and how many of each status and platform, of the report and of what is current."""
    councils = lambda df, name: df.agg(F.count("*").alias(f"{name}_jobs"), F.countDistinct(F.nullif(F.col("council_key"), F.lit(""))).alias(f"councils_with_{name}_jobs"))
    counted = [
        sources.agg(F.count("*").alias("sources_configured")),
        councils(current, "current"),
        councils(report, "report"),
        jobs.agg(F.count("*").alias("all_jobs")),
        observations.agg(F.count("*").alias("observations")),
        counts_map(report, "classification_status", "unclassified", "classification_status_counts"),
        counts_map(report, "source_platform", "unknown", "source_platform_counts"),
        counts_map(current, "classification_status", "unclassified", "current_classification_status_counts"),
        counts_map(current, "source_platform", "unknown", "current_source_platform_counts"),
    ]
    return reduce(lambda a, b: a.crossJoin(b), counted)
