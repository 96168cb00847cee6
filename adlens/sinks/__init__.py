"""Published files: snapshots, appended logs and descriptions, all written by Spark."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adlens.operators import history
from adlens.operators.staging import written
from adlens.sinks import versions


def append_log(rows: DataFrame, path: str, day: str) -> None:
    """Rows as JSON lines in the day's part of a log, keys in order; null fields are left out."""
    rows.select(*sorted(rows.columns)).withColumn("observed_date", F.lit(day)).write.mode("append").partitionBy("observed_date").json(path)


def write_snapshot(rows: DataFrame, path: str, version: str) -> None:
    """A snapshot under its own version; readers switch to it when it is whole."""
    rows.withColumn("schema_version", F.lit(version)).write.mode("overwrite").json(f"{path}/{version}")


#: What the store of descriptions holds, besides the shard, the first two digits of the hash.
DESCRIPTION = "hash string, text string, source_url string, source_id string, schema_version string, extracted_at string, shard string"


def insert_descriptions(new: DataFrame, path: str, *seq: str) -> int:
    """Add the descriptions (hash and more columns of DESCRIPTION) that aren't stored yet, of equal hashes the first by seq; how many were added.

    Only the shards that the new rows touch are read, of which there are 256 at most; a second insert adds none.
    """
    spark = new.sparkSession
    rows = new.where("hash is not null").withColumn("shard", F.substring("hash", 1, 2))
    shards = [r[0] for r in rows.select("shard").distinct().collect()]
    fresh = written(history.new_descriptions(rows, stored_descriptions(spark, path, shards), *seq).select(*[c for c in spark.createDataFrame([], DESCRIPTION).columns if c in rows.columns]))
    n = fresh.count()
    if n:
        fresh.write.mode("append").partitionBy("shard").json(path)
    return n


def stored_descriptions(spark: SparkSession, path: str, shards: list[str] | None = None) -> DataFrame:
    """The store's rows, of these shards alone where they are named; none where nothing is stored."""
    try:
        every = spark.read.schema(DESCRIPTION).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], DESCRIPTION)
    return every if shards is None else every.where(F.col("shard").isin(shards))


#: The version of the profiles' schema: under another one a run starts without profiles.
PROFILES = "source-profiles.v1"
HISTORY = "array<struct<run_id:string,strategy:string,accepted_count:bigint,score:bigint,codes:string>>"
PROFILE = f"source_id string, preferred_strategy string, last_good_count bigint, last_good_score bigint, last_good_run_id string, failure_streak int, health string, quality_history {HISTORY}"
RULES = "title string"


def write_state(profiles: DataFrame, rules: DataFrame, path: str, run_id: str) -> bool:
    """The profiles and the rules for all sources after a run, switched to together; False if the run has been written."""
    fields = spark_names(PROFILE)
    return versions.publish({"profiles": (profiles.select(*fields), PROFILES), "global_rules": (rules.select("title"), PROFILES)}, path, run_id)


def spark_names(schema: str) -> list[str]:
    return [f.name for f in StructType.fromDDL(schema).fields]


def read_state(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The newest whole profiles and rules; empty ones where there are none, or where they have another schema version."""
    return versions.current(spark, path, "profiles", PROFILE, PROFILES), versions.current(spark, path, "global_rules", RULES, PROFILES)


def append_quarantine(rows: DataFrame, path: str, day: str) -> None:
    """Rejected rows as JSON lines in the day's part of the quarantine."""
    append_log(rows, path, day)


PUBLISHED = ("all", "current", "report", "board", "summary")


def write_published(found, path: str, version: str, feed: DataFrame) -> bool:
    """All tables of a rebuild and its feed under one version, switched to at once; False if the version is there. `found` is a report.Published."""
    return versions.publish({name: (getattr(found, name), f"{name}.v1") for name in PUBLISHED} | {"feed": (feed.select("xml"), "feed.v1")}, path, version)
