"""The log as a stream: snapshots kept by micro-batches, replays dropped, and counts by key."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adlens.operators import history
from adlens.operators.staging import folder, written
from adlens.sinks import versions


def read_log(spark: SparkSession, path: str, schema: StructType, kind: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).format(kind).load(path)


def without_replays(log: DataFrame, time: str, lateness: str, *keys: str) -> DataFrame:
    """The stream without rows whose keys were seen within the watermark."""
    return log.withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(keys))


def day_counts(log: DataFrame, time: str, key: str, lateness: str = "1 day") -> DataFrame:
    """Rows by day and key; a day is closed when the watermark passes it."""
    return log.withWatermark(time, lateness).groupBy(F.window(time, "1 day").alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("day"), key, "n")


def joined(old: DataFrame | None, new: DataFrame, *seq: str) -> DataFrame:
    """A snapshot joined with that of more rows, latest row by job; late rows change counts but not the latest state."""
    if old is None:
        return new
    both = old.unionByName(new)
    rest = [c for c in both.columns if c not in ("job_id", "first_seen_at", "last_seen_at", "sighting_count")]
    newest = F.max_by(F.struct(*rest), F.struct("last_seen_at", *seq))
    folded = both.groupBy("job_id").agg(newest.alias("r"), F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at"), F.sum("sighting_count").alias("sighting_count"))
    return folded.select("job_id", "r.*", "first_seen_at", "last_seen_at", "sighting_count").select(*old.columns)


def keep_snapshot(path: str, *seq: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: a snapshot under path, joined with each batch exactly once.

    Sightings are told by job, time and run: one that was counted, in this batch or an earlier epoch, is passed over. Of them
    only the shards are read that the batch touches, 256 at most. An epoch's counted sightings, its snapshot and its manifest
    are written in this order; an epoch that has a manifest is passed over, one that has none is written anew, from
    the epoch before it.
    """

    def step(batch: DataFrame, epoch: int) -> None:
        spark, version = batch.sparkSession, f"{epoch:012}"
        last = versions.newest(spark, path)
        if last is not None and last >= version:
            return
        first = written(history.dedupe(batch, *seq).withColumn("shard", F.substring(F.sha2(F.col("job_id").cast("binary"), 256), 1, 2)))
        counted = None if last is None else seen(spark, path, last, [r[0] for r in first.select("shard").distinct().collect()])
        new = first if counted is None else first.join(counted, SIGHTING, "left_anti")
        new = written(new)
        new.select(*SIGHTING, "shard").write.mode("overwrite").partitionBy("shard").parquet(f"{path}/seen/epoch={version}")
        old = None if last is None else spark.read.parquet(f"{path}/data/{last}/snapshot")
        versions.publish({"snapshot": (joined(old, history.latest(new.drop("shard"), *seq), *seq), SNAPSHOT)}, path, version)

    return step


SIGHTING, SNAPSHOT = ["job_id", "observed_at", "run_id"], "snapshot.v1"


def seen(spark: SparkSession, path: str, last: str, shards: list[str]) -> DataFrame:
    """The sightings that were counted up to an epoch, of these shards."""
    every = spark.read.schema("job_id string, observed_at string, run_id string, epoch string, shard string").parquet(f"{path}/seen")
    return every.where((F.col("epoch") <= last) & F.col("shard").isin(shards)).select(*SIGHTING)


def snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """The snapshot under path after its last whole epoch; None before the first."""
    last = versions.newest(spark, path)
    return None if last is None else spark.read.parquet(f"{path}/data/{last}/snapshot")


def counted_to_end(spark: SparkSession, path: str) -> DataFrame:
    """Events by day and type out of a stream that reads what is at the path now and stops; days that may still grow are given as they are."""
    at, _, name = path.rpartition("/")
    schema = spark.read.parquet(path).schema
    log = spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(at)
    counts = log.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n")).select("event_type", F.col("w.start").alias("day"), "n")
    kept = f"{folder(spark)}/days-{uuid.uuid4().hex}"
    put = lambda df, epoch: df.write.mode("overwrite").parquet(f"{kept}/counts")
    counts.writeStream.foreachBatch(put).outputMode("complete").option("checkpointLocation", f"{kept}/offsets").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{kept}/counts")
