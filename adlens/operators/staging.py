"""A border between jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The folder that the cluster names for checkpoints; on one machine, where none is named, as in tests, one of its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            named = tempfile.mkdtemp(prefix="adlens-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def written(df: DataFrame) -> DataFrame:
    """df, worked out and kept in the folder for checkpoints."""
    folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """df, kept as files beside the checkpoints and read again, for frames that a loop makes of one another.

    A checkpoint cuts lineage but hands on what was known of the frame (constraints, partitioning, order). Rounds over checkpoints took
    longer and longer over the same rows, over files they don't. Files hand on nothing but their size.
    """
    path = f"{folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt to as many tasks as a shuffle has: a small file is read by one task, however much work a row of it is."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
