"""Connected components by alternating large and small stars, in joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import cut, packed


def components(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node of its component, for all nodes of edges (u, v) but the roots themselves.

    A node with very many neighbours sends one minimum for each task; its edges are dealt out by a join that
    Spark can split.
    """
    first = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    n = first.count()  # edges never become more
    now, state = packed(first, n), None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = packed(cut(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))), n)
        large = packed(cut(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()), n)
        joined = large.join(packed(cut(large.groupBy("u").agg(F.min("v").alias("m"))), n), "u")
        now = packed(cut(joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v"))).distinct()), n)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = seen
