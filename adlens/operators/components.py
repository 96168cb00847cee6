"""Connected components of a graph in joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.operators.staging import stored


def components(edges: DataFrame) -> DataFrame:
    """node and group, the least node of its component, for every node of edges (u, v); an edge from a node to itself names it.

    Stars are made large and small in turn: every node points its greater neighbours to the least it knows, then its lesser
    ones and itself. Rounds grow with the logarithm of the longest path, edges never become more, and a node with very many
    neighbours sends one minimum a task.
    """
    nodes = stored(edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct())
    now = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m_")).select("u", F.least("u", "m_").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(small.union(low).distinct())
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    return nodes.join(now, nodes.node == now.u, "left").select("node", F.coalesce("v", "node").alias("group"))
