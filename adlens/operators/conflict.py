"""Listings whose pay contradicts their band, judged by their peers.

A peer span is the least and greatest pay of a council's other listings with a band. Leaving out a listing's own
address needs no join of each listing with all samples: the two least lows, and greatest highs, of different
addresses for each council and band are enough to know the span without any one of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spans(samples: DataFrame) -> DataFrame:
    """For each council_key and band, the two least (low, identity) and two greatest (high, identity) of different identities."""
    each = samples.groupBy("council_key", "band", "identity").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    first = each.groupBy("council_key", "band").agg(F.min(F.struct("low", "identity")).alias("low1"), F.max(F.struct("high", "identity")).alias("high1"))
    rest = each.join(first, ["council_key", "band"]).groupBy("council_key", "band").agg(
        F.first("low1").alias("low1"),
        F.first("high1").alias("high1"),
        F.min(F.when(F.col("identity") != F.col("low1.identity"), F.col("low"))).alias("low2"),
        F.max(F.when(F.col("identity") != F.col("high1.identity"), F.col("high"))).alias("high2"),
    )
    return rest


def conflicts(jobs: DataFrame, samples: DataFrame) -> DataFrame:
    """jobs (job, council_key, band, low, high, identity, coupled) with `conflict`; rows that repeat are judged each.

    A conflict: peers of the declared band exist and their span doesn't overlap the pay, while the span of another
    band holds half of the pay's range or its midpoint; unless text couples the band with the pay. Jobs without a
    council, band or pay have none. A council's spans, one a band, meet its jobs as one row; nothing is gathered after.
    """
    span = F.struct(F.col("band").alias("band"), "low1", "low2", "high1", "high2")
    peers = spans(samples).groupBy(F.col("council_key").alias("council_")).agg(F.collect_list(span).alias("spans_"))
    joined = jobs.join(peers, F.col("council_key") == F.col("council_"), "left")
    low, high, middle = F.col("low"), F.col("high"), (F.col("low") + F.col("high")) / 2

    def seen(s: Column) -> Column:
        """A span as the job sees it, without its own address."""
        least = F.when(s["low1"]["identity"] == F.col("identity"), s["low2"]).otherwise(s["low1"]["low"])
        most = F.when(s["high1"]["identity"] == F.col("identity"), s["high2"]).otherwise(s["high1"]["high"])
        overlap = F.greatest(F.lit(0.0), F.least(high, most) - F.greatest(low, least))
        near = (overlap / F.greatest(F.lit(1.0), high - low) >= 0.5) | middle.between(least, most)
        return F.struct((s["band"] == F.col("band")).alias("own"), least.isNotNull().alias("there"), (overlap <= 0).alias("apart"), near.alias("near"))

    found = joined.withColumn("seen_", F.transform("spans_", seen))
    some = lambda f: F.coalesce(F.exists("seen_", f), F.lit(False))
    apart, elsewhere = some(lambda s: s["own"] & s["there"] & s["apart"]), some(lambda s: ~s["own"] & s["there"] & s["near"])
    return found.withColumn("conflict", apart & elsewhere & ~F.col("coupled")).select(*[F.col(c) for c in jobs.columns], "conflict")
