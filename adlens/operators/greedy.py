"""A greedy choice that depends on order, settled in rounds over all rows at once.

The rule for one row after another: a row joins the first place whose present holder is the same as it; it becomes the holder if
it is better; if no holder is the same, it opens a place of its own. Being the same isn't transitive, so that the outcome depends on
the order, and every row must see what it would have seen.

Rows are the same through cells: a row lies in a few, and ``adjacent`` tells which cells of an incoming row go with which of
a holder, so that very many rows that are all the same take a row a cell, not a row a pair. In a round a row is settled
if nothing that comes before it can still change what it sees, and it changes nothing that an earlier one is still to see: no
undecided earlier row is the same as it, none could take the place of the holder that it would join, and, if it takes that place itself,
none is the same as that holder. Besides, in each group of linked rows, the first that changes anything is settled, and all
before it, which change nothing. The first undecided row of every group is thus always settled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.operators.components import components
from adlens.operators.staging import stored


def linked(cells: DataFrame, adjacent: DataFrame) -> DataFrame:
    """row and group (the least cell that chains of adjacent cells lead to) of the rows that may be the same as another."""
    counts = cells.groupBy("cell").agg(F.count("*").alias("n"))
    pairs = adjacent.join(counts, adjacent.incoming == counts.cell).where("incoming <> holder or n > 1").select("incoming", "holder")
    active = stored(pairs.select(F.col("incoming").alias("cell")).union(pairs.select("holder")).distinct())
    own = stored(cells.join(active, "cell", "left_semi"))
    firsts = own.groupBy("row").agg(F.min("cell").alias("u"))
    edges = own.join(firsts, "row").select("u", F.col("cell").alias("v")).union(pairs)
    found = components(edges.distinct())
    return firsts.join(found, firsts.u == found.node).select("row", "group")


def chosen(rows: DataFrame, cells: DataFrame, adjacent: DataFrame) -> DataFrame:
    """place and row, the holder of each place in the end; a place is named by the row that opened it.

    rows: row, of any type that sorts, in the order in which they come, and score; cells: row, cell (a number); adjacent: incoming and
    holder, cells of rows that are the same when one comes in and the other holds a place. Rows of no adjacent cell keep their own place.
    """
    groups = stored(linked(cells, adjacent))
    alone = rows.join(groups, "row", "left_anti").select(F.col("row").alias("place"), "row")
    left = stored(rows.join(groups, "row"))
    cells = stored(cells.join(groups.select("row"), "row", "left_semi"))
    either = stored(adjacent.union(adjacent.select("holder", "incoming")).distinct())
    holders = stored(left.select(F.col("row").alias("place"), F.col("row").alias("holder"), "score").limit(0))
    while not left.isEmpty():
        at = stored(holders.join(cells, F.col("holder") == F.col("row")).select("cell", "place", "holder", "score"))
        mine = stored(left.join(cells, "row").select("row", "cell", "score"))
        # the first place whose holder is the same as the row
        first = at.groupBy("cell").agg(F.min(F.struct("place", "holder", "score")).alias("first"))
        seen = adjacent.join(first, F.col("holder") == F.col("cell")).groupBy("incoming").agg(F.min("first").alias("first"))
        # the first undecided row that is the same as it, whichever comes in
        waiting = mine.groupBy("cell").agg(F.min("row").alias("before"))
        before = either.join(waiting, F.col("holder") == F.col("cell")).groupBy("incoming").agg(F.min("before").alias("before"))
        sees = mine.join(seen, mine.cell == seen.incoming, "left").drop("incoming").join(before, F.col("cell") == before.incoming, "left")
        sees = sees.groupBy("row").agg(F.min("first").alias("first"), F.min("before").alias("before"))
        # the first undecided row that is the same as a holder, and the first that would take its place
        comes = mine.groupBy("cell", "score").agg(F.min("row").alias("row"))
        comes = adjacent.join(comes, F.col("incoming") == F.col("cell")).select(F.col("holder").alias("cell"), "row", F.col("score").alias("other"))
        threat = at.join(comes, "cell").groupBy("holder").agg(F.min("row").alias("waits"), F.min(F.when(F.col("other") > F.col("score"), F.col("row"))).alias("threat"))
        now = left.join(sees, "row").join(threat, F.col("first.holder") == F.col("holder"), "left").drop("holder")
        now = stored(now.withColumn("changes", F.col("first").isNull() | (F.col("score") > F.col("first.score"))))
        change = now.where("changes").groupBy("group").agg(F.min("row").alias("change"))
        not_before = lambda c: F.coalesce(c >= F.col("row"), F.lit(True))
        free = not_before(F.col("before")) & not_before(F.when(F.col("changes"), F.col("waits")).otherwise(F.col("threat")))
        settled = F.col("change").isNull() | (F.col("row") <= F.col("change")) | free
        now = stored(now.join(change, "group", "left").withColumn("settled", settled))
        changed = now.where("settled and changes")
        takes = changed.where("first is not null").select(F.col("first.place").alias("place"), F.col("row").alias("new"), F.col("score").alias("new_score"))
        kept = holders.join(takes, "place", "left").select("place", F.coalesce("new", "holder").alias("holder"), F.coalesce("new_score", "score").alias("score"))
        holders = stored(kept.union(changed.where("first is null").select("row", "row", "score")))
        left = stored(now.where("not settled").select("row", "score", "group"))
    return holders.select("place", F.col("holder").alias("row")).union(alone)
