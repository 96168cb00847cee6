"""Mixing sources to target weights by entropy balancing.

Targets share the total by weight, none above a multiple of its source. Within a source the rates are
those nearest to 1 in relative entropy, none above the same multiple, that bring the words taken to the
target: ``min(most, exp(lambda * size / mean size))``. Newton steps on the convex dual find each source's
lambda; a step is one pass over the counts of equal sizes. Rates become whole copies by carrying the
error on within chunks of a source, large documents first.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import cut, few, fresh, multiplied, width

WORDS = r"[^\x20\x09-\x0D]+"
#: Documents rounded together, about; a chunk's words end within a small document's size of its share.
CHUNK = 2000
#: Up to so many sources their table goes to every executor; beyond, Spark joins by key.
SMALL = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def ranked(df: DataFrame, order: Column) -> DataFrame:
    """df with `rank` from 0 in this order: rows numbered within ranges, after the rows of the ranges before."""
    part = cut(df.repartitionByRange(width(df), order).sortWithinPartitions(order).withColumn("id", F.monotonically_increasing_id()))
    part = part.withColumn("part", F.shiftright("id", 33)).withColumn("nth", F.col("id").bitwiseAND((1 << 33) - 1))
    counts = part.groupBy("part").count()
    before = counts.alias("x").join(counts.alias("y"), F.col("y.part") < F.col("x.part"), "left").groupBy(F.col("x.part").alias("part")).agg(F.coalesce(F.sum("y.count"), F.lit(0)).alias("before"))
    return part.join(before, "part").withColumn("rank", F.col("before") + F.col("nth")).drop("id", "part", "nth", "before")


def targets(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """sources (source, words, n, least) with sid and target, null last in order. The target is null where the source is taken `most` times whole."""
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    t = cut(ranked(sources, F.col("source").asc_nulls_last()).select("*", F.col("rank").alias("sid"), weight.alias("weight"), F.lit(False).alias("full")).drop("rank"))
    exact = lambda c: c.cast("decimal(38,0)")
    while True:
        x = t.agg(F.sum(exact(F.col("words"))).alias("all"), F.sum(F.when(F.col("full"), exact(F.col("words")))).alias("full"), F.sum(F.when(~F.col("full"), F.col("weight"))).alias("free")).first()
        room, free = int(x["all"] or 0) - most * int(x["full"] or 0), int(x["free"] or 0)
        above = ~F.col("full") & (exact(F.col("weight")) * exact(F.lit(room)) > exact(F.col("words")) * exact(F.lit(most * free)))
        if not free or t.where(above).isEmpty():
            break
        t = cut(t.withColumn("full", F.col("full") | above))
    share = F.col("weight").cast("double") * F.lit(float(room)) / F.lit(float(free or 1))
    return cut(t.withColumn("target", F.when(F.col("full"), F.col("words").cast("double") * most).otherwise(share)))


def tilts(sizes: DataFrame, sources: DataFrame, most: int = 3, tolerance: float = 1e-10, steps: int = 80) -> DataFrame:
    """sid and tilt for the sources that aren't taken whole: Newton's steps, kept within a bracket that halves otherwise."""
    small = sources.count() <= SMALL
    hint = F.broadcast if small else (lambda x: x)
    free = sources.where(~F.col("full") & (F.col("words") > 0))
    mean = F.col("words") / F.col("n")
    end = F.log(F.col("target") / F.col("words")) / (F.col("least") / mean)
    t = cut(free.select("sid", "target", mean.alias("mean"), F.lit(0.0).alias("tilt"), F.least(F.lit(0.0), end).alias("low"), F.greatest(F.lit(0.0), end).alias("high"), F.lit(False).alias("ok")))
    for _ in range(steps):
        z = F.col("size") / F.col("mean")
        u = F.least(F.col("tilt") * z, F.lit(math.log(most) + 1))
        rate = F.least(F.lit(float(most)), F.exp(u))
        words = F.col("k") * F.col("size") * rate
        sums = sizes.join(hint(t.where(~F.col("ok"))), "sid").groupBy("sid").agg(F.sum(words).alias("g"), F.sum(F.when(F.col("tilt") * z < math.log(most), words * z).otherwise(0.0)).alias("slope"))
        low = F.when(F.col("g") < F.col("target"), F.col("tilt")).otherwise(F.col("low"))
        high = F.when(F.col("g") > F.col("target"), F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - F.try_divide(F.col("g") - F.col("target"), F.col("slope"))
        done = F.col("ok") | F.col("g").isNull() | (F.abs(F.col("g") - F.col("target")) <= tolerance * F.col("target")) | (high - low <= 1e-13 * F.greatest(F.abs(low), F.abs(high)))
        step = F.when((newton > low) & (newton < high), newton).otherwise((low + high) / 2)
        t = cut(t.join(sums, "sid", "left").select("sid", "target", "mean", F.when(done, F.col("tilt")).otherwise(step).alias("tilt"), low.alias("low"), high.alias("high"), done.alias("ok")))
        if t.where("not ok").isEmpty():
            break
    return t.select("sid", "mean", F.round("tilt", 9).alias("tilt"))


def _copies(most: int):
    def chunk(table: pa.Table) -> pa.Table:
        size, rate, m = (table.column(x).to_numpy() for x in ("size", "rate", "m"))
        left, out = 0.0, np.empty(len(size), np.int64)
        for i in np.lexsort((table.column("tie").to_numpy(), -size)).tolist():
            down = math.floor(rate[i]) * m[i]
            up = min(most, math.floor(rate[i]) + 1) * m[i]
            out[i] = min(max(math.ceil(rate[i] * m[i] + left / size[i] - 0.5), down), up) if size[i] else m[i]
            left += (rate[i] * m[i] - out[i]) * size[i]
        key = table.column("key")
        if pa.types.is_struct(key.type):  # fields that Spark knows to be never null are declared nullable in the result
            key = key.cast(pa.struct([pa.field(f.name, f.type) for f in key.type]))
        rest = ["size", "source_size", "target", "rate", "m"]
        return pa.Table.from_arrays([key, *(table.column(x) for x in rest), pa.array(out)], ["key", *rest, "all_copies"])

    return chunk


def mix(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", weights: tuple[int, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """One row per row of docs: key, size, source_size, target, taken, copies, rate.

    Null text has no words; null is a source of its own, the last. Documents without words get one copy and
    add nothing. A key may be null. Rows that repeat are documents of their own; those alike in key, source and size are
    rounded together, so that however many there are, none fills a task, and share their copies as evenly as
    can be. Other columns are ignored. An empty table gives none.
    """
    rates = _rates(docs, text, key, source, weights, most)
    each = multiplied(rates, "m", "nth").withColumn("copies", F.floor(F.col("all_copies") / F.col("m")) + (F.col("nth") < F.col("all_copies") % F.col("m")).cast("long"))
    return each.select(F.col("key").alias(key), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate")


def _rates(docs: DataFrame, text: str, key: str, source: str, weights: tuple[int, ...], most: int) -> DataFrame:
    """One row for each key, source and size: key, size, source_size, target, rate, m (rows alike) and all_copies of them."""
    each = docs.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"))
    base = cut(each.groupBy("key", "source", "size").agg(F.count("*").alias("m")))
    some = F.col("size") > 0
    per = base.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("words"), F.sum(F.when(some, F.col("m"))).alias("n"), F.count("*").alias("rows"), F.min(F.when(some, F.col("size"))).alias("least"))
    sources = targets(per, weights, most)
    hint = F.broadcast if sources.count() <= SMALL else (lambda x: x)
    known = sources.select(F.col("source").alias("s"), "sid", F.col("words").alias("source_size"), "rows", "target", "full")
    rows = base.join(hint(known), F.col("source").eqNullSafe(F.col("s"))).drop("s", "source")
    sizes = cut(rows.where("size > 0 and not full").groupBy("sid", "size").agg(F.sum("m").alias("k")))
    tilt = tilts(sizes, sources, most)
    rate = F.when(F.col("full"), F.lit(float(most))).otherwise(F.least(F.lit(float(most)), F.exp(F.least(F.coalesce("tilt", F.lit(0.0)) * F.col("size") / F.coalesce("mean", F.lit(1.0)), F.lit(math.log(most) + 1)))))
    rated = rows.join(hint(tilt), "sid", "left").withColumn("rate", F.when(F.col("size") == 0, 1.0).otherwise(rate))
    dealt = rated.select("key", "sid", "size", "source_size", "target", "rate", "m", F.xxhash64("key", "size").alias("tie"), F.pmod(F.xxhash64("key", "size"), F.ceil(F.col("rows") / CHUNK)).alias("chunk"))
    kind = dict(docs.dtypes)[key]
    return dealt.groupBy("sid", "chunk").applyInArrow(_copies(most), f"key {kind}, size long, source_size long, target double, rate double, m long, all_copies long")


def mixed(docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """The rows of docs that the mix takes, with copies, and taken, the words they come to.

    Where docs has columns of these names, the new ones get an underscore. Keys, texts and sources may be null. Of rows
    that repeat key, source and text, each is taken as often as the next or once more. Without rows there are none.
    """
    own = F.struct(F.col(key).alias("key"), F.col(source).cast("string").alias("source"), F.xxhash64(text).alias("print"))
    copies, taken = fresh(docs.columns, "copies", "taken")
    inner = fresh([*docs.columns, copies, taken], "key_", "source_", "print_", "size_", "m_", "all_", "nth_", "first_", "rank", "id", "part", "nth", "before")
    k, s, p, size, m, every, nth, first = inner[:8]
    rates = _rates(docs.select(own.alias("own"), F.col(text).alias("text"), F.col(source).alias("source")), "text", "own", "source", (5, 2, 1), 3).where("all_copies > 0")
    rates = cut(rates.select(F.col("key.key").alias(k), F.col("key.source").alias(s), F.col("key.print").alias(p), F.col("size").alias(size), F.col("m").alias(m), F.col("all_copies").alias(every)))
    same = F.col(key).eqNullSafe(F.col(k)) & F.col(source).cast("string").eqNullSafe(F.col(s)) & (F.xxhash64(text) == F.col(p))
    even = F.col(every) % F.col(m) == 0
    found = docs.join(few(cut(rates.where(even))), same).withColumn(copies, F.floor(F.col(every) / F.col(m)))
    odd = rates.where(~even)
    if not odd.isEmpty():
        # rows alike are put in order by what they hold (maps have no hash and don't count), and numbered across tasks
        rows = cut(docs.join(few(cut(odd)), same))
        rows = numbered(rows, [k, s, p], [F.xxhash64(*[f"`{f.name}`" for f in docs.schema.fields if "map<" not in f.dataType.simpleString()])], nth, first)
        more = F.col(nth) - F.col(first) < F.col(every) % F.col(m)
        found = found.unionByName(rows.withColumn(copies, F.floor(F.col(every) / F.col(m)) + more.cast("long")).drop(nth, first))
    return found.where(F.col(copies) > 0).withColumn(taken, F.col(copies) * F.col(size)).select(*[f"`{c}`" for c in docs.columns], copies, taken)


def numbered(rows: DataFrame, group: list[str], order: list[Column], nth: str, first: str) -> DataFrame:
    """rows with their place in a sort by group and order, and the first place of their group. No group is one task's."""
    packed = cut(rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"), *[F.col(c).alias(f"g{i}") for i, c in enumerate(group)], *[c.alias(f"o{i}") for i, c in enumerate(order)], F.monotonically_increasing_id().alias("tie")))
    sort = F.struct(*[f"g{i}" for i in range(len(group))], *[f"o{i}" for i in range(len(order))], "tie")
    placed = cut(ranked(packed, sort))
    keys = [f"g{i}" for i in range(len(group))]
    least = placed.groupBy(*keys).agg(F.min("rank").alias("least")).select(*[F.col(x).alias(f"l_{x}") for x in keys], "least")
    same = F.lit(True)
    for x in keys:
        same = same & F.col(x).eqNullSafe(F.col(f"l_{x}"))
    out = placed.join(few(cut(least)), same)
    return out.select("row.*", F.col("rank").alias(nth), F.col("least").alias(first))
