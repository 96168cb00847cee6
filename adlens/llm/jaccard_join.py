"""Grouped prefix join: connected components of documents whose word shingles have a Jaccard similarity of 0.8 or more.

* A pass over all texts signs each set of shingles and counts all shingles in a table of fixed size; the counts
  order shingles from rare to common. Any order that all sets share is right; a good one keeps common passages
  out of prefixes.
* Two similar sets share a shingle within their prefixes, their first ``n - ceil(0.8 n) + 1``. Documents with equal
  prefixes and sizes are one group in the index. Groups that share no shingle with another are done.
* Where groups share a shingle, members are compared with leaders: in each bucket those that stand first (least
  missing before the shingle), one in the first round and GROWTH times as many in each round after. Pairs must pass
  the length and position filters and lie in different components; their sets are then read and intersected whole. Links join
  components, and buckets left with one component are done. So all pairs of a bucket count as compared, but a large
  group of near copies takes one comparison a member, not one a pair; no round or bucket is capped.
* A set is told by two 64-bit signatures and its size; sets that agree in the first alone get another name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlens.llm.common import cut, few, fresh, join2, mix, packed, slices, swept, width, without, word_hashes
from adlens.llm.components import components

SHINGLE = 5
#: Similar means num * union <= den * intersection.
NUM, DEN = 4, 5
#: The table that orders shingles has so many counters at most, of a byte each when sent out.
MOST_BITS = 24
BLOCK = 1 << 16
#: So many times more leaders a round than in the round before.
GROWTH = 16


def sets(column: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row; fewer words make one shingle, none make none."""
    words, first = word_hashes(column)
    h = words[: max(0, len(words) - size + 1)]
    for k in range(1, size):
        h = join2(h, words[k : len(h) + k])
    out = []
    for i, j in zip(first[:-1], first[1:], strict=True):
        if j - i >= size:
            out.append(np.unique(h[i : j - size + 1]))
        elif j > i:
            x = words[i : i + 1]
            for k in range(i + 1, j):
                x = join2(x, words[k : k + 1])
            out.append(x)
        else:
            out.append(words[:0])
    return out


def _signed(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([mix(x).sum(dtype=np.uint64) for x in found], np.uint64).view(np.int64), np.array([np.bitwise_xor.reduce(mix(~x)) if len(x) else 0 for x in found], np.uint64).view(np.int64)


def _survey(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.int32)
        for b in slices(batches):
            found = sets(b.column("text"))
            if any(map(len, found)):
                counts += np.bincount((np.concatenate(found) & np.uint64((1 << bits) - 1)).astype(np.int64), minlength=1 << bits).astype(np.int32)
        for k in range(0, 1 << bits, BLOCK):
            if counts[k : k + BLOCK].any():
                yield pa.RecordBatch.from_pydict({"block": pa.array([k // BLOCK], pa.int32()), "salt": pa.array([int(counts.sum()) % 64], pa.int32()), "counts": [counts[k : k + BLOCK].tobytes()]})

    return run


def _total(pdf: pd.DataFrame) -> pd.DataFrame:
    n = sum(np.frombuffer(x, np.int32).astype(np.int64) for x in pdf["counts"])
    return pd.DataFrame({"block": pdf["block"][:1], "salt": [0], "counts": [np.minimum(n, 2**31 - 1).astype(np.int32).tobytes()]})


def _leveled(pdf: pd.DataFrame) -> pd.DataFrame:
    n = np.frombuffer(_total(pdf)["counts"].iloc[0], np.int32)
    return pd.DataFrame({"block": pdf["block"][:1], "levels": [np.minimum(4 * np.log2(np.maximum(n, 1)), 127).astype(np.uint8).tobytes()]})


def _levels(rows: DataFrame) -> np.ndarray:
    """A byte for each counter: four times the binary logarithm of its count, over all rows."""
    size = rows.agg(F.sum(F.length(F.col("text").cast("binary")))).first()[0] or 0
    bits = int(np.clip(np.ceil(np.log2(size / 1000 + 1)), 16, MOST_BITS))
    schema = "block int, salt int, counts binary"
    part = rows.select("text").coalesce(2 * rows.sparkSession.sparkContext.defaultParallelism).mapInArrow(_survey(bits), schema)
    out = np.zeros(1 << bits, np.uint8)
    for r in part.groupBy("block", "salt").applyInPandas(_total, schema).groupBy("block").applyInPandas(_leveled, "block int, levels binary").collect():  # 2**MOST_BITS bytes at most
        out[r["block"] * BLOCK : r["block"] * BLOCK + len(r["levels"])] = np.frombuffer(r["levels"], np.uint8)
    return out


def _prefixes(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = shared.value
        mask = np.uint64(len(levels) - 1)
        for b in slices(batches):
            found = sets(b.column("text"))
            s, t = _signed(found)
            prefixes, groups = [], np.zeros(len(found), np.int64)
            for i, x in enumerate(found):
                order = np.sort((levels[x & mask].astype(np.uint64) << np.uint64(56)) | (x >> np.uint64(8)))
                p = order[: len(x) - (len(x) * NUM + DEN - 1) // DEN + 1] if len(x) else order
                groups[i] = (mix(p * np.uint64(3)).sum(dtype=np.uint64) ^ np.uint64(len(x))).view(np.int64) if len(x) else 0
                prefixes.append(p.view(np.int64))
            off = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(prefixes)))
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array([len(x) for x in found], pa.int32()), pa.array(s), pa.array(t), pa.array(groups), lists], ["key", "n", "c", "d", "g", "prefix"])

    return run


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        found = sets(b.column("text"))
        off = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([*map(pa.array, _signed(found)), pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(found).view(np.int64)))], ["r", "d", "items"])


def _told_apart(signed: DataFrame) -> DataFrame:
    """signed with its first signature as r, and c, a name that no two different sets share."""
    signed = signed.withColumnRenamed("c", "r").withColumn("c", F.col("r"))
    while True:
        same = cut(signed.groupBy("c").agg(F.min("d").alias("d1"), F.max("d").alias("d2"), F.min("n").alias("n1"), F.max("n").alias("n2")).where("d1 < d2 or n1 < n2").select(F.col("c").alias("same")))
        if same.isEmpty():
            return signed
        signed = cut(signed.join(few(same), F.col("c") == F.col("same"), "left").withColumn("c", F.when(F.col("same").isNotNull(), F.xxhash64("c", "d", "n")).otherwise(F.col("c"))).drop("same"))


def _mark(key: Column) -> Column:
    """One number for a key of any kind, to be sent to all tasks in its place. Others may have the same."""
    return F.xxhash64(key)


def _needed(n: Column, m: Column) -> Column:
    """The least intersection of similar sets of these sizes."""
    return F.ceil((n + m) * NUM / (NUM + DEN))


def _whole_sets(rows: DataFrame, nodes: DataFrame, n: int, signed: DataFrame) -> DataFrame:
    """The shingles of each node's set, n at most, read anew from one document that has it: c, items, one row a node.

    Documents are found by a mark of their key, which takes the driver less than keys do; others of the same mark do no
    harm, as sets are told by their signatures.
    """
    keys = cut(signed.select("key", "r", "d", "n", "c").join(few(nodes, n), "c", "left_semi").groupBy("c").agg(_mark(F.min("key")).alias("k"), F.first("r").alias("r"), F.first("d").alias("d"), F.first("n").alias("n")))
    some = rows.join(few(cut(keys.select("k").distinct()), n), _mark(F.col("key")) == F.col("k"), "left_semi")
    found = some.mapInArrow(_items, "r long, d long, items array<long>").withColumn("n", F.size("items")).dropDuplicates(["r", "d", "n"])
    return cut(found.join(keys.select("c", "r", "d", "n"), ["r", "d", "n"]).select("c", "items"))  # names go where the sets lie


def _linked(posts: DataFrame, of: DataFrame, leaders: int) -> tuple[DataFrame, DataFrame]:
    """Open buckets' rows with their ranks and components, and the pairs of members and leaders to be compared."""
    bucket = Window.partitionBy("token")
    reach = (F.col("n") - F.col("pos")) * (NUM + DEN) - F.col("n") * NUM  # NUM times the largest size of a similar partner
    with_root = posts.join(of, "c", "left").withColumn("root", F.coalesce("root", "c"))
    rows = with_root.withColumns({"least": F.min("n").over(bucket), "one": F.min("root").over(bucket) == F.max("root").over(bucket)})
    rows = rows.where(~F.col("one") & (reach >= F.col("least") * NUM)).withColumn("rank", F.row_number().over(bucket.orderBy("pos", "n", "c")))
    a, b = rows.where(F.col("rank") <= leaders).alias("a"), rows.alias("b")
    left = lambda x: F.col(f"{x}.n") - F.col(f"{x}.pos")
    ok = (
        (F.col("a.token") == F.col("b.token"))
        & (F.col("a.rank") < F.col("b.rank"))
        & (F.col("a.root") != F.col("b.root"))
        & (F.least(left("a"), left("b")) >= _needed(F.col("a.n"), F.col("b.n")))
        & (F.least("a.n", "b.n") >= _needed(F.col("a.n"), F.col("b.n")))
    )
    pairs = a.join(b, ok).select(F.least("a.c", "b.c").alias("x"), F.greatest("a.c", "b.c").alias("y"), F.least("a.root", "b.root").alias("u"), F.greatest("a.root", "b.root").alias("v")).distinct()
    return rows.where(F.col("rank") > leaders).select("token", "c", "n", "pos"), pairs


def near_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of docs: key, n_shingles, component_id.

    Null and empty texts, and those without words, have no shingles and are linked with nothing: their component
    is their key. A component's id is its smallest key, null keys aside. Rows that repeat are each given, in one
    component. Bytes that aren't UTF-8 are parts of words like others. Other columns of docs are ignored, whatever their
    names; without rows there are none.
    """
    parts = width(docs)
    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    levels = rows.sparkSession.sparkContext.broadcast(_levels(rows))
    signed = cut(rows.mapInArrow(_prefixes(levels), f"key {kind}, n int, c long, d long, g long, prefix array<long>"))
    levels.destroy()
    swept(rows.sparkSession)
    signed = _told_apart(signed)
    full = signed.where("n > 0")

    groups = full.groupBy("n", "g").agg(F.min("c").alias("c"), (F.min("c") < F.max("c")).cast("int").alias("many"), F.first("prefix").alias("prefix"))
    entries = groups.select("n", "c", "many", F.posexplode("prefix").alias("pos", "token"))
    narrow = entries.select("token", "c", F.expr("shiftleft(cast(n as long), 32) | (pos * 2 + many)").alias("at"))
    shared = narrow.withColumn("df", F.count("*").over(Window.partitionBy("token"))).where("df > 1 or (at & 1) = 1")
    posts = cut(shared.select("token", "c", F.expr("cast(shiftright(at, 32) as int)").alias("n"), F.expr("cast(shiftright(at & 4294967295, 1) as int)").alias("pos"), F.expr("(at & 1) = 1").alias("many")))
    members = full.select("n", "g", "c").distinct()
    members = members.join(members.groupBy("n", "g").agg(F.min("c").alias("first"), F.max("c").alias("last")).where("first < last"), ["n", "g"]).select(F.col("n").alias("m"), "first", F.col("c").alias("member"))
    posts = packed(posts, posts.count())
    posts = posts.where("not many").drop("many").unionByName(posts.where("many").join(few(cut(members)), (F.col("c") == F.col("first")) & (F.col("n") == F.col("m"))).select("token", F.col("member").alias("c"), "n", "pos"))

    of, placed_n, leaders = rows.sparkSession.createDataFrame([], "c long, root long"), 0, 1
    whole = rows.sparkSession.createDataFrame([], "c long, items array<long>")
    while True:
        swept(rows.sparkSession)
        rest, pairs = _linked(posts, few(of, placed_n), leaders)
        pairs = cut(pairs)
        n = pairs.count()
        pairs = packed(pairs, n)
        swept(rows.sparkSession)
        if n:
            nodes = cut(pairs.select(F.col("x").alias("c")).union(pairs.select("y")).distinct().join(whole, "c", "left_anti"))
            whole = whole.unionByName(_whole_sets(rows, nodes, 2 * n, signed))
            swept(rows.sparkSession)
            x, y = whole.select(F.col("c").alias("x"), F.col("items").alias("xs")), whole.select(F.col("c").alias("y"), F.col("items").alias("ys"))
            x = x.join(few(cut(pairs.select("x").distinct()), n), "x", "left_semi")
            both = F.size(F.array_intersect("xs", "ys"))
            links = packed(cut(y.join(few(pairs, n), "y").join(x, "x").where(both * DEN >= (F.size("xs") + F.size("ys") - both) * NUM).select("u", "v")), n)
            if not links.isEmpty():
                new = components(links).withColumnRenamed("root", "to")
                moved = of.join(new, F.col("root") == F.col("node"), "left").select("c", F.coalesce("to", "root").alias("root"))
                of = cut(moved.unionByName(new.select(F.col("node").alias("c"), F.col("to").alias("root")).join(of, "c", "left_anti")))
                placed_n = of.count()
                of = packed(of, placed_n)
        posts = cut(rest)
        n = posts.count()
        if not n:
            break
        posts = packed(posts, n)
        leaders *= GROWTH

    swept(rows.sparkSession)
    placed = signed.select("key", "n", "c").join(of, "c", "left").select("key", "n", F.coalesce("root", "c").alias("root"))
    some = placed.where("n > 0")
    least = cut(some.groupBy("root").agg(F.min("key").alias("component_id")), parts)
    none = placed.where("n = 0").select("key", "n", F.col("key").alias("component_id"))
    return some.join(least, "root").select("key", "n", "component_id").unionByName(none).select(F.col("key").alias(key), F.col("n").cast("long").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs with one row of each component: the one with the smallest key, and of equal keys one text.

    Of rows that repeat key and text one stays, any of them, whatever their other columns. Texts without words stay.
    Columns may have any names and hold nulls; without rows there are none.
    """
    own = F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("print"))
    found = cut(near_copies(docs.select(own.alias("own"), F.col(text).alias("text")), "text", "own"))
    swept(docs.sparkSession)
    if not found.where("component_id = own").groupBy("own").count().where("count > 1").isEmpty():
        (name,) = fresh(docs.columns, "print_")
        docs = docs.withColumn(name, F.xxhash64(text)).dropDuplicates([key, name]).drop(name)
    goes = F.col("component_id") != F.col("own")
    if not found.groupBy(_mark(F.col("own")).alias("mark")).agg(F.min(goes).alias("all"), F.max(goes).alias("some")).where("all <> some").isEmpty():
        return without(docs, found.where(goes).select("own.key", "own.print"), F.col(key), F.xxhash64(text))
    (name,) = fresh(docs.columns, "mark")  # no row that stays has the mark of one that goes
    return docs.join(few(cut(found.where(goes).select(_mark(F.col("own")).alias(name)).distinct())), _mark(own) == F.col(name), "left_anti")
