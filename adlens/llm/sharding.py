"""Sharding by fixed virtual slots: records are hashed into thousands of slots, and a stored map says which shard has a slot.

The hash of a record and the number of slots never change; what changes is the map, of which every version is kept. To balance
shards, the bytes of each slot are added up, and slots move, the fewest that do, from the heaviest shards to the
lightest; to add shards, slots move to the new ones only. No record is looked at for either.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlens.llm.common import cut, few, fresh, multiplied
from adlens.llm.mixing import numbered

SLOTS, SHARDS = 16_384, 16
#: Shards whose bytes differ by less than this share of their mean count as even.
EVEN = 0.0005


def _exchange(heavy: np.ndarray, light: np.ndarray, gap: float) -> tuple[int, int | None] | None:
    """Which of heavy's weights to move, and which of light's to take for it (None: nothing), so that the gap shrinks most; None if it can't."""
    if not len(heavy):
        return None
    order = np.argsort(light, kind="stable")
    back = np.concatenate([[0], light[order]])
    at = np.clip(np.searchsorted(back, heavy - gap / 2), 0, len(back) - 1)
    at = np.where((at > 0) & (np.abs(heavy - back[np.maximum(at - 1, 0)] - gap / 2) <= np.abs(heavy - back[at] - gap / 2)), at - 1, at)
    shift = heavy - back[at]
    good = np.flatnonzero((shift > 0) & (shift < gap))
    if not len(good):
        return None
    i = good[np.argmin(np.abs(shift[good] - gap / 2))]
    return int(i), None if at[i] == 0 else int(order[at[i] - 1])


def balanced(owner: np.ndarray, weight: np.ndarray, shards: int, even: float = EVEN) -> np.ndarray:
    """The map owner (a shard for each slot), edited by moves and swaps of slots between two shards until none makes them more even, or all are within `even` of their mean."""
    owner, load = owner.copy(), np.bincount(owner, weight, shards)
    enough = even * weight.sum() / shards
    while True:
        by = np.argsort(load, kind="stable")
        for high, low in ((h, l) for h in by[::-1] for l in by if load[h] - load[l] > enough):
            mine, theirs = np.flatnonzero((owner == high) & (weight > 0)), np.flatnonzero((owner == low) & (weight > 0))
            if found := _exchange(weight[mine], weight[theirs], load[high] - load[low]):
                shift = weight[mine[found[0]]]
                owner[mine[found[0]]] = low
                if found[1] is not None:
                    shift -= weight[theirs[found[1]]]
                    owner[theirs[found[1]]] = high
                load[high] -= shift
                load[low] += shift
                break
        else:
            return owner


def grown(owner: np.ndarray, weight: np.ndarray, shards: int, more: int = 1) -> np.ndarray:
    """The map owner for `more` shards beyond `shards`: each new one takes slots from the heaviest until it has its share; no slot moves elsewhere."""
    owner, load = owner.copy(), np.bincount(owner, weight, shards + more)
    share = weight.sum() / (shards + more)
    for new in range(shards, shards + more):
        stuck: set[int] = set()
        while load[new] < share and len(stuck) < shards:
            high = max((s for s in range(shards) if s not in stuck), key=lambda s: load[s])
            mine = np.flatnonzero((owner == high) & (weight > 0))
            fits = mine[weight[mine] <= min(share - load[new], load[high] - load[new])]
            if not len(fits):
                stuck.add(high)
                continue
            slot = fits[np.argmax(weight[fits] * (weight[fits] <= max(load[high] - share, weight[fits].min())))]
            owner[slot] = new
            load[high] -= weight[slot]
            load[new] += weight[slot]
    return owner


def store(spark: SparkSession, path: str, version: int, owner: np.ndarray, weight: np.ndarray, rows: np.ndarray) -> None:
    """Write one version of a map, with each slot's bytes and rows when it was made; a version is never written twice."""
    if len(owner) > 1 << 20:
        raise ValueError("the map of slots is kept by the driver and sent to all tasks: at most 2**20 slots")
    table = spark.createDataFrame([(version, s, int(o), int(w), int(n)) for s, (o, w, n) in enumerate(zip(owner, weight, rows, strict=True))], "version int, vslot int, shard int, bytes long, rows long")
    table.coalesce(1).write.partitionBy("version").mode("append").parquet(path)


def stored(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the map at path, the newest whole one unless told: version, vslot, shard, bytes, rows."""
    every = spark.read.schema("vslot int, shard int, bytes long, rows long, version int").parquet(path)
    if version is None:
        whole = every.groupBy("version").agg(F.count("*").alias("n"), F.max("vslot").alias("last")).where("n = last + 1").agg(F.max("version")).first()[0]
        version = -1 if whole is None else whole
    return every.where(F.col("version") == version)


def records(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """How often each key, size and text_crc32 occurs (m). The size is the bytes of the text and one; a null text has none."""
    body = F.coalesce(F.col(text).cast("string").cast("binary"), F.lit("").cast("binary"))
    return docs.select(F.col(key).alias("key"), (F.length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32")).groupBy("key", "size", "text_crc32").agg(F.count("*").alias("m"))


def vslot(nth: str, slots: int, key: str = "key", size: str = "size", crc: str = "text_crc32") -> Column:
    """The virtual slot of the nth of the records alike in key, size and crc."""
    return F.pmod(F.xxhash64(key, size, crc, nth), F.lit(slots)).cast("int")


def place(docs: DataFrame, path: str, shards: int = SHARDS, slots: int = SLOTS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per row of docs: key, size, text_crc32, shard, slot (its place in the shard, from 0 without gaps), vslot, version.

    The map at path is taken in its newest version, or else made: version 0 deals slots out in turn. If shards aren't even by
    bytes under it, the edited map is stored as the next version and used; where it has fewer shards, it is edited so that slots
    move to the new ones only. Null texts have size 1, keys may be null. Rows that
    repeat are records of their own and hashed by how many came before, so that any number of them spread over all slots. Other
    columns are ignored; an empty table gives none. What the driver holds is one row a virtual slot. A shard's rows are numbered slot by
    slot, so that no task has more than some of the slots.
    """
    spark = docs.sparkSession
    each = cut(multiplied(cut(records(docs, text, key)), "m", "nth").withColumn("vslot", vslot("nth", slots)).drop("m"))
    weight, rows = np.zeros(slots, np.int64), np.zeros(slots, np.int64)
    for r in each.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect():
        weight[r["vslot"]], rows[r["vslot"]] = r["bytes"], r["rows"]
    try:
        now = sorted(stored(spark, path).collect(), key=lambda r: r["vslot"])
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        now = []
    if now:
        owner, version = np.array([r["shard"] for r in now]), now[0]["version"]
        have = int(owner.max()) + 1
        if len(owner) != slots or have > shards:
            raise ValueError(f"the map at {path} has {len(owner)} slots and {have} shards")
    else:
        owner, version, have = np.arange(slots) % shards, 0, shards
        store(spark, path, version, owner, weight, rows)
    edited = grown(owner, weight, have, shards - have) if have < shards else balanced(owner, weight, shards)
    if (edited != owner).any():
        owner, version = edited, version + 1
        store(spark, path, version, owner, weight, rows)
    begin = np.zeros(slots, np.int64)
    for s in range(shards):
        mine = np.flatnonzero(owner == s)
        begin[mine] = np.cumsum(rows[mine]) - rows[mine]
    slotmap = spark.createDataFrame(list(zip(range(slots), owner.tolist(), begin.tolist(), strict=True)), "vs int, shard int, begin long")
    number = F.row_number().over(Window.partitionBy("vslot").orderBy("key", "size", "text_crc32", "nth"))
    placed = each.withColumn("number", number).join(F.broadcast(slotmap), F.col("vslot") == F.col("vs"))
    return placed.select(F.col("key").alias(key), "size", "text_crc32", "shard", (F.col("begin") + F.col("number") - 1).alias("slot"), "vslot", F.lit(version).alias("version"))


def write(docs: DataFrame, path: str, to: str, files: int = 4, text: str = "text", key: str = "doc_id") -> None:
    """Write docs as Parquet, a folder a shard, under the newest version of the map at path; `files` is how many a shard's rows are dealt to.

    Of rows alike in key, size and checksum, which goes where is any of them: they are numbered across tasks.
    """
    spark, body = docs.sparkSession, F.coalesce(F.col(text).cast("string").cast("binary"), F.lit("").cast("binary"))
    slots = stored(spark, path)
    n = slots.count()
    k, s, c, nth, first, v, shard = fresh(docs.columns, "key_", "size_", "crc_", "nth_", "first_", "vslot_", "shard")
    rows = docs.withColumn(k, F.col(key)).withColumn(s, (F.length(body) + 1).cast("long")).withColumn(c, F.crc32(body))
    twice = few(cut(records(docs, text, key).where("m > 1").select(F.col("key").alias("k_"), F.col("size").alias("s_"), F.col("text_crc32").alias("c_"))))
    same = F.col(k).eqNullSafe(F.col("k_")) & (F.col(s) == F.col("s_")) & (F.col(c) == F.col("c_"))
    many = numbered(cut(rows.join(twice, same, "left_semi")), [k, s, c], [], nth, first)
    rows = rows.join(twice, same, "left_anti").withColumn(nth, F.lit(0).cast("long")).unionByName(many.withColumn(nth, F.col(nth) - F.col(first)).drop(first))
    slotmap = slots.select(F.col("vslot").alias("vs_"), F.col("shard").alias(shard))
    rows = rows.withColumn(v, vslot(nth, n, k, s, c)).join(F.broadcast(slotmap), F.col(v) == F.col("vs_"))
    rows = rows.repartition(files * slots.agg(F.max("shard")).first()[0] + files, F.col(shard), F.col(v) % files)
    rows.select(*[f"`{x}`" for x in docs.columns], shard).write.partitionBy(shard).parquet(to)
