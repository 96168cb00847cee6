"""Exact deduplication by deterministic block naming.

Texts are cut into blocks of a fixed number of bytes. Distinct blocks are sorted and numbered;
neighbouring numbers are paired and the distinct pairs numbered in turn, until one number is left
for each document. Two documents have the same number on the same level exactly if all their bytes
agree: contents are compared, never digests. A 64-bit fingerprint only decides which blocks travel:
a block whose fingerprint occurs once has no equal, so that its document is alone and needs no number. Documents all of
whose blocks may have equals are found by key; up to so many keys as ``common.few`` sends to all tasks, no other body
moves, and beyond, the join that finds them moves each body once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import cut, few, fresh, multiplied, width, without

BLOCK = 8192


def _numbered(df: DataFrame) -> DataFrame:
    """df's distinct rows, sorted within partitions, with a number each."""
    distinct = df.distinct()
    return cut(distinct.sortWithinPartitions(*distinct.columns).withColumn("name", F.monotonically_increasing_id()), width(df))


def _names(content: DataFrame) -> DataFrame:
    """One (level, name) for each (key, sha) of content, which has their blocks: key, sha, nb, i, block."""
    first = _numbered(content.select("block"))
    now = cut(content.join(first, "block").select("key", "sha", "nb", "i", "name").distinct())
    level, done = 0, None
    while True:
        ready = now.where("nb = 1").select("key", "sha", F.lit(level).alias("level"), "name")
        done = ready if done is None else done.unionByName(ready)
        rest = now.where("nb > 1")
        if rest.isEmpty():
            return done
        pairs = rest.groupBy("key", "sha", "nb", F.floor(F.col("i") / 2).cast("int").alias("i")).agg(
            F.max(F.when(F.col("i") % 2 == 0, F.col("name"))).alias("a"), F.max(F.when(F.col("i") % 2 == 1, F.col("name"))).alias("b")
        )
        pairs = cut(pairs.select("key", "sha", F.ceil(F.col("nb") / 2).cast("int").alias("nb"), "i", "a", F.coalesce("b", F.lit(-1)).alias("b")))
        now = cut(pairs.join(_numbered(pairs.select("a", "b")), ["a", "b"]).select("key", "sha", "nb", "i", "name"))
        level += 1


def groups(docs: DataFrame, text: str = "text", key: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """One row per row of docs: key, keep_id, group_size, kept, text_sha256.

    Null text counts as empty, and empty texts equal each other. Of equal texts the row with the largest key
    stays, a null key being the smallest; of rows that repeat both key and text one stays. group_size counts
    rows. Other columns of docs are ignored.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"))
    rows = rows.select("key", F.sha2("body", 256).alias("sha"), F.greatest(F.lit(1), F.ceil(F.length("body") / block)).cast("int").alias("nb"), "body")
    piece = lambda i: F.substring(F.col("body"), i * block + 1, F.lit(block))
    prints = F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda i: F.xxhash64(piece(i)))
    keys = cut(rows.groupBy("key", "sha", prints.alias("prints")).agg(F.count("*").alias("m")))

    blocks = keys.select("key", "sha", F.size("prints").alias("nb"), F.explode("prints").alias("print"))
    repeated = cut(blocks.groupBy("print").count().where("count > 1").select("print"), width(docs))
    maybe = blocks.join(repeated, "print", "left_semi").groupBy("key", "sha", "nb").count().where("count = nb").select(F.col("key").alias("k"), F.col("sha").alias("s"))
    content = rows.join(few(cut(maybe)), F.col("key").eqNullSafe(F.col("k")) & (F.col("sha") == F.col("s")), "left_semi")
    content = cut(content.select("key", "sha", "nb", "body", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("i")).select("key", "sha", "nb", "i", piece(F.col("i")).alias("block")))

    named = _names(content).select(F.col("key").alias("k"), F.col("sha").alias("s"), "level", "name")
    marked = cut(keys.drop("prints").join(named, F.col("key").eqNullSafe(F.col("k")) & (F.col("sha") == F.col("s")), "left").drop("k", "s"))
    found = marked.where("name is not null")
    sizes = cut(found.groupBy("level", "name").agg(F.max("key").alias("keep_id"), F.sum("m").alias("group_size")), width(docs))
    alone = marked.where("name is null").select("key", "sha", "m", F.col("key").alias("keep_id"), F.col("m").alias("group_size"))
    every = found.join(sizes, ["level", "name"]).select(*alone.columns).unionByName(alone)
    return multiplied(every, "m", "nth").select(
        F.col("key").alias(key),
        "keep_id",
        "group_size",
        (F.col("key").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 0)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs with one row of each group of equal texts, the one that ``groups`` keeps.

    Null text counts as empty, a null key is the smallest; of rows that repeat both key and text one stays, any of them,
    whatever their other columns. Columns may have any names and hold nulls. Of a table without rows none stays.
    """
    found = cut(groups(docs, text, key).select(F.col(key).alias("key"), "text_sha256", "kept"))
    rows = found.groupBy("key", "text_sha256").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    sha = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    if not rows.where("kept and n > 1").isEmpty():
        (name,) = fresh(docs.columns, "sha_")
        docs = docs.withColumn(name, sha).dropDuplicates([key, name]).drop(name)
    return without(docs, rows.where("not kept").select("key", "text_sha256"), F.col(key), sha)
