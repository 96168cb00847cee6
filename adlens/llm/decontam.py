"""Benchmark decontamination with a positional inverted index, split by document.

Pass one counts in how many places each test term stands in the corpus. Pass two indexes the corpus: every
task stores, for each stretch of documents it reads, the postings (sorted places) of the test terms, and
answers all test phrases from them: the postings of a phrase's rarest term, moved by its offset, are
intersected with those of the next rarest, and so on, until all terms have agreed or nothing is left. With
``slop`` a term may stand so many words off its place (proximity); without, matches are exact phrases.

Documents never move, so that neither a common passage nor a common term gathers anywhere. Test items travel
to all tasks in blocks of a bounded number of words, one pass for each block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.chars import sums_by_row
from adlens.llm.common import arrow, cut, row_of, slices, without, word_hashes

WINDOW = 13
#: Words are runs of 0-9, a-z and all characters beyond ASCII, after A-Z are lower-cased.
BREAKS = np.ones(256, bool)
BREAKS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
#: Test words that go to every task at once, with their windows in arrays of some 40 bytes a word together.
BLOCK_WORDS = 1_000_000
NO_ID = -1


@dataclass
class Block:
    terms: np.ndarray  # sorted hashes
    flat: np.ndarray  # the items' words one after another, as numbers of terms
    starts: np.ndarray  # where each window starts in flat
    sizes: np.ndarray
    owners: np.ndarray  # each window's item, NO_ID for items without an id
    items: list[str]


def blocks(items: DataFrame, text: str, key: str, window: int, most: int = BLOCK_WORDS) -> Iterator[Block]:
    """The distinct items as windows of terms, read block by block; items without words have none."""
    rows = cut(items.where(F.col(text).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(text).cast("string").alias("text")).distinct())
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0  # a word has a character at least, and one beside it
    n = max(1, -(-size // (2 * most)))
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("key", "text"), F.lit(n)) == k).toArrow()
        words, first = word_hashes(part.column("text").combine_chunks(), BREAKS)
        keys = part.column("key").to_pylist()
        terms, flat = np.unique(words, return_inverse=True)
        names = sorted({x for x in keys if x is not None})
        place = {x: i for i, x in enumerate(names)} | {None: NO_ID}
        length = np.diff(first)
        each = np.where(length > 0, np.maximum(1, length - window + 1), 0)
        of = np.repeat(np.arange(len(keys)), each)
        starts = first[:-1][of] + np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)
        owners = np.array([place[x] for x in keys], np.int32)
        yield Block(terms, flat.astype(np.int32), starts, np.minimum(length, window)[of], owners[of] if len(keys) else owners, names)


def _occurrences(docs: DataFrame, block: Block, text: str) -> np.ndarray:
    """How often each of the block's terms stands in docs."""
    shared = docs.sparkSession.sparkContext.broadcast(block.terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, n = shared.value, np.zeros(len(shared.value), np.int64)
        for b in slices(batches):
            n += np.bincount(numbers(word_hashes(b.column("text"), BREAKS)[0], terms), minlength=len(terms) + 1)[:-1]
        at = np.flatnonzero(n)
        yield arrow({"term": at, "n": n[at]})

    out = np.zeros(len(block.terms), np.int64)
    if len(out):
        got = docs.select(F.col(text).alias("text")).mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
        out[got["term"]] = got["n"]
    return out


def _all(term: np.ndarray, block: Block) -> np.ndarray:
    """Whether `term` holds for all terms of each window."""
    short = np.concatenate([[0], np.cumsum(~term[block.flat])])
    return short[block.starts + block.sizes] == short[block.starts]


def numbers(words: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Each word's number among the terms, or their count."""
    if not len(terms):
        return np.zeros(len(words), np.int64)
    at = np.minimum(np.searchsorted(terms, words), len(terms) - 1)
    return np.where(terms[at] == words, at, len(terms))


class Postings:
    """The sorted places of every term in one stretch of documents."""

    def __init__(self, found: np.ndarray, terms: int) -> None:
        at = np.flatnonzero(found < terms)
        self.places = at[np.argsort(found[at], kind="stable")]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(found[at], minlength=terms))])

    def of(self, term: int) -> np.ndarray:
        return self.places[self.first[term] : self.first[term + 1]]

    def starts(self, terms: np.ndarray, offsets: np.ndarray, slop: int) -> np.ndarray:
        """Where phrases start: terms from the rarest on, offsets their places in the phrase."""
        got = self.of(terms[0]) - offsets[0]
        for t, o in zip(terms[1:], offsets[1:], strict=True):
            if not len(got):
                break
            p = self.of(t)
            if not len(p):
                return p
            at = np.searchsorted(p, got + o - slop)
            got = got[(at < len(p)) & (p[np.minimum(at, len(p) - 1)] <= got + o + slop)]
        return got


def matches(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text", item_key: str = "item_id", window: int = WINDOW, slop: int = 0, block_words: int = BLOCK_WORDS) -> list[DataFrame]:
    """For each block of items, a row per row of docs: row keys, n_words, hits and found.

    hits are the flattened starts and ends, in words, of stretches that windows cover; found are the ids of the
    items, null for all without an id. Null texts have no words and no hits.
    """
    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("print"), F.col(text).alias("text"))
    out = []
    for block in blocks(items, item_text, item_key, window, block_words):
        n = _occurrences(rows, block, "text")
        some = _all(n > 0, block)
        held = Block(block.terms, block.flat, block.starts[some], block.sizes[some], block.owners[some], block.items)
        shared = docs.sparkSession.sparkContext.broadcast((held, n))

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            held, n = shared.value
            for b in slices(batches):
                words, first = word_hashes(b.column("text"), BREAKS)
                index = Postings(numbers(words, held.terms), len(held.terms))
                row = row_of(first)
                edge = np.zeros(len(words) + 1, np.int64)
                found: dict[int, set[int]] = {}
                for k in np.flatnonzero(_all(np.diff(index.first) > 0, held)):
                    size = int(held.sizes[k])
                    ts = held.flat[held.starts[k] : held.starts[k] + size]
                    offsets = np.argsort(n[ts], kind="stable")
                    s = index.starts(ts[offsets], offsets, slop)
                    s = s[(s >= 0) & (s + size <= len(words))]
                    s = s[row[s] == row[s + size - 1]] if len(s) else s
                    np.add.at(edge, s, 1)
                    np.add.at(edge, s + size, -1)
                    for r in set(row[s].tolist()):
                        found.setdefault(r, set()).add(int(held.owners[k]))
                hit = np.cumsum(edge[:-1]) > 0
                hits = [[] for _ in range(b.num_rows)]
                for r in found:
                    h = np.diff(hit[first[r] : first[r + 1]].astype(np.int8), prepend=0, append=0)
                    hits[r] = np.flatnonzero(h).astype(np.int32).tolist()
                yield pa.RecordBatch.from_arrays(
                    [b.column("key"), b.column("print"), pa.array(np.diff(first)), pa.array(hits, pa.list_(pa.int32())), pa.array([[held.items[i] if i >= 0 else None for i in found.get(r, ())] for r in range(b.num_rows)], pa.list_(pa.string()))],
                    ["key", "print", "n_words", "hits", "found"],
                )

        out.append(rows.mapInArrow(search, f"key {kind}, print long, n_words long, hits array<int>, found array<string>"))
    return out


def _merged(hits: pd.Series) -> pd.Series:
    """The number of words that the stretches cover together."""

    def size(flat: np.ndarray) -> int:
        n = end = 0
        for s, e in sorted(zip(flat[::2], flat[1::2], strict=True)):
            n += max(0, e - max(s, end))
            end = max(end, e)
        return int(n)

    return hits.map(size)


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """One row per row of docs: key, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit where an occurrence of a window of an item covers it; a document is contaminated if a twentieth
    of its words are hit, one at least. Null and empty texts have no words and aren't contaminated. Items without words
    are ignored; those without an id hit words like others, but aren't among the items counted and listed. Repeated ids
    count once. Rows that repeat give the same result each, columns of either table may have any other names, and without
    items nothing is hit.
    """
    parts = matches(docs, items, key=key, **options)
    every = parts[0]
    if len(parts) > 1:  # only documents with hits meet, by their key; all others are as the first block says
        hit = None
        for p in parts[1:]:
            some = p.where("size(found) > 0").dropDuplicates(["key", "print"]).select(F.col("key").alias("k"), F.col("print").alias("p"), F.col("hits").alias("h"), F.col("found").alias("f"))
            hit = some if hit is None else hit.unionByName(some)
        more = hit.groupBy("k", "p").agg(F.flatten(F.collect_list("h")).alias("h"), F.flatten(F.collect_list("f")).alias("f"))
        every = every.join(more, F.col("key").eqNullSafe(F.col("k")) & (F.col("print") == F.col("p")), "left").select(
            "key", "n_words", F.concat("hits", F.coalesce("h", F.array().cast("array<int>"))).alias("hits"), F.concat("found", F.coalesce("f", F.array().cast("array<string>"))).alias("found")
        )
        n_hit = F.pandas_udf(_merged, "long")("hits")
    else:
        n_hit = F.aggregate(F.transform("hits", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"), lambda a, x: a + x)
    ids = F.array_sort(F.array_compact(F.array_distinct("found")))
    return every.select(F.col("key").alias(key), "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )


def clean(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs without the contaminated rows, found by key and text, null being a value.

    Texts that are null or without words stay. Rows that repeat both all stay or all go; other columns, of any names
    and with nulls, stay as they are. Without items all rows stay, of a table without rows none.
    """
    own = F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("print"))
    found = contamination(docs.select(own.alias("own"), F.col(text).alias("text")), items, key="own")
    return without(docs, found.where("contaminated").select("own.key", "own.print"), F.col(key), F.xxhash64(text))
