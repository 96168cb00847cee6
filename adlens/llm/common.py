"""What several text operators share: reading, cutting lineage, and word hashing on Arrow buffers."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DatetimeType, NumericType

#: Text is worked on in slices of about this many bytes, whatever Spark's batch holds.
SLICE_BYTES = 2 << 20
#: Bytes between words: space and \t \n \v \f \r.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
#: Maps A-Z to a-z and leaves every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def findable(spark: SparkSession) -> None:
    """Let the workers of a local session import this package from where the driver has it."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    findable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; on one machine, where none is set, as in tests, a folder of its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="adlens-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Write df to the shared folder and go on from there; with parts, dealt evenly first.

    Dealing evenly also forgets by what keys the rows were grouped, so that a later join
    deals out both its sides and Spark can split a hot key.
    """
    shared_dir(df.sparkSession)
    return (df.repartition(parts) if parts else df).checkpoint()


def swept(spark: SparkSession) -> None:
    """Let go of relations, shuffles and files that no frame needs any more; the driver's Java shrinks only when it collects all its garbage."""
    spark.sparkContext._jvm.System.gc()


def width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def packed(df: DataFrame, n: int, rows: int = 100_000) -> DataFrame:
    """What is cut, in as many tasks as n rows need; it no longer counts as grouped by any key."""
    return df.coalesce(max(1, min(width(df), n // rows + 1)))


#: What goes to every task has so many rows and bytes at most; beyond, Spark joins by key.
FEW, FEW_BYTES = 1_000_000, 64 << 20


def few(df: DataFrame, n: int | None = None, most: int = FEW) -> DataFrame:
    """df, to be sent to every task where it is small enough: its rows (n at most, or counted here) and bytes are bounded. Give it what is cut."""
    if (df.count() if n is None else n) > most:
        return df
    fixed = [f for f in df.schema.fields if isinstance(f.dataType, (NumericType, BooleanType, DatetimeType))]
    size = F.lit(16 * (1 + len(fixed)))
    if rest := [f"`{f.name}`" for f in df.schema.fields if f not in fixed]:
        size = size + F.octet_length(F.to_json(F.struct(*rest)))
    elif n is None or 16 * (1 + len(fixed)) * n <= FEW_BYTES:
        return F.broadcast(df)
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= FEW_BYTES else df


def fresh(taken: Iterable[str], *names: str) -> list[str]:
    """These names, each with so many underscores after it that it is none of those taken."""
    used, out = {t.lower() for t in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


#: Rows that one row is made into at a time.
REPEATS = 10_000


def multiplied(df: DataFrame, times: str, nth: str) -> DataFrame:
    """Each row of df so many times as its column `times` says, numbered from 0 in `nth`; no long array is ever built."""
    n = F.col(times)
    starts = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / REPEATS)), lambda i: i.cast("long") * REPEATS)
    return df.withColumn(nth, F.explode(starts)).withColumn(nth, F.explode(F.sequence(F.col(nth), F.least(F.col(nth) + REPEATS, n.cast("long")) - 1)))


def without(docs: DataFrame, gone: DataFrame, *keys: Column) -> DataFrame:
    """docs without the rows whose keys are a row of gone, null being a value. Columns of docs may have any names."""
    names = fresh(docs.columns, *[f"gone_{i}" for i in range(len(keys))])
    gone = few(cut(gone.toDF(*names).distinct()))
    same = F.lit(True)
    for k, n in zip(keys, names, strict=True):
        same = same & k.eqNullSafe(F.col(n))
    return docs.join(gone, same, "left_anti")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null where the id is null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let_go() -> None:
    """Workers live on from task to task; what this one took goes back."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in pieces that hold about `most` bytes of text each, or one longer row."""
    try:
        yield from _slices(batches, column, most)
    finally:
        let_go()


def _slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        n = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False))])
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(n, n[at] + most, "right")) - 1)
            yield b.slice(at, to - at)
            at = to


def valid(text: Column) -> Column:
    """The text with bytes that aren't UTF-8 as U+FFFD, as workers that read characters need it."""
    text = text.cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(F.make_valid_utf8(text))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows one after another, and each row's start with the end last. Null is empty."""
    a = pc.fill_null(column, "").cast(pa.large_binary())
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2], np.uint8)[off[0] : off[-1]] if a.buffers()[2] and off[-1] > off[0] else np.empty(0, np.uint8)
    return data, off - off[0]


def spans(word: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs where `word` holds, none across rows; and each row's first run, the total last."""
    if not len(word):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(off), np.int64)
    edge = np.zeros(len(word) + 1, bool)
    edge[off] = True
    before = np.concatenate([[False], word[:-1]])
    before[edge[:-1]] = False
    after = np.concatenate([word[1:], [False]])
    after[edge[1:]] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, off)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, eight bytes at a time."""
    n = (ends - starts).astype(np.int64)
    out = mix(n.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    at8 = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))
    left, i = n, np.arange(len(n))
    lane = 0
    while len(i):
        keep = np.minimum(left[i] - lane, 8).astype(np.uint64)
        x = at8[starts[i] + lane] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - keep * np.uint64(8)))
        out[i] = mix(out[i] ^ x * np.uint64(0x9E3779B97F4A7C15)) + x
        lane += 8
        i = i[left[i] > lane]
    return out


def join2(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One hash of two; the order counts."""
    return mix(a * np.uint64(0xD1342543DE82EF95) + mix(b ^ np.uint64(0x2545F4914F6CDD1D)))


def word_hashes(column: pa.Array, blanks: np.ndarray = BLANKS, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word of all rows, and where each row's words start, the total last."""
    data, off = text_bytes(column)
    if lower:
        data = LOWER[data]
    starts, ends, first = spans(~blanks[data], off)
    return hashes(data, starts, ends), first


def row_of(first: np.ndarray) -> np.ndarray:
    """The row of each element, from the rows' starts with the total last."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def arrow(columns: dict[str, np.ndarray | pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()], list(columns))
