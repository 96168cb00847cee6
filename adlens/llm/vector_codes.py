"""Compression of vectors to codes: the nearest entry of a codebook for each part of a vector, in whole numbers.

The entries of a part position lie in a vantage-point tree. A node holds one entry and, for each of its two subtrees, the
least and greatest distance from that entry to theirs, the one rounded down and the other up. A search goes to a subtree
if its bound, rounded down, is not above the best distance so far: equal bounds are visited too, so that ties go to the lower
index. Distances that decide are squares in whole numbers; square roots only prune.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import arrow, cut, few

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Sums of squares below this stay in 64 bits.
SAFE = 1 << 62
_isqrt = np.frompyfunc(math.isqrt, 1, 1)


def _roots(square: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Square roots rounded down and up."""
    if square.dtype == object:
        down = _isqrt(square)
    else:
        down = np.sqrt(square.astype(np.float64)).astype(np.int64)
        down -= down * down > square
        down += (down + 1) * (down + 1) <= square
    return down, down + (down * down < square)


def whole(values: np.ndarray) -> np.ndarray:
    """floor(4096 * x) of finite numbers, in 64 bits where they fit and as Python's integers otherwise."""
    x = values.astype(np.float64)
    if not x.size or np.abs(x).max() < 2.0**40:
        return np.floor(x * SCALE).astype(np.int64)
    return np.array([int(v) * SCALE if abs(v) >= 2.0**53 else math.floor(v * SCALE) for v in x.ravel().tolist()], object).reshape(x.shape)


@dataclass
class Node:
    entry: int
    under: list[tuple[int, int, Node]]


def tree(entries: np.ndarray, index: list[int] | None = None) -> Node:
    """A vantage-point tree over entries: the first is the vantage point, the others are halved by their distance from it."""
    index = list(range(len(entries))) if index is None else index
    top, rest = index[0], index[1:]
    d = {i: int(sum((int(a) - int(b)) ** 2 for a, b in zip(entries[i], entries[top], strict=True))) for i in rest}
    rest.sort(key=lambda i: (d[i], i))
    half = (len(rest) + 1) // 2
    under = []
    for part in filter(None, (rest[:half], rest[half:])):
        low, high = math.isqrt(d[part[0]]), math.isqrt(d[part[-1]])
        under.append((low, high + (high * high < d[part[-1]]), tree(entries, sorted(part))))
    return Node(top, under)


def nearest(x: np.ndarray, entries: np.ndarray, root: Node) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x the index of the nearest entry, the lowest of equally near ones, and its squared distance. All are whole numbers of one type."""
    best = np.full(len(x), SAFE if x.dtype != object else math.inf, x.dtype)
    found = np.full(len(x), len(entries), np.int64)

    def visit(node: Node, rows: np.ndarray) -> None:
        if not len(rows):
            return
        square = ((x[rows] - entries[node.entry]) ** 2).sum(axis=1)
        if x.dtype == object:
            square = square.astype(object)
        nearer = (square < best[rows]) | ((square == best[rows]) & (node.entry < found[rows]))
        best[rows[nearer]], found[rows[nearer]] = square[nearer], node.entry
        if not node.under:
            return
        down, up = _roots(square)
        bounds = [np.maximum(np.maximum(low - up, down - high), 0) for low, high, _ in node.under]
        first = bounds[0] <= bounds[-1] if len(bounds) > 1 else np.ones(len(rows), bool)
        for near in (True, False):
            mine = first == near
            for k in range(len(bounds)) if near else reversed(range(len(bounds))):
                b, r = bounds[k][mine], rows[mine]
                visit(node.under[k][2], r[(b * b <= best[r]).astype(bool)])

    visit(root, np.arange(len(x)))
    return found, best


def encode(x: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The index of the nearest entry for each row and part, and the squared distances summed over parts."""
    size = x.shape[1] // len(books)
    most = max([0, *(int(abs(v).max()) for v in (x, *books) if v.size)])
    kind = np.int64 if x.shape[1] * (2 * most) ** 2 < SAFE else object
    x = x.astype(kind)
    codes, error = np.empty((len(x), len(books)), np.int64), np.zeros(len(x), kind)
    for p, book in enumerate(books):
        book = book.astype(kind)
        codes[:, p], d = nearest(x[:, p * size : (p + 1) * size], book, tree(book))
        error = error + d
    return codes, error


def _batches(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for b in batches:
        if b.num_rows:
            yield b, whole(b.column("vector_").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dims))


def _limbs(n: int) -> Iterator[tuple[int, int]]:
    """n in pieces of 32 bits, lowest first, the last with the sign: whatever its size, pieces can be added up in 64 bits."""
    k = 0
    while not -(1 << 31) <= n < 1 << 31:
        yield k, n & 0xFFFFFFFF
        n, k = n >> 32, k + 1
    yield k, n


def _round(rows: DataFrame, books: list[np.ndarray], dims: int) -> list[np.ndarray]:
    """The codebooks after one round: each entry is the mean, rounded down, of the parts nearest to it."""
    size = dims // len(books)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for _, x in _batches(batches, dims):
            codes, _ = encode(x, books)
            for p in range(len(books)):
                for e in np.unique(codes[:, p]).tolist():
                    mine = codes[:, p] == e
                    now = np.append(x[mine, p * size : (p + 1) * size].sum(axis=0), mine.sum()).astype(object)
                    total[p, e] = total[p, e] + now if (p, e) in total else now
        out = [(p, e, i, k, v) for (p, e), s in total.items() for i, n in enumerate(s.tolist()) for k, v in _limbs(int(n))]
        yield arrow(dict(zip(("part", "entry", "position", "limb", "value"), np.array(out, np.int64).reshape(-1, 5).T.copy(), strict=True)))

    parts = rows.select("vector_").mapInArrow(sums, "part long, entry long, position long, limb long, value long")
    new = [[[int(v) for v in row] for row in b.tolist()] for b in books]
    total: dict[tuple[int, int], list[int]] = {}
    for r in parts.groupBy("part", "entry", "position", "limb").agg(F.sum("value").alias("value")).collect():  # so many as the codebooks have components
        total.setdefault((r["part"], r["entry"]), [0] * (size + 1))[r["position"]] += r["value"] << (32 * r["limb"])
    for (p, e), s in total.items():
        new[p][e] = [n // s[-1] for n in s[:-1]]
    return [_book(b, size) for b in new]


def _book(entries: list[list[int]], size: int) -> np.ndarray:
    big = any(abs(v) >= 1 << 60 for row in entries for v in row)
    return np.array(entries, object if big else np.int64).reshape(len(entries), size)


@dataclass
class Codebooks:
    """The fitted entries of all part positions, each an array of entries by components."""

    books: list[np.ndarray]
    dims: int

    def digest(self) -> str:
        """SHA-256 of all entries' components by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(str(int(v)) for b in self.books for row in b.tolist() for v in row).encode()).hexdigest()


def kept(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows whose vector isn't null and holds finite numbers only."""
    return vectors.where(F.col(vector).isNotNull() & F.forall(vector, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")), F.lit(False))))


def fit(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of all kept vectors: the parts of the vectors with the smallest keys, then so many rounds of means.

    Every round reads all vectors, adds up in each task, and gathers one sum for each component of the codebooks. A null key is
    the largest; of several vectors of one key the smallest seeds. Vectors have as many components as the one with the smallest key;
    others are left aside. None where there is no kept vector or its components can't be cut into equal parts. Codes are written in
    two hex digits, so that there are 256 entries at most.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries")
    rows = kept(vectors, vector).select(F.col(key).alias("key_"), F.col(vector).alias("vector_"))
    ids = [r[0] for r in rows.select("key_").distinct().orderBy(F.col("key_").asc_nulls_last()).limit(entries).collect()]
    mine = F.coalesce(F.col("key_").isin([i for i in ids if i is not None]), F.lit(False)) | (F.col("key_").isNull() & F.lit(None in ids))
    first = rows.where(mine).groupBy("key_").agg(F.min("vector_").alias("vector_")).orderBy(F.col("key_").asc_nulls_last()).collect()
    dims = len(first[0]["vector_"]) if first else 1
    if dims % parts:
        return None
    seeds = whole(np.array([[float(v) for v in r["vector_"]] for r in first if len(r["vector_"]) == dims]).reshape(-1, dims))
    books = [_book(seeds[:, p * dims // parts : (p + 1) * dims // parts].tolist(), dims // parts) for p in range(parts)]
    rows = rows.where(F.size("vector_") == dims)
    for _ in range(rounds):
        books = _round(rows, books, dims)
    return Codebooks(books, dims)


def codes(vectors: DataFrame, model: Codebooks | None, keep: list[Column], vector: str = "embedding", label: str = "label") -> DataFrame:
    """For every kept row the columns in `keep`, code, error, and label_error, the errors of all rows of its label (null being one).

    Rows whose vector is null or holds null, NaN or infinite components are dropped. Vectors of another length than the model's
    have no code and no error; an error beyond 64 bits is null, as is a sum of them. Rows that repeat are coded each;
    other columns are ignored; an empty table gives none. Errors are added up by label in each task first, and labels joined by sending the
    sums to all tasks while they are few, so that a label may have any share of the rows.
    """
    rows = kept(vectors, vector).select(*keep, F.col(label).alias("label_"), F.col(vector).alias("vector_"))
    names = rows.columns[:-1]
    fits = F.size("vector_") == (model.dims if model else -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x in _batches(batches, model.dims):
            found, error = encode(x, model.books)
            text = np.frombuffer(found.astype(np.uint8).tobytes().hex().encode(), np.uint8)
            off = np.arange(b.num_rows + 1, dtype=np.int32) * (2 * found.shape[1])
            code = pa.Array.from_buffers(pa.string(), b.num_rows, [None, pa.py_buffer(off), pa.py_buffer(text)])
            error = pa.array([e if e < 1 << 63 else None for e in error.tolist()], pa.int64())
            yield arrow({**{n: b.column(n) for n in names}, "code": code, "error": error})

    schema = rows.drop("vector_").schema.add("code", "string").add("error", "long")
    none = rows.where(~fits).select(*[f"`{n}`" for n in names], F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    coded = cut(none if model is None else rows.where(fits).mapInArrow(run, schema).unionByName(none))
    total = F.when(F.count("error") == F.count(F.when(F.col("code").isNotNull(), 1)), F.sum(F.col("error").cast("decimal(20,0)"))).try_cast("long")
    labels = coded.groupBy(F.col("label_").alias("same_")).agg(total.alias("label_error"))
    return coded.join(few(cut(labels)), F.col("label_").eqNullSafe(F.col("same_"))).drop("label_", "same_")
