"""Quality classifier: naive Bayes support vectors.

Indicators of hashed character n-grams, and of one word three times in a row, are scaled by the classes' log-count ratios; a linear model with
hinge loss is fitted to them by dual coordinate descent, and its margins are mapped to probabilities.
The fit sees a bounded sample of the labelled rows (SAMPLE); every document is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm import chars
from adlens.llm.common import cut, slices, word_hashes

SIZES = (1, 2, 3)
#: Labelled rows that the fit sees at most, those with the smallest hashes of their ids.
SAMPLE = 10_000
#: Rows marked in one table of indicators, of 64 KB a row.
ROWS = 512
#: Indicators: the buckets, the place of what isn't counted, and the repeated word.
AGAIN = chars.NONE + 1
WIDTH = chars.NONE + 2


@dataclass
class Model:
    weights: np.ndarray  # by bucket, the log-count ratio included
    bias: float
    slope: float
    offset: float


def indicators(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For stretches of rows: the first row, the distinct buckets of its rows one after another, and the rows' starts."""
    for at in range(0, len(column), ROWS):
        part = column.slice(at, ROWS)
        p, off = chars.code_points(part)
        seen = np.zeros((len(part), WIDTH), bool)
        row = np.repeat(np.arange(len(part)), np.diff(off))
        for n in SIZES:
            seen[row, chars.buckets(p, off, n)] = True
        seen[:, chars.NONE] = False
        words, first = word_hashes(part)
        row = np.repeat(np.arange(len(part)), np.diff(first))
        same = (words[2:] == words[1:-1]) & (words[1:-1] == words[:-2]) & (row[2:] == row[:-2])
        seen[row[2:][same], AGAIN] = True
        flat = np.flatnonzero(seen.reshape(-1))
        rows, cols = np.divmod(flat, WIDTH)
        yield at, cols, np.searchsorted(rows, np.arange(len(part) + 1))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        for at, cols, off in indicators(b.column("text")):
            n = len(off) - 1
            packed = [cols[i:j].astype(np.uint32).tobytes() for i, j in zip(off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("order").slice(at, n), b.column("label").slice(at, n), pa.array(packed, pa.binary())], ["order", "label", "x"])


def dual_descent(x: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: np.ndarray, epochs: int = 12, seed: int = 7) -> np.ndarray:
    """Weights by bucket, the bias last, of the hinge-loss model over indicators times `ratio`."""
    w = np.zeros(len(ratio) + 1)
    scaled = [ratio[i] for i in x]
    norm = np.array([v @ v + 1 for v in scaled])
    a = np.zeros(len(x))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(x)):
            g = y[i] * (scaled[i] @ w[x[i]] + w[-1]) - 1
            new = min(max(a[i] - g / norm[i], 0.0), cost[i])
            if d := (new - a[i]) * y[i]:
                w[x[i]] += d * scaled[i]
                w[-1] += d
                a[i] = new
    return w


def _platt(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through margins, by Newton's steps with a little shrinkage."""
    z = np.stack([margin, np.ones_like(margin)], 1)
    t = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ t, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(2)
        step = np.linalg.solve(h, z.T @ (p - good) + 1e-2 * t)
        t -= step
        if abs(step).max() < 1e-9:
            break
    return float(t[0]), float(t[1])


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", sample: int = SAMPLE) -> Model:
    """Learn from at most `sample` of the different label rows (key, 0 or 1); others teach nothing, nor do rows that repeat both.

    Of documents that repeat a key, the one whose text has the smallest hash is learned from. Null text counts as empty.
    Without rows of both classes the model gives every text the share of ones (one half without rows). Columns of
    either table may have any other names.
    """
    order = F.xxhash64(key)
    some = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(label).cast("int").alias("label"), order.alias("order")).distinct().orderBy("order", "label").limit(sample)
    some = cut(some)
    bodies = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(some.select("k").distinct()), "k", "left_semi")
    one = bodies.groupBy("k").agg(F.min_by("text", F.xxhash64("text")).alias("text"))  # at most `sample` texts
    rows = one.join(F.broadcast(some), "k").select("order", "label", "text")
    got = rows.mapInArrow(_features, "order long, label int, x binary").toPandas().sort_values(["order", "label", "x"], kind="stable")
    x = [np.frombuffer(v, np.uint32) for v in got["x"]]
    good = got["label"].to_numpy() == 1
    y = np.where(good, 1.0, -1.0)
    if good.all() or not good.any():
        share = good.mean() if len(good) else 0.5
        return Model(np.zeros(WIDTH, np.float32), 0.0, 0.0, 30.0 * (share - 0.5))
    learn = np.arange(len(x)) % 5 != 0 if len(x) >= 50 else np.ones(len(x), bool)
    count = {c: np.bincount(np.concatenate([x[i] for i in np.flatnonzero(learn & (good == c))] or [np.empty(0, int)]), minlength=WIDTH) + 1.0 for c in (True, False)}
    ratio = np.log(count[True] / count[True].sum()) - np.log(count[False] / count[False].sum())
    cost = np.where(good, 1.0, good.sum() / (~good).sum()) * 0.1
    at = np.flatnonzero(learn)
    w = dual_descent([x[i] for i in at], y[at], ratio, cost[at])
    even = np.abs(w[:-1]).mean()  # the weights are drawn towards their mean size, so that the ratios count as well
    weights = (0.25 * w[:-1] + 0.75 * even) * ratio
    raw = np.array([weights[i].sum() for i in x]) + w[-1]
    rest = ~learn if (~learn & good).any() and (~learn & ~good).any() else learn
    slope, offset = _platt(raw[rest], good[rest])
    return Model(weights.astype(np.float32), float(w[-1]), slope, offset)


def score(docs: DataFrame, model: Model, keep: list[Column], text: str = "text") -> DataFrame:
    """The columns in `keep` with score, the probability of label 1.

    Null counts as empty, bytes that aren't UTF-8 as U+FFFD; whole texts are read. Rows that repeat give the same score each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col(text).alias("text_"))
    names = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches, "text_"):
            for at, cols, off in indicators(b.column("text_")):
                raw = chars.sums_by_row(m.weights[cols], off) + m.bias
                p = 1 / (1 + np.exp(-np.clip(m.slope * raw + m.offset, -30, 30)))
                yield pa.RecordBatch.from_arrays([*(b.column(x).slice(at, len(p)) for x in names), pa.array(p)], [*names, "score"])

    return rows.mapInArrow(run, rows.drop("text_").schema.add("score", "double"))
