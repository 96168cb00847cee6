"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from adlens.llm import chars
from adlens.llm.common import arrow, slices

SIZES = (1, 2, 3)
BLANK = 0x20
UNKNOWN = "und"
#: Languages whose log probabilities, 256 KB each, go to all tasks at once.
LANGUAGES = 200


@dataclass
class Model:
    languages: list[str]
    logs: np.ndarray  # (buckets + 1, languages), the last row zero
    prior: np.ndarray


def _points(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded code points with blanks for all but letters, the rows' starts, and whether a row has a letter."""
    p, off = chars.code_points(column)
    is_letter = chars.letters()[p]
    low = chars.folded()[np.minimum(p, chars.FOLDED - 1)]
    p = np.where(is_letter, np.where(p < chars.FOLDED, low, p), np.uint32(BLANK))
    return p, off, chars.sums_by_row(is_letter.astype(np.uint8), off) > 0


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    by: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for b in slices(batches):
        langs = np.array(b.column("lang").to_pylist(), object)
        p, off, known = _points(b.column("text"))
        row = np.repeat(np.arange(len(langs)), np.diff(off))
        grams = [chars.buckets(p, off, n, BLANK) for n in SIZES]
        for lang in set(langs[known]):
            mine = (langs == lang) & known
            rows[lang] = rows.get(lang, 0) + int(mine.sum())
            c = by.setdefault(lang, np.zeros(chars.NONE + 1, np.int64))
            at = mine[row]
            for g in grams:
                c += np.bincount(g[at], minlength=chars.NONE + 1)
    for lang, c in by.items():
        c[chars.NONE] = rows[lang]  # the last place holds the number of rows
        at = np.flatnonzero(c)
        yield arrow({"lang": pa.array([lang] * len(at)), "bucket": at.astype(np.int32), "n": c[at]})


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Count the n-grams of all rows with a language and a letter; rows without either teach nothing.

    A language's counts come to the driver as one row of a bounded number of buckets; any number of languages is learned.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    counts = rows.mapInArrow(_counts, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    packed = counts.groupBy("lang").agg(F.collect_list("bucket").alias("b"), F.collect_list("n").alias("n"))
    languages, logs, rows_of = [], [], []
    for r in packed.toLocalIterator():
        c = np.zeros(chars.NONE + 1)
        c[r["b"]] = r["n"]
        rows_of.append(c[chars.NONE])
        one = np.log(c + 1) - np.log(c[:-1].sum() + chars.NONE)
        one[chars.NONE] = 0
        languages.append(r["lang"])
        logs.append(one.astype(np.float32))
    order = sorted(range(len(languages)), key=languages.__getitem__)
    n = np.array([rows_of[i] for i in order])
    every = np.stack([logs[i] for i in order], 1) if order else np.zeros((chars.NONE + 1, 0), np.float32)
    return Model([languages[i] for i in order], every, np.log(n / max(1, n.sum())))


def _scores(model: Model):
    """For each row of text_ the best language of the model, its log probability, and the sum of all to the base of that."""

    def run(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        p, off, known = _points(column)
        n = len(column)
        if not model.languages:
            return np.full(n, UNKNOWN, object), np.full(n, -np.inf), np.zeros(n), known
        s = model.prior + sum(chars.sums_by_row(model.logs[chars.buckets(p, off, n, BLANK)], off) for n in SIZES)
        return np.array(model.languages, object)[s.argmax(axis=1)], s.max(axis=1), np.exp(s - s.max(axis=1, keepdims=True)).sum(axis=1), known

    return run


def predict(docs: DataFrame, model: Model, keep: list[Column], text: str = "text", with_text: bool = False, most: int = LANGUAGES) -> DataFrame:
    """The columns in `keep`, and text_ if that is asked for, with lang_pred and score, the posterior of that language.

    A null text, one without letters, or a model without languages gives `und` and 0. Equal posteriors
    go to the language that sorts first. Whole texts are read; bytes that aren't UTF-8 are no letters. Rows that repeat
    give the same result each. Languages go to all tasks `most` at a time, in a pass over the texts each; every pass
    takes up the best language so far and the sum of probabilities so far.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(*keep, F.col(text).alias("text_"))
    names = rows.columns[:-1]
    state = [StructField("best_", StringType()), StructField("top_", DoubleType()), StructField("sum_", DoubleType())]
    schema = StructType([*rows.schema.fields, *state])
    result = StructType([*(rows if with_text else rows.drop("text_")).schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def step(shared: Broadcast, first: bool, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scores = _scores(shared.value)
            for b in slices(batches, "text_"):
                best, top, total, known = scores(b.column("text_"))
                if not first:
                    old, before, sum_ = (b.column(x) for x in ("best_", "top_", "sum_"))
                    before, sum_ = before.to_numpy(), sum_.to_numpy()
                    new = np.maximum(before, top)
                    total = sum_ * np.exp(before - new) + total * np.exp(top - new)
                    best, top = np.where(top > before, best, np.array(old.to_pylist(), object)), new
                if last:
                    ok = known & np.isfinite(top)
                    best = np.where(ok, best, UNKNOWN)
                    kept = [*names, *(["text_"] if with_text else [])]
                    yield pa.RecordBatch.from_arrays([*(b.column(x) for x in kept), pa.array(best.tolist(), pa.string()), pa.array(np.where(ok, 1 / np.maximum(total, 1), 0.0))], [*kept, "lang_pred", "score"])
                else:
                    kept = [*names, "text_"]
                    yield pa.RecordBatch.from_arrays([*(b.column(x) for x in kept), pa.array(best.tolist(), pa.string()), pa.array(top), pa.array(total)], [*kept, "best_", "top_", "sum_"])

        return run

    ends = list(range(most, len(model.languages), most))
    for i, (a, z) in enumerate(zip([0, *ends], [*ends, len(model.languages)], strict=True)):
        part = context.broadcast(Model(model.languages[a:z], model.logs[:, a:z], model.prior[a:z]))
        rows = rows.mapInArrow(step(part, i == 0, i == len(ends)), result if i == len(ends) else schema)
    return rows


def known(docs: DataFrame, text: str = "text", lang: str = "lang", least: float = 0.5) -> DataFrame:
    """docs without the rows that have no language: `und`, or a posterior below `least`.

    So rows with a null or empty text, or one without letters, go. Rows that repeat all stay or all go; texts and other
    columns, of any names and with nulls, stay as they are. Of a table without rows, or without languages, none stays.
    """
    names = docs.columns
    rest = [F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names) if n != text]
    found = predict(docs, fit(docs, text, lang), rest, text, with_text=True)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select(*[F.col("text_" if n == text else f"c{i}").alias(n) for i, n in enumerate(names)])
