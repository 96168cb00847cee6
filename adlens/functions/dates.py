"""Closing dates from free text, and calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlens.functions.text import compact, once

#: Hints, and the two ways in which a date is written.
HINT = r"\b(?:closing|closes|applications close|apply by|deadline|closing date)\b.{0,120}"
NUMERIC = r"\b(\d{1,2})[/-](\d{1,2})[/-](\d{2,4})\b"
WORDED = (
    r"\b(\d{1,2})(?:st|nd|rd|th)?\s+(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|jun(?:e)?|jul(?:y)?|aug(?:ust)?|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)\s+(20\d{2})\b"
)
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def _date(year: Column, month: Column, day: Column) -> Column:
    made = F.try_to_date(F.format_string("%04d-%02d-%02d", year, month, day), "yyyy-MM-dd")
    return F.when(year >= 2020, made)


def parsed(c: Column) -> Column:
    """The date in a text, a numeric one before a worded one; null if that one isn't a date or lies before 2020."""
    n = lambda i: F.regexp_extract(c, NUMERIC, i).try_cast("int")
    w = lambda i: F.regexp_extract(c, "(?i)" + WORDED, i)
    year = F.when(n(3) < 100, n(3) + 2000).otherwise(n(3))
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.substring(w(2), 1, 3))).cast("int")
    return F.when(c.rlike(NUMERIC), _date(year, n(2), n(1))).when(w(1) != "", _date(w(3).try_cast("int"), month, w(1).try_cast("int")))


def closing_date(*texts: Column) -> Column:
    """The first date after a hint or, failing that, in the whole text; texts in order."""
    tries = []
    for text in texts:
        candidates = lambda clean: F.concat(F.regexp_extract_all(clean, F.lit("(?i)" + HINT), F.lit(0)), F.array(clean))
        tries.append(F.get(F.filter(F.transform(once(compact(text), candidates), parsed), lambda d: d.isNotNull()), F.lit(0)))
    return F.coalesce(*tries)


def month_key(c: Column) -> Column:
    """The first seven characters of a timestamp in text, or `unknown`."""
    return F.coalesce(F.nullif(F.substring(compact(c), 1, 7), F.lit("")), F.lit("unknown"))


def range_start(reference: Column, kind: str) -> Column:
    """Where a date filter begins: the reference's month, or two months before for a quarter."""
    first = F.trunc(reference, "month")
    return first if kind == "month" else F.add_months(first, -2)
