"""Salary labels and annual ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlens.functions.text import compact


def label(c: Column) -> Column:
    """$1,234, or $1,234.50 where there are cents."""
    return F.concat(F.lit("$"), F.when(F.abs(c - F.round(c)) < 0.01, F.format_number(F.round(c), 0)).otherwise(F.format_number(c, 2)))


def range_label(low: Column, high: Column, period: Column) -> Column:
    """Both ends, or one where they agree or one is missing, with the period; empty without either."""
    a, b, p = F.coalesce(low, high), F.coalesce(high, low), compact(period)
    text = F.when(F.abs(b - a) < 0.01, label(a)).otherwise(F.concat(label(a), F.lit("-"), label(b)))
    return F.coalesce(F.concat(text, F.when(p == "", "").otherwise(F.concat(F.lit("/"), p))), F.lit(""))


def compact_label(c: Column) -> Column:
    """$91k."""
    return F.concat(F.lit("$"), F.format_number(F.round(c / 1000), 0), F.lit("k"))


def annual_range(low: Column, high: Column, period: Column) -> Column:
    """The range that a chart shows: a year's pay of 30,000 or more; a smaller low end is taken as the high one."""
    a, b = F.least(F.coalesce(low, high), F.coalesce(high, low)), F.greatest(F.coalesce(low, high), F.coalesce(high, low))
    yearly = (compact(period) == "") | F.lower(compact(period)).rlike("year|annum|annual") | (b >= 30000)
    return F.when(yearly & (b >= 30000), F.struct(F.when(a < 30000, b).otherwise(a).alias("low"), b.alias("high")))


def clamp(c: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))
