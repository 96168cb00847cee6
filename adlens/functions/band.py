"""Classification bands from free text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlens.functions.text import compact, once

#: The words for bands, and the ways in which a band is written, tried in this order.
WORDS = {"one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8}
TOKEN = "([1-8]|one|two|three|four|five|six|seven|eight)"
PATTERNS = (
    r"\b(?:classification|classified|salary|remuneration|position)?\s*(?:band|banding|band\s*/\s*level|level\s*/\s*band)\s*(?:no\.?|number|level|range|grade|:|-)?\s*"
    + TOKEN
    + r"(?:\s*(?:/|-|to|or)\s*(?:[1-8]|one|two|three|four|five|six|seven|eight))?[a-d]?\b",
    r"\b(?:classification|classified|municipal\s+employee|local\s+government\s+employee|employee|me)\s+(?:level|grade)\s*(?:no\.?|number|:|-)?\s*" + TOKEN + r"[a-d]?\b",
    r"\b(?:level|grade)\s*" + TOKEN + r"[a-d]?\b.{0,48}\b(?:municipal|local\s+government|classification|classified|award|band)\b",
)


def parse(c: Column) -> Column:
    """A whole number from 1 to 8, or null."""
    n = F.expr("null").cast("int") if c is None else F.trim(c.cast("string")).try_cast("int")
    return F.when(n.between(1, 8), n)


def _found(text: Column) -> Column:
    words = F.create_map(*[F.lit(x) for pair in WORDS.items() for x in pair])
    token = F.coalesce(*[F.nullif(F.lower(F.regexp_extract(text, "(?i)" + p, 1)), F.lit("")) for p in PATTERNS])
    return once(token, lambda t: F.coalesce(t.try_cast("int"), F.try_element_at(words, t)))


def extract(*texts: Column) -> Column:
    """The band that the first text with one gives, or null."""
    return F.coalesce(*[once(compact(t), _found) for t in texts])


def status(band: Column) -> Column:
    return F.when(band.isNotNull(), "explicit_band").otherwise("unclassified")


def existing(*values: Column) -> Column:
    """The band that the first value gives, as a number or in words."""
    tries = []
    for v in values:
        tries += [parse(v), extract(v)]
    return F.coalesce(*tries)


def upgraded(class_status: Column, band: Column) -> Column:
    """A status that says less than the band is replaced."""
    s = F.coalesce(F.nullif(compact(class_status), F.lit("")), F.lit("unclassified"))
    return F.when(band.isNotNull() & s.isin("unclassified", "description_only", "salary_only", "parse_warning"), "explicit_band").otherwise(s)
