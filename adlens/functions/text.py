"""Text keys and similarity as column expressions. Null counts as empty, as in the listings' own rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that don't count when titles are compared.
TITLE_STOP_WORDS = ("and", "the", "of", "at", "in", "for", "with", "jan", "january", "feb", "february", "mar", "march", "apr", "april", "may", "jun", "june", "jul", "july", "aug", "august", "sep", "sept", "september", "oct", "october", "nov", "november", "dec", "december")


def once(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of a column that is worked out once, however often f uses it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


#: The characters up to U+02AF that compatibility composition changes, and all beyond: texts without any are left alone.
RARE = r"[\x{a8}\x{aa}\x{af}\x{b2}-\x{b5}\x{b8}-\x{ba}\x{bc}-\x{be}\x{132}\x{133}\x{13f}\x{140}\x{149}\x{17f}\x{1c4}-\x{1cc}\x{1f1}-\x{1f3}]|[^\x{0}-\x{2af}]"


def composed(text: Column) -> Column:
    """The text in compatibility composition (NFKC): compatible forms folded, marks in canonical order, all composed that can be.

    The JVM's own normaliser (ICU, with which Spark collates) does it, called by name; no Python worker sees the text. Spark
    takes such a call for one that may differ each time, so that it can't stand in the condition of a join or inside an aggregate:
    make it a column first.
    """
    return F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(True))


#: What makes a text other than it will be: any but printable ASCII, a placeholder run, a space doubled or at an end.
UNTIDY = r"[^ -~]|\?\?\?|  |^ | $"


def compact(c: Column) -> Column:
    """The text composed, placeholder runs and white space become one space, trimmed. A look over the text tells whether there is anything to do, another whether to compose it.

    What c stands for is worked out once: texts that are compacted again and again, as titles are, would grow sixfold each time.
    """
    return once(F.coalesce(c.cast("string"), F.lit("")), _compacted)


def _compacted(text: Column) -> Column:
    whole = F.when(text.rlike(RARE), composed(text)).otherwise(text)
    tidy = F.trim(F.regexp_replace(F.regexp_replace(whole, "\\?{3,}|\\uFFFD+", " "), r"(?U)[\s\x1c-\x1f]+", " "))
    return F.when(text.rlike(UNTIDY), tidy).otherwise(text)


def excerpt(c: Column, limit: int) -> Column:
    """At most `limit` characters, cut before a word that would be broken."""
    cut = lambda t: F.regexp_replace(F.regexp_replace(F.substring(t, 1, limit), " [^ ]*$", ""), "[ ,.;:]+$", "")
    return once(compact(c), lambda t: F.when(F.length(t) <= limit, t).otherwise(F.concat(cut(t), F.lit("..."))))


def key(c: Column) -> Column:
    """Upper-case letters and digits with one space between."""
    return F.trim(F.regexp_replace(F.replace(F.upper(compact(c)), F.lit("&"), F.lit(" AND ")), "[^A-Z0-9]+", " "))


def title_key(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.replace(F.lower(compact(c)), F.lit("&"), F.lit(" and ")), "[^a-z0-9]+", " "))


def stable_hash(*parts: Column, length: int = 20) -> Column:
    """The first digits of a SHA-256 over the parts; nulls are skipped, empty parts aren't."""
    cleaned = [F.when(p.isNotNull(), F.lower(compact(p))) for p in parts]
    return F.substring(F.sha2(F.concat_ws("\u001f", *cleaned), 256), 1, length)


def title_words(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(title_key(c), " "), lambda w: (w != "") & ~w.isin(*TITLE_STOP_WORDS)))


def alike(a: Column, b: Column) -> Column:
    """Whether two arrays of title words mean the same listing: one within the other, or 80 % of the smaller shared."""
    shared, least = F.size(F.array_intersect(a, b)), F.least(F.size(a), F.size(b))
    return (least > 0) & (5 * shared >= 4 * least)


def escape(c: Column) -> Column:
    """Text for XML or HTML."""
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(raw), F.lit(entity))
    return c


def unit_hash(c: Column) -> Column:
    """A 32-bit multiplicative hash of the characters, as a share of one."""
    codes = F.transform(F.filter(F.split(c, ""), lambda x: x != ""), lambda x: F.ascii(x).cast("long"))
    folded = F.aggregate(codes, F.lit(2166136261).cast("long"), lambda h, x: h.bitwiseXOR(x).bitwiseAND(4294967295) * 16777619 % 4294967296)
    return folded / 4294967295.0
