"""URLs as column expressions. They are split by patterns, so that a space or a pipe in a URL does no harm."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlens.functions.text import compact, once

PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
#: Sites that repeat others' listings, and sites that hold none.
MIRRORS, MIRROR_TAILS = ("councildirect.com.au", "au.jora.com", "jora.com"), ("indeed.com", "seek.com.au")
SCORED_MIRROR_TAILS = ("jora.com", "indeed.com", "seek.com.au")
NO_LISTINGS = r"(^|\.)(facebook|instagram|linkedin|tiktok|youtube)\.com$|^(help|secure)\.employmenthero\.com$|^employmenthero\.page\.link$"


def part(url: Column, i: int) -> Column:
    return F.regexp_extract(url, PARTS, i)


def canonical(c: Column) -> Column:
    """Lower-case host, no final slash, no fragment, no tracking parameters."""
    return once(compact(c), _canonical)


def _canonical(url: Column) -> Column:
    query = F.array_join(F.filter(F.split(part(url, 4), "&"), lambda p: (p != "") & ~F.lower(p).rlike("^(utm_|fbclid=|gclid=)")), "&")
    said = lambda c, f: once(c, lambda t: F.when(t == "", "").otherwise(f(t)))
    return F.concat(
        said(part(url, 1), lambda t: F.concat(F.lower(t), F.lit(":"))),
        said(part(url, 2), lambda t: F.concat(F.lit("//"), F.lower(t))),
        once(F.regexp_replace(part(url, 3), "/+$", ""), lambda t: F.when(t == "", "/").otherwise(t)),
        said(query, lambda t: F.concat(F.lit("?"), t)),
    )


def path_key(c: Column, keep_query: bool = False) -> Column:
    """Host and path in lower case, for comparison; with the query where that tells pages apart."""
    url = F.regexp_replace(compact(c), "#.*$" if keep_query else "[?#].*$", "")
    return F.regexp_replace(F.lower(F.regexp_replace(url, "/+$", "")), r"^https?://(www\.)?", "")


def host(c: Column) -> Column:
    return F.substring_index(path_key(c), "/", 1)


def _tail(h: Column, tails: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for t in tails:
        out = out | h.endswith(t)
    return out


def is_mirror(c: Column) -> Column:
    return once(host(c), lambda h: h.isin(*MIRRORS) | _tail(h, MIRROR_TAILS))


def scored_mirror_host(h: Column) -> Column:
    return _tail(h, SCORED_MIRROR_TAILS)


def official_host(h: Column) -> Column:
    return h.endswith(".vic.gov.au") | h.contains("pageuppeople.com") | h.contains("pulsesoftware.com")


def holds_no_listing(c: Column) -> Column:
    return once(F.regexp_replace(compact(c), r"^.*?://", ""), _no_listing)


def _no_listing(rest: Column) -> Column:
    h = F.regexp_replace(F.lower(F.substring_index(rest, "/", 1)), r"^www\.", "")
    path = F.regexp_replace(F.regexp_replace(rest, r"^[^/]*/?", ""), "^/+|/+$", "")
    return h.isin("au.jora.com", "jora.com") & (path == "") | h.rlike("(?i)" + NO_LISTINGS)


def same_origin(a: Column, b: Column) -> Column:
    return F.lower(part(b, 1)).isin("http", "https") & (part(b, 2) != "") & (F.lower(part(a, 1)) == F.lower(part(b, 1))) & (F.lower(part(a, 2)) == F.lower(part(b, 2)))


def without_dots(path: Column) -> Column:
    """A path whose segments . and .. are taken, as a browser takes them."""
    segments = F.split(F.substring(path, 2, 2**31 - 1), "/")
    last = F.element_at(segments, -1)
    none = F.array().cast("array<string>")
    step = lambda kept, s: F.when(s == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))).when(s == ".", kept).otherwise(F.concat(kept, F.array(s)))
    kept = F.aggregate(segments, none, step)
    taken = F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(last.isin(".", "..") & (F.size(kept) > 0), "/").otherwise(""))
    return F.when(path.rlike(r"^/(.*/)?\.\.?(/|$)"), taken).otherwise(path)


def resolved(base: Column, href: Column) -> Column:
    """An address found on a page, made absolute; empty for mail, phone, script and data addresses."""
    return once(F.regexp_replace(compact(href), "#.*$", ""), lambda raw: _resolved(base, raw))


def _resolved(base: Column, raw: Column) -> Column:
    root = F.concat(part(base, 1), F.lit("://"), part(base, 2))
    folder = F.concat(root, F.regexp_replace(part(base, 3), "[^/]*$", ""))
    absolute = (
        F.when(raw.rlike("^(?i)https?://"), raw)
        .when(raw.startswith("//"), F.concat(part(base, 1), F.lit(":"), raw))
        .when(raw.startswith("/"), F.concat(root, raw))
        .when(raw.startswith("?"), F.concat(root, part(base, 3), raw))
        .otherwise(F.concat(F.when(folder == root, F.concat(folder, F.lit("/"))).otherwise(folder), raw))
    )
    query = lambda u: F.regexp_extract(u, r"^[^?]*(\?.*)?$", 1)
    tidy = once(absolute, lambda u: F.concat(part(u, 1), F.lit("://"), part(u, 2), without_dots(part(u, 3)), query(u)))
    return F.when((raw == "") | raw.rlike("^(?i)(mailto|tel|javascript|data):"), "").when(raw.rlike(r"(^|/)\.\.?(/|\?|$)"), tidy).otherwise(absolute)
