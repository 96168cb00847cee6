"""Main text of web pages, by differencing each page with the pages nearest to it by URL.

A page is read into lines, one a block. Pages are ordered by host and path; every page, whether it marks an article or
not, is aligned with its nearest distinct neighbours of the same host by longest common subsequence of lines, and lines
that they share are deleted. A neighbour whose other lines are the page's own with a few words changed is a copy of
it, not a sister, and has no vote.

* On a page without a marked article a line goes that three quarters of the VOTERS nearest sisters share.
* In a marked article, articles of one host may quote the same passage. A line goes only where SURE sisters at least vote,
  seven eighths of all in reach share it, and stand it at the same place from the start or the end of their articles, or
  both among the first or last EDGE lines; a heading never goes for being shared, and an article never loses its last line.

What neighbours can't tell, as pages differ in it too, is told by markup: elements that are never main text (menus,
footers, asides, form controls, scripts), and those that class, id or role calls adverts, notices, comments and the
like. A name speaks against an element only if it says nothing else: every part of it is such a word or a word of layout
(``ad-slot``, but not ``share-price``). In an article, headings have no such names, ids of paragraphs and sections, which
are often made from headings, don't count, and what a name alone speaks against is kept where it has most of the text. In
``main`` around articles that hold most of its text, only headings before the first count. Such a word weighs, but an element is
kept that holds the article, or over four times the text of all else that stays.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from adlens.llm.common import cut, few, join2, mix, slices, word_hashes
from adlens.llm.mixing import ranked

#: Attributes end at the first > outside quotes. A quote that nothing fit for the end of a value closes is no quote.
ATTRS = r"(?:\"[^\"<]*+\"|'[^'<]*+'|\"[^\"]*+\"(?=[\s/>])|'[^']*+'(?=[\s/>])|[^>\"'])*+"
#: Raw text up to the end tag; the tokens of markup. A comment or raw element that is never closed takes the rest.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(script|style|noscript|template|textarea|iframe|svg|xmp|noembed|noframes)\b(?:{ATTRS}>|[^>]*>).*?(?:</\1\s*[^>]*>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)(?:({ATTRS})(?:>|\Z)|([^>]*)(?:>|\Z))",
    re.S | re.I,
)
ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody tfoot thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that are never main text; a form may wrap a whole page.
OUT = frozenset("head nav footer aside button select menu dialog object canvas audio video map fieldset label".split())
#: Words of class, id or role that speak against main text, where a name holds nothing but them and words of layout.
OUT_WORDS = frozenset(
    "ad ads advert adverts advertisement adbox adslot sponsor sponsored sponsors promo promotion promoted banner nav navbar navigation menu menubar sidebar sidebars side aside complementary footer contentinfo masthead breadcrumb breadcrumbs pagination pager cookie cookies consent gdpr notice notices alert popup modal overlay dialog newsletter subscribe subscription signup login search share sharing social related recommended recommendations trending widget widgets toolbar comment comments commentlist reply replies respond discussion disqus feedback form skip adsbygoogle".split()
)
COMMENTS = frozenset("comment comments commentlist reply replies disqus".split())
#: Words that say where or how an element stands, not what it is; so do single letters.
PLACES = frozenset("area articles bar block body bottom box btn button buttons card center column container content desktop div email fixed global group header holder horizontal icon icons inline inner item items js left link links list local main middle mobile module news next outer page panel policy post posts prev previous primary right row secondary section site slot small sticky stories text title top unit user users vertical wide wrap wrapper zone article story thread form google dfp".split())
#: In an article, elements that no name speaks against, and those against which ids don't speak.
HEADINGS, BY_CLASS = frozenset("h1 h2 h3 h4 h5 h6".split()), frozenset("p section li dd dt td th tr table figure blockquote pre".split())
#: Names with such a word say how a page is laid out, not what the element is.
LAYOUT = frozenset("has no not with without by is open opened closed enabled disabled free allow allows".split())
#: Kept inside an article, where they hold its headline.
HEADS = frozenset({"header"})
PARAGRAPH_ENDS = ("p", "div", "article", "main", "section", "body", "td", "li")
ITEM_ENDS = ("li", "ul", "ol", "menu")
NAME = re.compile(r"[a-z]+")
SEEDS = mix(np.arange(1, 9, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: So many nearest neighbours in the order of URLs are compared, on either side or, at the ends of a host, on one.
REACH = 8
#: The nearest sisters that vote on pages without an article, and how many must vote on lines of one.
VOTERS = 4
SURE = 6
#: So many lines at either end of an article count as one place, as what stands there may change places.
EDGE = 2
#: Pages compared in one group, besides REACH beyond either end.
BLOCK = 64
NEVER, WEAK, TALK = 1, 2, 3
OUTER, INNER = 1, 2


def _kind(tag: str, attrs: str, in_article: bool) -> int:
    """0 for content, NEVER, WEAK where only a name or a form speaks against it, TALK for readers' comments."""
    names: list[list[str]] = []
    hidden = False
    if attrs:
        for m in ATTR.finditer(attrs):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name in ("class", "role") or name == "id" and not (in_article and tag in BY_CLASS):
                names += [NAME.findall(x) for x in value.lower().split()]
            elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and re.search(r"display\s*:\s*none", value, re.I):
                hidden = True
    if tag in ("html", "body", "main"):
        return 0
    if tag in OUT or hidden or tag in HEADS and not in_article:
        return NEVER
    if in_article and tag in HEADINGS:
        return 0
    against = OUT_WORDS if in_article else OUT_WORDS | HEADS
    words = {w for n in names if n and LAYOUT.isdisjoint(n) and all(w in against or w in PLACES or len(w) < 2 for w in n) for w in n}
    if words & COMMENTS:
        return TALK
    return WEAK if tag == "form" or words & against else 0


def lines(page: str) -> tuple[list[str], bool, list[int]]:
    """The lines of the page that markup doesn't rule out, whether they stand in a marked article, and the places of headings."""
    found: list[tuple[str, int, int, bool]] = []  # text, the innermost element that may be left out, how far in an article (INNER: in one by its tag), whether a heading
    outs: list[list] = []  # of such elements: the one around it, kind, characters of its own, whether it holds an article
    buf: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements, with what may be left out around each
    open_: defaultdict[str, list[int]] = defaultdict(list)  # their places by tag
    out, articles, plain = -1, 0, False

    def flush() -> None:
        if buf:
            if text := " ".join(html.unescape("".join(buf)).split()):
                level = INNER if open_["article"] else OUTER if articles > 0 else 0
                found.append((text, out, level, any(open_[h] for h in HEADINGS)))
                if out >= 0:
                    outs[out][2] += len(text)
            buf.clear()

    def pop(n: int) -> None:
        nonlocal out, articles
        for tag, _ in reversed(stack[n:]):
            open_[tag].pop()
            articles -= tag == "article" or tag == "main"
        if n < len(stack):
            out = stack[n][1]
            del stack[n:]

    def last(tags: tuple[str, ...]) -> int:
        return max((open_[t][-1] for t in tags if open_[t]), default=-1)

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            buf.append(page[at : m.start()])
        at = m.end()
        if m[3] is None:
            if m[1] is None and m[0].startswith("<![CDATA["):
                buf.append(m[0][9:].removesuffix("]]>"))
            continue
        tag, attrs = m[3].lower(), m[4] if m[4] is not None else m[5]
        if m[2]:
            n = open_[tag][-1] if open_[tag] else -1
            if tag in BLOCKS or n >= 0 and stack[n][1] != out:
                flush()
            if n >= 0:
                pop(n)
            continue
        if tag in BLOCKS:
            flush()
        elif tag in ("br", "td", "th"):
            buf.append(" ")
        if tag in VOID or attrs.endswith("/") and tag not in BLOCKS:
            continue
        if tag == "p" and (n := last(PARAGRAPH_ENDS)) >= 0 and stack[n][0] == "p":
            pop(n)  # a paragraph ends where the next one starts
        if tag == "li" and (n := last(ITEM_ENDS)) >= 0 and stack[n][0] == "li":
            pop(n)
        if tag == "body":
            pop(0)
        kind = _kind(tag, attrs, articles > 0)
        around = out
        if kind:
            flush()
            outs.append([out, kind, 0, False])
            out = len(outs) - 1
        stack.append((tag, around))
        open_[tag].append(len(stack) - 1)
        if tag == "article" or tag == "main":
            articles += 1
            plain = plain or out < 0
            k = out
            while kind != TALK and k >= 0 and not outs[k][3]:
                outs[k][3] = True
                k = outs[k][0]
    if at < len(page):
        buf.append(page[at:])
    flush()
    return _kept(found, outs, plain)


def _kept(found: list[tuple[str, int, int, bool]], outs: list[list], plain: bool) -> tuple[list[str], bool, list[int]]:
    """What stays of the lines: an element that may be left out stays where the main text is nowhere else.

    plain tells that there is an article besides those elements, if an empty one.
    """
    marked = any(o < 0 and a for _, o, a, _ in found)
    size = sum(len(t) for t, o, _, _ in found if o < 0)
    gone = []
    for around, kind, own, holds in outs:
        if around >= 0 and gone[around]:
            gone.append(True)
        elif kind == WEAK and own > 4 * size and (marked or not plain) or not marked and holds and kind != TALK:
            gone.append(False)
            size += own
        else:
            gone.append(True)
    rest = [(t, a, h) for t, o, a, h in found if o < 0 or not gone[o]]
    if any(a for _, a, _ in rest):
        rest = [x for x in rest if x[1]]
        marked = True
        inner = [i for i, x in enumerate(rest) if x[1] == INNER]
        if inner and 2 * sum(len(rest[i][0]) for i in inner) >= sum(len(x[0]) for x in rest):
            rest = [x for i, x in enumerate(rest) if x[1] == INNER or x[2] and i < inner[0]]
    else:
        marked = False
    return [t for t, _, _ in rest], marked, [i for i, x in enumerate(rest) if x[2]]


def shared(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """The places in a and in b of a longest common subsequence.

    What both start or end with is matched first. Of the rest, a bit a line of b tells for each line of a where the
    subsequence grows; rows of bits are kept at every so many lines and worked out again on the way back.
    """
    start, least = 0, min(len(a), len(b))
    while start < least and a[start] == b[start]:
        start += 1
    end = 0
    while end < least - start and a[-1 - end] == b[-1 - end]:
        end += 1
    x, y = a[start : len(a) - end], b[start : len(b) - end]
    middle: list[tuple[int, int]] = []
    if x and y:
        masks: defaultdict[int, int] = defaultdict(int)
        wanted = set(x)
        for j, v in enumerate(y):
            if v in wanted:
                masks[v] |= 1 << j
        full = (1 << len(y)) - 1
        every = max(16, int(len(x) ** 0.5))

        def rows(at: int, to: int, v: int) -> list[int]:
            kept = [v]
            for i in range(at, to):
                if m := masks.get(x[i], 0):
                    u = v & m
                    v = ((v + u) | (v - u)) & full
                kept.append(v)
            return kept

        stops = [full]
        for i in range(0, len(x), every):
            stops.append(rows(i, min(i + every, len(x)), stops[-1])[-1])
        j = len(y)
        for k in range(len(stops) - 2, -1, -1):
            first = k * every
            block = rows(first, min(first + every, len(x)), stops[k])
            i = len(block) - 1
            while i and j:
                if block[i] >> (j - 1) & 1:
                    j -= 1
                elif block[i - 1] >> (j - 1) & 1:
                    i, j = i - 1, j - 1
                    middle.append((start + first + i, start + j))
                else:
                    i -= 1
    tail = [(len(a) - k, len(b) - k) for k in range(end, 0, -1)]
    return [*((i, i) for i in range(start)), *reversed(middle), *tail]


def sketches(text: list[str]) -> np.ndarray:
    """Eight bytes a line, each from the least of one hash of the line's pairs of words: edited lines agree in most bytes."""
    words, first = word_hashes(pa.array(text, pa.string()), lower=False)
    out = np.zeros(len(text), np.uint64)
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        after = np.zeros(len(words), np.uint64)
        after[:-1] = words[1:]
        after[first[1:][full] - 1] = 0
        pairs = join2(words, after)
        single = np.ones(len(words), bool)
        single[first[1:][full] - 1] = np.diff(first)[full] == 1  # the last word leads no pair unless it is alone
        for k, seed in enumerate(SEEDS):
            h = np.where(single, mix(pairs ^ seed), np.uint64(0xFFFFFFFFFFFFFFFF))
            out[full] |= (np.minimum.reduceat(h, first[:-1][full]) & np.uint64(255)) << np.uint64(8 * k)
    return out.view(np.int64)


def edited(a: list[int], b: list[int]) -> int:
    """How many of the sketches a agree with one of b in six of eight bytes: such two agree in one of four pairs of bytes."""
    at = defaultdict(list)
    cut_ = lambda x: x.to_bytes(8, "little", signed=True)
    for x in set(b):
        y = cut_(x)
        for k in range(0, 8, 2):
            at[k, y[k : k + 2]].append(y)
    alike = {x: any(sum(map(int.__eq__, y, z)) >= 6 for y in (cut_(x),) for k in range(0, 8, 2) for z in at.get((k, y[k : k + 2]), ())) for x in set(a)}
    return sum(alike[x] for x in a)


def copies(a: list[int], b: list[int]) -> bool:
    """Whether two pages' lines besides those they share, as sketches, are the same text: none on one side, or half of them edited."""
    a, b = sorted((a, b), key=len)
    return not a or 2 * edited(a, b) >= len(a)


def deleted(own: list[int], marked: bool, sketches: list[int], others: list[tuple[list[int], list[int]]], heads: list[int]) -> list[int]:
    """The places of the lines that the page shares with its sisters, given neighbours' lines and sketches, the nearest first, and where the page has headings."""
    votes: Counter[int] = Counter()
    sisters = 0
    for theirs, marks in others:
        if not marked and sisters == VOTERS:
            break
        both = shared(own, theirs)
        mine, them = {i for i, _ in both}, {j for _, j in both}
        if copies([x for i, x in enumerate(sketches) if i not in mine], [x for j, x in enumerate(marks) if j not in them]):
            continue
        sisters += 1
        votes.update(i for i, j in both if not marked or i == j or max(i, j) < EDGE or (at := len(own) - i) == (other := len(theirs) - j) or max(at, other) <= EDGE)
    if not marked:
        return [i for i, n in sorted(votes.items()) if 4 * n >= 3 * sisters]
    gone = [i for i, n in sorted(votes.items()) if sisters >= SURE and 8 * n >= 7 * sisters and i not in heads]
    return gone if len(gone) < len(own) else []


def _outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "html"):
        every, marks, prints, text, heads = [], [], [], [], []
        for page in b.column("html").to_pylist():
            found, marked, at = lines(page or "")
            heads.append(at)
            own = np.array([xxh64_intdigest(x.encode("utf-8", "surrogatepass")) for x in found], np.uint64).view(np.int64)
            prints.append(xxh64_intdigest(own.tobytes(), marked))
            every.append(own)
            marks.append(marked)
            text += found
        off = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in every])]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(off, pa.array(x)) for x in (np.concatenate(every), sketches(text))]
        yield pa.RecordBatch.from_arrays([b.column("key"), b.column("print"), b.column("host"), b.column("path"), pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(marks), *lists, pa.array(heads, pa.list_(pa.int32()))], ["key", "print", "host", "path", "page", "marked", "own", "sketches", "heads"])


def _differ(reach: int):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["rank"])
        group = [(r["host"], r["marked"]) for r in rows]
        out = []
        for i, r in enumerate(rows):
            if r["inside"]:
                near = [j for k in range(1, reach + 1) for j in (i - k, i + k) if 0 <= j < len(rows) and group[j] == group[i]]
                others = [(rows[j]["own"], rows[j]["sketches"]) for j in near[:reach]]
                if gone := deleted(r["own"], r["marked"], r["sketches"], others, r["heads"]):
                    out.append((r["host"], r["page"], gone))
        host, page, gone = zip(*out, strict=True) if out else ((), (), ())
        return pa.Table.from_arrays([pa.array(host, pa.string()), pa.array(page, pa.int64()), pa.array(gone, pa.list_(pa.int32()))], ["host", "page", "gone"])

    return run


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "html"):
        text = []
        for page, gone in zip(b.column("html").to_pylist(), b.column("gone").to_pylist(), strict=True):
            drop = set(gone or ())
            text.append("\n".join(x for i, x in enumerate(lines(page or "")[0]) if i not in drop))
        yield pa.RecordBatch.from_arrays([b.column("key"), b.column("url"), pa.array(text, pa.string())], ["key", "url", "text"])


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", reach: int = REACH) -> DataFrame:
    """One row per row of pages: key, url and text, the main text with one line a block.

    A null or empty page has the empty text. Pages with a null url, or alone on their host, have no sisters and
    lose no lines to differencing; those of a host with fewer than SURE + 1 distinct pages lose none inside a marked
    article; with a reach of 0 none do. Equal pages of a host count as one. Rows that repeat give the same text each.
    Bytes that aren't UTF-8 are read as U+FFFD. Other columns are ignored, whatever their names; nothing is cut short.
    """
    kind = dict(pages.dtypes)[key]
    rest = F.regexp_replace(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.coalesce(F.lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.lit(""))
    path = F.coalesce(F.regexp_replace(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), r"(/|\.html?)+$", ""), F.lit(""))
    body = F.coalesce(F.col(page).cast("string"), F.lit(""))
    rows = pages.select(F.col(key).alias("key"), F.xxhash64(url, page).alias("print"), F.col(url).cast("string").alias("url"), F.when(F.is_valid_utf8(body), body).otherwise(F.make_valid_utf8(body)).alias("html"), host.alias("host"), path.alias("path"))
    schema = f"key {kind}, print long, host string, path string, page long, marked boolean, own array<long>, sketches array<long>, heads array<int>"
    every = cut(rows.where("host <> ''").select("key", "print", "host", "path", "html").mapInArrow(_outlines, schema))
    distinct = every.groupBy("host", "marked", "page").agg(F.min(F.struct("path", "key", "print")).alias("at"), F.first("own").alias("own"), F.first("sketches").alias("sketches"), F.first("heads").alias("heads"))
    order = ranked(cut(distinct), F.struct("host", "marked", "at"))
    mine = F.floor(F.col("rank") / BLOCK)
    blocks = order.select("rank", "host", "marked", "page", "own", "sketches", "heads", F.explode(F.array_distinct(F.array(F.floor((F.col("rank") - reach) / BLOCK), mine, F.floor((F.col("rank") + reach) / BLOCK)))).alias("block"))
    blocks = blocks.withColumn("inside", F.col("block") == F.floor(F.col("rank") / BLOCK))
    gone = cut(blocks.groupBy("block").applyInArrow(_differ(reach), "host string, page long, gone array<int>"))
    gone = every.select("key", "print", "host", "page").join(few(gone), ["host", "page"])
    gone = few(cut(gone.groupBy(F.col("key").alias("k"), F.col("print").alias("p")).agg(F.first("gone").alias("gone"))))
    return rows.join(gone, F.col("key").eqNullSafe(F.col("k")) & (F.col("print") == F.col("p")), "left").select("key", "url", "html", "gone").mapInArrow(_texts, f"key {kind}, url string, text string").select(F.col("key").alias(key), F.col("url").alias(url), "text")
