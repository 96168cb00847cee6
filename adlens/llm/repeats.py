"""Maximal runs of words, found with the suffix trees of the texts as Stoye and Gusfield do.

Many texts are worked on at once, each with a suffix tree of its own. The trees are arrays: leaves are suffixes in
order, an inner node is an interval of leaves with the number of words its suffixes share. The order comes from naming
stretches of 1, 2, 4, ... words, and the names of all lengths are kept, as they tell in a few steps how far two places agree.

At every node all lists of leaves but the longest are walked (the smaller-half trick, so that a leaf is met at most log n
times): a leaf i of a node of depth d makes a tandem repeat with i + d or i - d if that is a leaf of the node too, and the
repeat branches if the words after its halves differ. Every run ends in one branching repeat for each multiple of its
period; rotated left as far as words agree, repeats that come to the same stretch are merged into one run with the least
period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from adlens.llm.common import BLANKS, arrow, hashes, mix, row_of, slices, spans, text_bytes, valid

#: Leaves that are met at a time.
BLOCK = 1 << 20


def _same_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, a: np.ndarray, b: np.ndarray) -> bool:
    """Whether word a[i] and word b[i] have the same bytes for all i."""
    n = ends[a] - starts[a]
    if (n != ends[b] - starts[b]).any():
        return False
    at8 = np.ndarray((len(data) + 1,), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), 0, (1,))
    x, y = starts[a], starts[b]
    while len(n):
        past = np.uint64(64) - np.minimum(n, 8).astype(np.uint64) * np.uint64(8)
        if (((at8[x] ^ at8[y]) & (np.uint64(0xFFFFFFFFFFFFFFFF) >> past)) != 0).any():
            return False
        more = n > 8
        x, y, n = x[more] + 8, y[more] + 8, n[more] - 8
    return True


def _classes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words in an order in which equal words of a row are neighbours, and whether each differs from the one before it.

    Hashes sort them; their bytes are compared then, and should different words have one hash, the bytes decide.
    """
    key = mix(hashes(data, starts, ends) ^ mix(row.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)))
    order = np.argsort(key)
    new = np.concatenate([[True], key[order[1:]] != key[order[:-1]]])
    a, b = order[:-1][~new[1:]], order[1:][~new[1:]]
    if (row[a] != row[b]).any() or not _same_words(data, starts, ends, a, b):
        names: dict[tuple[int, bytes], int] = {}
        key = np.array([names.setdefault((r, data[i:j].tobytes()), len(names)) for r, i, j in zip(row.tolist(), starts, ends, strict=True)])
        order = np.argsort(key)
        new = np.concatenate([[True], key[order[1:]] != key[order[:-1]]])
    return order, new


class Trees:
    """The suffix trees of texts whose words are given as ``_classes`` gives them; each text ends in a mark of its own."""

    def __init__(self, order: np.ndarray, new: np.ndarray, row: np.ndarray, rows: int) -> None:
        n = len(order) + rows
        self.place = np.arange(len(order)) + row  # of each word among words and marks
        marks = np.searchsorted(row, np.arange(rows), "right") + np.arange(rows)
        sa = np.concatenate([marks, self.place[order]])
        start = np.concatenate([np.ones(rows, bool), new])
        rank = np.empty(n, np.int32)
        rank[sa] = np.maximum.accumulate(np.where(start, np.arange(n), 0))
        self.names = []  # names[k]: of the 2**k words that start at each place
        ends = np.concatenate([start[1:], [True]])
        active = np.flatnonzero(~(start & ends))
        while len(active):
            self.names.append(rank.copy())
            here = sa[active]
            key = rank[here].astype(np.int64) * n + rank[here + (1 << (len(self.names) - 1))]
            by = np.argsort(key)
            key, here = key[by], here[by]
            first = np.concatenate([[True], key[1:] != key[:-1]])
            sa[active] = here
            rank[here] = np.maximum.accumulate(np.where(first, active, 0))
            active = active[~(first & np.concatenate([first[1:], [True]]))]
        self.sa, self.rank, self.n = sa, rank, n

    def ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a[i] and b[i] on agree."""
        top, alive = np.full(len(a), -1, np.int8), np.arange(len(a))
        for k, name in enumerate(self.names):
            alive = alive[name[a[alive]] == name[b[alive]]]
            top[alive] = k
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            i = np.flatnonzero(top >= k)
            out[i[self.names[k][a[i] + out[i]] == self.names[k][b[i] + out[i]]]] += 1 << k
        return out

    def behind(self, a: np.ndarray, p: np.ndarray) -> np.ndarray:
        """The first place from which on the words before a[i] agree with those p[i] further."""
        a = a.copy()
        for k in range(len(self.names) - 1, -1, -1):
            x = a - (1 << k)
            i = np.flatnonzero(x >= 0)
            a[i[self.names[k][x[i]] == self.names[k][x[i] + p[i]]]] -= 1 << k
        return a

    def nodes(self) -> tuple[np.ndarray, ...]:
        """Children of all inner nodes but the roots: first leaf, leaves, and first leaf, end and depth of the node they belong to."""
        lcp = np.zeros(self.n + 1, np.int64)
        if not self.names:
            return (np.empty(0, np.int64),) * 5
        name = self.names[0][self.sa]
        at = np.flatnonzero(name[1:] == name[:-1]) + 1
        lcp[at] = self.ahead(self.sa[at - 1], self.sa[at])
        deep = lcp > 0
        longest = int(np.diff(np.flatnonzero(~deep)).max())
        least = [lcp]
        while 1 << len(least) < longest:
            half, x = 1 << (len(least) - 1), least[-1]
            least.append(np.minimum(x[:-half], x[half:]) if len(x) > half else x[:0])
        value = lcp[at]
        low, high = at - 1, at + 1
        for k in range(len(least) - 1, -1, -1):
            x = least[k]
            i = np.flatnonzero(low - (1 << k) + 1 >= 0)
            low[i[x[low[i] - (1 << k) + 1] >= value[i]]] -= 1 << k
            i = np.flatnonzero(high < len(x))
            high[i[x[high[i]] >= value[i]]] += 1 << k
        by = np.argsort(low * (self.n + 1) + high, kind="stable")
        at, low, high, value = at[by], low[by], high[by], value[by]
        head = np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
        tail = np.concatenate([head[1:], [True]])
        # a node's children start at its first leaf and at each of its entries
        node, firsts = np.cumsum(head) - 1, np.flatnonzero(head)
        child = np.empty(len(at) + len(firsts), np.int64)
        child[np.arange(len(at)) + node + 1] = at
        child[firsts + np.arange(len(firsts))] = low[firsts]
        end = np.empty_like(child)
        end[:-1] = child[1:]
        end[np.flatnonzero(tail) + np.arange(len(firsts)) + 1] = high[firsts]
        own = np.repeat(np.arange(len(firsts)), np.diff(np.append(firsts, len(at))) + 1)
        return child, end - child, low[firsts][own], high[firsts][own], value[firsts][own]

    def repeats(self) -> tuple[np.ndarray, np.ndarray]:
        """Place and half length of every branching tandem repeat."""
        child, size, low, high, depth = self.nodes()
        if not len(child):
            return child, child
        group = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])]))
        most = np.repeat(np.maximum.reduceat(size, group), np.diff(np.append(group, len(size))))
        largest = np.flatnonzero(size == most)
        keep = np.ones(len(size), bool)
        of = np.searchsorted(group, largest, "right")
        keep[largest[np.concatenate([[True], of[1:] != of[:-1]])]] = False  # the first of the longest lists isn't walked
        child, size, low, high, depth = (x[keep] for x in (child, size, low, high, depth))
        word, found, so_far = self.names[0], [], np.cumsum(size)
        i = 0
        while i < len(size):
            j = max(i + 1, int(np.searchsorted(so_far, (so_far[i - 1] if i else 0) + BLOCK, "right")))
            c = np.repeat(np.arange(i, j), size[i:j])
            leaf = self.sa[np.arange(len(c)) + (child[i:j] - so_far[i:j] + size[i:j])[c - i] + (so_far[i - 1] if i else 0)]
            for step in (depth[c], -depth[c]):
                other = leaf + step
                k = np.flatnonzero((other >= 0) & (other < self.n))
                at = self.rank[other[k]]
                k = k[(low[c[k]] <= at) & (at < high[c[k]])]
                d, a = depth[c[k]], np.minimum(leaf[k], other[k])
                k = word[a] != word[a + 2 * d]
                found.append(a[k] * (self.n + 1) + d[k])
            i = j
        both = np.unique(np.concatenate(found))
        return both // (self.n + 1), both % (self.n + 1)


def runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray, rows: int, exponent: int = 2, least: int = 2) -> tuple[np.ndarray, ...]:
    """Row, first word (from all rows' words, from 0), words and period of every run of at least `exponent` periods and `least` words, in order."""
    if not len(starts):
        return (np.empty(0, np.int64),) * 4
    tree = Trees(*_classes(data, starts, ends, row), row, rows)
    at, period = tree.repeats()
    start, end = tree.behind(at, period), at + 2 * period
    by = np.lexsort((period, end, start))
    start, end, period = start[by], end[by], period[by]
    keep = np.ones(len(start), bool)
    keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    keep &= (end - start >= exponent * period) & (end - start >= least)
    start, length, period = start[keep], (end - start)[keep], period[keep]
    first = np.searchsorted(tree.place, start)
    by = np.lexsort((period, first))
    return row[first[by]], first[by], length[by], period[by]


def _collapsed(data: np.ndarray, off: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray, gone: np.ndarray) -> pa.Array:
    """The rows' words that aren't gone, joined by one space. data has a blank after every row."""
    starts, ends, row = starts[~gone], ends[~gone], row[~gone]
    last = np.append(row[1:] != row[:-1], True) if len(row) else np.empty(0, bool)
    edge = np.zeros(len(data) + 2, np.int8)
    edge[starts] += 1
    np.subtract.at(edge, ends + ~last, 1)
    keep = np.cumsum(edge[:-2], dtype=np.int8).astype(bool)
    size = np.concatenate([[0], np.cumsum(keep)])[off]
    out = data[keep]
    out[BLANKS[out]] = 0x20
    return pa.Array.from_buffers(pa.large_string(), len(off) - 1, [None, pa.py_buffer(size.astype(np.int64)), pa.py_buffer(out)]).cast(pa.string())


RUNS = ArrayType(StructType().add("start", "long").add("length", "long").add("period", "long"))


def find(docs: DataFrame, keep: list[Column], text: str = "text", exponent: int = 4, least: int = 6) -> DataFrame:
    """The columns in `keep` with `runs`, all runs of at least `exponent` periods and `least` words by start and then period, and
    `collapsed`, the text's words but those that a run holds beyond its first period, joined by one space.

    A word is a stretch of anything but space and \\t \\n \\v \\f \\r, numbered from 0; a run is a stretch of words with a
    least period that no neighbouring word extends. Null and empty texts and texts without words have no runs and an empty `collapsed`; bytes
    that aren't UTF-8 count as U+FFFD; rows that repeat give the same each; other columns are ignored; an empty table gives
    none. Each task works on the rows it reads, about two megabytes of text at a time or one longer text: no row is
    shuffled, and memory is bounded by the longest text.
    """
    rows = docs.select(*keep, valid(F.col(text)).alias("text_"))
    names = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text_"):
            data, off = text_bytes(b.column("text_"))
            data, off = np.insert(data, off[1:], 0x20), off + np.arange(len(off))
            starts, ends, first = spans(~BLANKS[data], off)
            row = row_of(first)
            of, at, length, period = runs(data, starts, ends, row, b.num_rows, exponent, least)
            edge = np.zeros(len(starts) + 1, np.int64)
            np.add.at(edge, at + period, 1)
            np.subtract.at(edge, at + length, 1)
            gone = np.cumsum(edge[:-1]) > 0
            found = pa.StructArray.from_arrays([pa.array(x) for x in (at - first[of], length, period)], ["start", "length", "period"])
            listed = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(b.num_rows + 1)).astype(np.int32)), found)
            yield arrow({**{x: b.column(x) for x in names}, "runs": listed, "collapsed": _collapsed(data, off, starts, ends, row, gone)})

    return rows.mapInArrow(run, rows.drop("text_").schema.add("runs", RUNS).add("collapsed", "string"))


def planted(docs: DataFrame, text: str = "text", key: str = "doc_id") -> Column:
    """The text with a periodic end, in the tenth of documents whose crc32 of the key (as text) ends in 0, and as it is in all others.

    With g that number without its last digit and n the words, every word from a = g % n on repeats with period
    p = 1 + floor((n - a) / (3 + g % 8)). Words are joined by one space then.
    """
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(F.col(text), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    turns = F.ceil((n - a) / p).cast("int")
    end = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), turns)), F.lit(1), n - a)
    return F.when((h % 10 == 0) & (n > 0), F.array_join(F.concat(F.slice(words, F.lit(1), a), end), " ")).otherwise(F.col(text))
