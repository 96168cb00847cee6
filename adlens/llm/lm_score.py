"""Interpolated modified Kneser-Ney model of word pairs or triples, counted in Spark, and log probabilities under it.

A first pass counts words. Shards by a hash of the word write the word table and number their words by falling count, so
that frequent words have small numbers. A second pass counts triples of these numbers: tasks sort what they have, and send it
to shards by the word between, as differences that are compressed (some 3 bytes a triple); words that are frequent are spread
over more shards by the third word, the more the more frequent, so that none fills a shard. A shard has all triples of
a pair (its two last words), and so in how many contexts that stands, which is its count (pairs at the beginning of a text
keep their own). It writes one file: its words between, for each the words after, and for each of those the words before with counts.

What a context sums up to lies beside them, unless its last word is spread: then shards send on their parts, and shards by
context add them up. Shards send on what they have for each word, too: how often it follows and leads, with how many partners.
Words that come after are found by binary search in files that workers map into memory.

With the order 2 there is nothing before a pair, and its count is how often it occurs.
"""

from __future__ import annotations

import atexit
import json
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.chars import sums_by_row
from adlens.llm.common import let_go, mix, shared_dir, slices, word_hashes

#: Stand for the end of a text, a token, and for its beginning, which is none.
END, BEGIN = (mix(np.array([x], np.uint64))[0] for x in (1, 2))
#: A word is spread over one more shard for each so many times that it occurs.
PART = 1 << 18
#: Bytes of text for each shard of triples; shards of words are of four times as many.
SHARD_BYTES = 32 << 20
#: Tokens, and different words, counted together in a task.
CHUNK, WORDS_CHUNK = 2_000_000, 1_000_000
U64, U32, U8 = np.uint64, np.uint32, np.uint8
#: The number of a word that isn't in the table.
NEVER = 0xFFFFFFFF
#: What is kept of a context: how often it stands, with how many words once, twice and more.
SUMS = ("count", "ones", "twos", "more")


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All rows' tokens with an end each, and the rows' starts with the total last."""
    words, first = word_hashes(column)
    off = first + np.arange(len(first))
    out = np.empty(len(words) + len(first) - 1, U64)
    is_end = np.zeros(len(out), bool)
    is_end[off[1:] - 1] = True
    out[~is_end], out[is_end] = words, END
    return out, off


def before(x: np.ndarray, off: np.ndarray, begin: int) -> np.ndarray:
    """What stands before each of x in its row."""
    out = np.concatenate([[begin], x[:-1]])[: len(x)]
    out[off[:-1]] = begin
    return out


def placed(words: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The different words, with the beginning; and of each token the places there of the one two before it, the one before it, and its own."""
    every, where = np.unique(np.append(words, BEGIN), return_inverse=True)
    c = where[:-1]
    v = before(c, off, where[-1])
    return every, before(v, off, where[-1]), v, c


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(U64) << U64(32) | b.astype(U64)


def shard_of(lead: np.ndarray, word: np.ndarray, seen: np.ndarray, shards: int, part: int) -> np.ndarray:
    """Of pairs of words' numbers; seen: how often the first of them occurs."""
    spread = np.minimum(shards, 1 + seen // part).astype(U64)
    return ((mix(lead.astype(U64)) + mix(word.astype(U64) ^ U64(0x5851F42D4C957F2D)) % spread) % U64(shards)).astype(narrow(shards))


def narrow(shards: int) -> type:
    """The type of shards' numbers, of which narrow ones are sorted faster."""
    return np.uint16 if shards < 1 << 16 else U32


def _heads(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _runs(heads: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(heads, n))


def _summed(v: np.ndarray, heads: np.ndarray) -> np.ndarray:
    return np.add.reduceat(v, heads) if len(heads) else v[:0]


def _sums(n: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """SUMS of each run of counts, a row each."""
    ones, twos = (_summed((n == x).astype(np.int64), heads) for x in (1, 2))
    return np.stack([_summed(n, heads), ones, twos, _runs(heads, len(n)) - ones - twos])


CODEC = pa.Codec("zstd", 1)


def packed(x: np.ndarray, kind: type = U32) -> bytes:
    """Compressed, all lowest bytes first."""
    x = np.ascontiguousarray(x.astype(kind))
    return bytes([x.itemsize]) + len(x).to_bytes(8, "little") + CODEC.compress(x.view(U8).reshape(-1, x.itemsize).T.tobytes(), asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    size, n = data[0], int.from_bytes(data[1:9], "little")
    raw = np.frombuffer(CODEC.decompress(data[9:], size * n, asbytes=True), U8)
    return np.ascontiguousarray(raw.reshape(size, n).T).view(f"<u{size}").ravel().astype(np.int64)


def _steps(x: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Differences within the runs of an array that rises in each."""
    x = x.astype(np.int64)
    out = np.diff(x, prepend=0)
    out[heads] = x[heads]
    return out


def _risen(steps: np.ndarray, runs: np.ndarray) -> np.ndarray:
    up = np.cumsum(steps)
    heads = np.cumsum(runs) - runs
    return up - np.repeat((up - steps)[heads], runs)


def _bytes(path: str, data: bytes) -> None:
    """Write a file of the shared folder in one step, so that a task that runs again does no harm."""
    if "://" in path:
        from pyarrow import fs

        system, at = fs.FileSystem.from_uri(path)
        part = f"{at}.{uuid.uuid4().hex}"
        with system.open_output_stream(part) as f:
            f.write(data)
        system.move(part, at)
        return
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as f:
        f.write(data)
    os.replace(part, path)


def _write(path: str, arrays: dict[str, np.ndarray]) -> None:
    """One file of arrays, each at a multiple of 8 bytes, after a list of them."""
    at, listed, parts = 0, {}, []
    for name, x in arrays.items():
        listed[name] = (x.dtype.str, at, x.shape)
        parts.append(x.tobytes() + b"\0" * (-x.nbytes % 8))
        at += len(parts[-1])
    top = json.dumps(listed).encode()
    top += b" " * (-len(top) % 8)
    _bytes(path, b"".join([len(top).to_bytes(8, "little"), top, *parts]))


def _arrays(path: str) -> dict[str, np.ndarray]:
    """The arrays of a file: mapped into memory where the shared folder is a file system, else read from the store."""
    if "://" in path:
        from pyarrow import fs

        system, at = fs.FileSystem.from_uri(path)
        with system.open_input_file(at) as f:
            data = np.frombuffer(f.read(), U8)
    else:
        data = np.asarray(np.memmap(path, U8, "r"))
    top = 8 + int.from_bytes(data[:8].tobytes(), "little")
    listed = json.loads(data[8:top].tobytes())
    return {name: np.ndarray(shape, kind, data, top + at) for name, (kind, at, shape) in listed.items()}


def _small(name: str, n: np.ndarray) -> dict[str, np.ndarray]:
    """Counts as bytes, those of 255 or more in a table beside."""
    large = np.flatnonzero(n >= 255)
    return {name: np.minimum(n, 255).astype(U8), f"{name}+": np.stack([large, n[large]]).astype("<u8")}


def counts(arrays: dict[str, np.ndarray], name: str, at: np.ndarray) -> np.ndarray:
    n, large = arrays[name][at].astype(np.int64), arrays[f"{name}+"]
    i = np.flatnonzero(n == 255)
    n[i] = large[1, np.searchsorted(large[0], at[i].astype(U64))]
    return n


def _offsets(starts: np.ndarray) -> dict[str, np.ndarray]:
    """Rising numbers by their lowest 16 bits, and where the others grow."""
    return {"low": (starts & 0xFFFF).astype("<u2"), "high": np.searchsorted(starts >> 16, np.arange(1, (int(starts[-1]) >> 16) + 1)).astype("<u8")}


def offsets(arrays: dict[str, np.ndarray], at: np.ndarray) -> np.ndarray:
    return arrays["low"][at].astype(np.int64) + (np.searchsorted(arrays["high"], at.astype(U64), "right") << 16)


#: Contexts' sums are a byte where they are among so many frequent ones of a shard.
CODES = 255


def _contexts(lead: np.ndarray, word: np.ndarray, sums: np.ndarray, ids: np.ndarray) -> dict[str, np.ndarray]:
    """Contexts sorted by their last word and the one before it, under the last words `ids`."""
    edges = np.searchsorted(lead, np.append(ids, NEVER))
    # as one number where all sums are small, which is what is frequent
    one = np.where((sums < 1 << 15).all(axis=0), ((sums[0] << 15 | sums[1]) << 15 | sums[2]) << 15 | sums[3], -1)
    kinds, first, back, n = np.unique(one, return_index=True, return_inverse=True, return_counts=True)
    top = np.argsort(np.where(kinds < 0, 0, -n), kind="stable")[:CODES]
    top = top[kinds[top] >= 0]
    code = np.full(len(kinds), CODES, U8)
    code[top] = np.arange(len(top))
    code = code[back]
    rest = np.flatnonzero(code == CODES)
    return {"contexts": edges.astype("<u4"), "before": word.astype("<u4"), "code": code, "codes": sums[:, first[top]].T.astype("<u8"), "rest": np.stack([rest, *sums[:, rest]]).astype("<u8")}


def context_sums(arrays: dict[str, np.ndarray], at: np.ndarray) -> np.ndarray:
    """SUMS of the contexts at these places, a row each."""
    code, rest = arrays["code"][at], arrays["rest"]
    out = np.zeros((4, len(at)), np.int64)
    known = code < CODES
    out[:, known] = arrays["codes"][code[known]].T
    out[:, ~known] = rest[1:, np.searchsorted(rest[0], at[~known].astype(U64))]
    return out


def found(sorted_: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each of x stands in a sorted array, and whether it does."""
    if not len(sorted_):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)
    return at, sorted_[at] == x


def within(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each of x stands among values[lo:hi], which rise, and whether it does."""
    if not len(values):
        return lo.astype(np.int64), np.zeros(len(x), bool)
    at, n, x = np.minimum(lo, len(values) - 1).astype(np.int64), hi.astype(np.int64) - lo, x.astype(U32)
    some = n > 0
    i = np.flatnonzero(n > 1)
    while len(i):  # the last that is not above x lies among the n from at on
        a, m, y = at[i], n[i], x[i]
        for _ in range(4):
            half = m >> 1
            a += half * (values[a + half] <= y)
            m -= half
        at[i], n[i] = a, m
        i = i[m > 1]
    return at, some & (values[at] == x)


WORDS = "shard int, hash binary, n binary"


def _count_words(word_shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def added() -> tuple[np.ndarray, np.ndarray]:
            h, n = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(h, kind="stable")
            heads = _heads(h[order])
            held.clear()
            return h[order][heads], _summed(n[order], heads)

        def flush() -> Iterator[pa.RecordBatch]:
            h, n = added()
            shard = mix(h) % U64(word_shards)
            rows = [{"shard": int(k), "hash": h[shard == k].tobytes(), "n": packed(n[shard == k])} for k in np.unique(shard)]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("shard", pa.int32()), ("hash", pa.binary()), ("n", pa.binary())]))

        size = 0
        for b in slices(batches):
            h, n = np.unique(tokens(b.column("text"))[0], return_counts=True)
            held += [(h, n), (np.array([BEGIN], U64), np.zeros(1, np.int64))]
            size += len(h)
            if size > 2 * WORDS_CHUNK:
                held.append(added())
                size = len(held[0][0])
                if size > WORDS_CHUNK:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    return run


def _words(folder: str, word_shards: int):
    """Write a shard of the word table; what is returned: its words, tokens and texts, and the number of the beginning if it is here."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        k = key[0].as_py()
        h = np.concatenate([np.frombuffer(x.as_buffer(), U64) for x in table.column("hash")])
        n = np.concatenate([unpacked(x.as_py()) for x in table.column("n")])
        order = np.argsort(h, kind="stable")
        heads = _heads(h[order])
        h, n = h[order][heads], _summed(n[order], heads)
        falling = np.argsort(-n, kind="stable")
        rank = np.empty(len(h), "<u4")
        rank[falling] = np.arange(len(h))
        if len(h) * word_shards >= NEVER:
            raise ValueError("more different words than 32 bits can number")
        _write(f"{folder}/words-{k}", {"hash": h, "rank": rank, **_small("count", n[falling])})
        at, ok = found(h, np.array([BEGIN, END], U64))
        sums = [len(h), n.sum(), (n > 0).sum(), n[at[1]] if ok[1] else 0, rank[at[0]] * word_shards + k if ok[0] else -1]
        return pa.Table.from_pydict({"shard": pa.array([k], pa.int32()), "sums": pa.array([[int(x) for x in sums]], pa.list_(pa.int64()))})

    return run


#: lead: words between, with how many words after each (pairs) and whether they are spread; word: those after, with how many before each (runs); back: those before, and counts.
TRIPLES = pa.schema([("shard", pa.int32()), *[(x, pa.binary()) for x in ("lead", "pairs", "spread", "word", "runs", "back", "n")]])
TRIPLES_DDL = "shard int, lead binary, pairs binary, spread binary, word binary, runs binary, back binary, n binary"


def _count(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            back, lead, word, shard, spread = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.argsort(back, kind="stable")
            order = order[np.argsort(paired(lead, word)[order], kind="stable")]
            order = order[np.argsort(shard[order], kind="stable")]
            back, lead, word, shard, spread = (x[order] for x in (back, lead, word, shard, spread))
            at = _heads(lead, word, back)
            n = _runs(at, len(back))
            back, lead, word, shard, spread = (x[at] for x in (back, lead, word, shard, spread))
            edges = _heads(shard)
            for i, j in zip(edges, np.append(edges, len(shard))[1:], strict=True):
                pair = _heads(lead[i:j], word[i:j])
                v, w = lead[i:j][pair], word[i:j][pair]
                of = _heads(v)
                got = _steps(v[of], [0]), _runs(of, len(pair)), spread[i:j][pair][of], _steps(w, of), _runs(pair, j - i), _steps(back[i:j], pair), n[i:j]
                yield pa.RecordBatch.from_arrays([pa.array([shard[i]], pa.int32()), *(pa.array([packed(x)], pa.binary()) for x in got)], schema=TRIPLES)

        for b in slices(batches):
            every, u, v, c = placed(*tokens(b.column("text")))
            table = model.words(every, ("count",))
            ids, seen = table["id"].astype(U32), model.seen(table)
            back = ids[u] if model.order == 3 else np.zeros(len(c), U32)
            held.append((back, ids[v], ids[c], shard_of(ids[v], ids[c], seen[v], model.shards, model.part), seen[v] >= model.part))
            if sum(len(x[0]) for x in held) >= CHUNK:
                yield from flush()
        if held:
            yield from flush()

    return run


#: Parts of sums: of words that follow (kind 0) or lead (1), by number in x; of contexts (2), their last words in x, with how many before each (runs), those in y; of a shard's counts (3).
PARTS = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), *[(x, pa.binary()) for x in ("x", "runs", "y", "a", "b", "c", "d")]])
PARTS_DDL = "shard int, kind int, x binary, runs binary, y binary, a binary, b binary, c binary, d binary"


def _dealt(shard: np.ndarray, shift: int, kind: int, x: np.ndarray, sums: np.ndarray, y: np.ndarray | None = None) -> Iterator[dict]:
    """A row of PARTS for each shard, x and then y rising."""
    order = np.argsort(shard, kind="stable")
    shard, x, sums, y = shard[order], x[order], sums[:, order], None if y is None else y[order]
    edges = _heads(shard)
    for i, j in zip(edges, np.append(edges, len(shard))[1:], strict=True):
        of = _heads(x[i:j])
        more = {} if y is None else {"runs": packed(_runs(of, j - i)), "y": packed(_steps(y[i:j], of))}
        yield {"shard": int(shard[i]) + shift, "kind": kind, "x": packed(_steps(x[i:j][of], [0])), **{name: packed(v[i:j], U64) for name, v in zip("abcd", sums, strict=False)}} | more


def _of_counts(n: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3 and 4."""
    return [int((n == x).sum()) for x in (1, 2, 3, 4)]


def _triples(model: Model):
    folder, shards, order3, w_shards = model.folder, model.shards, model.order == 3, len(model.word_sizes)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        k = key[0].as_py()
        parts, heavy = [], []
        for r in range(table.num_rows):
            lead, pairs, spread, word, runs, back, n = (unpacked(table.column(x)[r].as_py()) for x in TRIPLES.names[1:])
            lead = np.cumsum(lead)
            heavy.append(lead[spread > 0])
            pair = paired(np.repeat(lead, pairs), _risen(word, pairs))
            parts.append((np.repeat(pair, runs), _risen(back, runs).astype(U32), n.astype(U32)))
        del pairs, word, runs, pair
        pair, back, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        order = np.argsort(back, kind="stable")
        order = order[np.argsort(pair[order], kind="stable")]
        pair, back, n = pair[order], back[order], n[order]
        heads = _heads(pair, back)
        pair, back, n = pair[heads], back[heads], _summed(n.astype(np.int64), heads)
        del order
        heads = _heads(pair)
        lead, word = (pair[heads] >> U64(32)).astype(np.int64), (pair[heads] & U64(NEVER)).astype(np.int64)
        of = np.where(lead == model.begin, n[heads], _runs(heads, len(n))) if order3 else n
        by = _heads(lead)
        ids = lead[by]
        arrays = {"lead": ids.astype("<u4"), "pairs": np.append(by, len(lead)).astype("<u4"), "word": word.astype("<u4"), **_small("n", n)}
        out = []
        if order3:
            arrays |= {"back": back.astype("<u4"), **_offsets(np.append(heads, len(n)))}
            context = paired((pair >> U64(32)), back)
            order = np.argsort(context, kind="stable")
            context, n_ = context[order], n[order]
            at = _heads(context)
            sums, last, first = _sums(n_, at), (context[at] >> U64(32)).astype(np.int64), (context[at] & U64(NEVER)).astype(np.int64)
            spread = np.isin(last, np.unique(np.concatenate(heavy)))
            arrays |= _contexts(last[~spread], first[~spread], sums[:, ~spread], ids)
            shard = (mix(context[at][spread]) % U64(shards)).astype(narrow(shards))
            out += _dealt(shard, w_shards, 2, last[spread], sums[:, spread], first[spread])
            del context, n_, order
        _write(f"{folder}/grams-{k}", arrays)
        del arrays, pair, back
        out += _dealt((ids % w_shards).astype(np.int32), 0, 1, ids // w_shards, _sums(of, by))
        follow, times = np.unique(word, return_counts=True)
        out += _dealt((follow % w_shards).astype(np.int32), 0, 0, follow // w_shards, times[None])
        out.append({"shard": -1, "kind": 3, "x": packed(np.array([k, *_of_counts(n), *_of_counts(of)]), U64)})
        del n, of
        let_go()
        return pa.Table.from_pylist(out, PARTS)

    return run


def _added_up(model: Model):
    folder, sizes = model.folder, model.word_sizes

    def run(key: tuple, table: pa.Table) -> pa.Table:
        k, rows = key[0].as_py(), table.to_pylist()
        if k < 0:  # the counts of counts, and the shards that have files
            each = np.stack([unpacked(r["x"]) for r in rows])
            sums = [*each[:, 1:].sum(axis=0), *np.sort(each[:, 0])]
        elif k < len(sizes):
            got = np.zeros((5, sizes[k]), np.int64)
            for r in rows:
                at = np.cumsum(unpacked(r["x"]))
                for place, name in zip(((0,), (1, 2, 3, 4))[r["kind"]], "abcd", strict=False):
                    got[place, at] += unpacked(r[name])
            _write(f"{folder}/sums-{k}", {x: y for name, v in zip(("follows", *SUMS), got, strict=True) for x, y in _small(name, v).items()})
            sums = [got[0].sum(), (got[0] > 0).sum(), *_of_counts(got[0])]
        else:
            runs = [unpacked(r["runs"]) for r in rows]
            context = np.concatenate([paired(np.repeat(np.cumsum(unpacked(r["x"])), n), _risen(unpacked(r["y"]), n)) for r, n in zip(rows, runs, strict=True)])
            order = np.argsort(context, kind="stable")
            context = context[order]
            heads = _heads(context)
            got = np.stack([_summed(np.concatenate([unpacked(r[x]) for r in rows])[order], heads) for x in "abcd"])
            lead, word = (context[heads] >> U64(32)).astype(np.int64), (context[heads] & U64(NEVER)).astype(np.int64)
            ids = np.unique(lead)
            _write(f"{folder}/spread-{k - len(sizes)}", {"lead": ids.astype("<u4"), **_contexts(lead, word, got, ids)})
            sums = []
        return pa.Table.from_pydict({"shard": pa.array([k], pa.int32()), "sums": pa.array([[int(x) for x in sums]], pa.list_(pa.int64()))})

    return run


def discounts(n: list[int]) -> np.ndarray:
    """What is taken from counts of 1, 2, and 3 or more, given how many counts are 1, 2, 3 and 4; zero for a count of 0."""
    n1, n2, n3, n4 = (max(x, 0) for x in n)
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    d = [k - (k + 1) * y * b / a if a and b else k * 0.5 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return np.array([0.0, *(min(max(x, 0.1), k) for x, k in zip(d, (1, 2, 3), strict=True))])


@dataclass
class Model:
    folder: str
    order: int
    shards: int
    part: int
    word_sizes: list[int]  # of each shard of words
    tokens: int = 0
    vocabulary: int = 0
    texts: int = 0
    begin: int = NEVER  # the number of the beginning
    gram_shards: list[int] = field(default_factory=list)
    spread_shards: list[int] = field(default_factory=list)
    triple_discount: np.ndarray | None = None
    pair_discount: np.ndarray | None = None
    word_discount: np.ndarray | None = None
    pairs: int = 0
    spare: float = 1.0  # what the discounts leave to words never seen, as a share
    files: dict = field(default_factory=dict)

    def open(self, path: str) -> dict[str, np.ndarray]:
        """A file's arrays. Mapped files stay open; what is read from a store is let go, so that a worker holds one shard at a time."""
        if path not in self.files:
            got = _arrays(f"{self.folder}/{path}")
            if "://" in self.folder:
                return got
            self.files[path] = got
        return self.files[path]

    def words(self, h: np.ndarray, names: tuple[str, ...]) -> dict[str, np.ndarray]:
        """The number of each hash's word and what the table has for it; NEVER and zeros for words never seen."""
        out = {"id": np.full(len(h), NEVER, np.int64)} | {name: np.zeros(len(h), np.int64) for name in names}
        shard = (mix(h) % U64(len(self.word_sizes))).astype(np.int32)
        for k in (k for k, n in enumerate(self.word_sizes) if n):
            i = np.flatnonzero(shard == k)
            if not len(i):
                continue
            table = self.open(f"words-{k}")
            at, ok = found(table["hash"], h[i])
            i, rank = i[ok], table["rank"][at[ok]].astype(np.int64)
            out["id"][i] = rank * len(self.word_sizes) + k
            sums = self.open(f"sums-{k}") if set(names) - {"count"} else {}
            for name in names:
                out[name][i] = counts(table, "count", rank) if name == "count" else counts(sums, name.removeprefix("lead_"), rank)
        return out

    def seen(self, table: dict[str, np.ndarray]) -> np.ndarray:
        """How often each word stands before others; the beginning, which is no token, in each text."""
        return np.where(table["id"] == self.begin, self.texts, table["count"])

    def of_shards(self, name: str, shards: list[int], shard: np.ndarray, lead: np.ndarray, below: str) -> Iterator[tuple[dict, np.ndarray, np.ndarray, np.ndarray]]:
        """For each shard its arrays, which rows have a word there that stands in `lead`, and from where to where `below` goes for it."""
        order = np.argsort(shard, kind="stable")
        edges = np.searchsorted(shard[order], np.arange(self.shards + 1))
        for k in shards:
            i = order[edges[k] : edges[k + 1]]
            if len(i):
                table = self.open(f"{name}-{k}")
                at, ok = found(table["lead"], lead[i].astype(U32))
                if ok.any():
                    yield table, i[ok], table[below][at[ok]], table[below][at[ok] + 1]

    def grams(self, back: np.ndarray, lead: np.ndarray, word: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The counts of pairs and triples of words' numbers, zeros for those never seen."""
        two, three = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
        for table, i, lo, hi in self.of_shards("grams", self.gram_shards, shard_of(lead, word, seen, self.shards, self.part), lead, "pairs"):
            at, ok = within(table["word"], lo, hi, word[i])
            i, at = i[ok], at[ok]
            if self.order == 2:
                two[i] = counts(table, "n", at)
                continue
            lo, hi = offsets(table, at), offsets(table, at + 1)
            two[i] = np.where(lead[i] == self.begin, counts(table, "n", lo), hi - lo)
            at, ok = within(table["back"], lo, hi, back[i])
            three[i[ok]] = counts(table, "n", at[ok])
        return two, three

    def contexts(self, back: np.ndarray, lead: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """SUMS of each context, zeros for those never seen."""
        out = np.zeros((4, len(back)), np.int64)
        spread = seen >= self.part
        whole = (mix(lead.astype(U64)) % U64(self.shards)).astype(narrow(self.shards))
        for name, shards, which, shard in (("grams", self.gram_shards, ~spread, whole), ("spread", self.spread_shards, spread, (mix(paired(lead, back)) % U64(self.shards)).astype(narrow(self.shards)))):
            own = np.flatnonzero(which)
            for table, i, lo, hi in self.of_shards(name, shards, shard[own], lead[own], "contexts"):
                at, ok = within(table["before"], lo, hi, back[own[i]])
                out[:, own[i[ok]]] = context_sums(table, at[ok])
        return out

    def score(self, words: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each token after the two before it, of which the order 2 heeds one: log10 probability, log10 base probability, and whether it was seen."""
        every, u, v, c = placed(words, off)
        table = self.words(every, ("count", "follows", *SUMS_OF_LEAD))
        seen = self.seen(table)
        ids = table["id"]
        # what is alike is worked out once, in the order of the files; words never seen are alike
        known, rank = np.unique(ids, return_inverse=True)
        key = paired(rank[v], rank[c])
        if self.order == 3:
            key = (rank[v] << 21 | rank[c]) << 21 | rank[u] if len(known) < 1 << 21 else paired(np.unique(key, return_inverse=True)[1], rank[u])
        order = np.argsort(key)
        heads = _heads(key[order])
        again = np.empty(len(key), np.int64)
        again[order] = np.repeat(np.arange(len(heads)), _runs(heads, len(key)))
        u, v, c = (x[order[heads]] for x in (u, v, c))
        follows, count = table["follows"][c], table["count"][c]
        p = np.maximum(follows - self.word_discount[np.minimum(follows, 3)], 0) / max(1, self.pairs) + self.spare / (self.vocabulary + 1)
        two, three = self.grams(ids[u], ids[v], ids[c], seen[v])

        def mixed(n: np.ndarray, sums: list[np.ndarray], d: np.ndarray) -> np.ndarray:
            total, ones, twos, more = sums
            return np.where(total > 0, (np.maximum(n - d[np.minimum(n, 3)], 0) + (d[1] * ones + d[2] * twos + d[3] * more) * p) / np.maximum(total, 1), p)

        p = mixed(two, [table[x][v] for x in SUMS_OF_LEAD], self.pair_discount)
        if self.order == 3:
            p = mixed(three, self.contexts(ids[u], ids[v], seen[v]), self.triple_discount)
        base = np.log10((count + 1) / (self.tokens + self.vocabulary + 1))
        return np.log10(p)[again], base[again], (count > 0)[again]


SUMS_OF_LEAD = tuple(f"lead_{x}" for x in SUMS)


def fit(docs: DataFrame, text: str = "text", order: int = 2, part: int = PART) -> Model:
    """Count all rows of docs, null texts as empty; the order is 2 or 3. The files stay in the shared folder until the program ends.

    Rows that repeat count each. Bytes that aren't UTF-8 are parts of words like others. Without rows every word is new.
    """
    if order not in (2, 3):
        raise ValueError(f"order {order}: 2 or 3")
    spark = docs.sparkSession
    folder = f"{shared_dir(spark).removesuffix('/')}/kn-{uuid.uuid4().hex}"
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    if "://" not in folder:
        os.makedirs(folder, exist_ok=True)
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    rows = docs.select(F.col(text).alias("text"))
    size = rows.agg(F.sum(F.length(F.col("text").cast("binary")))).first()[0] or 0
    shards, word_shards = max(4, -(-size // SHARD_BYTES)), max(4, -(-size // (4 * SHARD_BYTES)))
    # both jobs give a number of rows bounded by the shards
    counted = rows.mapInArrow(_count_words(word_shards), WORDS).groupBy("shard").applyInArrow(_words(folder, word_shards), RESULT)
    sizes, begin, total = [0] * word_shards, NEVER, np.zeros(3, np.int64)
    for r in counted.collect():
        sizes[r["shard"]], *sums, first = r["sums"]
        total += sums
        begin = first if first >= 0 else begin
    model = Model(folder, order, shards, part, sizes, *total.tolist(), begin)
    counted = rows.mapInArrow(_count(model), TRIPLES_DDL).groupBy("shard").applyInArrow(_triples(model), PARTS_DDL)
    got = {r["shard"]: r["sums"] for r in counted.groupBy("shard").applyInArrow(_added_up(model), RESULT).collect()}
    n = got.pop(-1, [0] * 8)
    model.gram_shards = n[8:]
    model.spread_shards = sorted(k - word_shards for k in got if k >= word_shards)
    model.pairs, kinds, *ones = np.sum([[0] * 6, *(v for k, v in got.items() if k < word_shards)], axis=0).tolist()
    model.triple_discount, model.pair_discount, d = discounts(n[:4]), discounts(n[4:8]), discounts(ones)
    model.word_discount = d
    model.spare = (d[1] * ones[0] + d[2] * ones[1] + d[3] * (kinds - ones[0] - ones[1])) / model.pairs if model.pairs else 1.0
    return model


RESULT = "shard int, sums array<long>"


def score(docs: DataFrame, model: Model, keep: list[Column], text: str = "text") -> DataFrame:
    """The columns in `keep` with n_tokens, n_known, train_tokens, base_score, score and perplexity.

    Null counts as empty: one token, the end. Rows that repeat give the same result each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*keep, F.col(text).alias("text_"))
    names = rows.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches, "text_"):
            words, off = tokens(b.column("text_"))
            p, base, known = m.score(words, off)
            p, n = sums_by_row(p, off), np.diff(off)
            out = [n, sums_by_row(known.astype(np.int64), off).astype(np.int64), np.full(len(n), m.tokens), sums_by_row(base, off), p, 10.0 ** np.minimum(-p / n, 300)]
            yield pa.RecordBatch.from_arrays([*(b.column(x) for x in names), *(pa.array(x) for x in out)], [*names, "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    schema = rows.drop("text_").schema
    for name, kind in (("n_tokens", "long"), ("n_known", "long"), ("train_tokens", "long"), ("base_score", "double"), ("score", "double"), ("perplexity", "double")):
        schema = schema.add(name, kind)
    return rows.mapInArrow(run, schema)
