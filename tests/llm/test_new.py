"""Runs, vector codes and shards against brute force, with nulls, repeats, ties, clashing columns and empty tables."""

import collections
import hashlib
import math
import random
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adlens.llm import quality, queries, repeats, sharding, vector_codes
from adlens.llm.common import BLANKS, row_of, shared_dir, spans, text_bytes

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(w, exponent, least):
    out = {}
    for p in range(1, len(w) // 2 + 1):
        i = 0
        while i + p < len(w):
            s = i
            while i + p < len(w) and w[i] == w[i + p]:
                i += 1
            if i - s >= p:
                out.setdefault((s, i - s + p), p)
            i = max(i, s + 1)
    return sorted((s, n, p) for (s, n), p in out.items() if n >= exponent * p and n >= least)


def fast_runs(texts, exponent, least):
    data, off = text_bytes(pa.array(texts, pa.string()))
    data, off = np.insert(data, off[1:], 0x20), off + np.arange(len(off))
    starts, ends, first = spans(~BLANKS[data], off)
    out = [[] for _ in texts]
    for r, a, n, p in zip(*repeats.runs(data, starts, ends, row_of(first), len(texts), exponent, least), strict=True):
        out[r].append((int(a - first[r]), int(n), int(p)))
    return out


def test_runs_are_those_of_brute_force(monkeypatch):
    rng = random.Random(5)
    for trial in range(150):
        texts = [None, ""]
        for _ in range(rng.randint(1, 6)):
            w = [rng.choice(["a", "b", "cé", "longer-than-eight-bytes", "longer-than-eight-bytez"][: rng.randint(1, 5)]) for _ in range(rng.randint(0, 50))]
            if w and rng.random() < 0.4:
                w = (w[: rng.randint(1, 9)] * 60)[: rng.randint(1, 150)]
            texts.append(" ".join(w + ["x"] + w if rng.random() < 0.3 else w))
        if trial % 3 == 2:  # all words meet under one hash
            monkeypatch.setattr(repeats, "hashes", lambda data, starts, ends: np.zeros(len(starts), np.uint64))
        monkeypatch.setattr(repeats, "BLOCK", rng.choice([3, 1 << 20]))
        for exponent, least in ((2, 2), (4, 6), (3, 1)):
            assert fast_runs(texts, exponent, least) == [brute_runs((t or "").split(), exponent, least) for t in texts]
        monkeypatch.undo()


def test_fibonacci_words_and_long_periodic_texts():
    a, b = "x", "x y"
    for _ in range(12):
        a, b = b, b + " " + a
    assert fast_runs([b], 2, 2)[0] == brute_runs(b.split(), 2, 2)
    assert fast_runs(["w " * 30_000, " ".join(str(i % 7_000) for i in range(30_000))], 4, 6) == [[(0, 30_000, 1)], [(0, 30_000, 7_000)]]


def planted_words(i, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(i).encode()) if i is not None else 1
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (j - a) % p] for j in range(a, n)]
    return w


def runs_row(i, text):
    w = planted_words(i, text)
    found, gone = brute_runs(w, 4, 6), set()
    for s, n, p in found:
        gone.update(range(s + p, s + n))
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    kept = " ".join(x for j, x in enumerate(w) if j not in gone)
    return (i, len(found), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4), sha("".join(f"{s},{n},{p}\n" for s, n, p in found)), sha(kept))


def test_op11(spark, tmp_path):
    got = queries.op11_periodic_runs(spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    small = [(i, t) for i, t in rows if len(t or "") < 9_000]
    want = sorted(runs_row(*r) for r in small)
    assert sorted(tuple(r) for r in got.collect() if r[0] in {i for i, _ in small}) == want
    assert sum(r[1] > 0 for r in want) > 10
    odd = [(i, t) for i, t in enumerate([None, "", " \n\t", "a a a a a a", "b a b a b a b a b a b a", "ü " * 9, "x y " * 8 + "z"])] + [(None, "a " * 9), (3, "a a a a a a")]
    odd += [(i, f"w{i} " * 5 + "tail of it") for i in range(10, 60)]
    spark.createDataFrame([(*r, "1", "2") for r in odd], "doc_id long, text string, runs string, collapsed string").write.parquet(f"{tmp_path}/documents.parquet")
    assert collections.Counter(map(tuple, queries.op11_periodic_runs(spark, str(tmp_path)).collect())) == collections.Counter(runs_row(*r) for r in odd)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.find(none, [F.col("doc_id")]).count() == 0


def brute_codes(rows, parts=8, entries=16, rounds=6):
    """vec_id -> (code, error), label sums and the digest, in plain Python."""
    good = [(i, [math.floor(4096 * x) for x in v], y) for i, v, y in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    first = {}
    for i, v, _ in sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        first.setdefault(i, v)
    size = len(good[0][1]) // parts if good else 0
    books = [[v[p * size : (p + 1) * size] for v in list(first.values())[:entries]] for p in range(parts)]

    def assign(v, p):
        d = [sum((a - b) ** 2 for a, b in zip(v[p * size : (p + 1) * size], e, strict=True)) for e in books[p]]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        new = []
        for p in range(parts):
            of = collections.defaultdict(list)
            for _, v, _ in good:
                of[assign(v, p)[0]].append(v[p * size : (p + 1) * size])
            new.append([[sum(c) // len(of[e]) for c in zip(*of[e], strict=True)] if e in of else b for e, b in enumerate(books[p])])
        books = new
    out, total = [], collections.Counter()
    for i, v, y in good:
        got = [assign(v, p) for p in range(parts)]
        out.append((i, "".join(f"{c:02x}" for c, _ in got), sum(d for _, d in got), y))
        total[y] += out[-1][2]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return collections.Counter((i, c, e, total[y], sha) for i, c, e, y in out)


def vectors(tmp_path, spark, rows, kind="float"):
    path = f"{tmp_path}/{uuid.uuid4().hex}"
    spark.createDataFrame([(*r, "7", "8") for r in rows], f"vec_id long, embedding array<{kind}>, label int, code string, label_ string").repartition(3).write.parquet(f"{path}/embeddings.parquet")
    return collections.Counter(map(tuple, queries.op12_vector_codes(spark, path).collect()))


def test_op12(spark, tmp_path):
    got = queries.op12_vector_codes(spark, SF)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and [t for _, t in got.dtypes] == ["bigint", "string", "bigint", "bigint", "string"]
    rows = [(r[0], list(r[1]), r[2]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert collections.Counter(map(tuple, got.collect())) == brute_codes(rows)


@pytest.mark.parametrize("seed", range(3))
def test_op12_ties_and_odd_rows(spark, tmp_path, seed):
    rng = random.Random(seed)
    grid = lambda: [rng.choice([-1.0, 0.0, 1 / 4096, 0.5, 1.0]) for _ in range(16)]
    rows = [(i, grid(), rng.choice([None, 1, 2])) for i in rng.sample(range(200), 70)]
    rows += [(rows[5][0], rows[5][1], 1), (rows[5][0], rows[6][1], None), (None, grid(), 2), (900, None, 1), (901, grid()[:15] + [None], 1), (902, grid()[:15] + [float("nan")], 1), (903, [float("-inf"), *grid()[:15]], 1)]
    rows += [(300 + i, rows[0][1], 3) for i in range(60)]
    assert vectors(tmp_path, spark, rows) == brute_codes(rows)
    assert vectors(tmp_path, spark, rows[:9]) == brute_codes(rows[:9])  # fewer vectors than entries


def test_op12_huge_components(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-1, 1]) * rng.choice([1e-3, 3.0, 2.0e9, 7.0e12]) * rng.random() for _ in range(8)], i % 3) for i in range(40)]
    limit = lambda e: e if e is not None and e < 1 << 63 else None
    alone = collections.Counter()
    want = brute_codes(rows)
    by = {i: y for i, _, y in rows}
    large = {by[i] for i, _, e, _, _ in want if e >= 1 << 63}
    for (i, c, e, t, s), n in want.items():
        alone[i, c, limit(e), None if by[i] in large else limit(t), s] += n
    assert large and vectors(tmp_path, spark, rows, "double") == alone


def test_op12_other_lengths_and_none(spark, tmp_path):
    got = vectors(tmp_path, spark, [(1, [0.0] * 8, 1), (2, [1.0] * 16, 1), (3, [2.0] * 8, 1), (4, [], None)])
    assert sorted((r[0], r[1], r[2], r[3]) for r in got) == [(1, "00" * 8, 0, 0), (2, None, None, 0), (3, "01" * 8, 0, 0), (4, None, None, None)]
    assert vectors(tmp_path, spark, [(1, None, 1)]) == {} and vectors(tmp_path, spark, []) == {}
    assert [r[1] for r in vectors(tmp_path, spark, [(1, [0.0] * 7, 1)])] == [None]


def test_trees_find_what_all_distances_find():
    rng = np.random.default_rng(2)
    for k in (1, 2, 3, 16, 40):
        for spread in (2, 5, 1000):
            book, x = rng.integers(-spread, spread, (k, 4)), rng.integers(-spread, spread, (300, 4))
            d = ((x[:, None] - book) ** 2).sum(2)
            for kind in (np.int64, object):
                found, best = vector_codes.nearest(x.astype(kind), book.astype(kind), vector_codes.tree(book))
                assert (found == d.argmin(1)).all() and (best == d.min(1)).all()


def held(rows, sizes):
    """What the contract says of shards by bytes."""
    load, places = collections.Counter(), collections.defaultdict(list)
    for i, size, crc, shard, slot in rows:
        assert 0 <= shard < 16
        load[shard] += size
        places[shard].append(slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert max(load.values()) - min(load[s] for s in range(16)) <= max(0.001 * sum(load.values()) / 16, sizes)
    return collections.Counter((i, n, c) for i, n, c, _, _ in rows)


def test_op13(spark, tmp_path):
    for sf, most in ((SF, 2_000), ("/root/testdata/sf0.01", 500)):
        got = queries.op13_shards(spark, sf)
        assert dict(got.dtypes) == {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int", "vslot": "int", "version": "int"}
        rows = [(r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in got.collect()]
        docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
        assert held(rows, most) == collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs)
        again = [(r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in queries.op13_shards(spark, sf).collect()]
        assert sorted(rows) == sorted(again)


def test_op13_odd_rows_versions_and_growth(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, rng.choice([None, "", "é" * rng.randint(1, 90), "text " * rng.randint(1, 40)])) for i in range(900)]
    rows += [(5, "hot row")] * 2_000 + [(None, "no id")] * 50
    docs = spark.createDataFrame([(*r, {"a": 1}, "x") for r in rows], "doc_id long, text string, shard map<string,int>, vslot string")
    path = f"{shared_dir(spark)}/map-{uuid.uuid4().hex}"
    first = sharding.place(docs, path, slots=512).collect()
    want = collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert held([tuple(r)[:5] for r in first], 20) == want and {r["version"] for r in first} == {1}
    assert collections.Counter(map(tuple, sharding.place(docs.repartition(5), path, slots=512).collect())) == collections.Counter(map(tuple, first))  # the stored map serves again
    before = {r["vslot"]: r["shard"] for r in sharding.stored(spark, path).collect()}
    more = sharding.place(docs, path, shards=17, slots=512).collect()
    after = {r["vslot"]: r["shard"] for r in sharding.stored(spark, path).collect()}
    assert {r["version"] for r in more} == {2} and {v for k, v in after.items() if v != before[k]} == {16}
    load = collections.Counter()
    for r in more:
        load[r["shard"]] += r["size"]
    assert 0.8 < load[16] * 17 / sum(load.values()) < 1.2
    assert {r["version"] for r in sharding.stored(spark, path, 0).collect()} == {0}
    with pytest.raises(ValueError):
        sharding.place(docs, path, shards=16, slots=512)
    sharding.write(docs, path, f"{tmp_path}/shards")
    out = spark.read.parquet(f"{tmp_path}/shards")
    assert out.count() == len(rows)
    sizes = {r[0]: r[1] for r in out.groupBy("shard_").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1)).collect()}
    assert sizes == dict(load)
    assert sharding.place(docs.limit(0), f"{path}-none").count() == 0


def test_half_written_maps_are_passed_over(spark):
    path = f"{shared_dir(spark)}/map-{uuid.uuid4().hex}"
    for version in (0, 1):
        sharding.store(spark, path, version, np.arange(8) % 2, np.ones(8, int), np.ones(8, int))
    spark.createDataFrame([(2, 7, 0, 1, 1)], "version int, vslot int, shard int, bytes long, rows long").write.partitionBy("version").mode("append").parquet(path)
    assert {r["version"] for r in sharding.stored(spark, path).collect()} == {1}


def test_repeated_labels_teach_once(spark):
    """Ten thousand repeats of one label row leave the classes of the others in the sample."""
    docs = spark.createDataFrame([(i, ("good prose of many words " if i % 2 else "zzz qqq xxx junk ") * (3 + i % 4)) for i in range(40)], "doc_id long, text string")
    labels = [(i, i % 2) for i in range(40)]
    said = lambda rows: [r["score"] for r in quality.score(docs, quality.fit(docs, spark.createDataFrame(rows, "doc_id long, quality int")), [F.col("doc_id")]).orderBy("doc_id").collect()]
    once = said(labels)
    assert said(labels + [(3, 1)] * 10_000) == once and min(once[1::2]) > max(once[::2])
