"""Each text operator against a brute force on small tables, with nulls, empty and repeated rows, clashing columns and empty tables."""

import collections
import hashlib
import math
import os
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adlens.llm import components, decontam, exact_dedup, html_text, jaccard_join, langid, lm_score, mixing, quality, secrets, token_count

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, k string, key string, n int, c long, print string"
LOW = lambda s: re.sub("[A-Z]+", lambda m: m[0].lower(), s or "")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with odd rows and columns named like the operators' own."""
    rng = random.Random(3)
    words = ["the", "And", "über", "señor", "x", "plain", "long", "déjà", "vu", "a" * 40]
    base = " ".join(rng.choice(words) + str(i % 7) for i in range(120))
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60))), "en", "s1") for i in range(30)]
    rows += [(100 + i, base if i < 4 else base.replace("the", "teh", i - 3), "en" if i % 2 else "fr", "s2") for i in range(9)]
    rows += [(200, None, "en", None), (201, "", None, "s3"), (202, "   \n\t", "fr", "s3"), (203, "12345 !!", "fr", "s1"), (None, base, None, None), (None, "lost words", "en", "s1")]
    rows += [(204, base, "en", "s2"), (204, base, "en", "s2"), (205, "x " * 9000 + "end", "en", "s2"), (206, "x " * 9000 + "end", "en", "s2"), (207, "x " * 9000 + "enD", "en", "s2"), (208, "one two three", "en", "s1"), (209, "One two  three", "en", "s1")]
    return spark.createDataFrame([(*r, "1", "2", 3, 4, "5") for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def texts(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def test_exact_dedup(docs, none):
    got = collections.Counter(tuple(r) for r in exact_dedup.groups(docs, block=64).collect())
    groups = collections.defaultdict(list)
    for i, t in texts(docs):
        groups[t or ""].append(i)
    want = collections.Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        free = True
        for i in ids:
            want[i, keep, len(ids), i == keep and free, hashlib.sha256(t.encode()).hexdigest()] += 1
            free = free and i != keep
    assert got == want
    assert exact_dedup.groups(none).count() == 0
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups) and exact_dedup.keep_one(none).count() == 0


def shingles(text):
    w = WORD.findall(LOW(text))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min((x for x in (k, least.get(find(i))) if x is not None), default=None)
    return collections.Counter((k, len(sets[i]), least[find(i)]) for i, (k, _) in enumerate(rows))


def test_near_copies(docs, none):
    assert collections.Counter(tuple(r) for r in jaccard_join.near_copies(docs).collect()) == near(texts(docs))
    assert jaccard_join.near_copies(none).count() == 0
    assert jaccard_join.keep_one(none).count() == 0 and jaccard_join.keep_one(docs).columns == docs.columns


def test_near_copies_of_one_template(spark):
    """A large group of edited copies, in which most pairs are unlike, and texts with a common passage."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(100)]
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(100)] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    for i in range(150, 190):
        w = [f"u{rng.randrange(10**6)}" for _ in range(rng.randint(2, 60))]
        rows.append((i, " ".join(w[:10] + passage + w[10:])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert collections.Counter(tuple(r) for r in jaccard_join.near_copies(df).collect()) == near(rows)


def test_near_copies_send_little(docs, monkeypatch):
    """The driver gets a byte for each counter, and sends whole numbers alone to all tasks, whatever the keys are."""
    from adlens.llm import common

    rows = docs.select(F.col("doc_id").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    frame, got, sent, few = type(docs), [], set(), common.few

    def collect(self, f=frame.collect):
        out = f(self)
        got.append(sum(len(x) for r in out for x in r if isinstance(x, (bytes, bytearray))))
        return out

    def sending(df, *bounds):
        sent.update(kind for _, kind in df.dtypes)
        return few(df, *bounds)

    monkeypatch.setattr(frame, "collect", collect)
    levels = jaccard_join._levels(rows)
    assert 0 < max(got) <= len(levels)
    monkeypatch.undo()
    n = np.zeros(len(levels), np.int64)
    for x in jaccard_join.sets(pa.array([r["text"] for r in rows.collect()])):
        np.add.at(n, (x & np.uint64(len(levels) - 1)).astype(np.int64), 1)
    assert levels.tolist() == [int(min(4 * math.log2(max(x, 1)), 127)) for x in n.tolist()]
    monkeypatch.setattr(jaccard_join, "few", sending)
    monkeypatch.setattr(common, "few", sending)
    assert jaccard_join.keep_one(docs.withColumn("doc_id", F.concat(F.lit("key "), F.col("doc_id")))).count() > 0
    assert sent and sent <= {"int", "bigint"}


def test_near_copies_whose_marks_clash(spark, monkeypatch):
    """Marks find rows; where they don't tell rows apart, keys and texts do."""
    text = [" ".join(f"w{i}x{j}" for j in range(60)) for i in range(30)]
    rows = [(3 * i + k, text[i] + (f" more{k}" if k else "")) for i in range(30) for k in range(3 if i % 2 else 1)] + [(None, text[0]), (0, text[1]), (7, None), (8, ""), (9, text[1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = lambda: sorted((tuple(r) for r in jaccard_join.keep_one(df).collect()), key=str)
    want, groups = kept(), sorted((tuple(r) for r in jaccard_join.near_copies(df).collect()), key=str)
    assert 0 < len(want) < len(rows)
    monkeypatch.setattr(jaccard_join, "_mark", lambda key: F.xxhash64(key).bitwiseAND(1))
    assert kept() == want and sorted((tuple(r) for r in jaccard_join.near_copies(df).collect()), key=str) == groups


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (120, 5)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert set(got.values()) == {0} and len(got) == 70
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_decontamination(spark, docs, none):
    rows = texts(docs)
    items = [(1, rows[3][1] or "x"), (2, "One two three"), (3, None), (None, "the the"), (4, ""), (2, "one TWO three"), (5, "not there at all")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = collections.defaultdict(set)
    for i, t in items:
        w = word.findall(LOW(t))
        for k in range(max(1, len(w) - 12)) if w else ():
            windows[tuple(w[k : k + 13])].add(None if i is None else str(i))
    want = collections.Counter()
    for k, t in rows:
        w, hit, found = word.findall(LOW(t)), set(), set()
        for x, ids in windows.items():
            for s in range(len(w) - len(x) + 1):
                if tuple(w[s : s + len(x)]) == x:
                    hit.update(range(s, s + len(x)))
                    found |= ids
        found.discard(None)
        want[k, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)] += 1
    for size in (1_000_000, 20):
        assert collections.Counter(tuple(r) for r in decontam.contamination(docs, bench, block_words=size).collect()) == want
    assert decontam.contamination(none, bench).count() == 0
    assert {r["n_hit"] for r in decontam.contamination(docs, bench.limit(0)).collect()} == {0}
    stays = collections.Counter(r[0] for r in want.elements() if not r[-1])
    assert collections.Counter(r["doc_id"] for r in decontam.clean(docs, bench).collect()) == stays
    assert decontam.clean(docs, bench).columns == docs.columns and decontam.clean(docs, bench.limit(0)).count() == docs.count()


def test_proximity(spark):
    d = spark.createDataFrame([(1, "alpha big beta"), (2, "alpha beta"), (3, "alpha one two three beta")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    found = lambda slop: {r["key"] for m in decontam.matches(d, b, slop=slop) for r in m.collect() if r["found"]}
    assert found(0) == {2} and found(1) == {1, 2}


def test_language(spark, docs, none):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    got = langid.predict(d, langid.fit(d.where(~held)), [F.col("doc_id"), F.col("lang"), held.alias("h")]).where("h").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.9 * len(got)
    r = {x["doc_id"]: x for x in langid.predict(docs, langid.fit(docs), [F.col("doc_id")]).collect()}
    assert r[200]["lang_pred"] == r[201]["lang_pred"] == r[203]["lang_pred"] == "und" and r[0]["lang_pred"] in ("en", "fr") and 0 <= r[0]["score"] <= 1
    assert langid.predict(docs, langid.fit(none), [F.col("doc_id")]).where("lang_pred <> 'und'").count() == 0
    kept = langid.known(docs)
    assert kept.columns == docs.columns and kept.where("doc_id in (200, 201, 202, 203)").count() == 0 and langid.known(none).count() == 0


def test_quality(spark, docs, none):
    d, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = quality.fit(d, labels.where(~held))
    got = quality.score(d, model, [F.col("doc_id")]).join(labels, "doc_id").where(held).toPandas()
    rank, good = got["score"].rank().to_numpy(), (got["quality"] == 1).to_numpy()
    auc = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert auc > 0.9
    odd = quality.score(docs, model, [F.col("doc_id")]).collect()
    assert len(odd) == docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    empty = quality.fit(none, labels.limit(0))
    assert {r["score"] for r in quality.score(docs, empty, [F.col("doc_id")]).collect()} == {0.5}
    w = quality.dual_descent([np.array([0]), np.array([1])] * 20, np.array([1.0, -1.0] * 20), np.ones(2), np.ones(40))
    assert w[0] > w[1]


def test_mixing(docs, none):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    size = lambda t: len(WORD.findall(t or ""))
    total = collections.Counter()
    for _, t, s in rows:
        total[s] += size(t)
    order = sorted((s for s in total if s is not None)) + [None] * (None in total)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    full = set()
    while True:
        free = sum(weight[s] for s in order if s not in full)
        room = sum(total.values()) - 3 * sum(total[s] for s in full)
        new = {s for s in order if s not in full and weight[s] * room > 3 * total[s] * free}
        if not new:
            break
        full |= new
    want = {s: 3.0 * total[s] if s in full else weight[s] * room / free for s in order}
    got = mixing.mix(docs).collect()
    assert collections.Counter((r["doc_id"], r["size"]) for r in got) == collections.Counter((k, size(t)) for k, t, _ in rows)
    assert {(r["source_size"], round(r["target"], 6)) for r in got} == {(total[s], round(want[s], 6)) for s in order}
    assert all(0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"] for r in got)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(2)).collect()))
    assert mixing.mix(none).count() == 0 and mixing.mixed(none).count() == 0


def test_mix_comes_near_targets(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mix(d).groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert all(abs(r["taken"] - r["target"]) <= 0.02 * r["target"] for r in got)


def test_language_model(docs, none):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    held = lambda k: k is not None and zlib.crc32(str(k).encode()) % 7 == 2
    is_held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    tokens = [(k, [*WORD.findall(LOW(t)), None]) for k, t in rows]
    train = [t for k, t in tokens if not held(k)]
    one = collections.Counter(w for t in train for w in t)
    two = collections.Counter(p for t in train for p in zip([0, *t[:-1]], t, strict=True))
    n, v, follows = sum(one.values()), len(one), collections.Counter(w for _, w in two)
    lead, kinds = collections.Counter(), collections.Counter()
    for (a, _), c in two.items():
        lead[a] += c
        kinds[a, min(c, 3)] += 1
    d2 = lm_score.discounts([sum(c == i for c in two.values()) for i in (1, 2, 3, 4)])
    d1 = lm_score.discounts([sum(c == i for c in follows.values()) for i in (1, 2, 3, 4)])
    spare = sum(d1[min(c, 3)] for c in follows.values()) / len(two)

    def p(a, w):
        q = max(follows[w] - d1[min(follows[w], 3)], 0) / len(two) + spare / (v + 1)
        return (max(two[a, w] - d2[min(two[a, w], 3)], 0) + sum(d2[i] * kinds[a, i] for i in (1, 2, 3)) * q) / lead[a] if lead[a] else q

    assert sum(p(0, w) for w in one) + p(0, "never") == pytest.approx(1)
    got = lm_score.score(docs, lm_score.fit(docs.where(~is_held)), [F.col("doc_id")]).collect()
    want = sorted((str(k), len(t), sum(one[w] > 0 for w in t), n, round(sum(math.log10((one[w] + 1) / (n + v + 1)) for w in t), 5), round(sum(math.log10(p(a, w)) for a, w in zip([0, *t[:-1]], t, strict=True)), 5)) for k, t in tokens)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5), round(r["score"], 5)) for r in got) == want
    assert {(r["score"], r["n_known"]) for r in lm_score.score(docs.where("doc_id = 200"), lm_score.fit(none), [F.col("doc_id")]).collect()} == {(0.0, 0)}


def test_language_model_of_triples(docs, none):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    texts_ = [(k, [*WORD.findall(LOW(t)), None]) for k, t in rows]
    is_held = F.coalesce(F.col("doc_id") % 4 == 0, F.lit(False))
    grams = lambda t: list(zip([0, 0, *t[:-2]][: len(t)], [0, *t[:-1]], t, strict=True))
    three = collections.Counter(g for k, t in texts_ if k is None or k % 4 for g in grams(t))
    raw, two, one = collections.Counter(), collections.Counter(), collections.Counter()
    for (_, b, w), c in three.items():
        raw[b, w] += c
        two[b, w] += c if b == 0 else 1
    for _, w in two:
        one[w] += 1
    d3, d2, d1 = (lm_score.discounts([sum(c == i for c in x.values()) for i in (1, 2, 3, 4)]) for x in (three, two, one))
    sums = collections.defaultdict(list)
    for x in (three, two):
        for g, c in x.items():
            sums[g[:-1]].append(c)
    words, spare = len(one), sum(d1[min(c, 3)] for c in one.values()) / len(two)

    def p(a, b, w):
        q = max(one[w] - d1[min(one[w], 3)], 0) / len(two) + spare / (words + 1)
        for context, n, d in (((b,), two[b, w], d2), ((a, b), three[a, b, w], d3)):
            if s := sums.get(context):
                q = (max(n - d[min(n, 3)], 0) + sum(d[min(c, 3)] for c in s) * q) / sum(s)
        return q

    for a, b in [(0, 0), *list({g[:2] for g in three})[:5]]:
        assert sum(p(a, b, w) for w in one) + p(a, b, "never") == pytest.approx(1)
    n = sum(raw.values())
    got = lm_score.score(docs, lm_score.fit(docs.where(~is_held), order=3), [F.col("doc_id")]).collect()
    count = collections.Counter()
    for (_, w), c in raw.items():
        count[w] += c
    want = sorted((str(k), len(t), sum(count[w] > 0 for w in t), n, round(sum(math.log10((count[w] + 1) / (n + words + 1)) for w in t), 4), round(sum(math.log10(p(*g)) for g in grams(t)), 4)) for k, t in texts_)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4), round(r["score"], 4)) for r in got) == want
    assert {r["score"] for r in lm_score.score(docs.where("doc_id = 200"), lm_score.fit(none, order=3), [F.col("doc_id")]).collect()} == {0.0}


@pytest.mark.parametrize("order", [2, 3])
def test_language_model_of_frequent_words(docs, order):
    """Words that are spread over shards, and contexts whose sums are added up of these shards' parts, give the same scores."""
    some = docs.where("doc_id % 4 > 0")
    got = lambda model: sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["score"]) for r in lm_score.score(docs, model, [F.col("doc_id")]).collect())
    whole, spread = lm_score.fit(some, order=order), lm_score.fit(some, order=order, part=2)
    assert got(whole) == got(spread) and not whole.spread_shards and bool(spread.spread_shards) == (order == 3)


def test_language_model_files():
    """Counts and offsets beyond a byte and 16 bits, sums beyond the frequent ones, and differences come back."""
    rng = np.random.default_rng(1)
    n = np.concatenate([rng.integers(1, 600, 500), [2**40, 255, 254]])
    assert (lm_score.counts(lm_score._small("n", n), "n", np.arange(len(n))[::-1]) == n[::-1]).all()
    starts = np.cumsum(np.concatenate([[0], rng.integers(1, 9, 300), [5, 200_000, 1], rng.integers(1, 3000, 300)]))
    assert (lm_score.offsets(lm_score._offsets(starts), np.arange(len(starts))) == starts).all()
    sums = np.stack([rng.integers(1, 1 << 40, 900), *rng.integers(0, 40, (3, 900))])
    sums[:, ::2] = [[2], [2], [0], [0]]
    at = rng.permutation(900)
    assert (lm_score.context_sums(lm_score._contexts(np.zeros(900, np.int64), np.arange(900), sums, np.array([0])), at) == sums[:, at]).all()
    runs = rng.integers(1, 9, 200)
    heads = np.cumsum(runs) - runs
    x = np.concatenate([np.sort(rng.integers(0, lm_score.NEVER, k)) for k in runs])
    assert (lm_score._risen(lm_score.unpacked(lm_score.packed(lm_score._steps(x, heads))), runs) == x).all()


def test_language_model_takes_little_disk(spark):
    """What is shuffled and what is written stay within eight times the file, which is small: a quarter of its words differ."""
    folder = SF.replace("0.001", "0.01")
    sc = spark.sparkContext

    def shuffled():
        stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    at = shuffled()
    model = lm_score.fit(spark.read.parquet(f"{folder}/documents.parquet"), order=3)
    time.sleep(1)  # for the listener
    files = sum(os.path.getsize(os.path.join(model.folder, f)) for f in os.listdir(model.folder))
    assert 0 < shuffled() - at + files < 8 * os.path.getsize(f"{folder}/documents.parquet")


def test_secrets(spark, docs, none):
    key = "AKIA" + "B" * 16
    bare = "abcdEFGH/+" * 4
    rows = [
        (1, f'password = "hunter22" é token: abc secret=x'), (2, f"{key} then {bare} end"), (3, f"only {bare} here"), (4, "é" * 7 + "0123456789abcdef01234567"), (5, None), (6, ""), (6, ""),
        (7, f"{key} {'z ' * 400}{bare}"), (8, "user: somebody https://db.example/x " + bare), (9, "see https://db.example/x"), (10, "API_KEY==deadbeef00 api-key=abcdefg"), (None, f"{key}"),
    ]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, key string, h int")
    got = {r["doc_id"]: r for r in secrets.scan(df).select("doc_id", secrets.listed(F.col("base")).alias("base"), secrets.listed(F.col("linked")).alias("linked")).collect()}
    assign = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for k, t in rows:
        t = t or ""
        want = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(t) if len(m[2]) >= 6]
        want += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        want += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        assert got[k]["base"] == ",".join(f"{n}:{s}:{e}" for s, _, e, n in sorted(want)), k
    assert got[2]["linked"] == "bare40:26:66" and got[3]["linked"] == "" and got[7]["linked"] == ""
    assert "account" in got[8]["linked"] and "endpoint" in got[8]["linked"] and "bare40" in got[8]["linked"] and got[9]["linked"] == ""
    assert secrets.scan(none).count() == 0 and secrets.scan(docs).count() == docs.count()
    many = f"x token={'a' * 8} " * 1500
    spans = secrets.scan(spark.createDataFrame([(1, many)], "doc_id long, text string")).first()["base"]
    assert [(s["start"], s["end"]) for s in spans] == [m.span() for m in assign.finditer(many)] and len(spans) == 1500


def test_secret_scan_is_native(docs):
    plan = secrets.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_token_count(docs, none):
    tokenizers = pytest.importorskip("tokenizers")
    pieces = token_count.scores()
    latin = lambda b: "".join(chr(0x100 + c) for c in b)
    other = tokenizers.Tokenizer(tokenizers.models.Unigram([(latin(p), s) for p, s in pieces.items()], 0, False))
    import regex

    got = collections.Counter(tuple(r) for r in token_count.count(docs, [F.col("doc_id")]).collect())
    want = collections.Counter()
    for k, t in texts(docs):
        words = regex.findall(token_count.PATTERN, t or "")
        want[k, len(words), sum(len(other.encode(latin(w.encode())).tokens) for w in words)] += 1
    assert got == want and token_count.count(none, [F.col("doc_id")]).count() == 0
    trie, long = token_count.Trie(pieces, 20), "abcde" * 200
    assert trie.count(long) == trie.count(long) > 1


BOILER = "<html><head><title>t</title></head><body><div>Site name &amp; motto</div><div>Home</div>{}<div>Copyright 2020</div></body></html>"


def test_pages(spark):
    pages = [
        (1, "http://a.org/x/1", "<body><nav><a href='/'>Home</a></nav><article><h1>Head&nbsp;line</h1><p>One\n two<br>three<p>Four &lt;5&gt;</article><footer>End</footer>"),
        (2, "http://a.org/x/2", "<article><p>Same passage that both quote.</p><p>Own</p><div class='comments'><p>Nice!</p></div></article>"),
        (3, "http://a.org/x/3", "<article><p>Same passage that both quote.</p><p>Other</p></article><script>var a='<p>no</p>'</script>"),
        (4, None, None), (5, "http://b.org/", ""), (None, "::", "plain text &#233; only"), (6, "http://b.org/f", "<p>a<form>f</form><aside>s</aside><div class='cookie-notice'>c</div>b"),
        *[(10 + i, f"http://c.org/n/{i}.html", BOILER.format(f"<p>Story {i} of many</p><p>More about {i}, told at length</p><p>And an end {i}</p><p>Fin {i}</p>")) for i in range(5)],
    ]
    df = spark.createDataFrame([(*p, 1, "x") for p in pages], "page_id long, url string, html string, key int, text string")
    got = {r["page_id"]: r["text"] for r in html_text.extract(df).collect()}
    assert got[1] == "Head line\nOne two three\nFour <5>"
    assert got[2] == "Same passage that both quote.\nOwn" and got[3] == "Same passage that both quote.\nOther"
    assert got[4] == got[5] == "" and got[None] == "plain text é only" and got[6] == "a\nb"
    for i in range(5):
        assert got[10 + i] == f"Story {i} of many\nMore about {i}, told at length\nAnd an end {i}\nFin {i}"
    assert html_text.extract(df.limit(0)).count() == 0


def test_pages_lines_at_fixed_places_of_articles(spark):
    """Notices in plain elements of marked articles go, passages that articles quote stay."""
    quote = "<p>Same passage that many quote.</p>"
    page = "<body><main><div>Site motto</div><h1>Title {0}</h1><div>Read our guide</div>" + "{1}" + "<div>All rights</div></main></body>"
    body = lambda i: "".join(f"<p>Own {i} {k}</p>" for k in range(i % 4 + 1)) + quote + f"<p>End {i}</p>" * (i % 3 + 1)
    rows = [(i, f"http://d.org/n/{i}", page.format(i, body(i))) for i in range(30)]
    rows += [(100 + i, f"http://e.org/n/{i}", page.format(i, body(i))) for i in range(html_text.SURE)]
    rows += [(200 + i, f"http://f.org/n/{i}", page.format(0, body(0))) for i in range(30)]  # one page, 30 times
    got = {r["page_id"]: r["text"].split("\n") for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k, _, html in rows:
        want = html_text.lines(html)[0]
        assert got[k] == (want if k >= 100 else [x for x in want if x not in ("Site motto", "Read our guide", "All rights")]), k


def test_pages_with_fewer_own_lines_than_shared_ones(spark):
    """Short stories under much boilerplate lose it, also beside copies; edited copies take no lines from each other."""
    rng = random.Random(7)
    say = lambda n=30: " ".join(rng.choice("abcdefghij") + str(rng.randrange(400)) for _ in range(n))
    page = "<body><div>Motto</div><div>Home</div><div>Guide</div>{}<div>Contact</div><div>Copyright</div></body>"
    texts = [[say(), say()] for _ in range(6)]
    rows = [(i, f"http://g.org/n/{i}", page.format("".join(f"<p>{x}</p>" for x in t))) for i, t in enumerate(texts)]
    rows += [(100 + i, f"http://g.org/n/2-{i}", rows[2][2]) for i in range(9)]  # copies at neighbouring URLs
    want = {k: "\n".join(texts[2 if k >= 100 else k]) for k, _, _ in rows}
    long = [say() for _ in range(8)]
    for i in range(5):  # one text with a word changed in one line each
        own = [f"{x} edit{i}" if j == i else x for j, x in enumerate(long)]
        rows.append((200 + i, f"http://h.org/n/{i}", "".join(f"<p>{x}</p>" for x in own)))
        want[200 + i] = "\n".join(own)
    got = {r["page_id"]: r["text"] for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert got == want


def test_pages_keep_their_main_text():
    """Names that tell the layout, forms around a page, unclosed quotes and elements: the main text stays."""
    for page, want in [
        ('<article class="post hentry comments-open"><p>Text</p></article>', ["Text"]),
        ('<article class="no-share"><p>Text</p></article>', ["Text"]),
        ('<div class="content has-sidebar"><p>Text</p></div>', ["Text"]),
        ('<div class="side-by-side"><p>Text</p></div>', ["Text"]),
        ("<body><form><h1>Head</h1><p>Text <input><label>Name</label></p><button>Go</button></form>", ["Head", "Text"]),
        ('<p><a href="x>link</a> more <b class="y">bold</b></p>', ["link more bold"]),
        ("<a href='x>link", ["link"]),
        ('<a title="a > b" href=x>link</a><p title="a<b>c">Text</p>', ["link", "Text"]),
        ("<nav><ul><li>Menu<article><p>Text</p></article>", ["Text"]),
        ('<div class="widget"><article><p>Text</p></article></div><div class="ad-slot">Buy</div>', ["Text"]),
        ('<article><p>Text</p><div class="ad">Buy</div><div class="comment-list"><article>Nice</article></div></article>', ["Text"]),
        ('<article></article><div class="ad">Buy</div>', []),
        ('<div class="ad">Buy this</div><p>Text</p><div class="sidebar-left">More</div><div id="cookie-notice">Cookies</div>', ["Text"]),
        ("a < b &amp;&lt;p&gt; &#x41;<![CDATA[ c ]]>", ["a < b &<p> A c"]),
    ]:
        assert html_text.lines(page)[0] == want, page
    deep = "<div>" * 20_000 + "</span>" * 20_000 + "x"
    assert html_text.lines(deep)[0] == ["x"]


def common(a, b):
    """Places of a longest common subsequence by the whole table, later places first."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best


def test_differencing_decides(spark):
    """Pages with plain boilerplate, in and out of articles, held against their known texts and a brute-force differ."""
    rng = random.Random(11)
    say = lambda n=12: " ".join(rng.choice("klmnopqrst") + str(rng.randrange(10**6)) for _ in range(n))
    quote, rows, want = say(40), [], {}
    for host, (a, z) in {"i.org": ("<body><div>Motto</div><div>Home</div>", "<div>Contact</div></body>"), "j.org": ("<article><div>Motto</div>", "<div>Contact</div></article>")}.items():
        for i in range(25):
            own = [say() for _ in range(rng.randint(2, 9))] + [quote] * (i % 5 == 0)
            rng.shuffle(own)
            rows.append((len(rows), f"https://{host}/p/{i:02}?x={i}", a + "".join(f"<p>{x}</p>" for x in own) + z))
            want[len(rows) - 1] = own
    rows.append((len(rows), "https://k.org/alone", rows[0][2]))
    want[len(rows) - 1] = ["Motto", "Home", *want[0], "Contact"]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    on, off = ({r["page_id"]: r["text"].split("\n") for r in html_text.extract(df, reach=k).collect()} for k in (html_text.REACH, 0))
    assert on == want
    assert sum(on[k] != off[k] for k in want) == 50

    for first in (0, 25):  # every page against its neighbours, by the whole table
        mine = [(html_text.lines(rows[i][2])) for i in range(first, first + 25)]
        for i, (own, marked, _) in enumerate(mine):
            near = sorted((j for j in range(25) if j != i), key=lambda j: (abs(i - j), j))[: html_text.REACH if marked else html_text.VOTERS]
            votes = collections.Counter()
            for j in near:
                other = mine[j][0]
                best, x, y = common(own, other), len(own), len(other)
                while x and y:
                    if own[x - 1] == other[y - 1]:
                        x, y = x - 1, y - 1
                        votes[x] += not marked or x == y or max(x, y) < html_text.EDGE or len(own) - x == len(other) - y or max(len(own) - x, len(other) - y) <= html_text.EDGE
                    elif best[x - 1][y] >= best[x][y - 1]:
                        x -= 1
                    else:
                        y -= 1
            gone = {k for k, n in votes.items() if (8 * n >= 7 * len(near) if marked else 4 * n >= 3 * len(near))}
            assert on[first + i] == [x for k, x in enumerate(own) if k not in gone]


def test_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randrange(rng.choice((2, 5))) for _ in range(rng.randrange(40))] for _ in range(2))
        got = html_text.shared(a, b)
        assert len(got) == common(a, b)[-1][-1] and all(a[i] == b[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:], strict=False))
    assert len(html_text.shared([1, 2] * 4000, [2, 1] * 4000)) == 7999


def test_odd_pages(spark):
    """Bytes that aren't UTF-8, columns named like the operator's own, pages without lines, repeated rows."""
    df = spark.createDataFrame([(1, "http://l.org/a", "<p>x</p>", "k", 1), (1, "http://l.org/a", "<p>x</p>", "k", 1), (2, "http://l.org/b", "", "k", 1)], "page_id long, url string, html string, host string, rank int")
    df = df.withColumn("html", F.expr("CASE WHEN page_id = 1 THEN cast(concat(cast(html as binary), X'80FF', cast('y' as binary)) as string) ELSE html END"))
    assert sorted(tuple(r) for r in html_text.extract(df).collect()) == [(1, "http://l.org/a", "x\n\ufffd\ufffdy"), (1, "http://l.org/a", "x\n\ufffd\ufffdy"), (2, "http://l.org/b", "")]


def test_stages_with_clashing_names_nulls_and_repeats(spark):
    """Columns named like the operators' own pass through every stage's operator, nulls and repeated rows have defined results."""
    rows = [(1, "one two three four five six", "en", "a"), (1, "one two three four five six", "en", "a"), (1, "one two three four five six", "en", "a"), (2, "One two three four five six", "en", "a"), (3, None, "en", None), (None, "x y z", None, "a"), (None, "x y z", None, "b"), (4, "", "en", "b")]
    extra = {"copies": "c", "taken": "t", "gone_0": "g", "gone_1": "h", "sha_": "s", "key_": "k", "print_": "p", "key": "q", "own": "o", "nth": "n", "rank": "r", "text_": "u", "m_": "m"}
    df = spark.createDataFrame([(*r, *extra.values()) for r in rows], "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} string" for n in extra))
    bench = spark.createDataFrame([(9, "one two three four five six", "k")], "item_id long, text string, key string")
    ids = lambda x: sorted((r["doc_id"] or 0 for r in x.collect()))
    same = lambda x: x.columns == df.columns and x.select(*extra).distinct().collect() == [tuple(extra.values())]
    for out, want in [(exact_dedup.keep_one(df), [0, 1, 2, 4]), (jaccard_join.keep_one(df), [0, 1, 3, 4]), (decontam.clean(df, bench), [0, 0, 3, 4])]:
        assert ids(out) == want
        assert same(out)
    known = langid.known(df)
    assert same(known) and 3 not in ids(known) and 4 not in ids(known)
    mixed = mixing.mixed(df)
    assert mixed.columns == [*df.columns, "copies_", "taken_"]
    rates = {(r["doc_id"], r["size"]): 0 for r in mixing.mix(df).collect()}
    for r in mixing.mix(df).collect():
        rates[r["doc_id"], r["size"]] += r["copies"]
    got = collections.Counter()
    for r in mixed.collect():
        got[r["doc_id"], len((r["text"] or "").split())] += r["copies_"]
        assert r["taken_"] == r["copies_"] * len((r["text"] or "").split())
    assert got == collections.Counter({k: v for k, v in rates.items() if v})


def test_mix_of_repeated_rows(spark):
    """Very many rows alike: each is a document, they are rounded together and no copy is lost."""
    df = spark.createDataFrame([(None, "a b c", "s")] * 5000 + [(i, "d " * (i % 40), "t") for i in range(3000)], "doc_id long, text string, source string").repartition(4)
    got = mixing.mix(df).toPandas()
    assert len(got) == 8000 and got["copies"].between(0, 3).all()
    for _, g in got.groupby("source_size"):
        assert abs(g["taken"].sum() - g["target"].iloc[0]) <= 40
    taken = mixing.mixed(df).groupBy("source").agg(F.sum("taken").alias("n")).collect()
    assert sorted(r["n"] for r in taken) == sorted(got.groupby("source_size")["taken"].sum().tolist())


def test_mix_by_brute_force(spark):
    """Tilts by bisection in plain floats; copies are one of the two whole numbers at a rate, and add up to the target."""
    rng = random.Random(9)
    rows = [(i, " ".join(["w"] * rng.randint(1, 400)), f"s{i % 4}" if i % 9 else "big") for i in range(1200)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).toPandas()
    for (size, target), g in got.groupby(["source_size", "target"]):
        if target >= 3 * size:
            assert (g["copies"] == 3).all()
            continue
        mean = size / len(g)
        words = lambda t: sum(n * min(3.0, math.exp(min(t * n / mean, 2))) for n in g["size"])
        low, high = -50.0, 50.0
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if words(mid) < target else (low, mid)
        rate = np.array([min(3.0, math.exp(min(low * n / mean, 2))) for n in g["size"]])
        assert np.abs(rate - g["rate"].to_numpy()).max() < 1e-5
        assert (np.abs(g["copies"].to_numpy() - rate) <= 1 + 1e-9).all()
        assert abs(g["taken"].sum() - target) <= max(g["size"].max(), 0.01 * target)


def fold(text):
    """Letters folded up to U+05FF, all else a blank, as language ID reads a text."""
    out = []
    for c in text:
        low = c.lower()
        out.append((low if ord(c) < 0x600 and len(low) == 1 else c) if c.isalpha() else " ")
    return "".join(out)


def test_language_by_brute_force(spark, docs, monkeypatch):
    """Counts and posteriors from plain dictionaries, with all languages at once and two at a time."""
    from adlens.llm import chars

    rng = random.Random(4)
    rows = [(i, " ".join("".join(rng.choice("abcdeéü"[k : k + 4]) for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(0, 9))) + rng.choice(["", " 12", "\t"]), f"l{k}") for i in range(60) for k in [i % 4]]
    df = spark.createDataFrame([*rows, (99, None, "l1"), (98, "abc", None)], "doc_id long, text string, lang string")

    def grams(text):
        p = np.array([ord(c) for c in fold(text)], np.uint32)
        for n in langid.SIZES:
            for i in range(len(p) - n + 1):
                if not all(p[i : i + n] == 0x20):
                    yield int(chars.buckets(p[i : i + n], np.array([0, n]), n)[0])

    counts, number = collections.defaultdict(collections.Counter), collections.Counter()
    for _, t, k in rows:
        if any(c.isalpha() for c in t):
            number[k] += 1
            counts[k].update(grams(t))
    model = langid.fit(df)
    assert model.languages == sorted(number)
    for most in (langid.LANGUAGES, 2, 1):
        got = {r["doc_id"]: r for r in langid.predict(df, model, [F.col("doc_id")], most=most).collect()}
        assert len(got) == 62
        for i, t, _ in [*rows, (98, "abc", None)]:
            if not any(c.isalpha() for c in t):
                assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0)
                continue
            logs = {k: math.log(number[k] / sum(number.values())) + sum(math.log((counts[k][g] + 1) / (sum(counts[k].values()) + chars.NONE)) for g in grams(t)) for k in number}
            best = max(sorted(logs), key=logs.get)
            share = 1 / sum(math.exp(v - logs[best]) for v in logs.values())
            assert got[i]["lang_pred"] == best or abs(logs[best] - logs[got[i]["lang_pred"]]) < 1e-3
            assert got[i]["score"] == pytest.approx(share, abs=1e-3)
        assert got[99]["lang_pred"] == "und"


def test_bad_bytes(spark):
    """Bytes that aren't UTF-8 shift nothing: neighbours' results stay as they are."""
    df = spark.createDataFrame([(i, t, "en" if i % 2 else "fr") for i, t in enumerate(["plain words here", "BAD", "des mots simples", "other plain words"])], "doc_id long, text string, lang string")
    bad = df.withColumn("text", F.expr("CASE WHEN text = 'BAD' THEN cast(concat(X'FFC3', cast('a é b' as binary), X'E282') as string) ELSE text END")).coalesce(1)
    good = df.where("text <> 'BAD'")
    model = langid.fit(good)
    for f in (lambda d: langid.predict(d, model, [F.col("doc_id")]), lambda d: token_count.count(d, [F.col("doc_id")]), lambda d: quality.score(d, quality.Model(np.arange(quality.WIDTH, dtype=np.float32) % 7, 0.0, 0.01, 0.0), [F.col("doc_id")])):
        rest = sorted(tuple(r) for r in f(bad).collect() if r["doc_id"] != 1)
        assert rest == sorted(tuple(r) for r in f(good).collect()) and f(bad).count() == 4


def test_quality_by_brute_force(spark):
    """Log-count ratios from plain counts, the dual's solution against a fine projected descent, and scores."""
    x = [np.array(sorted(random.Random(i).sample(range(12), 4))) for i in range(40)]
    y = np.array([1.0 if 0 in v or 1 in v else -1.0 for v in x])
    ratio, cost = np.linspace(-1, 1, 12) + 0.05, np.full(40, 0.1)
    w = quality.dual_descent(x, y, ratio, cost, epochs=400)
    z = np.zeros((40, 13))
    for i, v in enumerate(x):
        z[i, v], z[i, 12] = ratio[v], 1
    q, a = (z * y[:, None]) @ (z * y[:, None]).T, np.zeros(40)
    for _ in range(100_000):
        a = np.clip(a - (q @ a - 1) / np.linalg.norm(q, 2), 0, cost)
    assert np.abs(w - (a * y) @ z).max() < 1e-3

    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["good", "fine", "text"] if i % 2 else ["junk", "spam", "zz"]) for _ in range(20))) for i in range(40)]
    df, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, i % 2, "x") for i in range(40)], "doc_id long, quality int, text string")
    model = quality.fit(df.union(df).union(df), labels)  # repeated documents don't count again
    assert (model.weights == quality.fit(df, labels).weights).all()
    once = {r["doc_id"]: r["score"] for r in quality.score(df, model, [F.col("doc_id")]).collect()}
    from adlens.llm import chars
    for i, t in rows[:6]:
        p = np.array([ord(c) for c in t], np.uint32)
        seen = {int(b) for n in quality.SIZES for b in chars.buckets(p, np.array([0, len(p)]), n) if b != chars.NONE}
        words = t.split()
        if any(words[k] == words[k + 1] == words[k + 2] for k in range(len(words) - 2)):
            seen.add(quality.AGAIN)
        margin = sum(float(model.weights[b]) for b in seen) + model.bias
        assert once[i] == pytest.approx(1 / (1 + math.exp(-(model.slope * margin + model.offset))), abs=1e-4)
    assert min(once[i] for i in range(1, 40, 2)) > max(once[i] for i in range(0, 40, 2))
