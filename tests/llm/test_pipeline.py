"""The stages of the pipeline, each against what its operator says about its own input."""

import collections
import re

from pyspark.sql import functions as F

import corpus_pipeline
from adlens.llm import langid, mixing, queries

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in df.collect()]


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near_kept(rows):
    """The rows with the smallest id of each component, by comparing all pairs that share a shingle."""
    sets, by, root = [shingles(r[1]) for r in rows], collections.defaultdict(list), list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, x in enumerate(sets):
        for j in {j for s in x for j in by[s]}:
            if 5 * len(x & sets[j]) >= 4 * len(x | sets[j]):
                root[find(i)] = find(j)
        for s in x:
            by[s].append(i)
    least = {}
    for i, r in enumerate(rows):
        least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [r for i, r in enumerate(rows) if r[0] == least[find(i)]]


def clean_kept(rows, items):
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = collections.defaultdict(set)
    for _, t in items:
        w = word(t)
        for i in range(max(1, len(w) - 12)) if w else ():
            windows[len(w[i : i + 13])].add(tuple(w[i : i + 13]))
    out = []
    for r in rows:
        w, hit = word(r[1]), set()
        for n, of in windows.items():
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in of:
                    hit.update(range(i, i + n))
        if not (hit and 20 * len(hit) >= len(w)):
            out.append(r)
    return out


def test_stages(spark, tmp_path):
    """Each stage on all that its predecessor kept, against brute force (language ID against the operator, which has its own)."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = rows_of(docs)
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        assert i == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
        kept[name] = (before, rows_of(docs))
    count = collections.Counter

    before, after = kept["language ID"]
    said = {(r["doc_id"], r["text"]): r for r in langid.predict(spark.createDataFrame(before, "doc_id long, text string, lang string, source string"), langid.fit(spark.read.parquet(f"{SF}/documents.parquet")), [F.col("doc_id"), F.col("text")]).collect()}
    assert count(after) == count(r for r in before if said[r[0], r[1]]["lang_pred"] != "und" and said[r[0], r[1]]["score"] >= 0.5)
    before, after = kept["exact dedup"]
    last = {}
    for r in before:
        last[r[1]] = max(last.get(r[1], r[0]), r[0])
    assert count(after) == count(r for r in before if last[r[1]] == r[0]) and len(after) < len(before)
    before, after = kept["near dedup"]
    assert count(after) == count(near_kept(before)) and len(after) < len(before)
    before, after = kept["decontamination"]
    assert count(after) == count(clean_kept(before, [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()])) and len(after) < len(before)
    before, after = kept["mixing"]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    source = {i: s for i, _, _, s in before}
    want = mixing.mix(spark.createDataFrame(before, "doc_id long, text string, lang string, source string")).where("copies > 0").collect()
    got = docs.collect()  # of documents of one source and size, any may get the odd copy
    assert count((r["source"], size(r["text"]), r["copies"]) for r in got) == count((source[r["doc_id"]], r["size"], r["copies"]) for r in want)
    assert all(r["taken"] == r["copies"] * size(r["text"]) and 1 <= r["copies"] <= 3 for r in got) and {r["doc_id"] for r in got} <= set(source)



def test_names():
    found = queries.queries()
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in found if n != "pipeline"} == set(range(1, 11))
    assert set(queries.oracle_sql()) <= set(found)
