"""Duplicates in rounds against one row after another."""

import random
import re

import pytest
from pyspark.sql import functions as F

from adlens.functions.text import TITLE_STOP_WORDS
from adlens.operators import components, dedupe, greedy

TEXTS = "location_text work_type closing_at closing_at_text description_text classification_status classification_band observed_status advertised_salary_period advertised_salary_text".split()
SCHEMA = "council_key string, job_title string, job_url string, standard_band_number int, seq long, advertised_salary_min double, advertised_salary_max double, " + ", ".join(f"{c} string" for c in TEXTS)
MIRRORS = ("councildirect.com.au", "au.jora.com", "jora.com")


def one_by_one(rows, same):
    """(place, holder) of rows (row, score) that come one after another."""
    places = []
    for row, score in rows:
        for p in places:
            if same(row, p[1]):
                if score > p[2]:
                    p[1:] = row, score
                break
        else:
            places.append([row, row, score])
    return sorted((p, h) for p, h, _ in places)


@pytest.mark.parametrize("seed", range(4))
def test_rounds_settle_what_order_settles(spark, seed):
    rng = random.Random(seed)
    n, k = ((20, 5), (40, 20), (60, 100), (30, 4))[seed]
    rows = [(i, rng.randint(0, 5)) for i in rng.sample(range(1000), n)]
    cells = sorted({(r, rng.randrange(k)) for r, _ in rows for _ in range(rng.randint(0, 3))})
    adjacent = sorted({(i, i) for i in range(k) if rng.random() < 0.8} | {(rng.randrange(k), rng.randrange(k)) for _ in range(k // 3)})
    of = {}
    for r, c in cells:
        of.setdefault(r, []).append(c)
    pairs = set(adjacent)
    want = one_by_one(sorted(rows), lambda a, b: any((x, y) in pairs for x in of.get(a, []) for y in of.get(b, [])))
    got = greedy.chosen(spark.createDataFrame(rows, "row long, score int").repartition(3), spark.createDataFrame(cells, "row long, cell long"), spark.createDataFrame(adjacent, "incoming long, holder long"))
    assert sorted(map(tuple, got.collect())) == want


def test_a_hundred_thousand_rows_that_are_all_the_same(spark):
    rows = spark.range(100_000).select(F.col("id").alias("row"), (F.col("id") * 7919 % 100_003 % 60).cast("int").alias("score"))
    got = greedy.chosen(rows, rows.select("row", F.lit(1).cast("long").alias("cell")), spark.createDataFrame([(1, 1)], "incoming long, holder long")).collect()
    scores = [i * 7919 % 100_003 % 60 for i in range(100_000)]
    assert [tuple(r) for r in got] == [(0, scores.index(max(scores)))]


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(200, 300)] + [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(900, 900)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        parent[b] = a
    got = {r["node"]: r["group"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in parent}


def in_order(rows):
    """seq of the rows that stay, by the rules, for board rows (dicts) in order."""
    text = lambda v: " ".join(str(v or "").split()).lower()
    for r in rows:
        r["words"] = set(re.sub("[^a-z0-9]+", " ", r["job_title"].lower()).split()) - set(TITLE_STOP_WORDS)
        r["path"] = re.sub("^https?://(www[.])?", "", r["job_url"]).lower()
        r["host"] = r["path"].split("/")[0]
        r["mirror"] = r["host"] in MIRRORS or r["host"].endswith(("indeed.com", "seek.com.au"))
        r["council"] = (r["council_key"] or "").upper()
        pay = f"{r['advertised_salary_min']:.0f}" if r["advertised_salary_min"] is not None else ""
        r["details"] = [text(r["work_type"]), text(r["location_text"]), text(r["closing_at"]), text(r["closing_at_text"]), pay]
        told = r["standard_band_number"] is not None or any(r["details"][i] for i in (0, 2, 3, 4))
        r["soft"], r["hard"] = not told, told or bool(r["details"][1])
        official = r["host"].endswith(".vic.gov.au")
        r["score"] = 40 * (r["standard_band_number"] is not None) + 20 * bool(pay) + 10 * bool(text(r["description_text"])) + 3 * official - 20 * r["host"].endswith(("jora.com", "indeed.com", "seek.com.au"))

    def alike(a, b):
        return bool(a["words"] and b["words"]) and 5 * len(a["words"] & b["words"]) >= 4 * min(len(a["words"]), len(b["words"]))

    def same(a, b):
        if a["council"] != b["council"] or not alike(a, b):
            return False
        if a["path"] == b["path"]:
            return True
        detail = any(x and x == y for x, y in zip(a["details"], b["details"], strict=True))
        if a["host"] and a["host"] == b["host"] and detail:
            return True
        if not (a["mirror"] or b["mirror"]):
            return False
        mirror, other = (a, b) if a["mirror"] else (b, a)
        return detail or mirror["soft"] and other["hard"]

    exact = {}
    for r in rows:
        key = (r["council"], re.sub("[^a-z0-9]+", " ", r["job_title"].lower()).strip(), r["path"], r["details"][0], r["details"][1], r["details"][2] or r["details"][3], r["details"][4])
        if key not in exact or r["score"] > exact[key]["score"]:
            exact[key] = r
    by_seq = {r["seq"]: r for r in rows}
    pages = {}
    for r in exact.values():
        pages.setdefault((r["council"], r["path"]), []).append(r)
    second = [by_seq[h] for page in pages.values() for _, h in one_by_one_in(page, alike)]
    return {h for _, h in one_by_one_in(second, same)}


def one_by_one_in(rows, same):
    by_seq = {r["seq"]: r for r in rows}
    holder = dict(one_by_one([(r["seq"], r["score"]) for r in rows], lambda a, b: same(by_seq[a], by_seq[b])))
    return [(r["seq"], holder[r["seq"]]) for r in rows if r["seq"] in holder]


@pytest.mark.parametrize("seed", range(2))
def test_dedupe_is_what_order_gives(spark, seed):
    rng = random.Random(20 + seed)
    rows = []
    for i in range((40, 110)[seed]):
        host = rng.choice(["c.vic.gov.au", "au.jora.com", "d.vic.gov.au", "www.seek.com.au", "councildirect.com.au"])
        title = " ".join(rng.sample("parks lead civil works health nurse senior June of".split(), rng.randint(0 if i % 50 == 0 else 1, 6)))
        more = {c: "" for c in TEXTS} | {"work_type": rng.choice(["", "", "full", "part"]), "location_text": rng.choice(["", "", "North", "South"]), "closing_at": rng.choice(["", "", "2026-01-01"]), "description_text": rng.choice(["", "text"])}
        pay = rng.choice([None, None, 50000.0, 60000.0])
        rows.append((rng.choice(["C", "D", None]), title, f"https://{host}/jobs/{rng.randrange(12)}", rng.choice([None, None, 5]), 3 * i, pay, pay, *[more[c] for c in TEXTS]))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    want = in_order([dict(zip(names, r, strict=True)) for r in rows])
    got = dedupe.dedupe(df, "seq")
    assert got.columns == names and {r["seq"] for r in got.select("seq").collect()} == want and 0 < len(want) < len(rows)


def test_long_titles_take_rows_a_word(spark):
    """Cells and pairs grow with words, not with subsets of them."""
    rows = spark.createDataFrame([(i, [f"w{j}" for j in range(i, i + 80)], False, True, False, ["p"]) for i in range(30)], "row long, words_ array<string>, mirror_ boolean, soft_ boolean, hard_ boolean, aspects_ array<string>")
    cells, adjacent = dedupe._cells(rows)
    want = {(a, b) for a in range(30) for b in range(30) if abs(a - b) <= 16}
    names = {r["cell"]: r["row"] for r in cells.collect()}
    assert {(names[r["incoming"]], names[r["holder"]]) for r in adjacent.collect()} == want and cells.count() == 30


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([], SCHEMA)
    plan = dedupe.dedupe(df, "seq")._jdf.queryExecution().toString()
    assert "Pandas" not in plan and "Python" not in plan and dedupe.dedupe(df, "seq").count() == 0


def test_rounds_hand_on_no_conclusions(spark):
    # each row is better than the one before and like it alone: one more change of the same place a row
    rows = spark.range(7).selectExpr("id AS row", "id AS score")
    cells = spark.range(7).selectExpr("id AS row", "id AS cell")
    adjacent = spark.range(7).selectExpr("id AS incoming", "explode(array(id - 1, id, id + 1)) AS holder").where("holder BETWEEN 0 AND 6")
    out = greedy.chosen(rows, cells, adjacent)
    assert [tuple(r) for r in out.collect()] == [(0, 6)]
    # what a checkpoint hands on lies in the plan's LogicalRDD; files have none
    assert "LogicalRDD" not in out._jdf.queryExecution().optimizedPlan().toString()
