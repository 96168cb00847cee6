"""What outlives a run: published versions, the store of descriptions, counted sightings, and profiles as a stream's state."""

import random

import pytest
from pyspark.sql import functions as F

from adlens import sinks
from adlens.operators import strategy
from adlens.sinks import versions
from adlens.streaming import log, profiles

HISTORY = sinks.HISTORY


def test_readers_stay_on_the_version_before_a_run_that_ends_between_tables(spark, tmp_path):
    path, rows = str(tmp_path / "p"), lambda *v: spark.createDataFrame([(x,) for x in v], "x int")
    assert versions.newest(spark, path) is None and versions.current(spark, path, "a", "x int", "a.v1").count() == 0
    assert versions.publish({"a": (rows(1), "a.v1"), "b": (rows(2), "b.v1")}, path, "r1")

    class Killed(Exception):
        pass

    class Dies:
        sparkSession = spark

        @property
        def write(self):
            raise Killed

    with pytest.raises(Killed):
        versions.publish({"a": (rows(8), "a.v1"), "b": (Dies(), "b.v1")}, path, "r2")
    assert versions.newest(spark, path) == "r1"
    assert [r[0] for n in "ab" for r in versions.current(spark, path, n, "x int", f"{n}.v1").collect()] == [1, 2]
    # a manifest that lacks a table isn't whole
    spark.createDataFrame([("a", 2, "a.v1")], "name string, tables int, schema_version string").write.json(f"{path}/manifests/version=r3")
    assert versions.newest(spark, path) == "r1"
    assert versions.publish({"a": (rows(8), "a.v1"), "b": (rows(9), "b.v2")}, path, "r2")
    assert not versions.publish({"a": (rows(0), "a.v1")}, path, "r2")
    assert [r[0] for r in versions.current(spark, path, "a", "x int", "a.v1").collect()] == [8]
    assert versions.current(spark, path, "b", "x int", "b.v1").count() == 0 and versions.current(spark, path, "c", "x int", "c.v1").count() == 0


def test_state_survives_and_starts_anew_under_another_schema(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "state")
    none, rules = sinks.read_state(spark, path)
    assert none.count() == rules.count() == 0 and "quality_history" in none.columns
    rows = spark.createDataFrame([("s", "json_ld", 4, 90, "r1", 0, "ok", [("r1", "json_ld", 4, 90, "")])], sinks.PROFILE)
    assert sinks.write_state(rows, spark.createDataFrame([("home",)], "title string"), path, "r1")
    assert not sinks.write_state(rows, spark.createDataFrame([], "title string"), path, "r1")
    got, rules = sinks.read_state(spark, path)
    assert got.collect() == rows.collect() and [r[0] for r in rules.collect()] == ["home"]
    monkeypatch.setattr(sinks, "PROFILES", "source-profiles.v2")
    assert [df.count() for df in sinks.read_state(spark, path)] == [0, 0]


def test_a_second_insert_adds_none_and_reads_touched_shards(spark, tmp_path):
    path = str(tmp_path / "d")
    rows = spark.createDataFrame([("12" + "0" * 30, "one", 1), ("12" + "0" * 30, "again", 2), ("ab" + "1" * 30, "two", 3), (None, "no hash", 4)], "hash string, text string, seq int")
    assert sinks.insert_descriptions(rows, path, "seq") == 2 and sinks.insert_descriptions(rows.repartition(3), path, "seq") == 0
    assert sinks.insert_descriptions(spark.createDataFrame([("12" + "f" * 30, "three", 1), ("ab" + "1" * 30, "other", 1)], "hash string, text string, seq int"), path, "seq") == 1
    assert sorted(r["text"] for r in sinks.stored_descriptions(spark, path).collect()) == ["one", "three", "two"]
    plan = sinks.stored_descriptions(spark, path, ["12"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard" in plan and "= 12" in plan
    assert len(sinks.stored_descriptions(spark, path, ["12"]).inputFiles()) >= 1
    assert sinks.insert_descriptions(rows.limit(0), path, "seq") == 0


def test_every_sighting_counts_once(spark, tmp_path):
    schema = "job_id string, run_id string, observed_at string, title string, seq long"
    path = str(tmp_path / "s")
    keep = log.keep_snapshot(path, "seq")
    batch = lambda *rows: spark.createDataFrame(list(rows), schema)
    one, two = batch(("a", "r1", "d1", "t", 1), ("a", "r1", "d1", "replayed", 2), ("b", "r1", "d1", "t", 3)), batch(("a", "r2", "d2", "u", 4), ("b", "r1", "d1", "replayed", 5), ("b", "r0", "d0", "late", 6))
    told = lambda: {r["job_id"]: (r["title"], r["first_seen_at"], r["last_seen_at"], r["sighting_count"]) for r in log.snapshot(spark, path).collect()}
    assert log.snapshot(spark, path) is None
    keep(one, 0)
    assert told() == {"a": ("t", "d1", "d1", 1), "b": ("t", "d1", "d1", 1)}
    keep(two, 1)
    want = {"a": ("u", "d1", "d2", 2), "b": ("t", "d0", "d1", 2)}
    assert told() == want
    for epoch, rows in ((1, two), (0, one), (2, one), (3, two), (4, one.limit(0))):  # epochs again, and rows again in later ones
        keep(rows, epoch)
        assert told() == want
    # an epoch that ended before its manifest is worked out anew
    three = batch(("c", "r3", "d3", "v", 7))
    three.select("job_id", "observed_at", "run_id", F.lit("00").alias("shard")).write.partitionBy("shard").parquet(f"{path}/seen/epoch={5:012}")
    keep(three, 5)
    assert told() == want | {"c": ("v", "d3", "d3", 1)}


CANDIDATES = "observed_at string, run_id string, source_id string, strategy string, strategy_index long, title string, url string, paid boolean, probable boolean, has_band boolean, has_salary boolean, has_description boolean, has_closing boolean, failed boolean"


def runs_of(rng, runs):
    rows = []
    for k in range(runs):
        for source in "abcdef":
            for index, name in enumerate(["known_endpoint", "platform:p", "json_ld"]):
                for _ in range(rng.choice([0, 2, 6, 12, 60 if source == "a" else 3])):
                    rows.append((f"2026-01-{k + 1:02}", f"r{k}", source, name, index, f"Officer {rng.randrange(30)}", f"u{rng.randrange(20)}", rng.random() < (0.2 if k % 4 == 3 else 0.9), rng.random() < 0.9, rng.random() < 0.5, True, True, False, source == "b" and k % 3 == 1))
    return rows


def test_streamed_profiles_equal_batches(spark, tmp_path):
    """Three micro-batches with replays between them, the stream stopped and started again, against the batch fold of every run."""
    for k, v in profiles.CONF.items():
        spark.conf.set(k, v)
    runs, read = 15, strategy.READ_HISTORY
    rows = spark.createDataFrame(runs_of(random.Random(read), runs), CANDIDATES).cache()
    global_rules, source_rules = spark.createDataFrame([("officer 3",)], "title string"), spark.createDataFrame([("c", "officer 4")], "source_id string, title string")
    measures = profiles.measured(rows, global_rules, source_rules).cache()

    state = spark.createDataFrame([], sinks.PROFILE)
    want = {}
    for k in range(runs):
        now = rows.where(F.col("run_id") == f"r{k}")
        got = strategy.contest(now, state, global_rules, source_rules, f"r{k}", "title")
        health = {r["source_id"]: r for r in got.health.collect()}
        after = strategy.updated_profiles(state, got.health, f"r{k}").collect()
        state = spark.createDataFrame([tuple(r) for r in after], sinks.PROFILE)
        for r in after:
            if r["source_id"] in health:
                h = health[r["source_id"]]
                want[r["source_id"], f"r{k}"] = (h["strategy"], h["status"], h["fallback_used"], ",".join(f["code"] for f in h["drift_flags"]), r["preferred_strategy"], r["last_good_count"] or 0, r["last_good_score"] or 0, r["failure_streak"], len(r["quality_history"]))

    got, third = {}, runs // 3
    put = lambda df, epoch: got.update({(r["source_id"], r["run_id"], epoch): tuple(r) for r in df.collect()})
    for i in range(3):
        some = measures.where(F.substring("run_id", 2, 9).cast("int").between(i * third - 2, (i + 1) * third - 1 if i < 2 else runs))  # two runs come again
        some.coalesce(1).write.parquet(str(tmp_path / "in" / f"day={i}"))
        stream = spark.readStream.schema(measures.schema).parquet(str(tmp_path / "in" / "day=*"))
        profiles.followed(stream).writeStream.foreachBatch(put).option("checkpointLocation", str(tmp_path / "c")).outputMode("update").trigger(availableNow=True).start().awaitTermination()
    assert len(got) == len({k[:2] for k in got}) == len(want)  # no run came out twice
    streamed = {k[:2]: (r[2], r[3], r[4], r[6], r[7], r[8], r[9], r[10], r[11]) for k, r in got.items()}
    assert streamed == want
    assert max(v[-1] for v in want.values()) == read + 1
    assert {v[1] for v in want.values()} >= {"ok", "degraded"} and any(v[-2] > 1 for v in want.values())


def test_a_history_of_twenty(spark, tmp_path):
    """Read in full, a history keeps twenty entries, in batch and as a stream."""
    for k, v in profiles.CONF.items():
        spark.conf.set(k, v)
    rows = [(f"2026-01-{k + 1:02}", f"r{k:02}", "s", "json_ld", 0, *[5] * 2, 0, 0, 5, 5, 5, 300 + k, False, 300 + k, 5) for k in range(25)]
    schema = "observed_at string, run_id string, source_id string, strategy string, strategy_index long, " + ", ".join(f"{c} long" for c in profiles.COUNTS) + ", score long, failed boolean, own_score long, own_accepted long"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    got = []
    put = lambda df, epoch: got.extend(df.collect())
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    profiles.followed(stream, read=20).writeStream.foreachBatch(put).option("checkpointLocation", str(tmp_path / "c")).outputMode("update").trigger(availableNow=True).start().awaitTermination()
    assert [r["entries"] for r in sorted(got, key=lambda r: r["run_id"])] == [min(k + 1, 20) for k in range(25)] and {r["last_good_score"] for r in got} == set(range(300, 325))
    old = spark.createDataFrame([("s", "json_ld", 5, 300, "r", 0, "ok", [(f"r{k:02}", "json_ld", 5, 300, "") for k in range(20)])], sinks.PROFILE)
    health = spark.createDataFrame([("s", "json_ld", 5, 310, False, [])], "source_id string, strategy string, accepted_count long, score long, severe boolean, drift_flags array<struct<code:string,severity:string>>")
    kept = [h["run_id"] for h in strategy.updated_profiles(old, health, "new", read=20).first()["quality_history"]]
    assert kept == [*(f"r{k:02}" for k in range(1, 20)), "new"]
    assert len(strategy.updated_profiles(old, health, "new").first()["quality_history"]) == strategy.READ_HISTORY + 1
