"""Queries over the log carry what they need, and read it no more often than they must."""

import pytest
from pyspark.sql import functions as F

from adlens.operators import history
from adlens.plans import listings, texts

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(("query", "unread"), [
    (listings.peer_band_conflict, ("p_name", "l_returnflag", "o_orderstatus")), (listings.rss_top250, ("l_quantity", "l_returnflag")), (listings.status_precedence, ("n_name", "p_name", "p_size", "l_quantity")),
    (listings.run_summary, ("p_name", "p_size", "l_quantity")), (listings.snapshot_rebuild, ("n_name", "p_name", "l_quantity")), (texts.salary_axis, ("p_name", "p_size", "o_orderstatus")), (texts.salary_points, ("p_name", "p_size", "o_orderstatus")),
    (texts.board_gate, ("l_returnflag",)), (texts.board_summary, ("l_returnflag",)), (texts.board_validation, ("l_returnflag",)),
])
def test_narrow(spark, query, unread):
    # what only the scan names is not carried: pruned scans list columns once, in ReadSchema or Relation
    said = plan(query(spark, SF))
    carried = [line for line in said.splitlines() if "Relation" not in line]
    assert not [c for c in unread if any(f"{c}#" in line for line in carried)]


def test_lines_meet_orders_with_their_customers(spark):
    from adlens.plans import lens

    joins = [line for line in plan(lens.observations(spark, SF)).splitlines() if "Join" in line]
    # outermost first: nation, part, orders with lines, and customers with orders inside
    assert ["c_nationkey" in joins[0], "l_partkey" in joins[1], "l_orderkey" in joins[2], "o_custkey" in joins[3]] == [True] * 4


def test_read_often(spark):
    assert plan(listings.run_summary(spark, SF)).count("Join Inner, (l_orderkey#") == 2


def test_latest_with_maps_and_nulls(spark):
    rows = spark.createDataFrame([(1, "2026-01-01", 1, None, {"a": "x"}), (1, "2026-01-02", 1, 5, {"a": "y"}), (1, "2026-01-02", 2, None, {"a": "z"}), (2, None, 1, 7, None)], "job_id int, observed_at string, seq int, v int, m map<string,string>")
    for df in (rows, rows.drop("m")):
        got = {r["job_id"]: r.asDict() for r in history.latest(df, "seq", first=F.min("seq")).collect()}
        assert list(got[1]) == [*df.columns, "first_seen_at", "last_seen_at", "sighting_count", "first"]
        assert (got[1]["seq"], got[1]["v"], got[1]["first_seen_at"], got[1]["last_seen_at"], got[1]["sighting_count"], got[1]["first"]) == (2, None, "2026-01-01", "2026-01-02", 3, 1)
        assert (got[2]["v"], got[2]["last_seen_at"]) == (7, None)
    assert sorted(tuple(r)[:4] for r in history.dedupe(rows.withColumn("run_id", F.lit("r")), "seq").collect() if r[0] == 1) == [(1, "2026-01-01", 1, None), (1, "2026-01-02", 1, 5)]


def test_summary_without_log(spark):
    jobs = spark.createDataFrame([(1, "A", history.SEEN, 3), (2, "", history.NOT_SEEN, 4)], "job_id int, council_key string, observed_status string, sighting_count long")
    assert tuple(history.summary(jobs, None, jobs).first()) == (2, 1, 1, 1, 7, 2)
