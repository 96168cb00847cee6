"""The driver's tables seen as a log of listings, as candidates of strategies, and as profiles of sources.

The expressions are read by Spark and by the SQL oracle alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from adlens.session import findable

SEQ = ("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
#: Columns of a sighting that both dialects compute from the joined tables.
SIGHTING = {
    "job_id": "l_partkey",
    "source_id": "l_suppkey",
    "council_key": "n_name",
    "classification_status": "CASE o_orderstatus WHEN 'F' THEN 'explicit_band' WHEN 'O' THEN 'salary_only' ELSE '' END",
    "title": "p_name",
    "band": "CAST(p_size % 10 AS INT)",
    "salary_lo": "40000 + (p_partkey * 37) % 60000",
    "salary_hi": "40000 + (p_partkey * 37) % 60000 + CAST(l_quantity AS BIGINT) * 100",
    "period": "CASE l_returnflag WHEN 'A' THEN 'year' WHEN 'N' THEN 'hour' ELSE '' END",
} | {c: c for c in SEQ}
CANDIDATE = {
    "source_id": "l_suppkey",
    "strategy": "CASE l_linenumber WHEN 1 THEN 'known_endpoint' WHEN 2 THEN 'json_ld' WHEN 3 THEN 'discovered_endpoint' ELSE concat('platform:p', CAST(l_linenumber AS VARCHAR(9))) END",
    "strategy_index": "CAST(l_linenumber AS BIGINT)",
    "title": "CASE WHEN l_partkey % 19 = 0 THEN '' ELSE concat('Officer ', CAST(l_partkey % 40 AS VARCHAR(9))) END",
    "url": "concat('https://jobs.example/', CAST(l_partkey % 60 AS VARCHAR(9)))",
    "paid": "l_quantity > 6",
    "probable": "l_partkey % 5 <> 0",
    "has_band": "l_returnflag = 'A'",
    "has_salary": "l_partkey % 3 = 0",
    "has_description": "l_linestatus = 'O'",
    "has_closing": "l_orderkey % 2 = 0",
    "failed": "l_suppkey % 11 = 0 AND l_linenumber = 2",
    "l_orderkey": "l_orderkey",
    "l_extendedprice": "l_extendedprice",
}
PROFILE = {
    "source_id": "s_suppkey",
    "platform": "r_name",
    "preferred_strategy": "CASE s_suppkey % 3 WHEN 0 THEN 'json_ld' WHEN 1 THEN 'known_endpoint' ELSE '' END",
    "last_good_count": "s_suppkey % 9",
    "last_good_score": "(s_suppkey % 9) * 50",
}
#: Orders as sources, which have a few candidates each.
ORDER_CANDIDATE = CANDIDATE | {"source_id": "l_orderkey", "paid": "l_quantity > 3", "failed": "l_orderkey % 11 = 0 AND l_linenumber = 2", "has_document": "l_partkey % 4 = 0", "l_extendedprice": "l_extendedprice", "l_suppkey": "l_suppkey"}
ORDER_PROFILE = {
    "source_id": "o_orderkey",
    "platform": "o_orderpriority",
    "preferred_strategy": "CASE o_orderkey % 3 WHEN 0 THEN 'json_ld' WHEN 1 THEN 'known_endpoint' ELSE '' END",
    "last_good_count": "o_orderkey % 9",
    "last_good_score": "(o_orderkey % 9) * 50",
}
GLOBAL_RULE, SOURCE_RULE = "concat('officer ', CAST(n_nationkey AS VARCHAR(9)))", "concat('officer ', CAST(30 + s_suppkey % 10 AS VARCHAR(9)))"


def _sql(columns: dict[str, str], source: str, more: str = "") -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in columns.items()) + more + f" FROM {source}"


_JOINED = "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey"
_SUPPLIERS = "supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"
OBS_SQL = _sql(SIGHTING, _JOINED, ", strftime(o_orderdate, '%Y-%m-%d') AS observed_at, strftime(o_orderdate, '%Y%m') AS run_id")
CANDIDATES_SQL = _sql(CANDIDATE, "lineitem")
PROFILES_SQL = _sql(PROFILE, _SUPPLIERS)
ORDER_CANDIDATES_SQL = _sql(ORDER_CANDIDATE, "lineitem")
ORDER_PROFILES_SQL = _sql(ORDER_PROFILE, "orders")


def judged_sql(candidates: str, by_all: bool = True) -> str:
    """Candidates with their reason, by all rules or by the sources' own alone."""
    every = f"WHEN title <> '' AND lower(title) IN (SELECT {GLOBAL_RULE} FROM nation) THEN 'global_reject_title'" if by_all else ""
    return f"""SELECT c.*, CASE {every}
  WHEN title <> '' AND EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c.source_id AND {SOURCE_RULE} = lower(c.title)) THEN 'source_reject_title'
  WHEN NOT paid THEN 'missing_salary_or_band' WHEN NOT probable THEN 'weak_vacancy_signal' END AS reason FROM ({candidates}) c"""


JUDGED_SQL = judged_sql(CANDIDATES_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    findable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _selected(df: DataFrame, columns: dict[str, str], *more: str) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {n}" for n, e in columns.items()], *more)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    line, orders, customer, nation, part = (t(n) for n in ("lineitem", "orders", "customer", "nation", "part"))
    # orders find their customers before lines find their orders: lines, of which there are most, move by order and by part alone
    placed = orders.join(customer, orders.o_custkey == customer.c_custkey).select("o_orderkey", "o_orderstatus", "o_orderdate", "c_nationkey")
    joined = line.join(placed, line.l_orderkey == placed.o_orderkey).join(part, line.l_partkey == part.p_partkey).join(nation, placed.c_nationkey == nation.n_nationkey)
    return _selected(joined, SIGHTING, "date_format(o_orderdate, 'yyyy-MM-dd') AS observed_at", "date_format(o_orderdate, 'yyyyMM') AS run_id")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(table(spark, sf_dir, "lineitem"), CANDIDATE)


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (table(spark, sf_dir, x) for x in ("supplier", "nation", "region"))
    return _selected(s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey), PROFILE)


def order_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(table(spark, sf_dir, "lineitem"), ORDER_CANDIDATE)


def order_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(table(spark, sf_dir, "orders"), ORDER_PROFILE)


def global_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").selectExpr(f"{GLOBAL_RULE} AS title")


def source_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr("s_suppkey AS source_id", f"{SOURCE_RULE} AS title")
