"""Rows of an imported snapshot as candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.functions import text
from adlens.functions.text import compact
from adlens.sources.adapters import with_fields

#: What a seed row may hold besides its source; a column that is missing counts as null.
FIELDS = {n: "string" for n in ("job_title", "title", "job_url", "description_text", "closing_at", "closing_at_text", "location_text", "work_type", "advertised_salary_text", "advertised_salary_period")} | {"advertised_salary_min": "double", "advertised_salary_max": "double"}


def candidates(seed: DataFrame, described: bool = False) -> DataFrame:
    """Candidates out of seed rows (source_id, as ``files.seed_sources`` gives it, and FIELDS), those with a title and an address.

    The band comes from title, pay and description, pay that is missing from its text or the description; a row without either is
    unclassified, or description_only if it has one. With `described`, descriptions of 40 characters count as fetched.
    """
    given = {n: F.col(n) if n in seed.columns else F.lit(None) for n in FIELDS}
    told = seed.select("source_id", *[c.cast(FIELDS[n]).alias(n) for n, c in given.items()])
    some = lambda c: F.nullif(compact(F.col(c)), F.lit(""))
    rows = told.select(
        "source_id", F.coalesce(some("job_title"), compact(F.col("title"))).alias("title"), F.col("job_url").alias("url"), "location_text", "work_type", F.col("closing_at_text").alias("closing_text"), compact(F.col("description_text")).alias("description"),
        *[F.col(f"advertised_salary_{c}").alias(f"own_{c}") for c in ("text", "min", "max", "period")], F.coalesce("closing_at_text", F.lit("")).alias("closes"), F.coalesce("closing_at", F.lit("")).alias("closed"),
    )
    pay = F.coalesce("own_text", F.lit(""))
    found = with_fields(rows.where("title <> '' and url <> ''"), [F.col("title"), pay, F.col("description")], [pay, F.col("description")], [F.col("closes"), F.col("closed")])
    has = F.col("description") != ""
    full = F.lit(described) & (F.length("description") >= 40)
    kept = {f"advertised_salary_{c}": F.coalesce(F.nullif(F.col(f"own_{c}"), F.lit(0.0 if c in ("min", "max") else "")), F.col(f"advertised_salary_{c}")) for c in ("text", "min", "max", "period")}
    more = {
        "classification_status": F.when((F.col("classification_status") == "unclassified") & has, "description_only").otherwise(F.col("classification_status")),
        "description_excerpt": text.excerpt(F.col("description"), 300),
        "description_hash": F.when(has, text.stable_hash(F.col("description"), length=32)),
        "description_status": F.when(full, "fetched").when(has, "excerpt").otherwise("missing"),
    }
    return found.withColumns({**kept, **more}).drop("description", "closes", "closed", *[f"own_{c}" for c in ("text", "min", "max", "period")])
