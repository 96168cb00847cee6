"""Search, facets and charts over a board."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions import dates, money, text
from adlens.operators import dedupe


@dataclass(frozen=True)
class State:
    """What an explorer has chosen; None leaves a filter out."""

    query: str = ""
    band: int | None = None
    council: str | None = None
    range: str | None = None  # month or quarter
    reference: str | None = None  # a date, yyyy-MM-dd
    paid: bool = False
    banded: bool = False
    current: bool = False


def search_text(*columns: str) -> Column:
    return F.lower(F.concat_ws(" ", *[text.compact(F.col(c)) for c in columns]))


def has_tokens(hay: Column, query: str) -> Column:
    """Whether all words of the query occur."""
    out = F.lit(True)
    for word in query.lower().split():
        out = out & F.contains(hay, F.lit(word))
    return out


def searched(jobs: DataFrame, state: State) -> DataFrame:
    """jobs (search_text, job_date, band, paid, current) after all filters but the council's, all pushed down as one predicate."""
    out = jobs.where(F.contains("search_text", F.lit(state.query.lower().strip()))) if state.query.strip() else jobs
    if state.range and state.reference:
        out = out.where(F.col("job_date") >= dates.range_start(F.to_date(F.lit(state.reference)), state.range))
    if state.band is not None:
        out = out.where(F.col("band") == state.band)
    for chosen, c in ((state.paid, F.col("paid")), (state.banded, F.col("band").isNotNull()), (state.current, F.col("current"))):
        out = out.where(c) if chosen else out
    return out


def by_council(jobs: DataFrame, state: State) -> DataFrame:
    return searched(jobs, state).groupBy("council_key").agg(F.count("*").alias("n"))


def visible(jobs: DataFrame, state: State) -> DataFrame:
    out = searched(jobs, state)
    return out.where(F.col("council_key") == state.council) if state.council else out


def band_chart(jobs: DataFrame, bands: DataFrame | None = None) -> DataFrame:
    """For bands 1 to 8, empty ones too: jobs, and average, least and greatest of the yearly minimum."""
    annual = money.annual_range(F.col("salary_min"), F.col("salary_max"), F.col("period"))["low"]
    every = bands if bands is not None else jobs.sparkSession.range(1, 9).select(F.col("id").cast("int").alias("band"))
    counted = jobs.withColumn("annual_", annual).groupBy("band").agg(F.count("*").alias("n"), F.avg("annual_").alias("average"), F.min("annual_").alias("least"), F.max("annual_").alias("greatest"))
    return every.join(F.broadcast(counted.where(F.col("band").between(1, 8))), "band", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def lower_quantiles(values: DataFrame, column: str, shares: dict[str, float], *keys: str) -> DataFrame:
    """The exact values at floor((n - 1) * share) in order, for each key, by counting equal values: no group is collected."""
    from pyspark.sql import Window

    counts = values.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("k_"))
    each = Window.partitionBy(*keys)
    upto = F.sum("k_").over(each.orderBy(column).rowsBetween(Window.unboundedPreceding, 0))
    placed = counts.withColumns({"upto_": upto, "total_": F.sum("k_").over(each)})
    at = lambda q: F.floor((F.col("total_") - 1) * F.lit(q))
    return placed.groupBy(*keys).agg(*[F.min(F.when(F.col("upto_") > at(q), F.col(column))).alias(name) for name, q in shares.items()])


def colour_scale(n: Column, domain: Column) -> Column:
    return money.clamp(n / F.greatest(F.lit(1), domain), 0.08, 1.0)


def job_date(*values: Column) -> Column:
    """The date of the first of these texts that isn't empty, as first and last sighting, observation and reference month; a month is its first day, and what is no date is null."""
    first = F.coalesce(*[F.nullif(v, F.lit("")) for v in values])
    return text.once(first, lambda v: F.when(v.rlike(r"^\d{4}-\d{2}$"), F.try_to_date(F.concat(v, F.lit("-01")))).otherwise(F.try_to_date(F.substring(v, 1, 10))))


def on_map(jobs: DataFrame, state: State, features: DataFrame, metro: tuple[str, ...]) -> DataFrame:
    """Every feature of a map (council_key, name, x, y) with its jobs after all filters but the council's: n, scale (its share of the ninth decile of councils' counts, 2 at
    least, from 0.08 to 1), metro and metro_total, the jobs of all councils of the city. Councils that aren't on the map count towards decile and total.
    """
    counts = by_council(jobs, state)
    decile = lower_quantiles(counts, "n", {"q90": 0.9}).agg(F.greatest(F.coalesce(F.max("q90"), F.lit(0)), F.lit(2)).alias("domain"))
    total = counts.agg(F.coalesce(F.sum(F.when(F.col("council_key").isin(*metro), F.col("n"))), F.lit(0)).alias("metro_total"))
    placed = features.join(counts, "council_key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    drawn = placed.crossJoin(F.broadcast(decile)).crossJoin(F.broadcast(total))  # one row each
    return drawn.select(*features.columns, "n", colour_scale(F.col("n"), F.col("domain")).alias("scale"), F.col("council_key").isin(*metro).alias("metro"), "metro_total")


def axis(low: Column, high: Column) -> Column:
    """Ends of an axis in tens of thousands, twenty thousand apart at least."""
    a, b = F.floor(low / 10000) * 10000, F.ceil(high / 10000) * 10000
    return F.struct(a.alias("low"), F.greatest(b, a + 20000).alias("high"))


def distinct_listings(jobs: DataFrame, seq: str, keep: list[str] | None = None) -> DataFrame:
    """The first row, by seq, of those that are the same vacancy, with `keep` of its columns or all: one partial aggregation, so that each task sends one row of them."""
    digest = F.sha2(F.concat_ws("\x1f", *[F.coalesce(k, F.lit("\x00")) for k in dedupe.exact_key()]), 256)
    rest = [c for c in keep or jobs.columns if c != seq]
    keyed = jobs.select(F.struct(*rest).alias("row_"), F.col(seq).alias("seq_"), F.unhex(digest).alias("key_"))
    first = keyed.groupBy("key_").agg(F.min_by("row_", "seq_").alias("row_"), F.min("seq_").alias(seq))
    return first.select(*[F.col(seq if c == seq else f"row_.{c}") for c in keep or jobs.columns])


def listed(jobs: DataFrame, collation: str | None = "UNICODE") -> DataFrame:
    """Junk titles last, then by council and title."""
    junk = F.lower(text.compact(F.col("title"))).isin("breadcrumb", "skip to content").cast("int")
    by = (lambda c: F.collate(F.coalesce(F.col(c), F.lit("")), collation)) if collation else (lambda c: F.coalesce(F.col(c), F.lit("")))
    return jobs.withColumn("junk_", junk).orderBy("junk_", by("council_key"), by("title")).drop("junk_")
