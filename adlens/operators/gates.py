"""What a listing must have to be published, and the checks of a board before it is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.functions import band, money, titles, urls
from adlens.functions.text import compact, once

#: Fixed value: listings of one council in one run that a board may hold.
MOST_PER_RUN = 50


def filled(*columns: Column) -> Column:
    """Whether any of the columns has text."""
    out = F.lit(False)
    for c in columns:
        out = out | (compact(c) != "")
    return out


def has_band() -> Column:
    return F.coalesce(band.existing(F.col("standard_band_number"), F.col("classification_band")).isNotNull(), F.lit(False))


def has_salary() -> Column:
    text = F.col("advertised_salary_text")
    return F.coalesce(text != "", F.lit(False)) | F.col("advertised_salary_min").isNotNull() | F.col("advertised_salary_max").isNotNull()


def has_compensation() -> Column:
    label = money.range_label(F.col("advertised_salary_min"), F.col("advertised_salary_max"), F.col("advertised_salary_period"))
    return has_band() | has_salary() | (label != "")


def names_role(explore: bool = False) -> Column:
    return compact(F.col("job_title")).rlike(titles.EXPLORE_ROLE if explore else titles.ROLE)


def has_context() -> Column:
    return F.concat_ws(" ", *[compact(F.col(c)) for c in ("description_text", "closing_at_text", "work_type")]).rlike(titles.CONTEXT)


def _signals(explore: bool) -> Column:
    """What the gates ask of a row, each worked out once."""
    status = F.lower(compact(F.col("classification_status")))
    named = filled(F.col("job_title")) & filled(F.col("job_url")) & filled(F.col("council_key"))
    detail = filled(F.col("closing_at"), F.col("closing_at_text"), F.col("location_text"), F.col("work_type"))
    label = money.range_label(F.col("advertised_salary_min"), F.col("advertised_salary_max"), F.col("advertised_salary_period"))
    parts = {
        "band": has_band(), "salary": has_salary() | (label != ""), "role": names_role(explore), "detail": detail, "context": has_context(), "named": named,
        "page": titles.is_shell(F.col("job_title")) | urls.holds_no_listing(F.col("job_url")), "weak": status.isin("parse_warning", "parser warning", "unclassified", "description_only"),
    }
    return F.struct(*[F.coalesce(c, F.lit(False)).alias(n) for n, c in parts.items()])


def _strong(s: Column) -> Column:
    return s["band"] | s["role"] & (s["salary"] | s["detail"] | s["context"])


def is_strong(explore: bool = False) -> Column:
    """A band; or a role with pay, a closing date, a place or kind of work, or words of a vacancy."""
    return once(_signals(explore), _strong)


def is_listing(explore: bool = False) -> Column:
    """The gate of the board; explorers need no compensation but know more roles."""
    paid = lambda s: F.lit(True) if explore else s["band"] | s["salary"]
    return once(_signals(explore), lambda s: s["named"] & ~s["page"] & paid(s) & (~s["weak"] | _strong(s)) & (_strong(s) | s["role"]))


def is_probable() -> Column:
    """Whether a candidate (title, url, band, pay, closing date, words) may be a listing: a role's title, and one thing more that listings have."""
    title, url = F.col("title"), F.col("url")
    other = (urls.host(url) == "employmenthero.com") & ~F.lower(urls.path_key(url)).contains("/jobs/position/")
    words = F.concat_ws(" ", *[compact(F.col(c)) for c in ("description_excerpt", "work_type", "location_text")])
    told = F.col("band").isNotNull() | has_salary() | filled(F.col("closing_date"), F.col("closing_text")) | words.rlike(titles.CONTEXT)
    named = once(compact(title), lambda t: ~t.rlike(titles.BAD_LINK_TITLES) & ~t.rlike(titles.BAD_LINK_FRAGMENTS) & titles.is_role(t))
    return named & ~F.coalesce(other, F.lit(False)) & told


def missing_evidence() -> Column:
    """The fields that a row must give evidence for and doesn't, sorted, comma-joined."""
    need = lambda when, name: F.when(when & ~filled(F.try_element_at("field_evidence", F.lit(name))), F.lit(name))
    banded = F.col("standard_band_number").isNotNull() | F.lower(compact(F.col("classification_band"))).startswith("band ")
    wanted = F.array(
        need(banded, "band"),
        need(filled(F.col("closing_at"), F.col("closing_at_text")), "closing_date"),
        need(filled(F.col("description_text"), F.col("description_status")), "description"),
        need(has_salary(), "salary"),
        need(F.lit(True), "strategy"),
        need(F.lit(True), "title"),
    )
    return F.when(F.col("field_evidence").isNull(), "field_evidence").otherwise(F.array_join(F.array_compact(wanted), ","))


def crowded(board: DataFrame, most: int = MOST_PER_RUN) -> DataFrame:
    """Councils and runs with more rows than a board may hold: council_key, run_id, n."""
    return board.groupBy("council_key", F.col("last_seen_run_id").alias("run_id")).agg(F.count("*").alias("n")).where(F.col("n") > most)


def violations(board: DataFrame) -> DataFrame:
    """One row: how many rows fail each check, with up to ten of them, and the crowded councils."""
    def failed(s: Column) -> Column:
        unpaid = s["named"] & ~s["band"] & ~s["salary"]
        return F.struct(unpaid.alias("compensation"), (~s["named"] | ~unpaid & (s["page"] | ~_strong(s))).alias("quality"), (s["named"] & ~unpaid & (s["missing"] != "")).alias("evidence"))

    board = board.withColumn("failed_", once(_signals(False).withField("missing", missing_evidence()), failed))
    who = F.concat_ws(": ", "council_key", "job_title")
    checks = {n: F.col(f"failed_.{n}") for n in ("compensation", "quality", "evidence")}
    out = board.agg(
        *[F.count_if(c).alias(f"{n}_rows") for n, c in checks.items()],
        *[F.array_join(F.slice(F.array_sort(F.collect_set(F.when(c, who))), 1, 10), "; ").alias(f"{n}_sample") for n, c in checks.items()],
    )
    outliers = crowded(board).agg(F.count("*").alias("outlier_rows"), F.array_join(F.array_sort(F.collect_list(F.format_string("%s/%s=%d", "council_key", F.coalesce("run_id", F.lit("unknown-run")), "n"))), ", ").alias("outlier_sample"))
    return out.crossJoin(outliers)


def validate(board: DataFrame) -> None:
    """Raise ValueError for the first check that fails."""
    v = violations(board).first()
    for name in ("compensation", "quality", "evidence", "outlier"):
        if v[f"{name}_rows"]:
            raise ValueError(f"board {name} gate: {v[f'{name}_rows']} row(s): {v[f'{name}_sample']}")
