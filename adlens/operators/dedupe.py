"""Duplicate listings: exact ones by key, then fuzzy ones greedily within a council."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlens.functions import band, money, text, urls
from adlens.operators import gates
from adlens.operators.greedy import chosen
from adlens.operators.staging import stored, written


def quality_score() -> Column:
    """How good a row is: 40 band, 30 explicit band, 20 pay, 10 description, 5 current, 3 official site, 20 less for a mirror."""
    points = ((band.parse(F.col("standard_band_number")).isNotNull(), 40), (text.compact(F.col("classification_status")) == "explicit_band", 30), (gates.has_salary(), 20), (gates.filled(F.col("description_text")), 10), (F.col("observed_status") == "seen_latest_run", 5))
    sites = text.once(urls.host(F.col("job_url")), lambda h: F.when(urls.official_host(h), 3).otherwise(0) + F.when(urls.scored_mirror_host(h), -20).otherwise(0))
    return sum((F.when(c, F.lit(p)).otherwise(0) for c, p in points), sites)


def pay_signature() -> Column:
    label = money.range_label(F.col("advertised_salary_min"), F.col("advertised_salary_max"), F.col("advertised_salary_period"))
    return F.lower(text.compact(F.when(label != "", label).otherwise(F.col("advertised_salary_text"))))


def exact_key() -> list[Column]:
    """The seven parts by which rows are the same vacancy."""
    low = lambda c: F.lower(text.compact(F.col(c)))
    closing = F.when(gates.filled(F.col("closing_at")), low("closing_at")).otherwise(low("closing_at_text"))
    return [F.upper(text.compact(F.col("council_key"))), text.title_key(F.col("job_title")), urls.path_key(F.col("job_url")), low("location_text"), low("work_type"), closing, pay_signature()]


def best_of_exact(rows: DataFrame, seq: str, keep: list[str] | None = None) -> DataFrame:
    """The best row of each exact key, the first of equally good ones, in the place of the key's first row (seq_), with `keep` of its columns or all, and score_.

    The key is worked out once, as one digest. A partial aggregation leaves each task one row a key, so that a key may have any share
    of the rows; as what it keeps is a struct, tasks sort by key to aggregate, and `keep` says how much they carry along.
    """
    digest = F.sha2(F.concat_ws("\x1f", *[F.coalesce(k, F.lit("\x00")) for k in exact_key()]), 256)
    keyed = rows.select(digest.alias("key_"), quality_score().alias("score_"), F.col(seq).alias("seq_"), F.struct(*[F.col(c) for c in keep or rows.columns]).alias("row_"))
    best = keyed.groupBy("key_").agg(F.min_by(F.struct("row_", "score_"), F.struct(-F.col("score_"), F.col("seq_"))).alias("best_"), F.min("seq_").alias("seq_"))
    return best.select("best_.row_.*", "best_.score_", "seq_")


DETAILS = ("work_", "place_", "closing_", "closing_text_", "pay_")


def _cells(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells and their adjacency, as ``greedy.chosen`` takes them, of rows (row, words_, mirror_, soft_, hard_, aspects_).

    A cell is an aspect with a title. Within an aspect, titles are compared that share a word which is among the rarest
    fifth, and one more, of the shorter: any that are alike do.
    """
    own = ["aspect", "words_", "mirror_", "soft_", "hard_"]
    each = stored(rows.where("size(words_) > 0").select("row", F.explode("aspects_").alias("aspect"), F.array_sort("words_").alias("words_"), "mirror_", "soft_", "hard_"))
    cells = stored(each.select(*own).distinct().withColumn("cell", F.monotonically_increasing_id()))
    named = cells.select("cell", "aspect", F.size("words_").alias("n"), F.explode("words_").alias("word"))
    counts = named.groupBy("word").agg(F.count("*").alias("count"))
    rare = named.join(counts, "word").groupBy("cell", "aspect", "n").agg(F.array_sort(F.collect_list(F.struct("count", "word"))).alias("by"))
    rare = rare.select(F.col("cell").alias("x"), "aspect", F.col("n").alias("least"), F.explode(F.slice("by", F.lit(1), F.floor(F.col("n") / 5).cast("int") + 1)).alias("w")).select("x", "aspect", "least", "w.word")
    pairs = rare.join(named, ["aspect", "word"]).where("least <= n").select("x", F.col("cell").alias("y")).distinct()
    both = pairs.union(pairs.select("y", "x")).distinct().toDF("incoming", "holder")
    side = lambda name: cells.select(F.col("cell").alias(name), F.struct("*").alias(f"{name[0]}_"))
    i, h = (lambda c: F.col(f"i_.{c}")), (lambda c: F.col(f"h_.{c}"))
    kind = F.substring(i("aspect"), 1, 1)
    weak = F.when(i("mirror_"), i("soft_") & h("hard_")).otherwise(h("mirror_") & h("soft_") & i("hard_"))
    same = F.when(kind == "d", i("mirror_") | h("mirror_")).when(kind == "w", weak).otherwise(F.lit(True))
    found = both.join(side("incoming"), "incoming").join(side("holder"), "holder").where(text.alike(i("words_"), h("words_")) & same)
    return each.join(cells, own).select("row", "cell"), stored(found.select("incoming", "holder"))


def _aspects() -> Column:
    """What makes rows with like titles the same, each as text: a page; a host and a detail; for mirrors a detail, or that the mirror tells nothing and the other does."""
    of = lambda kind, *c: F.concat_ws("\x1f", F.lit(kind), "council_", *c)
    hosts = [F.when((F.col("host_") != "") & (F.col(d) != ""), of("h", F.lit(d), "host_", d)) for d in DETAILS]
    mirrors = [F.when(F.col("mirrors_") & (F.col(d) != ""), of("d", F.lit(d), d)) for d in DETAILS]
    return F.array_compact(F.array(of("p", "path_"), *hosts, *mirrors, F.when(F.col("softs_") & (F.col("mirror_") & F.col("soft_") | F.col("hard_")), of("w"))))


def dedupe(rows: DataFrame, seq: str) -> DataFrame:
    """Rows without exact, same-page and mirrored duplicates. `seq` is a whole number that orders rows.

    The greedy steps, first within pages and then within councils, are settled by ``greedy.chosen`` in rounds over keys
    alone: no council, page or group of linked rows is one task's.
    """
    low = lambda c: F.lower(text.compact(F.col(c)))
    exact = written(best_of_exact(rows, seq))
    keys = exact.select(
        F.upper(text.compact(F.col("council_key"))).alias("council_"), text.title_words(F.col("job_title")).alias("words_"), urls.path_key(F.col("job_url")).alias("path_"), urls.host(F.col("job_url")).alias("host_"),
        urls.is_mirror(F.col("job_url")).alias("mirror_"), F.col("score_").alias("score"), low("work_type").alias("work_"), low("location_text").alias("place_"), low("closing_at").alias("closing_"), low("closing_at_text").alias("closing_text_"),
        pay_signature().alias("pay_"), band.parse(F.col("standard_band_number")).isNotNull().alias("band_"), F.col("seq_").cast("long").alias("row"),
    )
    told = F.col("band_") | F.greatest(*[F.length(c) for c in DETAILS if c != "place_"]).cast("boolean")
    keys = stored(keys.withColumns({"soft_": ~told, "hard_": told | (F.col("place_") != "")}))
    page = F.array(F.concat_ws("\x1f", F.lit("p"), "council_", "path_"))
    first = chosen(keys.select("row", "score"), *_cells(keys.withColumn("aspects_", page)))
    # pages come in the order of their first rows
    pages = keys.groupBy(F.col("council_").alias("c_"), F.col("path_").alias("p_")).agg(F.min("row").alias("page"))
    councils = keys.groupBy(F.col("council_").alias("k_")).agg(F.bool_or("mirror_").alias("mirrors_"), F.bool_or(F.col("mirror_") & F.col("soft_")).alias("softs_"))
    rest = keys.join(first, "row").join(pages, (F.col("council_") == F.col("c_")) & (F.col("path_") == F.col("p_"))).join(councils, F.col("council_") == F.col("k_"))
    rest = stored(rest.withColumn("seq_", F.col("row")).withColumn("row", F.struct("page", "place")))
    last = chosen(rest.select("row", "score"), *_cells(rest.withColumn("aspects_", _aspects())))
    kept = rest.join(last.select("row"), "row", "left_semi").select("seq_")
    return exact.join(kept, "seq_", "left_semi").drop("score_", "seq_")
