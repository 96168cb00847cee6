"""The text operators' queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from adlens.llm import decontam, exact_dedup, html_text, jaccard_join, langid, lm_score, mixing, quality, repeats, secrets, sharding, token_count, vector_codes
from adlens.llm.common import crc_mod, shared_dir, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The probability that labels.quality marks a document 1, learned from four fifths of the labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False))
    model = quality.fit(docs, labels.where(~held_out))
    scored = quality.score(docs, model, [F.col("doc_id"), held_out.alias("held_out")])
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op2_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page and its length in code points."""
    return html_text.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from two thirds of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 3) == 1, F.lit(False))
    model = langid.fit(docs.where(~held_out))
    return langid.predict(docs, model, [F.col("doc_id"), held_out.alias("held_out")])


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents with equal texts, by block naming."""
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix of sources takes."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens and pre-tokens of every document."""
    return token_count.count(table(spark, sf_dir, "documents"), [F.col("doc_id")])


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of every document that windows of 13 words of benchmark items cover."""
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document under a model of six sevenths of them, and those of single words."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 7) == 2, F.lit(False))
    return lm_score.score(docs, lm_score.fit(docs.where(~held_out), order=3), [F.col("doc_id"), held_out.alias("held_out")])


def op9_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by a Jaccard similarity of 0.8 or more of their shingles."""
    return jaccard_join.near_copies(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: counts and a digest of the strong spans, and all spans."""
    got = secrets.scan(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda p: p["kind"] == k)).cast("long")
    return got.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.listed(F.concat("base", "linked")).alias("spans"),
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words in every document, a tenth of which get a periodic end first, and a digest of the text without repeats."""
    docs = table(spark, sf_dir, "documents")
    got = repeats.find(docs.select("doc_id", repeats.planted(docs).alias("text")), [F.col("doc_id")])
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return got.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), listed.alias("listed"), "collapsed").select(
        "doc_id",
        "n_runs",
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.when(F.col("n_runs") > 0, F.concat("listed", F.lit("\n"))).otherwise("").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of every vector under codebooks fitted on all of them, and its error."""
    vectors = table(spark, sf_dir, "embeddings")
    model = vector_codes.fit(vectors)
    found = vector_codes.codes(vectors, model, [F.col("vec_id")])
    return found.withColumn("codebooks_sha256", F.lit((model or vector_codes.Codebooks([], 0)).digest()))


def op13_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document, of sixteen that are even by bytes, under a map of virtual slots stored beside the checkpoints."""
    docs = table(spark, sf_dir, "documents")
    placed = sharding.place(docs, f"{shared_dir(spark)}/shard-map-{uuid.uuid4().hex}")
    return placed.withColumn("law", F.lit("bytes")).withColumn("grown_shard", F.lit(None).cast("int"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_quality_score, op2_page_text, op3_language_id, op4_exact_dedup, op5_source_mix, op6_token_count, op7_decontamination, op8_language_model, op9_near_copies, op10_secret_scan, op11_periodic_runs, op12_vector_codes, op13_shards)}
LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL: dict[str, str] = {
    "op4_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM d""",
    "op7_decontamination": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS id, regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        win AS (SELECT DISTINCT id, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS key
                FROM (SELECT id, w, least(13, len(w)) AS size, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
        occ AS (SELECT doc_id, p, win.size AS size, id
                FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d) x CROSS JOIN (SELECT DISTINCT size FROM win) l
                JOIN win ON win.size = l.size AND win.key = array_to_string(list_slice(w, p, p + l.size - 1), ' ') WHERE p + l.size - 1 <= len(w)),
        hits AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM occ) GROUP BY 1),
        found AS (SELECT doc_id, count(id) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, id FROM occ) GROUP BY 1)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN found USING (doc_id)""",
    "op9_near_copies": rf"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER_SQL}, '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + least(5, len(w)) - 1), ' ') AS sh FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        links AS (SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * shared >= 80 * (nx.n + ny.n - shared)),
        reach AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
        SELECT x AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(y) AS component_id FROM reach LEFT JOIN n ON n.doc_id = x GROUP BY x""",
}


#: For SQL, whose expressions can't look around: maximal runs of 40 or more, of which those of 40 without = are kept.
BARE_SQL = r"[A-Za-z0-9/+=]{40,}"


def _places_sql(kind: int) -> str:
    """The spans of one kind with their role."""
    name, pattern, group, least, role = secrets.KINDS[kind]
    quoted = (BARE_SQL if name == "bare40" else pattern).replace("'", "''")
    keep = "len(hit) = 40 AND NOT contains(hit, '=')" if name == "bare40" else f"len(part) >= {least}"
    return rf"""
        SELECT r, {kind} AS kind, '{name}' AS name, '{role}' AS role, stop - len(hit) AS start, stop
        FROM (SELECT *, CAST(sum(len(before) + len(hit)) OVER (PARTITION BY r ORDER BY j) AS BIGINT) AS stop
              FROM (SELECT r, unnest(range(1, len(hits) + 1)) AS j, unnest(hits) AS hit, unnest(parts) AS part, unnest(list_slice(rest, 1, len(hits))) AS before
                    FROM (SELECT r, regexp_extract_all(t, '{quoted}') AS hits, regexp_extract_all(t, '{quoted}', {group}) AS parts, string_split_regex(t, '{quoted}') AS rest FROM d)))
        WHERE {keep}"""


SQL["op10_secret_scan"] = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    p AS ({" UNION ALL ".join(_places_sql(k) for k in range(len(secrets.KINDS)))}),
    near AS (SELECT x.r, x.kind, x.name, x.start, x.stop, bool_or(y.role = 'id') AS id, bool_or(y.role = 'secret') AS secret
             FROM p x JOIN p y ON x.r = y.r AND y.start <= x.stop + 300 AND y.stop >= x.start - 300 WHERE x.kind >= {secrets.BASE} GROUP BY ALL),
    kept AS (SELECT r, kind, name, start, stop FROM p WHERE kind < {secrets.BASE}
             UNION ALL SELECT r, kind, name, start, stop FROM near WHERE CASE name WHEN 'account' THEN secret WHEN 'bare40' THEN id ELSE id AND secret END),
    s AS (SELECT r, count_if(kind = 0) AS n_assign, count_if(kind = 1) AS n_access, count_if(kind = 2) AS n_hex,
                 string_agg(concat_ws(':', name, start, stop), ',' ORDER BY start, kind, stop) FILTER (kind < {secrets.BASE}) AS base,
                 string_agg(concat_ws(':', name, start, stop), ',' ORDER BY start, kind, stop) AS spans FROM kept GROUP BY r)
    SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN s USING (r)"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    return {**QUERIES, "pipeline": pipeline}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
