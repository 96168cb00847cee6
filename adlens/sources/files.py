"""Registries, logs, snapshots and descriptions from JSON files, and links and structured data from pages."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from adlens.functions import text, titles, urls
from adlens.sources import markup

SOURCE = T.StructType([T.StructField(n, T.StringType()) for n in ("source_id", "council_key", "short_name", "council_name", "platform", "url", "entry_url", "site_number")] + [T.StructField("enabled", T.BooleanType()), T.StructField("max_jobs", T.IntegerType())])
OBSERVATION = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("job_id", "run_id", "observed_at", "council_key", "council_name", "short_name", "source_id", "source_platform", "title", "url", "classification_status", "advertised_salary_text", "advertised_salary_period", "location_text", "work_type", "closing_date", "closing_text", "description_excerpt", "description_hash", "description_status", "source_strategy")]
    + [T.StructField("advertised_salary_min", T.DoubleType()), T.StructField("advertised_salary_max", T.DoubleType()), T.StructField("band", T.IntegerType()), T.StructField("field_evidence", T.MapType(T.StringType(), T.StringType())), T.StructField("corrupt", T.StringType())]
)
WORD_XML = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
#: What links to listings have in their title, path or query; sites that hold none; and what a refusal holds, in lower case.
JOB_LINK = r"(?i)\b(job|jobs|career|careers|vacanc|position|recruit|opening|role)s?\b"
OTHER_SITES = r"(?i)(^|\.)(facebook|instagram|linkedin|tiktok|youtube|x|twitter)\.com$|^(help|secure)\.employmenthero\.com$|^employmenthero\.page\.link$"
REFUSALS = ("awswafcookiedomainlist", "window.gokuprops")
#: Suffixes of log files in the order in which they are loaded.
LOADED = ("jsonl", "gz", "bz2")


def registry(spark: SparkSession, path: str) -> DataFrame:
    """The enabled sources of a registry file ({"sources": [...]}, plain or compressed), with ids and councils filled in."""
    rows = spark.read.schema(T.StructType([T.StructField("sources", T.ArrayType(SOURCE))])).option("multiLine", True).json(path).select(F.inline("sources"))
    council = F.coalesce(F.nullif("council_key", F.lit("")), text.key(F.coalesce("short_name", "council_name")))
    own = text.stable_hash(F.col("council_name"), F.col("platform"), F.col("url"), length=16)
    return rows.where(F.coalesce("enabled", F.lit(True))).withColumns({"source_id": F.coalesce(F.nullif("source_id", F.lit("")), own), "council_key": council})


def observations(spark: SparkSession, *paths: str) -> DataFrame:
    """The log's rows with `seq`, the order in which they were loaded: plain files, then gz, then bz2, each by whole path, then place in the file. Broken lines and lines without a job are left out."""
    rows = spark.read.schema(OBSERVATION).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "corrupt").json(list(paths))
    ends = F.regexp_extract("_metadata.file_path", r"\.(gz|bz2)$", 1)
    group = F.when(ends == "gz", LOADED.index("gz")).when(ends == "bz2", LOADED.index("bz2")).otherwise(LOADED.index("jsonl"))
    seq = F.struct(group.alias("suffix"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("seq")
    return rows.select("*", seq).where("corrupt is null and job_id is not null").drop("corrupt")


def previous_jobs(spark: SparkSession, *paths: str) -> DataFrame:
    """The jobs of the first of these published snapshots ({"jobs": [...]}) that is there and can be read, as all-jobs before current-jobs; none if there is none."""
    schema = T.StructType([T.StructField("jobs", T.ArrayType(OBSERVATION)), T.StructField("broken", T.StringType())])
    none = spark.createDataFrame([], T.StructType([f for f in OBSERVATION if f.name != "corrupt"]))
    for path in paths:
        try:
            rows = spark.read.schema(schema).option("multiLine", True).option("columnNameOfCorruptRecord", "broken").json(path)
        except AnalysisException:  # no such path
            continue
        if not rows.where("broken is null and jobs is not null").isEmpty():
            return rows.select(F.inline("jobs")).drop("corrupt").where("coalesce(job_id, '') <> ''")
    return none


def descriptions(spark: SparkSession, path: str) -> DataFrame:
    """Stored descriptions: hash (the file's name where it is missing) and text."""
    rows = spark.read.schema("hash string, text string, source_url string, source_id string").option("multiLine", True).json(path)
    return rows.select(F.coalesce(F.nullif("hash", F.lit("")), F.regexp_replace("_metadata.file_name", r"\.json.*$", "")).alias("hash"), "text", "source_url", "source_id")


def seed_sources(seed: DataFrame, sources: DataFrame, *seq: str) -> DataFrame:
    """Seed rows with the last source of the same name; rows without one get a source of their own."""
    named = text.key(F.coalesce(F.nullif("short_name", F.lit("")), F.col("council_name")))
    last = sources.withColumn("name_", named).groupBy("name_").agg(F.max_by("source_id", F.struct(*seq)).alias("found_"))
    j = seed.withColumn("name_", named).join(last, "name_", "left")  # broadcast by Spark where it is small
    own = F.concat(F.lit("seed-"), text.stable_hash(F.col("name_"), length=16))
    return j.withColumn("source_id", F.coalesce("found_", own)).drop("name_", "found_")


def is_blocked(status: Column, body: Column) -> Column:
    """Whether a site refused to answer: by its status, or by a challenge in the place of an accepted page."""
    low = F.lower(F.coalesce(body, F.lit("")))
    return F.coalesce(status.isin(401, 403, 429), F.lit(False)) | F.coalesce(status == 202, F.lit(False)) & (low.contains(REFUSALS[0]) | low.contains(REFUSALS[1]))


def links(pages: DataFrame) -> DataFrame:
    """Every anchor of a page (page_id, url, html) in order: page_id, pos, title, link, with references decoded. Anchors without an address are passed over."""
    a = pages.select("page_id", "url", F.posexplode(F.filter(markup.elements(F.col("html")), lambda e: (e["tag"] == "a") & e["url"].isNotNull())).alias("pos", "e"))
    return a.select("page_id", "pos", text.compact(F.col("e.text")).alias("title"), text.once(F.struct(F.col("url").alias("base"), F.col("e.url").alias("href")), lambda b: urls.resolved(b["base"], b["href"])).alias("link"))


def job_links(found: DataFrame) -> DataFrame:
    """Links that may lead to listings by their title, path or query, each address once a page, at its first place."""
    t, link = F.col("title"), F.col("link")
    site = F.regexp_replace(F.lower(urls.part(link, 2)), r"^www\.", "")
    said = F.concat_ws(" ", t, urls.part(link, 3), urls.part(link, 4))
    ok = (link != "") & (F.length(t) >= 4) & ~t.rlike(titles.BAD_LINK_TITLES) & ~t.rlike(titles.BAD_LINK_FRAGMENTS) & ~site.rlike(OTHER_SITES) & said.rlike(JOB_LINK)
    return found.where(ok).groupBy("page_id", "link").agg(F.min(F.struct("pos", "title")).alias("f")).select("page_id", "f.pos", "f.title", "link")


#: Keys, in lower case, of objects that may be listings, and how many of a payload count.
TITLE_KEYS = frozenset({"title", "jobtitle", "name", "positiontitle", "job title"})
LINK_KEYS = frozenset({"url", "uri", "link", "joburl", "externalurl"})
CONTEXT_KEYS = frozenset({"description", "closingdate", "validthrough", "salary", "compensation", "location", "employmenttype"})
MOST_ITEMS = 120
#: Where the fields of such an object stand, the first name that it has.
ALIASES = {
    "title": ("title", "jobtitle", "name", "positiontitle"),
    "link": ("url", "link", "joburl", "externalurl"),
    "closing_text": ("closingdate", "closing", "validthrough"),
    "location_text": ("location", "primarylocation"),
    "work_type": ("worktype", "employmenttype", "jobschedule"),
    "description": ("description",),
}


def _scalars(value: object) -> list[str]:
    """All numbers, words and truth values below a value, in order."""
    out, stack = [], [value]
    while stack:
        v = stack.pop()
        if isinstance(v, dict):
            stack += reversed(list(v.values()))
        elif isinstance(v, list):
            stack += reversed(v)
        elif isinstance(v, (str, int, float)):
            out.append(str(v))
    return out


def _objects(value: object, most: int) -> list[dict]:
    """Objects that may be listings, wherever they stand, those around others first; `most` at most."""
    out, stack = [], [value]
    while stack and len(out) < most:
        v = stack.pop()
        if isinstance(v, dict):
            keys = {" ".join(k.split()).lower() for k in v}
            if keys & TITLE_KEYS and keys & (LINK_KEYS | CONTEXT_KEYS):
                out.append(v)
            stack += reversed(list(v.values()))
        elif isinstance(v, list):
            stack += reversed(v)
    return out


def _field(item: dict, names: tuple[str, ...]) -> str:
    by_name = {k.lower(): v for k, v in item.items()}
    return next((" ".join(str(by_name[n]).split()) for n in names if isinstance(by_name.get(n), (str, int, float))), "")


def endpoint_items(payloads: DataFrame, most: int = MOST_ITEMS) -> DataFrame:
    """Objects that may be listings at any depth of JSON payloads (source_id, url, body), `most` a payload: source_id, base, pos, the fields of ALIASES, and body, all its words.

    Payloads that aren't JSON have none. Nesting of any depth that the JSON reader takes is walked without recursion.
    """
    names = list(ALIASES)

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for source, base, body in zip(pdf["source_id"], pdf["url"], pdf["body"], strict=True):
                try:
                    value = json.loads(body)
                except (TypeError, ValueError, RecursionError):
                    continue
                out += [(source, base, pos, *[_field(item, ALIASES[n]) for n in names], " ".join(" ".join(_scalars(item)).split())) for pos, item in enumerate(_objects(value, most))]
            yield pd.DataFrame(out, columns=["source_id", "base", "pos", *names, "body"])

    kind = dict(payloads.dtypes)["source_id"]
    return payloads.select("source_id", "url", "body").mapInPandas(walk, f"source_id {kind}, base string, pos int, " + ", ".join(f"{n} string" for n in names) + ", body string")


def embedded_document(url: Column) -> Column:
    """The document behind a viewer's address (?file=…), or the address itself."""
    file = F.regexp_extract(url, r"[?&]file=([^&#]+)", 1)
    return F.when(file != "", urls.resolved(url, F.try_url_decode(file))).otherwise(url)


@F.pandas_udf(T.StringType())
def docx_text(content: pd.Series) -> pd.Series:
    """The text of word-processor files, a line a paragraph; null for other bytes."""

    def one(data: bytes | None) -> str | None:
        try:
            with zipfile.ZipFile(io.BytesIO(data)) as z:
                root = ElementTree.fromstring(z.read("word/document.xml"))
        except (zipfile.BadZipFile, KeyError, TypeError, ElementTree.ParseError):
            return None
        return "\n".join("".join(t.text or "" for t in p.iter(f"{WORD_XML}t")) for p in root.iter(f"{WORD_XML}p"))

    return content.map(one)


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Word-processor files under a path: path, text."""
    return spark.read.format("binaryFile").load(path).select("path", docx_text("content").alias("text"))


def document_name(url: Column) -> Column:
    """The name, without its ending, under which a fetched document is kept; its first two digits are its folder, shard=…"""
    return F.sha2(url.cast("binary"), 256)


def document_texts(asked: DataFrame, root: str) -> DataFrame:
    """url and text of the documents at the addresses asked (url), as far as they are kept under root and can be read.

    Folders hold files by the first two digits of their names, of which there are 256 at most: only those that are asked for are listed and read.
    """
    spark = asked.sparkSession
    named = asked.select("url").distinct().withColumn("name", document_name(F.col("url")))
    shards = [r[0] for r in named.select(F.substring("name", 1, 2)).distinct().collect()]
    kept = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary, shard string").load(root).where(F.col("shard").isin(shards))
    stem = F.regexp_extract("path", r"([0-9a-f]{64})[^/]*$", 1)
    return kept.select(stem.alias("name"), "content").join(named, "name").select("url", docx_text("content").alias("text")).where("text is not null")
