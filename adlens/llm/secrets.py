"""Secret scan by multipart credential linking, in DataFrame functions only.

Strong patterns (an assignment to a telling name, an access key, a long hex run) are always
reported. Weak parts (an account name, a bare 40-character token, an endpoint) are reported
only where the parts that complete a credential lie within ``gap`` code points in the same
document: an interval join on (document, bucket of offsets), so that no document's parts are
paired with each other beyond their neighbourhood.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import cut

#: Kinds in the order in which equal starts are listed: name, pattern, group that is measured, least length, role.
KINDS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, "secret"),
    ("access", r"AKIA[A-Z0-9]+", 0, 20, "id"),
    ("hex", r"[0-9a-f]{24,}", 0, 24, "secret"),  # runs are maximal, so this finds what [0-9a-f]+ of 24 or more finds
    ("account", r"""(?i:access_key_id|client_id|user(?:name|_id)?|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]+""", 0, 8, "id"),
    ("bare40", r"(?<![A-Za-z0-9/+=])[A-Za-z0-9/+]{40}(?![A-Za-z0-9/+=])", 0, 40, "secret"),
    ("endpoint", r"""(?i:https?|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3)://[^\x00-\x20"'<>]+""", 0, 8, "endpoint"),
)
BASE = 3
#: The roles that must lie near a weak part before it is reported.
NEEDS = {"id": ("secret",), "secret": ("id",), "endpoint": ("id", "secret")}
SPAN = "array<struct<kind:int,start:int,end:int>>"
#: Matches walked through together.
CHUNK = 256


def found(text: Column, kind: int) -> Column:
    """The kept spans of one kind: leftmost matches that don't overlap, their places counted from the pieces between.

    Matches are walked through in stretches of CHUNK, so that very many in one text aren't copied once a match.
    """
    _, pattern, group, least, _ = KINDS[kind]
    none = F.array().cast(SPAN)

    def step(s: Column, x: Column) -> Column:
        start = s["at"] + F.length(x["before"])
        end = start + F.length(x["hit"])
        measured = x["hit"] if group == 0 else F.regexp_extract(x["hit"], pattern, group)
        span = F.array(F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(F.length(measured) >= least, F.concat(s["out"], span)).otherwise(s["out"]).alias("out"))

    def stretch(s: Column, part: Column) -> Column:
        return F.aggregate(part, F.struct(s["at"].alias("at"), none.alias("out")), step, lambda r: F.struct(r["at"].alias("at"), F.concat(s["out"], F.array(r["out"])).alias("out")))

    def walk(m: Column) -> Column:
        each = F.arrays_zip(F.slice(m["before"], F.lit(1), F.size(m["hits"])).alias("before"), m["hits"].alias("hit"))
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(m["hits"]) - 1) / CHUNK).cast("int")), lambda i: F.slice(each, i * CHUNK + 1, F.lit(CHUNK)))
        return F.flatten(F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out")), stretch, lambda s: s["out"]))

    matched = F.struct(F.split(text, pattern, -1).alias("before"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))
    return F.when(text.rlike(pattern), F.transform(F.array(matched), walk)[0]).otherwise(none)


def listed(parts: Column) -> Column:
    """kind:start:end by start, then by kind, comma-joined."""
    ordered = F.array_sort(F.transform(parts, lambda p: F.struct(p["start"], p["kind"], p["end"])))
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(F.transform(ordered, lambda p: F.concat_ws(":", F.element_at(names, p["kind"] + 1), p["start"].cast("string"), p["end"].cast("string"))), ",")


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id", gap: int = 300) -> DataFrame:
    """One row per row of docs: key, base (array of strong spans), linked (array of weak spans that a credential completes).

    Null text counts as empty and gives no spans; a null key is a key like others. Rows that repeat both
    key and text each give the same result. Other columns of docs are ignored. Spans count code points.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = cut(
        docs.select(F.col(key).alias("key"), F.xxhash64(body).alias("h"), body.alias("t")).select(
            "key", "h", F.concat(*[found(F.col("t"), k) for k in range(BASE)]).alias("base"), F.concat(*[found(F.col("t"), k) for k in range(BASE, len(KINDS))]).alias("weak")
        )
    )
    roles = F.array(*[F.lit(k[4]) for k in KINDS])
    some = rows.where((F.size("weak") > 0) & (F.size("weak") + F.size("base") > 1)).dropDuplicates(["key", "h"])
    low = F.floor(F.col("p.start") / gap).cast("int")
    near = some.select("key", "h", F.explode(F.concat("base", "weak")).alias("p")).select(
        "key", "h", F.element_at(roles, F.col("p.kind") + 1).alias("role"), F.col("p.start").alias("s"), F.col("p.end").alias("e"), F.explode(F.sequence(low, F.floor(F.col("p.end") / gap).cast("int"))).alias("bucket")
    )
    weak = some.select("key", "h", F.explode("weak").alias("p")).select(
        F.col("key").alias("k"), F.col("h").alias("g"), "p", F.explode(F.sequence(F.floor((F.col("p.start") - gap) / gap).cast("int"), F.floor((F.col("p.end") + gap) / gap).cast("int"))).alias("b")
    )
    pairs = weak.join(near, F.col("k").eqNullSafe(F.col("key")) & (F.col("g") == F.col("h")) & (F.col("b") == F.col("bucket")) & (F.col("s") <= F.col("p.end") + gap) & (F.col("e") >= F.col("p.start") - gap))
    seen = pairs.groupBy("k", "g", "p").agg(*[F.max(F.col("role") == r).alias(f"near_{r}") for r in ("id", "secret")])
    complete = F.lit(False)
    for i, k in list(enumerate(KINDS))[BASE:]:
        need = F.col("p.kind") == i
        for r in NEEDS[k[4]]:
            need = need & F.col(f"near_{r}")
        complete = complete | need
    linked = seen.where(complete).groupBy("k", "g").agg(F.collect_set("p").alias("linked"))
    return rows.join(linked, F.col("key").eqNullSafe(F.col("k")) & (F.col("h") == F.col("g")), "left").select(
        F.col("key").alias(key), "base", F.coalesce("linked", F.array().cast(SPAN)).alias("linked")
    )
