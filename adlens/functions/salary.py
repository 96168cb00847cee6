"""Salaries from free text: every candidate is found with what stands around it, scored, and the best taken."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlens.functions.text import compact, once

#: How an amount, a range and periods are written, and what tells pay from other numbers.
NUMBER = r"(?:\d{1,3}(?:,\d{3})+|\d{2,6})(?:\.\d+)?"
CORE = (
    rf"(?:(?:AUD|AU\$)\s*)?\$?\s*({NUMBER})(k)?\s*(?:AUD)?\s*(?:-|to|\?|–|—|â€“|â€”)\s*(?:(?:AUD|AU\$)\s*)?\$?\s*({NUMBER})(k)?(?:\s*AUD)?"
    rf"|\$\s*({NUMBER})(k)?"
)
PERIODS = (("hour", "hour|hourly|p/h|per hour"), ("week", "week|weekly|per week"), ("fortnight", "fortnight|fortnightly"), ("year", r"year|annual|annum|p\.?a\.?|per annum"))
CONTEXT = r"(?i)\b(salary|pay|rate|remuneration|package|annum|hour|weekly|fortnight)\b"
LARGE_CONTEXT = r"(?i)\b(salary|remuneration|package|pay|rate)\b"
REFERENCE = r"^\d{1,3}-20\d{2}$"
MARKERS = (
    " Description | Role Type | Job | Apply | Information pack | Position description | Categories: | About the team| About the role| Closing | Location:| Tool of trade | Join us | Join our | You will "
)
AROUND = 90
PARTS = "array<struct<before:string,hit:string,first:string,first_k:string,second:string,second_k:string,single:string,single_k:string,after:string>>"


def _amount(digits: Column, k: Column) -> Column:
    return F.replace(digits, F.lit(",")).try_cast("double") * F.when(k != "", 1000).otherwise(1)


def _is_reference(evidence: Column, low: Column, high: Column) -> Column:
    plain = F.regexp_replace(compact(evidence), "[–—]", "-")
    return (low <= 999) & high.between(2000, 2099) & once(plain, lambda p: ~p.contains("$") & p.rlike(REFERENCE))


def _nearest_period(before: Column, evidence: Column, after: Column) -> Column:
    """The period word nearest to the amount; of equally near ones the shorter period's."""
    behind, ahead = F.concat(before, F.substring(evidence, 1, 1)), F.concat(F.right(evidence, F.lit(1)), after)
    near = []
    for i, (_, words) in enumerate(PERIODS):
        tail = F.regexp_extract(behind, rf"(?i)^.*\b(?:{words})\b(.*)$", 1)
        ahead_at = F.regexp_instr(ahead, F.lit(rf"(?i)\b(?:{words})\b"))
        near.append(F.when(behind.rlike(rf"(?i)\b(?:{words})\b"), F.struct((F.length(tail) - 1).alias("d"), F.lit(i).alias("i"))))
        near.append(F.when(ahead_at > 0, F.struct((ahead_at - 2).alias("d"), F.lit(i).alias("i"))))
    names = F.array(*[F.lit(p[0]) for p in PERIODS])
    return F.get(names, F.array_min(F.array_compact(F.array(*near)))["i"])


def inferred_period(low: Column, high: Column, context: Column) -> Column:
    return F.when(high >= 30000, "year").when((high <= 250) & context.rlike(r"(?i)\b(casual|hourly|rate)\b"), "hour").when((low >= 1000) & (high < 10000), "fortnight")


def _shown(before: Column, evidence: Column, after: Column) -> Column:
    """The words around an amount that belong to it."""
    prefix = once(F.regexp_replace(before, "^.*[.;]", ""), lambda p: F.when(p.contains("$") | (F.length(p) > 35) | p.rlike(r"(?i)\bband\s*[1-8]\b"), "").otherwise(p))
    suffix = F.regexp_replace(after, r"(?i)\b(p)\.(\s*a)\.(?=\s|$|\+)", "$1\u0001$2\u0001")
    suffix = F.regexp_replace(suffix, r"(?i)\b(p)\.(\s*a)(?=\s|$|\+)", "$1\u0001$2")
    suffix = F.regexp_replace(suffix, r"(?i)\b(p\s*a)\.(?=\s|$|\+)", "$1\u0001")
    suffix = F.replace(F.regexp_replace(suffix, r"(?:(?<!\d)\.(?!\d)|;).*$", ""), F.lit("\u0001"), F.lit("."))
    suffix = once(suffix, lambda s: F.when(evidence.rlike(r"\d{1,3},\d{3}$"), F.regexp_replace(s, r"^\d+\b", "")).otherwise(s))
    suffix = F.regexp_replace(suffix, f"(?:{MARKERS}).*$", "")
    suffix = once(suffix, lambda s: F.when(s.rlike(r"(?i)\b(p\.?\s*a\.?|per annum|annum|year)\b") & s.rlike(r"\(\s*\$?\d"), F.regexp_replace(s, r" \(.*$", "")).otherwise(s))
    return F.substring(compact(F.concat(prefix, evidence, suffix)), 1, 300)


def candidates(text: Column) -> Column:
    """All candidates of a text, best first: score, minimum, maximum, period, evidence_text, text."""
    return once(compact(text), _candidates)


def _parts(clean: Column) -> Column:
    """Each amount with the words before and after it. The text is gone through once for each of amounts, gaps and what follows; what stands before is carried on from gap to gap."""
    whole = f"(?i)(?:{CORE})"
    names = ("first", "first_k", "second", "second_k", "single", "single_k")
    found = F.arrays_zip(
        F.split(clean, whole, -1).alias("gap"),
        F.regexp_extract_all(clean, F.lit(whole), F.lit(0)).alias("hit"),
        F.regexp_extract_all(clean, F.lit(f"{whole}(?=(.{{0,{AROUND}}}))"), F.lit(len(names) + 1)).alias("after"),
    )

    def carried(s: Column, x: Column) -> Column:
        before = F.substring(F.concat(s["tail"], x["gap"]), -AROUND, AROUND)
        groups = [F.regexp_extract(x["hit"], whole, i + 1).alias(n) for i, n in enumerate(names)]
        one = F.struct(before.alias("before"), x["hit"].alias("hit"), *groups, x["after"].alias("after"))
        return F.struct(F.concat(before, x["hit"]).alias("tail"), F.concat(s["out"], F.array(one)).alias("out"))

    # behind the last amount there is a gap without one
    start = F.struct(F.lit("").alias("tail"), F.array().cast(PARTS).alias("out"))
    return F.aggregate(F.filter(found, lambda x: x["hit"].isNotNull()), start, carried, lambda s: s["out"])


def _candidates(clean: Column) -> Column:
    groups = F.when(clean.rlike(r"\d"), _parts(clean)).otherwise(F.array().cast(PARTS))

    def scored(x: Column, i: Column, b: Column, period: Column) -> Column:
        high, window = F.greatest(b["first"], b["second"]), b["window"]
        money, context = window.contains("$") | F.lower(window).contains("aud"), window.rlike(CONTEXT)
        score = (
            F.when(x["single"] != "", 0).otherwise(10)
            + F.when(period.isNotNull(), 8).otherwise(0)
            + F.when(period == "year", 4).otherwise(0)
            + F.when(high >= 30000, 4).otherwise(0)
            + F.when(money, 3).otherwise(0)
            + F.when(context, 3).otherwise(0)
            - F.when(high < 20, 8).otherwise(0)
        )
        reference = _is_reference(b["evidence"], F.least(b["first"], b["second"]), high)
        ok = ~reference & ((high <= 350000) | window.rlike(LARGE_CONTEXT)) & (b["evidence"].contains("$") | F.lower(window).contains("aud") | context)
        shown = _shown(F.ltrim(x["before"]), b["evidence"], F.rtrim(x["after"]))
        return F.struct((-score).alias("order"), i.alias("at"), b["first"].alias("minimum"), b["second"].alias("maximum"), period.alias("period"), b["evidence"].alias("evidence_text"), shown.alias("text"), ok.alias("ok"))

    def one(x: Column, i: Column) -> Column:
        single = x["single"] != ""
        first = F.when(single, _amount(x["single"], x["single_k"])).otherwise(_amount(x["first"], x["first_k"]))
        second = F.when(single, _amount(x["single"], x["single_k"])).otherwise(_amount(x["second"], x["second_k"]))
        base = F.struct(first.alias("first"), second.alias("second"), compact(x["hit"]).alias("evidence"), compact(F.concat(x["before"], x["hit"], x["after"])).alias("window"))

        def with_period(b: Column) -> Column:
            low, high = F.least(b["first"], b["second"]), F.greatest(b["first"], b["second"])
            period = F.when(high >= 30000, "year").otherwise(F.coalesce(_nearest_period(x["before"], x["hit"], x["after"]), inferred_period(low, high, b["window"])))
            return once(period, lambda p: scored(x, i, b, p))

        return once(base, with_period)

    return F.array_sort(F.filter(F.transform(groups, one), lambda c: c["ok"]))


def extract(*texts: Column) -> Column:
    """The best candidate of the first text with any: minimum, maximum, period, evidence_text, text; null without."""
    return F.coalesce(*[F.get(candidates(t), F.lit(0)) for t in texts])


def normalised(text: Column, minimum: Column, maximum: Column, period: Column) -> Column:
    """Stored fields checked against their text: text, minimum, maximum, period."""
    clean = compact(text)
    base = F.struct(clean.alias("clean"), minimum.cast("double").alias("first"), F.coalesce(maximum.cast("double"), minimum.cast("double")).alias("second"), F.nullif(F.lower(compact(period)), F.lit("")).alias("stored"), F.when(clean != "", extract(clean)).alias("best"))
    return once(base, _checked)


def _checked(b: Column) -> Column:
    clean, first, second, stored, best = (b[x] for x in ("clean", "first", "second", "stored", "best"))
    low, high = F.least(first, second), F.greatest(first, second)
    result = lambda t, a, z, p: F.struct(t.alias("text"), a.alias("minimum"), z.alias("maximum"), p.alias("period"))
    parsed = result(best["text"], best["minimum"], best["maximum"], best["period"])
    best_low, best_high = F.least(best["minimum"], best["maximum"]), F.greatest(best["minimum"], best["maximum"])
    said_year = F.coalesce(F.when(high >= 30000, "year").otherwise(F.coalesce(stored, inferred_period(low, high, clean))) == "year", F.lit(False))
    better = clean.rlike(r"\d{1,3},\d{4,}") | high.isNull() | (high < 1000) & (best_high >= 1000) | (low < 1000) & (high >= 1000) & said_year
    tidier = (F.abs(low - best_low) < 0.01) & (F.abs(high - best_high) < 0.01) & (F.length(best["text"]) < F.length(clean))
    fixed = F.when((high >= 30000) & stored.isin("hour", "week", "fortnight"), "year").when(stored.isNull() & (high <= 300) & clean.contains("$"), "hour").otherwise(stored)
    lift = (high >= 30000) & (fixed == "year") & (low < 1000)
    kept = result(F.nullif(clean, F.lit("")), F.when(lift, high).otherwise(first), F.when(lift, high).otherwise(second), fixed)
    none = result(*[F.lit(None).cast(t) for t in ("string", "double", "double", "string")])
    reference = (clean != "") & F.coalesce(_is_reference(clean, low, high), F.lit(False))
    return F.when(reference, none).when(best.isNotNull() & F.coalesce(better | tidier, F.lit(False)), parsed).otherwise(kept)


def annual_interval(text: Column, minimum: Column, maximum: Column, period: Column) -> Column:
    """low and high of a year's pay of 30,000 or more, or null."""
    low, high = (lambda n: F.least(n["minimum"], n["maximum"])), (lambda n: F.greatest(n["minimum"], n["maximum"]))
    return once(normalised(text, minimum, maximum, period), lambda n: F.when((n["period"] == "year") & (high(n) >= 30000) & (low(n) > 0), F.struct(low(n).alias("low"), high(n).alias("high"))))
