"""Job titles: cleaning, checks, and recovery from addresses and text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adlens.functions.text import compact, excerpt, once, title_key

#: Words of roles, titles and addresses that are none, words that stay small or go from an address's end.
ROLES = (
    "accountant|administrator|adviser|advisor|analyst|assistant|auditor|business partner|case manager|coordinator|crew|developer|educator|engineer|graduate|inspector|labou?rer|lead|leader|librarian|"
    "manager|nurse|officer|operator|planner|project|ranger|receptionist|specialist|supervisor|surveyor|team leader|technician|trainee|worker"
)
MORE_ROLES = "driver|facilitator|instructor|leading hand|maintenance employee|producer|teacher"
ROLE = rf"(?i)\b({ROLES})\b"
EXPLORE_ROLE = rf"(?i)\b({ROLES}|{MORE_ROLES})\b"
GENERIC = (
    r"(?i)^(breadcrumb|recommended for you|apply for a job|careers?|current (opportunities|vacancies)|gtranslate|javascript is (?:turned off|not available).*|\d+\s+dismissed announcement|"
    r"search [0-9,]+ jobs? now|jobs?( and (careers|opportunities))?|employment opportunities|positions vacant|work(ing)? for council)$"
)
CONTEXT = (
    r"(?i)\b(applications? close|apply now|closing date|fixed term|full[- ]time|part[- ]time|permanent|position|responsibilities|role|salary|selection criteria|superannuation|successful applicant)\b"
)
JUNK = ("breadcrumb", "skip to content")
NO_TITLES = (
    "careers|careers at council|careers at yarra ranges|careers with us|breadcrumb|current opportunities|current vacancies|employment|employment opportunities|job vacancies|jobs|jobs and careers|"
    "jobs and opportunities|gtranslate|main navigation|menu|listen|about us|acknowledgement of country|alerts|apply for a job|business jobs and investment|contact us|cookie policy|"
    "employment hero work app|facebook|find a local job|help centre|hr login|instagram|linkedin|media centre|newsroom|our organisation|privacy policy|recommended for you|terms and conditions|"
    "youtube|positions vacant|work with us|working for council"
).split("|")
NO_TITLE_PATTERNS = (
    r"\bselect this as your preferred language\b",
    r"^javascript is (?:turned off|not available)",
    r"^\d+\s+dismissed announcement$",
    r"^search [0-9,]+ jobs? now$",
    r"^(about|business workshops|business,? jobs|contact|cookie|data processing|employee benefits|employment resources|employment support|financial disclosure|harvest work|implementation hub|integrations|looking to invest|payday super|products|quick demos|sales|service centre|solutions|support for your business|tenders and contracts|trust and legal|upper yarra local|why work for council)\b",
    r"^(canada|malaysia|new zealand|singapore|united kingdom)$",
    r"^employment (hero|shouldn|intelligently)",
    r"^find your next role with employment hero jobs$",
    r"^region of choice$",
    r"^start or grow your business$",
    r"^careers?( at| with|$)",
    r"^(current )?(job )?vacanc(y|ies)$",
    r"jobs? (and|or) (careers|opportunities)",
)
BAD_LINK_TITLES = (
    r"(?i)^(alerts|apply|apply for a job|login|register|view|read more|learn more|next|previous|about us|contact us|cookie policy|privacy policy|terms|facebook|instagram|linkedin|"
    r"tiktok|youtube|email|hr login|help centre|main navigation|gtranslate|javascript is not available\.?|javascript is turned off.*)$"
)
BAD_LINK_FRAGMENTS = r"(?i)(select this as your preferred language|employment hero|payday super|support for your business|start or grow your business|tenders and contracts|looking to invest|business workshops|business,? jobs and investment)"
SLUG_TAILS = ("job", "jobs", "career", "careers", "vic", "victoria", "australia", "jan", "january", "feb", "february", "mar", "march", "apr", "april", "may", "jun", "june", "jul", "july", "aug", "august", "sep", "sept", "september", "oct", "october", "nov", "november", "dec", "december")
SMALL = ("and", "at", "for", "in", "of", "on", "the", "to", "with")
#: How documents head a title, and what ends one at the start of a text.
TITLE_WORDS = r"([A-Z][A-Z0-9 &/'(),.-]{3,90}"
HEADINGS = (
    r"^(?:created\s+\d{1,2}/\d{1,2}/\d{4}\s+)?(?:page\s+\d+\s+)?position description\s+" + TITLE_WORDS + r"?)(?:\s+(?:Created|Classification|Employment Status|Position Details|Reports To|[A-Z][a-z]+(?:\s+[A-Z][a-z]+){0,4}\s+Council)\b)",
    r"^(?:page\s+\d+\s+)?(?:position description\s+)?" + TITLE_WORDS + r")\s+CLASSIFICATION\s*:",
    r"^(?:page\s+\d+\s+)?position description\s+" + TITLE_WORDS + r")\s+Created\s+\d{1,2}/\d{1,2}/\d{4}",
    r"^(?:page\s+\d+\s+)?" + TITLE_WORDS + r")\s+Created\s+\d{1,2}/\d{1,2}/\d{4}",
)
LEAD_END = r"(?: Visit | Kiosk mode | Add to favourites | Closing on:| Closing date:).*$"
LEAD = r"^([A-Z][A-Za-z0-9 &/'(),.-]{3,90}?)(?:\s+(?:New role|Full[- ]time|Part[- ]time|Permanent|Temporary|Fixed[- ]term|Casual|\$|Band|Classification|Salary)\b)"
MONTH_TAIL = r"(?i)\s+(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|jun(?:e)?|jul(?:y)?|aug(?:ust)?|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)(?:\s+20\d{2})?$"


def _without_tail(words: Column, tail: Column) -> Column:
    """words without the words of `tail` at their end."""
    n, m = F.size(words), F.size(tail)
    ends = (m > 0) & (n >= m) & (F.slice(words, F.greatest(n - m + 1, F.lit(1)), m) == tail)
    return F.when(ends, F.slice(words, F.lit(1), n - m)).otherwise(words)


def clean(c: Column, council: Column | None = None) -> Column:
    """A title without leads, codes, places, pay, terms, months, loose marks and the council's own name."""
    t = compact(c)
    t = F.regexp_replace(t, r"(?i)^(?:browse\s+jobs|search\s+jobs)\s+", "")
    t = F.regexp_replace(t, r"(?i)(?:\s+[0-9a-f]{4,}){2,}$", "")
    t = F.regexp_replace(t, r"(?i)\s+(?:vic|victoria)\s+australia(?:\s+[0-9a-f]{4,})*$", "")
    t = F.regexp_replace(t, r"\s+\$\d.*$", "")
    t = F.regexp_replace(t, r"(?i)^(.{9,}?)\s+(?:casual|permanent|temporary|fixed[- ]term|full[- ]time|part[- ]time)\s+position\b.*$", "$1")
    t = F.regexp_replace(t, r"^(.{9,}?)\s+(?:Type|Duration|Salary)\b.*$", "$1")
    t = F.regexp_replace(t, MONTH_TAIL, "")
    t = F.regexp_replace(t, r"\s+[\(\[\{]+$", "")
    t = F.regexp_replace(t, r"\s+[-,/:;]+$", "")
    if council is not None:
        tail = F.filter(F.split(F.lower(compact(council)), " "), lambda w: w != "")
        kept = lambda b: F.size(_without_tail(F.split(F.lower(b["t"]), " "), b["tail"]))
        t = once(F.struct(t.alias("t"), tail.alias("tail")), lambda b: F.when(kept(b) < 1, b["t"]).otherwise(F.array_join(F.slice(F.split(b["t"], " "), F.lit(1), F.greatest(kept(b), F.lit(1))), " ")))
    return compact(t)


def is_role(c: Column) -> Column:
    """A title of 4 to 140 characters with a word for a role, that isn't a page's own heading."""
    return once(compact(c), lambda t: F.length(t).between(4, 140) & ~t.rlike(GENERIC) & t.rlike(ROLE))


def is_shell(c: Column) -> Column:
    """Whether a title is empty or that of a page, not of a job."""
    patterns = "(?i)" + "|".join(f"(?:{p})" for p in NO_TITLE_PATTERNS)
    return once(title_key(c), lambda t: (t == "") | t.isin(*NO_TITLES) | t.rlike(patterns))


def cased(words: Column) -> Column:
    """Words as a title: each run of letters capitalised, small words but the first left small."""
    capital = lambda w: F.aggregate(
        F.regexp_extract_all(w, F.lit("([a-z]+|[^a-z]+)"), F.lit(1)), F.lit(""), lambda a, r: F.concat(a, F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 1000))
    )
    return F.array_join(F.transform(words, lambda w, i: F.when((i > 0) & w.isin(*SMALL), w).otherwise(capital(F.lower(w)))), " ")


def from_url(c: Column, council: Column | None = None) -> Column:
    """The title that an address's last part spells, or empty."""
    slug = F.lower(F.substring_index(F.regexp_replace(F.regexp_replace(compact(c), r"\?.*$", ""), "/+$", ""), "/", -1))
    words = F.filter(F.split(slug, "[^a-z0-9]+"), lambda w: w != "")
    noise = lambda w: w.isin(*SLUG_TAILS) | w.rlike("^[0-9a-f]{4,}$")
    last = lambda ws: F.array_max(F.transform(ws, lambda w, i: F.when(~noise(w), i + 1).otherwise(0)))
    words = once(words, lambda ws: F.slice(ws, F.lit(1), F.coalesce(last(ws), F.lit(0))))
    if council is not None:
        tail = F.filter(F.split(F.lower(compact(council)), "[^a-z0-9]+"), lambda w: w != "")
        words = once(F.struct(words.alias("ws"), tail.alias("tail")), lambda b: _without_tail(b["ws"], b["tail"]))
    return once(cased(F.filter(words, lambda w: ~w.rlike("^[0-9a-f]{8,}$"))), lambda t: F.when(is_role(t), t).otherwise(""))


def from_text(c: Column) -> Column:
    """The title that a page or document starts with, or empty: after its heading, or before the first mark of pay or terms."""
    spelt = lambda h: clean(cased(F.filter(F.split(F.lower(h), " "), lambda w: w != "")))
    heading = lambda t, p: once(F.regexp_extract(t, "(?i)" + p, 1), lambda h: F.when(h != "", role(spelt(h))))
    short = lambda t: F.regexp_replace(F.regexp_replace(F.regexp_replace(t, LEAD_END, ""), r" (?:\||-) .*$", ""), r"(?i)^New to you\s+", "")
    lead = lambda t: once(F.regexp_extract(t, LEAD, 1), lambda h: F.when(h != "", role(clean(h))))
    role = lambda x: once(x, lambda y: F.when(is_role(y), y))
    return once(compact(c), lambda t: F.coalesce(*[heading(t, p) for p in HEADINGS], once(F.trim(short(t)), lambda s: F.coalesce(lead(s), role(s))), F.lit("")))


def best(primary: Column, url: Column, fallback: Column | None = None, council: Column | None = None, body: Column | None = None) -> Column:
    """The title of a listing: its own if that names a role, else what the address, the body or the fallback says; each is looked at only if those before it name none."""
    role = lambda c: once(c, lambda t: F.when(is_role(t), t))
    told = [role(from_text(body))] if body is not None else []
    other = clean(fallback, council) if fallback is not None else F.lit("")
    last = lambda own: once(other, lambda o: F.coalesce(F.when(is_role(o), o), F.when(own != "", own), o))
    tried = once(clean(primary, council), lambda own: F.coalesce(F.when(is_role(own), own), role(from_url(url, council)), *told, last(own)))
    return excerpt(tried, 140)
