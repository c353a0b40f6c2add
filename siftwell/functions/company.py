"""Company identifiers, amounts, sizes and scores, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from siftwell.functions.text import squeeze_or_null
from siftwell.functions.urls import domain, root_domain

# Fixed values.
EXCHANGES = {"US": ["NMS", "NYQ", "NGM", "ASE", "PCX"], "FR": ["EPA", "FRA", "PAR"], "DE": ["ETR", "FRA", "STU", "MUN"], "GB": ["LSE", "IOB"], "TN": ["TUN"], "MA": ["CAS"], "AE": ["DFM", "ADS"], "SA": ["SAU"], "EG": ["CAI"], "CH": ["SWX", "VTX", "EBS"], "NL": ["AMS"], "ES": ["MCE", "MAD"], "IT": ["MIL", "BIT"], "JP": ["TYO", "OSA"], "CN": ["SHA", "SHE"], "HK": ["HKG"], "IN": ["BSE", "NSI"], "BR": ["SAO"], "AU": ["ASX"], "CA": ["TSX", "TOR"], "SG": ["SGX"]}
LEGAL_SUFFIXES = "inc|incorporated|ltd|limited|llc|llp|lp|plc|corp|corporation|sa|sas|sarl|sasu|eurl|snc|sca|se|nv|bv|ag|gmbh|kg|group|grp|holding|holdings|international|intl|global|tech|technology|solutions|services|systems"
HEADCOUNT_LABELS = [(1, "holding_ou_vide"), (10, "TPE"), (50, "PE"), (250, "ME"), (5000, "ETI")]


def digits_of(c: Column, n: int) -> Column:
    """The digits, if they are exactly n: registry numbers of companies (9) and sites (14)."""
    d = F.regexp_replace(c, "[^0-9]", "")
    return F.when(F.char_length(d) == n, d)


def year(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, "((?:19|20)[0-9]{2})", 1), F.lit("")).cast("int")


def activity_code(c: Column) -> Column:
    return F.nullif(F.regexp_extract(F.upper(c), "([0-9]{4}[A-Z])", 1), F.lit(""))


def legal_form(c: Column) -> Column:
    return squeeze_or_null(F.split(c, r"(?:Num[eé]ro|Capital|Inscr|TVA|\d{5})")[0])


def age(founded: Column, as_of: int) -> Column:
    return F.when(founded != 0, F.lit(as_of) - founded)


def amount(c: Column) -> Column:
    """Value in euros of an amount as it is written; null if it can't be read.  "nc" counts as
    unavailable only as a whole."""
    raw = F.regexp_replace(c, r"(?U)\s", "")
    unavailable = F.lower(raw).rlike("indisponible|confidentiel|n/a|^nc$")
    unit = F.when(raw.rlike("(?i)g€|gb|milliard"), 1e9).when(raw.rlike("(?i)m€|m$|million"), 1e6).when(raw.rlike("(?i)k€|k$|millier"), 1e3).otherwise(1.0)
    number = F.replace(F.regexp_replace(raw, r"[^0-9,.\-]", ""), F.lit(","), F.lit("."))
    number = F.regexp_replace(number, r"\.(?=.*\.)", "")
    return F.when(~unavailable, F.round(number.try_cast("double") * unit, 2))


def headcount(c: Column) -> Column:
    """struct (low, high, label) of texts like "50 à 99 salariés"."""
    text = squeeze_or_null(c)
    part = lambda p, k: F.nullif(F.regexp_extract(text, p, k), F.lit("")).cast("int")
    span, single = r"(\d+)\s*à\s*(\d+)", r"(?i)(\d+)\s*salari"
    low, high = F.coalesce(part(span, 1), part(single, 1)), F.coalesce(part(span, 2), part(single, 1))
    return F.struct(low.alias("low"), high.alias("high"), headcount_label(high).alias("label"))


def headcount_label(n: Column) -> Column:
    out = None
    for limit, name in HEADCOUNT_LABELS:
        out = F.when(n < limit, name) if out is None else out.when(n < limit, name)
    return out.when(n.isNotNull(), "GE")


def plain_words(c: Column) -> Column:
    """Lower case, without punctuation."""
    s = F.regexp_replace(F.lower(F.trim(F.coalesce(c, F.lit("")))), r"(?U)[^\w\s]", " ")
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def plain_name(c: Column) -> Column:
    """Lower case, without legal suffixes and punctuation."""
    s = F.regexp_replace(F.coalesce(c, F.lit("")), rf"(?i)\b(?:{LEGAL_SUFFIXES})\b\.?", " ")
    s = F.regexp_replace(F.lower(F.trim(s)), r"(?U)[^\w\s]", " ")
    return F.trim(F.regexp_replace(s, r"\s+", " "))


def exchange_score(exchange: Column, country: Column) -> Column:
    known = F.create_map(*[x for k, v in EXCHANGES.items() for x in (F.lit(k), F.array(*[F.lit(e) for e in v]))])
    expected = F.try_element_at(known, F.upper(country))
    return F.when(F.coalesce(exchange, F.lit("")).isin("") | expected.isNull(), 0.3).when(F.array_contains(expected, exchange), 1.0).when(exchange.isin(EXCHANGES["US"]), 0.5).otherwise(0.1)


def type_score(kind: Column) -> Column:
    k = F.upper(F.coalesce(kind, F.lit("")))
    return F.when(k == "EQUITY", 1.0).when(k == "FUND", 0.5).when(k == "ETF", 0.2).otherwise(0.1)


def jaccard(a: Column, b: Column) -> Column:
    x, y = F.array_distinct(F.split(a, " ")), F.array_distinct(F.split(b, " "))
    return F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))


def domain_score(query: Column, website: Column, spelled: Column | None = None) -> Column:
    """1 for the same root, .85 where one contains the other, .6 for the same brand, .4 where brands are
    spelled alike (``spelled``, the ratio of siftwell.functions.fuzzy, over .85), else 0."""
    found = domain(website)
    return hosts_score(query, root_domain(query), found, root_domain(found), spelled)


def hosts_score(query: Column, q: Column, found: Column, c: Column, spelled: Column | None = None) -> Column:
    """``domain_score`` of two domains and their roots."""
    brand = lambda r: F.substring_index(r, ".", 1)
    alike = spelled > 0.85 if spelled is not None else F.lit(False)
    return F.when((query == "") | (found == ""), 0.0).when(q == c, 1.0).when(found.contains(query) | query.contains(found), 0.85).when((brand(q) != "") & (brand(q) == brand(c)), 0.6).when(alike, 0.4).otherwise(0.0)


def sales_score(siren: Column, vat: Column, sector: Column, low: Column, leaders: Column, size_label: Column, growth: Column, margin: Column, age_: Column) -> Column:
    """struct (score, label, priority) of a prospect."""
    has = lambda c: F.when(F.coalesce(c, F.lit("")) != "", 4).otherwise(0)
    steps = lambda c, *s: F.coalesce(*[F.when(c > k, p) for k, p in s], F.lit(0))
    led = F.coalesce(leaders, F.lit(0)) > 0
    size_points = F.when(size_label == "TPE", 5).when(size_label == "PE", 10).when(size_label == "ME", 15).when(size_label.isin("ETI", "GE"), 20).otherwise(0)
    points = has(siren) + has(vat) + has(sector) + F.when(low.isNotNull(), 4).otherwise(0) + F.when(led, 9).otherwise(0)
    points = points + size_points + steps(growth, (20, 30), (10, 25), (5, 20), (0, 10)) + steps(margin, (10, 15), (5, 10), (0, 5))
    points = points + F.when(F.coalesce(age_, F.lit(0)) == 0, 0).otherwise(F.when(age_ > 10, 10).when(age_ > 5, 7).otherwise(4))
    score = F.least(points, F.lit(100))
    label = F.when(score >= 75, "A").when(score >= 50, "B").when(score >= 25, "C").otherwise("D")
    return F.struct(score.alias("score"), label.alias("label"), F.when(score >= 75, "haute").when(score >= 50, "moyenne").otherwise("basse").alias("priority"))
