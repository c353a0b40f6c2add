"""Text functions: cleaning, language, topics, relevance, page validity.  All are Column expressions."""

from __future__ import annotations

import html
from functools import reduce

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

# Marker words, keywords and signatures that results must agree on.
FR_MARKERS = [" le ", " la ", " les ", " de ", " des ", " et ", " pour ", " avec ", " une ", " un "]
EN_MARKERS = [" the ", " and ", " for ", " with ", " of ", " in ", " on ", " a ", " an "]
FR_RELIABLE = [" le ", " la ", " les ", " de ", " des ", " et ", " pour ", " avec ", " une ", " un ", " est ", " nous ", " vous ", " ils "]
EN_RELIABLE = [" the ", " and ", " for ", " with ", " of ", " in ", " on ", " is ", " are ", " was ", " that ", " this ", " have ", " has "]
ARTICLE_TYPES = [
    ("finance", ["stock", "shares", "valuation", "investors", "nasdaq", "market cap"]),
    ("product", ["launch", "product", "feature", "tool", "platform", "service", "software", "app"]),
    ("partnership", ["partnership", "collaboration", "partnered", "alliance"]),
    ("funding", ["funding", "raised", "investment round", "series a", "series b", "seed round"]),
]
SUBJECTS = [
    ("levee_fonds", ["funding round", "raised", "raises", "investment round", "series a", "series b", "seed round"]),
    ("nomination", ["appointed", "joins as", "new ceo", "chief executive officer"]),
    ("nouveau_produit_service", ["launches", "launched", "introduces", "new product", "new service", "unveiled"]),
    ("acquisition_rachat", ["acquisition", "acquire", "acquires", "acquired", "merger", "takeover"]),
    ("difficulte", ["layoffs", "bankruptcy", "losses", "shutdown", "restructuring"]),
    ("partenariat", ["partnership", "partners with", "collaboration", "alliance"]),
]
NEGATIVE = ["basketball", "football", "soccer", "golf", "tennis", "match", "fantasy", "shoe", "shoes", "recipe", "food", "kitchen", "lyrics", "coupon", "discount", "hotel", "travel"]
BLOCKED = ["checkingyourbrowser", "attentionrequired", "cloudflare", "captcha", "securitycheck", "verifyingthesecurity", "rayid"]
JS_BLOCKED = ["enable javascript", "javascript is required", "you need to enable javascript", "please enable javascript"]
LEGAL_TITLES = ["privacy policy", "cookie policy", "personal data protection", "terms of service", "terms and conditions", "legal notice"]
LEGAL_TERMS = ["privacy policy", "cookie policy", "personal data", "data protection", "terms of service", "terms and conditions", "legal notice", "gdpr", "rgpd", "politique de confidentialite", "mentions legales", "conditions generales"]
NAV_SIGNS = ["go to **", "skip to main content", "change location", "main navigation", "secondary menu", "header persistent"]
NOISE = r"(?i)cookie policy|privacy policy|terms of (?:use|service)|all rights reserved|subscribe to our newsletter|click here to|read more|share this article|follow us on|©\s*\d{4}|javascript is (?:disabled|required)|select your country|new articles\s*:|top \d+ articles|← previous|next →|\(current\)"
COUNTRY_LINES = "Algeria|Angola|Benin|Botswana|Burkina Faso|Cameroon|Central African Republic|Congo|Côte d'Ivoire|Djibouti|Egypt|Ethiopia|Gabon|Ghana|Guinea|Kenya|Liberia|Madagascar|Malawi|Mali|Mauritius|Morocco|Mozambique|Namibia|Niger|Nigeria|Senegal|Somalia|South Africa|Tanzania|Togo|Tunisia|Uganda|Afrique"


def blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def total(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def any_of(text: Column, terms: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(t) for t in terms])


def occurrences(text: Column, term: Column) -> Column:
    """Occurrences without overlap; 0 for the empty term."""
    n = F.char_length(term)
    return F.when(n > 0, ((F.char_length(text) - F.char_length(F.replace(text, term, F.lit("")))) / n).cast("long")).otherwise(F.lit(0).cast("long"))


def squeeze(c: Column) -> Column:
    """White space, the wider kinds too, to single spaces; trimmed."""
    return F.trim(F.regexp_replace(blank(c), r"(?U)\s+", " "))


def squeeze_or_null(c: Column) -> Column:
    return F.nullif(squeeze(c), F.lit(""))


def markers(text: Column, words: list[str]) -> Column:
    """How many different ones of the words the text holds."""
    return total([F.when(text.contains(w), 1).otherwise(0) for w in words])


def language(c: Column) -> Column:
    padded = F.concat(F.lit(" "), F.lower(blank(c)), F.lit(" "))
    return let(padded, lambda t: F.when(markers(t, FR_MARKERS) > markers(t, EN_MARKERS), "fr").otherwise("en"))


def language_reliable(c: Column, declared: Column) -> Column:
    text = blank(c)
    sample = F.concat(F.lit(" "), F.lower(F.substring(text, 1, 2000)), F.lit(" "))
    fr, en = markers(sample, FR_RELIABLE), markers(sample, EN_RELIABLE)
    fallback = F.when(declared.isin("fr", "en"), declared).otherwise("unknown")
    return F.when((F.char_length(text) < 50) | ((fr == 0) & (en == 0)), fallback).when(fr >= en, "fr").otherwise("en")


def article_type(c: Column) -> Column:
    def named(text: Column) -> Column:
        return F.coalesce(*[F.when(any_of(text, terms), name) for name, terms in ARTICLE_TYPES], F.lit("general"))

    return let(F.lower(blank(c)), named)


def subjects(c: Column) -> Column:
    found = let(F.lower(blank(c)), lambda text: F.array_compact(F.array(*[F.when(any_of(text, terms), name) for name, terms in SUBJECTS])))
    return let(found, lambda x: F.when(F.size(x) > 0, x).otherwise(F.array(F.lit("autre"))))


def relevance(company: Column, title: Column, text: Column) -> Column:
    """The score with its diagnosis as a struct."""
    name, title, text = F.lower(F.trim(blank(company))), F.lower(blank(title)), F.lower(blank(text))
    named, count = name != "", occurrences(text, name)
    hits = F.array_compact(F.array(*[F.when(title.contains(k) | text.contains(k), k) for k in NEGATIVE]))
    in_title = named & title.contains(name)
    score = F.when(in_title, 3).otherwise(0) + F.when(count >= 1, 2).otherwise(0) + F.when(count >= 2, 1).otherwise(0) - 3 * F.size(hits)
    return F.struct(score.alias("score"), in_title.alias("company_in_title"), count.alias("company_count"), hits.alias("negative_hits"), (F.char_length(text) > 200).alias("has_full_text"))


def _dense(c: Column) -> Column:
    return F.regexp_replace(blank(c), r"(?U)\s+", "")


def content_valid(c: Column) -> Column:
    dense = _dense(c)
    return (F.char_length(dense) >= 500) & ~any_of(F.lower(dense), BLOCKED)


def legal_page(c: Column) -> Column:
    text = F.lower(blank(c))
    hits = total([occurrences(text, F.lit(t)) for t in LEGAL_TERMS])
    return any_of(F.substring(text, 1, 500), LEGAL_TITLES) | (hits / (F.greatest(F.char_length(text), F.lit(1)) / F.lit(1000)) > 5)


def page_status(c: Column) -> Column:
    """Why a fetched page is used or not: struct (action, status, confidence)."""
    text = F.lower(blank(c))
    dense = _dense(text)
    n_lines = F.size(F.filter(F.split(blank(c), "\n"), lambda x: F.trim(x) != ""))
    signs = markers(text, NAV_SIGNS)
    verdict = lambda a, s, p: F.struct(F.lit(a).alias("action"), F.lit(s).alias("status"), F.lit(p).alias("confidence"))
    return (
        F.when(F.char_length(dense) < 500, verdict("skip", "too_short", 1.0))
        .when(any_of(dense, BLOCKED), verdict("flaresolverr", "bot_blocked", 0.95))
        .when(any_of(text, JS_BLOCKED), verdict("flaresolverr", "js_blocked", 0.9))
        .when((occurrences(text, F.lit("go to **")) > 20) | ((signs >= 2) & (n_lines > 150)), verdict("process", "nav_dump", 0.85))
        .when(legal_page(c), verdict("skip", "wrong_page", 0.85))
        .otherwise(verdict("process", "valid", 0.9))
    )


def squeeze_visible(c: Column) -> Column:
    """``squeeze`` without zero-width spaces."""
    return squeeze(F.replace(blank(c), F.lit("\u200b"), F.lit("")))


@F.pandas_udf(StringType())
def unescape(c: pd.Series) -> pd.Series:
    """All named and numeric character references, once; null stays null."""
    return c.map(html.unescape, na_action="ignore")


def keep_line(line: Column) -> Column:
    """False for noise phrases, lines that are a country's name, and lines of 1 to 3 characters."""
    return (line == "") | (~line.rlike(NOISE) & ~line.rlike(rf"(?iu)^(?:{COUNTRY_LINES})$") & (F.char_length(line) >= 4))


def clean_for_nlp(c: Column) -> Column:
    text = unescape(F.regexp_replace(blank(c), r"\{[^}]{1,30}\}", ""))
    for pattern, to in ((r"<[^>]+>", " "), (r"&[a-zA-Z#0-9]{1,10};", " "), (r"https?://\S+", ""), (r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")):
        text = F.regexp_replace(text, pattern, to)
    lines = F.transform(F.split(text, r"\r\n|[\n\r]"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
    text = F.array_join(F.filter(lines, keep_line), "\n")
    for pattern, to in ((r"(?U)([^\w\s])\1{2,}", "$1"), (r"\n{3,}", "\n\n"), (r" {2,}", " "), (r"(?U)^\s+|\s+$", "")):
        text = F.regexp_replace(text, pattern, to)
    return text
