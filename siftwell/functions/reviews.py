"""Review pages: the overall score, star shares, summaries; and quotations with their authors."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from siftwell.functions.profile import distinct_by, first
from siftwell.functions.text import blank, squeeze

# Fixed values.
MENTIONS = "Excellent|Bien|Moyen|Mauvais|Très mauvais"
SUMMARY_IDS = ["review-summary", "reviews-summary", "ai-summary"]
QUOTE = r"""(?s)["“„‘«](.{30,600}?)["”’»]\s*(?:[-–—]\s*)?([A-Z][A-Z\s]{2,40})(?:\s*[,\n]\s*(.{5,100}))?"""
NO_REVIEW = r"(?i)\b(?:certification|award|certifi|label|FTF|SWIFT\s+Certif|honored\s+to\s+receive|proud\s+to\s+win|ISO|SOC)\b"
MOST = 8


def score(html: Column) -> Column:
    """struct (score, mention, n_reviews, stars: map<int, struct<count, pct>>) of a review page: from the
    page's data, or its JSON-LD, or what it shows.  Halves round to even, as in the shown percentages."""
    data = first(html, r"""(?is)<script[^>]*\bid=["']?__NEXT_DATA__["']?[^>]*>(.*?)</script>""")
    linked = F.regexp_extract_all(blank(html), F.lit(r"""(?is)<script[^>]*\btype=["']application/ld\+json["'][^>]*>(.*?)</script>"""), F.lit(1))
    rating = lambda x: F.coalesce(F.get_json_object(x, "$.aggregateRating"), F.get_json_object(x, "$[0].aggregateRating"))
    rated = F.get(F.filter(F.transform(linked, rating), lambda x: F.get_json_object(x, "$.ratingValue").isNotNull()), F.lit(0))
    comma = lambda c: F.replace(c, F.lit("."), F.lit(","))
    in_data = first(data, r'"trustScore"\s*:\s*([\d.]+)')
    total = F.replace(F.format_number(first(data, r'"numberOfReviews"\s*:\s*\{[^}]*"total"\s*:\s*(\d+)').cast("long"), 0), F.lit(","), F.lit(" "))
    block = F.coalesce(first(data, r'"ratingDistribution"\s*:\s*(\[[^\]]+\])'), F.lit("[]"))
    stars = F.from_json(block, "array<struct<stars:int,count:long>>")
    every = F.aggregate(stars, F.lit(0).cast("long"), lambda s, x: s + x["count"])
    share = lambda n: F.coalesce(F.bround(n * 100 / F.nullif(every, F.lit(0).cast("long"))), F.lit(0)).cast("int")
    count = lambda k: F.aggregate(F.filter(stars, lambda x: x["stars"] == k), F.lit(0).cast("long"), lambda s, x: x["count"])
    shares = F.transform(F.sequence(F.lit(5), F.lit(1)), lambda k: F.struct(k, F.struct(count(k).alias("count"), share(count(k)).alias("pct"))))
    shown = first(html, r"(?is)>\s*(\d[\d\s,.]*(?:k\s+)?avis)\s*<")
    return F.struct(
        comma(F.coalesce(in_data, F.get_json_object(rated, "$.ratingValue"))).alias("score"),
        F.coalesce(first(data, r'"starsString"\s*:\s*"([^"]+)"'), first(html, rf"(?i)>\s*({MENTIONS})\s*<")).alias("mention"),
        F.coalesce(total, F.when(in_data.isNull(), F.get_json_object(rated, "$.reviewCount")), shown).alias("n_reviews"),
        F.when(F.size(stars) > 0, F.map_from_entries(shares)).alias("stars"),
    )


def without_contained(texts: Column) -> Column:
    """Longest first, without those that are part of one before."""
    longest = F.transform(F.array_sort(F.transform(texts, lambda t: F.struct((-F.char_length(t)).alias("n"), t.alias("t")))), lambda x: x["t"])
    return F.aggregate(longest, F.array().cast("array<string>"), lambda kept, t: F.when(F.exists(kept, lambda k: k.contains(t)), kept).otherwise(F.concat(kept, F.array(t))))


def summary(html: Column) -> Column:
    """The paragraphs of over 100 characters of a page's summary of its reviews; null if it has none."""
    ids = "|".join(SUMMARY_IDS)
    section = first(html, rf"""(?is)<(?:div|section|article)\b[^>]*\bdata-testid=["'](?:{ids})["'][^>]*>(.*?)(?:</section>|</article>|<section|<article|$)""")
    texts = F.transform(F.regexp_extract_all(blank(section), F.lit(r"(?is)<(p|span)\b[^>]*>(.*?)</\1>"), F.lit(2)), lambda t: squeeze(F.regexp_replace(t, "<[^>]*>", "")))
    long = F.filter(texts, lambda t: (F.char_length(t) > 100) & ~t.rlike(r"(?i)^voir (?:plus|moins)"))
    return F.nullif(F.array_join(without_contained(long), "\n\n"), F.lit(""))


def quotations(text: Column, own_name: Column) -> Column:
    """array<struct<quote, author, role>>: quoted passages followed by a name in capitals; none about
    awards or by people of the company itself; the first of each author, at most 8."""
    group = lambda k: F.regexp_extract_all(blank(text), F.lit(QUOTE), F.lit(k))
    found = F.arrays_zip(group(1).alias("quote"), group(2).alias("author"), group(3).alias("role"))
    found = F.transform(found, lambda x: F.struct(squeeze(x["quote"]).alias("quote"), F.trim(F.regexp_replace(x["author"], r"^\s+|\s+$", "")).alias("author"), F.trim(x["role"]).alias("role")))
    own = F.lower(blank(own_name))
    ok = F.filter(found, lambda x: (F.char_length(x["quote"]) >= 30) & ~x["quote"].rlike(NO_REVIEW) & ~((own != "") & F.lower(x["role"]).contains(own)))
    return F.slice(distinct_by(ok, lambda x: F.upper(x["author"])), 1, MOST)
