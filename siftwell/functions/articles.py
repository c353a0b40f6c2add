"""Articles: dates, metadata of pages, what counts as one; clean records and groups of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siftwell.functions import text, urls
from siftwell.functions.profile import first, meta
from siftwell.functions.text import blank, let, squeeze

# Fixed values.
DATE_META = [("property", "article:published_time"), ("name", "pubdate"), ("name", "date"), ("name", "publish-date")]
DATE_FORMS = [
    (r"(?<!\d)(\d{4}-\d{1,2}-\d{1,2})(?!\d)", ["yyyy-M-d"]),
    (r"(?<!\d)(\d{1,2} [A-Z][a-z]+ \d{4})(?!\d)", ["d MMM yyyy", "d MMMM yyyy"]),
    (r"([A-Z][a-z]+ \d{1,2} \d{4})(?!\d)", ["MMM d yyyy", "MMMM d yyyy"]),
    (r"(?<!\d)(\d{1,2}-\d{1,2}-\d{4})(?!\d)", ["M-d-yyyy", "d-M-yyyy"]),
    (r"^(\d{8})$", ["yyyyMMdd"]),
]
REQUIRED = ["url", "published", "body", "language"]
PLACEHOLDER = r"\{[^{}]{1,30}\}"
MIN_BODY = 100
JS_MARKERS = ["__NEXT_DATA__", "__NUXT__", "data-wf-site", "data-reactroot", "ng-version", "data-vue-app"]
JS_ROOTS = "root|app|__next|gatsby-focus-wrapper"


def iso_date(raw: Column) -> Column:
    """yyyy-MM-dd of a date in any usual form, alone or within words, as it is written, whatever the time
    zone; empty if there is none.  Of two numbers the month comes first where it can."""
    c = F.regexp_replace(F.regexp_replace(squeeze(raw), r"(?i)(?<=\d)(?:st|nd|rd|th)\b", ""), r"(?<=[A-Za-z])\.|,", "")
    c = F.regexp_replace(F.initcap(c), r"(?<=\d)[/.](?=\d)", "-")
    tried = [F.to_date(F.try_to_timestamp(F.regexp_extract(c, p, 1), F.lit(f))) for p, formats in DATE_FORMS for f in formats]
    return F.coalesce(F.date_format(F.coalesce(*tried), "yyyy-MM-dd"), F.lit(""))


def metadata(html: Column, url: Column, body: Column) -> Column:
    """struct of what a page says about its article; ``body`` is its main text."""
    og = meta(html, "property", "og:title")
    title = let(og, lambda o: F.when(o != "", o).otherwise(squeeze(first(html, r"(?is)<title[^>]*>(.*?)</title>"))))
    any_meta = lambda pairs: F.coalesce(*[let(meta(html, *p), lambda v: F.nullif(v, F.lit(""))) for p in pairs], F.lit(""))
    described = any_meta([("name", "description"), ("property", "og:description")])
    short = F.when(F.char_length(body) > 300, F.concat(F.left(body, F.lit(300)), F.lit("..."))).otherwise(body)
    words = F.filter(F.transform(F.split(meta(html, "name", "keywords"), ","), lambda k: F.trim(k)), lambda k: k != "")
    return F.struct(
        title.alias("title"),
        urls.source_host(url).alias("source"),
        any_meta(DATE_META).alias("published"),
        text.language(F.when(blank(body) != "", body).otherwise(title)).alias("language"),
        any_meta([("name", "author"), ("property", "article:author")]).alias("author"),
        let(described, lambda d: F.when(d != "", d).otherwise(blank(short))).alias("excerpt"),
        words.alias("keywords"),
        text.subjects(body).alias("subjects"),
        text.article_type(body).alias("article_type"),
    )


def is_article(html: Column, url: Column, body: Column, bad_paths: list[str] = []) -> Column:
    """Is the page one article?  Files and ``bad_paths`` aren't; a long text, a date, an article element or
    the type say so; else a long title, unless the page calls itself a website."""
    from siftwell.operators.navigation import bad_extension

    path = F.lower(urls.path(url))
    refused = bad_extension(url)
    for p in bad_paths:
        refused = refused | path.contains(p)
    dated = F.lit(False)
    for pair in DATE_META:
        dated = dated | (meta(html, *pair) != "")
    kind = meta(html, "property", "og:type")
    titled = F.char_length(squeeze(first(html, r"(?is)<title[^>]*>(.*?)</title>"))) > 20
    return F.when(refused, False).when(F.char_length(blank(body)) > 300, True).when(dated | blank(html).rlike(r"(?i)<article[\s>]") | (kind == "article"), True).when(kind == "website", False).otherwise(F.coalesce(titled, F.lit(False)))


# Fixed values of the older rules.
OLD_BAD_WORDS = ["about", "team", "career", "job", "service", "legal", "privacy", "contact", "mission", "vision", "strategy"]
OLD_LISTS = ["/page/", "/tag/", "/tags/", "/category/", "/categories/", "/author/", "/authors/", "/search", "/feed"]
OLD_CLASSES = ["post", "article", "news", "card", "item", "teaser", "entry", "content"]
OLD_TEXT, OLD_LINES, OLD_ANCHOR, OLD_ABOVE = 400, 5, 20, 4


def is_plain_article(url: Column, body: Column) -> Column:
    """The older rule: no word of other pages in the address, a text of OLD_TEXT characters on over OLD_LINES lines."""
    named = text.any_of(F.lower(blank(url)), OLD_BAD_WORDS)
    return ~named & (F.char_length(blank(body)) >= OLD_TEXT) & (F.size(F.split(blank(body), "\n")) > OLD_LINES)


def is_listing(url: Column) -> Column:
    """Addresses of lists, searches and feeds, and roots; by the older rule no articles."""
    path = F.lower(urls.path(url))
    return text.any_of(path, OLD_LISTS) | path.isin("", "/")


def made_by_script(html: Column) -> Column:
    """Does the page need JavaScript to show what it holds?"""
    h = blank(html)
    bare = F.regexp_replace(F.regexp_replace(h, r"(?is)<(script|style|noscript)\b[^>]*>.*?</\1\s*>", ""), r"(?i)<(?:meta|link)\b[^>]*>", "")
    body = F.regexp_extract(bare, r"(?is)<body\b[^>]*>(.*)", 1)
    shown = F.char_length(squeeze(F.regexp_replace(body, r"(?s)<[^>]*>", " ")))
    empty_root = h.rlike(rf"""(?is)<(\w+)[^>]*\b(?:id=["']?(?:{JS_ROOTS})["']?[\s>]|data-reactroot)[^>]*>?\s*</\1>""")
    marked = F.lit(False)
    for m in JS_MARKERS:
        marked = marked | h.contains(m)
    size = F.char_length(h)
    return (size < 500) | ~bare.rlike(r"(?i)<body\b") | (shown < 200) | ((size > 10000) & (shown / size < 0.03)) | empty_root | (marked & (shown < 500))


def clean(articles: DataFrame) -> DataFrame:
    """articles(company, url, title, rss_title, published, rss_date, body, excerpt, language, source, author)
    as records for language processing: cleaned fields, ``missing`` of the required ones, ``ready``."""
    pick = lambda a, b: F.when(blank(F.col(a)) != "", F.col(a)).otherwise(blank(F.col(b)))
    raw = articles.withColumn("_raw", pick("body", "excerpt"))
    out = raw.select(
        "company",
        squeeze(F.regexp_replace(pick("title", "rss_title"), PLACEHOLDER, "")).alias("title"),
        urls.validated(F.col("url")).alias("url"),
        blank(F.col("source")).alias("source"),
        iso_date(pick("published", "rss_date")).alias("published"),
        blank(F.col("language")).alias("declared"),
        blank(F.col("author")).alias("author"),
        text.clean_for_nlp(F.regexp_replace(blank(F.col("excerpt")), PLACEHOLDER, "")).alias("excerpt"),
        text.clean_for_nlp(F.col("_raw")).alias("body"),
    )
    out = out.withColumn("language", text.language_reliable(F.col("body"), F.col("declared"))).drop("declared")
    missing = F.array_compact(F.array(*[F.when(blank(F.col(c)) == "", c) for c in REQUIRED]))
    n = F.char_length(F.coalesce("body", F.lit("")))
    return out.withColumn("missing", missing).withColumn("n_chars", n).withColumn("ready", (F.size("missing") == 0) & (F.col("n_chars") >= MIN_BODY))


def grouped(articles: DataFrame, key: str, fields: list[str], order: str) -> DataFrame:
    """(key, part, articles): the articles of each group as lists, in order.  A group of more than PART
    articles comes in several parts, so that no row grows without bound."""
    from siftwell.operators.records import numbered

    rows = numbered(articles.select(key, *fields), [key], [order], "_nth")
    lists = rows.select(key, *fields, F.floor(F.col("_nth") / PART).cast("int").alias("part")).groupBy(key, "part").agg(F.sort_array(F.collect_list(F.struct(order, *[f for f in fields if f != order]))).alias("articles"))
    return lists


#: Articles in a row of ``grouped``.
PART = 1000


def flattened(groups: DataFrame, key: str) -> DataFrame:
    """The groups' articles as rows again, each with its group's name; a group without any keeps one row."""
    return groups.select(key, F.explode_outer("articles").alias("a")).select(key, "a.*")


def newest(articles: DataFrame, most: int, date: str = "published", tie: str = "url") -> DataFrame:
    """The newest articles, those without a date last."""
    return articles.orderBy(F.desc(F.coalesce(F.col(date), F.lit(""))), F.asc(tie)).limit(most)


def most_relevant(articles: DataFrame, most: int, score: str = "relevance", tie: str = "url") -> DataFrame:
    """The articles with the highest scores, those without one last."""
    return articles.orderBy(F.desc_nulls_last(score), F.asc(tie)).limit(most)


def sorted_out(found: DataFrame) -> DataFrame:
    """found(url, is_article, body, error) with the outcome of each: ok, skipped with a reason, or error."""
    reason = F.when(F.col("error").isNotNull(), F.col("error")).when(~F.coalesce("is_article", F.lit(False)), "pas un article").when(F.trim(blank(F.col("body"))) == "", "texte vide")
    status = F.when(F.col("error").isNotNull(), "error").when(reason.isNotNull(), "skipped").otherwise("ok")
    return found.withColumn("status", status).withColumn("reason", reason)
