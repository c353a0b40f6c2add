"""Which links of a site to follow: rules, labels given from outside, caps; and sections with articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from siftwell.functions import markdown, urls
from siftwell.functions.text import any_of, blank, let, squeeze
from siftwell.operators import matching

# Fixed values.
LINK_RULES = [
    ("about", ["about", "a-propos", "qui-sommes", "story", "histoire", "mission", "vision", "gouvernance", "presentation", "company", "entreprise"]),
    ("team", ["team", "equipe", "direction", "management", "leadership", "dirigeant", "career", "careers", "carriere", "emploi", "recrutement"]),
    ("services", ["service", "solution", "offre", "produit", "expertise", "prestation", "catalog"]),
    ("clients", ["customer", "client", "reference", "cas-client", "temoignage", "portfolio", "realisations", "success"]),
    ("contact", ["contact", "nous-joindre", "location", "bureau", "agence", "siege", "adresse"]),
    ("technology", ["technology", "tech", "stack", "cloud", "devops", "infra", "cyber", "securite", "observ"]),
    ("partners", ["partner", "partenaire", "certification", "ecosystem", "alliance"]),
]
ARTICLE_SEGMENTS = "news|blog|blogs|press|actualite|article|post|insight|event|newsletter|rapport|report|cgu|terms|privacy|cookie|legal|sitemap"
NEWS_HOSTS = ["blog", "news", "press", "presse", "actualites", "media", "newsroom", "insights"]
NEWS_SECTIONS = ["blog", "news", "newsroom", "actualite", "actualites", "actualité", "actualités", "presse", "press", "articles", "insights", "publications", "stories", "announcements", "evenements", "événements", "events", "journal", "magazine", "revue", "nouvelles", "communiques", "communiqués", "noticias", "notícias", "akhbar"]
BAD_EXTENSIONS = ["jpg", "jpeg", "png", "gif", "webp", "svg", "pdf", "doc", "docx", "xls", "xlsx", "mp4", "mp3", "zip", "rar"]

#: Categories in the order of their priority, with the least score by embedding.
CATEGORIES = {"about": 0.33, "team": 0.33, "services": 0.35, "clients": 0.33, "contact": 0.32, "technology": 0.36, "partners": 0.36}
MARGIN, PENALTY, NEAREST = 0.04, 0.85, 3

RULE_SCORE, LABEL_SCORE = 1.0, 0.92


def rule_category(text: Column, slug: Column) -> Column:
    """The first category one of whose words is in a link's slug or text; null if none."""
    joined = F.lower(F.concat_ws(" ", blank(slug), blank(text)))
    # bound once: inlined into sort keys, 58 searches make more code than a method may have
    return let(joined, lambda j: F.coalesce(*[F.when(any_of(j, words), name) for name, words in LINK_RULES]))


def context(text: Column, start: Column, size: Column, window: int = 80) -> Column:
    """What stands within ``window`` code points of a place (from 0), without markdown."""
    low = F.greatest(start - window, F.lit(0))
    return plain_context(F.substring(blank(text), low + 1, start + size + window - low))


def plain_context(c: Column) -> Column:
    """A piece of markdown without its signs."""
    for pattern, by in [(r"\[([^\]]*)\]\([^)]+\)", "$1"), (r"!\[[^\]]*\]\([^)]+\)", ""), (r"#{1,4}\s*", ""), ("[*_`]", "")]:
        c = F.regexp_replace(c, pattern, by)
    return squeeze(c)


def scoring_text(text: Column, slug: Column, near: Column, weight: float = 0.3) -> Column:
    """What an embedding of a link is made of: its text twice and its slug, or the slug three times where
    the text is but a sign; and the context."""
    t, s = F.trim(blank(text)), F.trim(blank(slug))
    parts = F.when(F.char_length(t) <= 2, F.array(s, s, s)).otherwise(F.array(t, t, s))
    parts = F.concat(parts, F.array(blank(near))) if weight > 0 else parts
    return F.trim(F.array_join(F.filter(parts, lambda p: p != ""), " "))


def worth_scoring(href: Column, base: Column) -> Column:
    """Links of the site's own host that are no articles and not its home page."""
    site = F.regexp_replace(blank(base), "/+$", "")
    return (urls.source_host(href) == urls.source_host(base)) & ~href.rlike(f"(?i)/(?:{ARTICLE_SEGMENTS})/") & (F.regexp_replace(href, "/+$", "") != site)


def score_links(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """links(page_id, url, href, text, slug, position) -> those with a category, and its score and source:
    by rule, or by ``labels`` (page_id, href, category), answers landed from a model."""
    known = [name for name, _ in LINK_RULES]
    found = links.where(worth_scoring(F.col("href"), F.col("url"))).withColumn("rule", rule_category(F.col("text"), F.col("slug")))
    if labels is None:
        found = found.withColumn("label", F.lit(None).cast("string"))
    else:
        given = labels.select("page_id", "href", F.lower(F.trim("category")).alias("label")).where(F.col("label").isin(known))
        found = found.join(given.groupBy("page_id", "href").agg(F.min("label").alias("label")), ["page_id", "href"], "left")
    category, by_rule = F.coalesce("rule", "label"), F.col("rule").isNotNull()
    found = found.select("page_id", "url", "href", "text", "slug", "position", category.alias("category"), F.when(by_rule, RULE_SCORE).otherwise(LABEL_SCORE).alias("score"), F.when(by_rule, "rule").otherwise("label").alias("source"))
    return found.where("category is not null")


def score_by_embedding(links: DataFrame, vectors: DataFrame, anchors: DataFrame, thresholds: dict[str, float] = CATEGORIES) -> DataFrame:
    """links(vec_id, ...) with vectors(vec_id, embedding), made of their ``scoring_text`` -> the links whose
    best category reaches its threshold, with category, score and source, as ``pick_links`` takes them.

    anchors(category, anchor) are a rule table.  A score is the mean of the NEAREST best cosines to 4
    places; where the second category is closer than MARGIN it counts PENALTY times."""
    best = matching.best_category(matching.category_scores(vectors.select("vec_id", "embedding"), anchors, NEAREST), MARGIN, PENALTY, max(thresholds.values()), thresholds)
    return links.join(best, "vec_id").withColumn("source", F.lit("embedding"))


def bundle_links(pages: DataFrame, internal_only: bool = True) -> DataFrame:
    """pages(company_id, category, page_no, url, markdown) -> the links of ``markdown_links`` over all pages of a
    company, each address once: from the first page that has it, with that page as source."""
    ids = F.struct("company_id", "page_no", "category").alias("page_id")
    found = markdown_links(pages.select(ids, "url", "markdown"), internal_only)
    named = found.select(F.col("page_id.company_id").alias("company_id"), "href", F.struct(F.col("page_id.page_no").alias("page_no"), "start").alias("o"), F.struct("text", "slug", "near", "is_internal", F.col("page_id.category").alias("source_page")).alias("l"))
    return named.groupBy("company_id", "href").agg(F.min_by("l", "o").alias("l"), F.min("o").alias("o")).select("company_id", "href", "l.*", F.col("o.page_no").alias("page_no"), F.col("o.start").alias("start"))


def pick_links(scored: DataFrame, priority: list[str], per_category: int = 2, per_page: int = 9) -> DataFrame:
    """At most ``per_category`` links of each category and ``per_page`` of each page, in the order of
    categories, then the best score (rules before labels), then places; ``rank`` counts them."""
    order = F.array_position(F.array(*[F.lit(x) for x in priority]), F.col("category"))
    keyed = scored.withColumn("order", F.when(order > 0, order).otherwise(F.lit(len(priority) + 1)))
    best_first = [F.asc("order"), F.desc("score"), F.asc("position"), F.asc("href")]
    kept = keyed.withColumn("nth", F.row_number().over(Window.partitionBy("page_id", "category").orderBy(*best_first))).where(F.col("nth") <= per_category)
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("page_id").orderBy(*best_first))).where(F.col("rank") <= per_page)
    return kept.drop("order", "nth")


def markdown_links(pages: DataFrame, internal_only: bool = True) -> DataFrame:
    """pages(page_id, url, markdown) -> (page_id, url, href, text, slug, near, start, size, position, is_internal):
    the links of markdown that may be worth following, of each address the first; ``near`` is their context.

    Assets, other services, language switches, links without text and path and those to legal pages and
    the like are left out, and with ``internal_only`` those of other hosts.  A link around an image has
    the image's text.  Null markdown has no links; rows that repeat a page count once.
    """
    found = pages.select("page_id", "url", F.posexplode(markdown.links("markdown")).alias("position", "l"))
    found = found.select("page_id", "url", "position", "l.start", "l.size", F.trim(F.regexp_replace("l.text", r"!?\[([^\[\]]*)\](?:\([^)]*\))?", "$1")).alias("text"), "l.near", urls.normalized(F.regexp_replace("l.url", r"[) ]+$", "")).alias("href"))

    def ok(x: Column) -> Column:
        href, text, slug = x["l"]["href"], x["l"]["text"], x["slug"]
        good = ~urls.asset(href) & ~urls.external(href) & ~urls.locale_only(href) & ((text != "") | (slug != "")) & ~urls.unwanted(text, slug)
        return good & urls.internal(href, x["l"]["url"]) if internal_only else good

    # bound once: a filter moves below the columns that it names and would make each of them anew wherever it does
    kept = found.where(let(F.struct("href", "text", "url"), lambda l: let(F.struct(l.alias("l"), urls.slug(l["href"]).alias("slug")), ok)))
    slug, is_internal = urls.slug(F.col("href")), urls.internal(F.col("href"), F.col("url"))
    first = kept.groupBy("page_id", "href").agg(F.min_by(F.struct("url", "text", slug.alias("slug"), "near", "start", "size", "position", is_internal.alias("is_internal")), "start").alias("l"))
    return first.select("page_id", "href", "l.*").withColumn("near", plain_context(F.col("near")))


def link_maps(picked: DataFrame) -> DataFrame:
    """(page_id, links): the first link of each category, as a map of structs (url, text, score, source)."""
    first = picked.groupBy("page_id", "category").agg(F.min_by(F.struct(F.col("href").alias("url"), "text", "score", "source"), "rank").alias("link"))
    return first.groupBy("page_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("category", "link")))).alias("links"))


def extension(path: Column) -> Column:
    """What follows the last dot of the last segment, in lower case; empty if none."""
    return F.regexp_extract(F.lower(path), r"\.([^./]*)$", 1)


def bad_extension(url: Column) -> Column:
    return extension(urls.path(url)).isin(BAD_EXTENSIONS)


def same_domain(url: Column, domain: Column) -> Column:
    return urls.host(url).contains(domain)


def _segments(url: Column) -> Column:
    return F.filter(F.split(F.lower(urls.path(url)), "/"), lambda s: s != "")


def news_section(url: Column) -> Column:
    """A section with news: by its subdomain, or by the end of its path."""
    segments = _segments(url)
    last, before = F.get(segments, F.size(segments) - 1), F.get(segments, F.size(segments) - 2)
    words = "|".join(NEWS_SECTIONS)
    named = last.rlike(f"^(?:{words})|(?:{words})$") | before.isin(NEWS_SECTIONS)
    return F.substring_index(F.lower(urls.host(url)), ".", 1).isin(NEWS_HOSTS) | F.coalesce(named, F.lit(False))


def article_candidates(links: DataFrame, most: int = 25) -> DataFrame:
    """(page_id, href, tier): up to ``most`` links of each page that may be articles: within its site, no
    section, no file, not its root; those below a news section first.  One of each normalised URL."""
    href = urls.validated(F.col("href"))
    ok = links.select("page_id", "url", "position", href.alias("href")).where(same_domain(F.col("href"), urls.source_host(F.col("url"))) & ~bad_extension(F.col("href")) & ~F.coalesce(F.get(_segments(F.col("href")), F.size(_segments(F.col("href"))) - 1), F.lit("")).isin(["", *NEWS_SECTIONS]))
    tier = F.when(F.col("href").rlike(f"(?i)/(?:{'|'.join(NEWS_SECTIONS)})/"), 1).otherwise(2)
    once = ok.groupBy("page_id", "href").agg(F.min("position").alias("position")).withColumn("tier", tier)
    best = Window.partitionBy("page_id").orderBy("tier", "position", "href")
    return once.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= most).select("page_id", "href", "tier")


def next_pages(sections: DataFrame, upto: int = 4) -> DataFrame:
    """sections(url) -> (url, candidate): the usual addresses of the following pages of a listing; keep
    those that are landed by a semi-join."""
    base, k = F.regexp_replace("url", "/+$", ""), F.col("k")
    made = F.array(F.concat(base, F.lit("/page/"), k, F.lit("/")), F.concat(base, F.lit("?page="), k), F.concat(base, F.lit("?paged="), k), F.concat(base, F.lit("/page-"), k), F.concat(base, F.lit("/p/"), k))
    return sections.select("url", F.explode(F.transform(F.sequence(F.lit(2), F.lit(upto)), lambda n: n.cast("string"))).alias("k")).select("url", F.explode(made).alias("candidate"))
