"""Links, embeddings and technology fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siftwell.functions import urls


def page_links(pages: DataFrame, boilerplate: bool = True) -> DataFrame:
    """(page_id, url, position, href, text): the anchors of pages that lead to web pages, in order, with
    absolute URLs.  Without ``boilerplate`` those in nav, header and footer elements are left out."""
    pattern = r"""(?is)<a\s[^>]*?href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>"""
    html = F.col("html") if boilerplate else main_content(F.col("html"))
    rows = pages.select("page_id", "url", F.posexplode(F.regexp_extract_all(html, F.lit(pattern), F.lit(0))).alias("position", "a"))
    part = lambda k: F.regexp_extract("a", pattern, k)
    rows = rows.select("page_id", "url", "position", urls.absolute(part(1), F.col("url")).alias("href"), F.trim(F.regexp_replace(part(2), "<[^>]*>", "")).alias("text"))
    return rows.where(urls.is_web(F.col("href")))


def main_content(html: Column) -> Column:
    """A page without its nav, header and footer elements."""
    return F.regexp_replace(html, r"(?is)<(nav|header|footer)\b[^>]*>.*?</\1\s*>", "")


def wanted_links(links: DataFrame) -> DataFrame:
    """Internal links worth following; the first of each page and URL among those accepted."""
    href = urls.normalized(F.col("href"))
    slug = urls.slug(href)
    ok = urls.internal(href, F.col("url")) & ~urls.external(href) & ~urls.locale_only(href) & ~((slug == "") & (F.col("text") == "")) & ~urls.unwanted(F.col("text"), slug)
    kept = links.where(ok).select("page_id", "position", "text", href.alias("href"), slug.alias("slug"))
    return kept.groupBy("page_id", "href").agg(F.min_by(F.struct("text", "slug", "position"), "position").alias("x")).select("page_id", "href", "x.*")


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)) + 1e-9)


#: Anchors of all categories: some megabytes as one row.
MOST_ANCHORS = 5000


def category_scores(vectors: DataFrame, anchors: DataFrame, top: int = 3) -> DataFrame:
    """(vec_id, scores: array<struct<category, score>>): the mean of the ``top`` best cosines with a category's
    anchors.  ``anchors`` (category, anchor) is a rule table of at most MOST_ANCHORS rows (more are an
    error): it is folded into one row, and that row is joined to each vector, so scores are made in the
    row without a shuffle of vectors."""
    if anchors.limit(MOST_ANCHORS + 1).count() > MOST_ANCHORS:
        raise ValueError(f"more than {MOST_ANCHORS} anchors")
    size = F.broadcast(anchors.groupBy("category").agg(F.collect_list("anchor").alias("anchors")).agg(F.sort_array(F.collect_list(F.struct("category", "anchors"))).alias("known")))

    def mean(c: Column) -> Column:
        best = F.slice(F.sort_array(F.transform(c["anchors"], lambda a: cosine(F.col("embedding"), a)), False), 1, top)
        return F.transform(F.array(best), lambda b: F.round(F.aggregate(b, F.lit(0.0), lambda s, v: s + v) / F.size(b), 4))[0]

    scores = F.transform("known", lambda c: F.struct(c["category"].alias("category"), mean(c).alias("score")))
    return vectors.join(size).select("vec_id", scores.alias("scores"))


def best_category(scores: DataFrame, margin: float = 0.04, penalty: float = 0.85, threshold: float = 0.33, thresholds: dict[str, float] | None = None) -> DataFrame:
    """(vec_id, category, score): the best category, penalised where the next one is close; none
    under the threshold, of which a category may have its own."""
    b = F.slice(F.array_sort(F.transform("scores", lambda x: F.struct((-x["score"]).alias("s"), x["category"].alias("category")))), 1, 2)
    listed = scores.select("vec_id", b.alias("b"))
    first, second = -F.get("b", F.lit(0))["s"], -F.get("b", F.lit(1))["s"]
    score = F.when(F.coalesce(first - second, F.lit(1.0)) < margin, F.round(first * penalty, 4)).otherwise(first)
    out = listed.select("vec_id", F.get("b", F.lit(0))["category"].alias("category"), score.alias("score"))
    least = F.lit(threshold)
    for name, own in (thresholds or {}).items():
        least = F.when(F.col("category") == name, own).otherwise(least)
    return out.where(F.col("score") >= least)


#: Points of a pattern in a page's html, whatever its case, and the signal's name.
SHOP_PATTERNS = [
    (r'"@type":\s*"Product"', 20, "schema:Product"),
    (r'"@type":\s*"Offer"', 15, "schema:Offer"),
    (r'"@type":\s*"ItemList"', 10, "schema:ItemList"),
    (r"add[_-]to[_-]cart", 10, "pattern:add-to-cart"),
    (r"data-product-id|product[_-]id", 8, "pattern:product-id"),
    (r"/cart\b|/checkout\b", 8, "pattern:cart-url"),
    (r'"sku"\s*:', 6, "pattern:sku"),
    (r'"price"\s*:\s*[\d"]', 6, "pattern:price"),
    (r"type=[\"']number[\"'].*quantit", 5, "pattern:quantity-input"),
    (r"free.shipping|livraison.gratuite", 4, "pattern:free-shipping"),
    (r"in.stock|out.of.stock|en.stock", 4, "pattern:stock"),
]


def ecommerce(pages: DataFrame, found: DataFrame, weights: DataFrame, flag: float = 15.0, most: int = 12) -> DataFrame:
    """(page_id, score, is_ecommerce, signals) of every page: weights (tech, weight) times confidences of
    its technologies, and the points of its patterns, capped at 100.  ``signals`` are the first ``most``
    names, technologies before patterns.  ``found`` is as ``fingerprints.detect`` gives it."""
    holds = [F.coalesce(F.col("html").rlike(f"(?iUd){p}"), F.lit(False)).alias(f"p{k}") for k, (p, _, _) in enumerate(SHOP_PATTERNS)]
    held = pages.select("page_id", *holds).groupBy("page_id").agg(*[F.bool_or(f"p{k}").alias(f"p{k}") for k in range(len(holds))])
    techs = found.join(F.broadcast(weights), "tech").groupBy("page_id").agg(F.sum(F.col("weight") * F.col("confidence")).alias("of_techs"), F.sort_array(F.collect_list("tech")).alias("techs"))
    points, names = F.coalesce("of_techs", F.lit(0.0)), []
    for k, (_, n, name) in enumerate(SHOP_PATTERNS):
        points += F.when(F.col(f"p{k}"), float(n)).otherwise(0.0)
        names.append(F.when(F.col(f"p{k}"), name))
    signals = F.slice(F.concat(F.coalesce("techs", F.array().cast("array<string>")), F.array_compact(F.array(*names))), 1, most)
    s = held.join(techs, "page_id", "left").select("page_id", F.round(F.least(F.lit(100.0), points), 1).alias("score"), signals.alias("signals"))
    return s.select("page_id", "score", (F.col("score") >= flag).alias("is_ecommerce"), "signals")
