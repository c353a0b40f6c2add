"""Where a site's articles are: sitemaps, sections, listing pages and their links, tier by tier.

Everything works on landed content: ``sites`` (site: scheme and host), ``pages`` (url, html and, where
known, final_url after redirections) and sitemap ``entries`` (parent, kind, url).  A page that isn't
landed counts as one that couldn't be fetched.  Sitemaps are closed over by a semi-naive fixpoint; a
tier is only read for sites that the tiers above left short of their limit.

Defined cases: URLs are compared without fragment and closing slash, those of sections and articles
without their query too; null URLs and pages without html are ignored; a URL that is landed twice counts
once; maps that name each other are read once; a site without anything gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from siftwell.functions import articles, structure, urls
from siftwell.functions.text import any_of, let, squeeze
from siftwell.operators import matching, navigation, records
from siftwell.shared import written

# Fixed values.
SITEMAP_PATHS = ["/sitemap.xml", "/sitemap_index.xml", "/sitemap-index.xml", "/sitemaps/sitemap.xml", "/news-sitemap.xml", "/blog-sitemap.xml", "/post-sitemap.xml", "/page-sitemap.xml"]
SITEMAP_KEYWORDS = ["blog", "news", "article", "post", "press", "insight", "update", "publication", "media", "story", "stories", "actualite", "actualité", "actualites", "actualités", "presse", "journal", "magazine", "communique", "communiqué", "akhbar", "jadid", "maqal"]
NAV_KEYWORDS = [
    "blog", "news", "newsroom", "insights", "articles", "resources", "press", "updates", "media", "publications", "stories", "thoughts", "perspectives", "announcements",
    "events", "editorial", "digest", "briefing", "bulletin", "report", "reports", "whitepapers", "case-studies", "learn", "learning", "knowledge", "hub",
    "actualité", "actualités", "actualite", "actualites", "nos actualités", "notre actualité", "presse", "communiqué", "communique", "journal", "magazine", "revue", "publication", "publications",
    "événement", "evenement", "événements", "evenements", "annonce", "annonces", "dossier", "dossiers", "tribune", "tribunes", "veille", "nos nouvelles", "nouvelles", "la une",
    "noticias", "novedades", "prensa", "articulos", "artículos", "publicaciones", "notícias", "imprensa", "أخبار", "مدونة", "مقالات", "الأخبار", "akhbar", "maqalat", "jadeed",
]
SECTION_PATHS = [
    "/blog", "/news", "/newsroom", "/insights", "/articles", "/resources", "/press", "/updates", "/media", "/publications", "/stories", "/announcements", "/events", "/editorial",
    "/press-releases", "/press-room", "/knowledge", "/case-studies", "/whitepapers", "/reports", "/en/news", "/en/blog", "/en/insights", "/en/press", "/en/newsroom", "/en/resources",
    "/en/articles", "/en/updates", "/en/media", "/en/publications", "/en/stories", "/actualites", "/actualités", "/actualite", "/actualité", "/nos-actualites", "/nos-actualités",
    "/notre-actualite", "/notre-actualité", "/espace-presse", "/presse", "/communiques", "/communiqués", "/communique-de-presse", "/nos-articles", "/nos-publications", "/journal",
    "/magazine", "/revue", "/evenements", "/événements", "/annonces", "/nouvelles", "/nos-nouvelles", "/dossiers", "/veille", "/fr/news", "/fr/blog", "/fr/actualites", "/fr/insights",
    "/fr/press", "/fr/newsroom", "/fr/resources", "/fr/articles", "/fr/publications", "/fr/evenements", "/company/news", "/company/blog", "/company/press", "/company/updates",
    "/company/announcements", "/about/news", "/about/press", "/corporate/news", "/corporate/press", "/noticias", "/prensa", "/articulos", "/novedades", "/notícias", "/imprensa",
]
NEXT_TEXTS = ["next", "›", "»", "suivant"]
FIRST_NEXT_TEXTS = [*NEXT_TEXTS, "suivante", "2"]
FULL_PAGE = 500
LISTING_PAGES, LIMIT = 3, 25


def _listing(base: Column, n: Column) -> list[Column]:
    """The usual addresses of a listing's n-th page."""
    plain, k = F.regexp_replace(base, "/+$", ""), n.cast("string")
    return [F.concat(plain, F.lit("/page/"), k, F.lit("/")), F.concat(plain, F.lit("/page/"), k), F.concat(base, F.lit("?page="), k), F.concat(base, F.lit("?paged="), k), F.concat(base, F.lit("?p="), k)]


def sitemap_closure(entries: DataFrame, roots: DataFrame, keywords: list[str] = SITEMAP_KEYWORDS) -> DataFrame:
    """(root, url): the pages that the maps under each of ``roots`` (root) list, however deep; below a root only
    maps with a keyword in their URL are followed.

    Each round joins the entries with the maps that the round before found first (anti-join with all
    that are known), so cycles end and no map is read twice for a root.
    """
    followed = entries.where((F.col("kind") == "sitemap") & let(F.lower("url"), lambda u: any_of(u, keywords))).select("parent", F.col("url").alias("map"))
    followed = written(followed, "followed")  # read in each round
    known = new = written(roots.select("root", F.col("root").alias("map")).where("root is not null").distinct(), "maps")
    while not new.isEmpty():
        below = new.withColumnRenamed("map", "parent").join(followed, "parent").select("root", "map").distinct()
        new = written(below.join(known, ["root", "map"], "left_anti"), "maps")
        known = known.unionByName(new)
    pages = entries.where((F.col("kind") == "url") & F.col("url").isNotNull()).select(F.col("parent").alias("map"), "url")
    return known.join(pages, "map").select("root", "url").distinct()


def sitemap_articles(sites: DataFrame, entries: DataFrame, keywords: list[str] = SITEMAP_KEYWORDS) -> DataFrame:
    """(site, url): a site's pages with a keyword in their path, from the first of its usual sitemaps that
    lists any."""
    usual = F.posexplode(F.array(*[F.lit(p) for p in SITEMAP_PATHS])).alias("nth", "path")
    roots = sites.select("site", usual).select("site", "nth", F.concat("site", "path").alias("root"))
    landed = written(roots.join(entries.select(F.col("parent").alias("root")).distinct(), "root", "left_semi"), "roots")
    listed = landed.join(sitemap_closure(entries, landed, keywords), "root")
    of_site = listed.where(F.col("url").contains(urls.source_host(F.col("site"))) & any_of(F.lower(urls.path(F.col("url"))), keywords))
    first = of_site.groupBy("site").agg(F.min("nth").alias("nth"))
    return of_site.join(first, ["site", "nth"], "left_semi").select("site", "url").distinct()


def _landed(pages: DataFrame) -> DataFrame:
    """(url, html, final, address) of the rows with html; relative links are those of the address."""
    final = urls.validated(F.col("final_url")) if "final_url" in pages.columns else F.lit("")
    return pages.where("url is not null and html is not null").select(urls.normalized(F.col("url")).alias("url"), "html", final.alias("final"), F.trim("url").alias("address"))


def _read(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (url, ...) with the html, final and address of its pages.  Only those are moved: a few of all that is
    landed.  Of rows that land a URL again the first by content counts."""
    of_wanted = _landed(pages).join(wanted.select("url").distinct(), "url", "left_semi")
    once = records.keep_first(of_wanted, ["url"], [F.xxhash64("html", "address")])
    return wanted.join(once, "url")


def _anchors(pages: DataFrame, boilerplate: bool = True) -> DataFrame:
    """pages(site[, section], html, address) -> (site[, section], url, position, href, text)."""
    known = F.struct("site", *[c for c in ["section"] if c in pages.columns]).alias("page_id")
    return matching.page_links(pages.select(known, F.col("address").alias("url"), "html"), boilerplate).select("page_id.*", "url", "position", "href", "text")


def sections(sites: DataFrame, pages: DataFrame) -> DataFrame:
    """(site, section, is_news): what the home page's anchors name by text, path or query, and what is landed
    at a usual path; of those that lead to one page the first."""
    landed = _landed(pages)
    homes = _read(pages, sites.select("site", F.col("site").alias("url")).distinct()).select("site", "html", "address")
    query = F.lower(F.regexp_extract("href", r"\?([^#]*)", 1))
    named = any_of(F.lower(squeeze(F.col("text"))), NAV_KEYWORDS) | any_of(F.lower(urls.path(F.col("href"))), NAV_KEYWORDS) | any_of(query, NAV_KEYWORDS)
    in_site = navigation.same_domain(F.col("href"), urls.source_host(F.col("site")))
    of_nav = _anchors(homes).where(in_site & named).select("site", urls.validated(F.col("href")).alias("section"))
    usual = urls.path(F.col("url")).isin(SECTION_PATHS) & ~F.col("url").contains("?") & (F.char_length("html") > FULL_PAGE)
    of_path = landed.where(usual).select(urls.site(F.col("url")).alias("site"), F.col("url").alias("section")).join(sites.select("site").distinct(), "site", "left_semi")
    every = of_nav.unionByName(of_path).distinct()
    leads = landed.select(F.col("url").alias("section"), "final").where("final <> ''")
    leads = leads.groupBy("section").agg(F.min("final").alias("final"))
    every = every.join(leads, "section", "left").withColumn("page", F.coalesce("final", "section"))
    once = every.groupBy("site", "page").agg(F.min("section").alias("section"))
    return once.select("site", "section", navigation.news_section(F.col("section")).alias("is_news"))


# The sections that older lists of articles were read from.
OLD_PATHS = ["/", "/Newsroom", "/blog", "/news", "/insights", "/articles", "/resources", "/press", "/updates", "/media", "/publications", "/en/news", "/fr/news", "/en/News", "/fr/News", "/en/blog", "/fr/blog"]
OLD_PAGE = 200


def plain_articles(sites: DataFrame, pages: DataFrame) -> DataFrame:
    """(site, url): the older discovery: what anchors that may lead to articles name, on landed pages at OLD_PATHS with over
    OLD_PAGE characters; in the site, no list, no section, each once."""
    usual = F.explode(F.array(*[urls.normalized(F.concat("site", F.lit(p))) for p in OLD_PATHS])).alias("url")
    wanted = sites.where("site is not null").select("site", usual).distinct()
    links = _read(pages.where(F.char_length("html") > OLD_PAGE), wanted).select("site", "address", F.explode(structure.anchors("html")).alias("a")).where("a.may_be_article")
    href = links.select("site", urls.validated(urls.absolute(F.col("a.href"), F.col("address"))).alias("url")).where(navigation.same_domain(F.col("url"), urls.source_host(F.col("site"))))
    return href.where(~articles.is_listing(F.col("url")) & ~navigation.bad_extension(F.col("url"))).distinct().join(wanted, ["site", "url"], "left_anti")


def listing_pages(found: DataFrame, pages: DataFrame, most: int = LISTING_PAGES) -> DataFrame:
    """found(site, section) -> (site, section, n, url): each section and the pages that go on from it, up to
    ``most``: by the template that its first "next" link fits, as long as they are landed and full, or
    by following such links."""
    first = found.select("site", "section", F.lit(1).alias("n"), F.col("section").alias("url"))
    if most <= 1:
        return first
    two = F.regexp_replace(F.concat(urls.path(F.col("href")), F.lit("?"), F.regexp_extract("href", r"\?([^#]*)", 1)), r"\?$", "")
    is_next = F.lower(squeeze(F.col("text"))).isin(FIRST_NEXT_TEXTS) | two.rlike("[/=]2/?$")
    nexts = _anchors(_read(pages, first)).where(is_next).groupBy("site", "section").agg(F.min_by("href", "position").alias("next"))
    fits = F.array_position(F.array(*[urls.normalized(t) for t in _listing(F.col("section"), F.lit(2))]), urls.normalized(F.col("next")))
    nexts = written(nexts.withColumn("template", fits), "next")

    numbered = nexts.where("template > 0").select("site", "section", F.explode(F.sequence(F.lit(2), F.lit(most))).alias("n"), "template")
    address = F.get(F.array(*_listing(F.col("section"), F.col("n"))), (F.col("template") - 1).cast("int"))
    numbered = numbered.select("site", "section", "n", urls.normalized(address).alias("url"))
    full = _landed(pages).where(F.char_length("html") >= FULL_PAGE).select("url")
    full = full.join(numbered.select("url").distinct(), "url", "left_semi").distinct().withColumn("full", F.lit(True))
    numbered = numbered.join(full, "url", "left")
    end = F.min(F.when(F.col("full").isNull(), F.col("n"))).over(Window.partitionBy("site", "section"))
    numbered = numbered.withColumn("end", end).where("end is null or n < end").select("site", "section", "n", "url")

    chain = now = nexts.where("template = 0").select("site", "section", F.lit(2).alias("n"), urls.normalized(F.col("next")).alias("url")).where("url <> section")
    for n in range(3, most + 1):
        links = _anchors(_read(pages, now)).where(F.lower(squeeze(F.col("text"))).isin(NEXT_TEXTS))
        links = links.groupBy("site", "section").agg(urls.normalized(F.min_by("href", "position")).alias("url"))
        now = links.join(chain.unionByName(first), ["site", "section", "url"], "left_anti").select("site", "section", F.lit(n).alias("n"), "url")
        chain = chain.unionByName(now)
    return first.unionByName(numbered).unionByName(chain)


def section_links(listings: DataFrame, pages: DataFrame) -> DataFrame:
    """listings(site, section, n, url) -> (site, url, place): the links of their content that may be
    articles: in the site, no file, upload or root, not the page itself."""
    links = _anchors(_read(pages, listings.select("site", F.struct("section", "n").alias("section"), "url")), boilerplate=False)
    path = F.regexp_replace(F.lower(urls.path(F.col("href"))), "/+$", "")
    href = urls.validated(F.col("href"))
    ok = navigation.same_domain(F.col("href"), urls.source_host(F.col("site"))) & (path != "") & ~navigation.bad_extension(F.col("href")) & ~path.contains("/wp-content/") & ~path.contains("/uploads/") & (href != urls.validated(F.col("url")))
    return links.where(ok).select("site", href.alias("url"), F.struct(F.col("section.section").alias("section"), F.col("section.n").alias("n"), "position").alias("place"))


def discover(sites: DataFrame, pages: DataFrame, entries: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(site, url, tier, nth): up to ``limit`` article addresses of each site.

    Tiers: 0 sitemaps, 1 news sections with their further pages, 2 other sections, 3 the home page of
    sites without a news section that have nothing yet.  In a tier they come by section, page and place;
    sections themselves are no articles.
    """
    sites = sites.select("site").where("site is not null").distinct()
    known = written(sections(sites, pages), "sections")
    skipped = known.select("site", F.col("section").alias("url"))
    no_place = F.struct(F.lit("").alias("section"), F.lit(0).alias("n"), F.lit(0).alias("position"))
    root = F.lower(urls.path(F.col("url"))).isin("", "/")

    def tier_0(left: DataFrame) -> DataFrame:
        found = sitemap_articles(left, entries).select("site", urls.validated(F.col("url")).alias("url"), no_place.alias("place"))
        return found.where(~root & ~navigation.bad_extension(F.col("url")))

    def of_sections(left: DataFrame, news: bool, most: int) -> DataFrame:
        wanted = known.where(F.col("is_news") == news).join(left, "site", "left_semi")
        return section_links(listing_pages(wanted, pages, most), pages)

    def tier_3(left: DataFrame) -> DataFrame:
        bare = left.join(known.where("is_news"), "site", "left_anti").where("have = 0")
        return section_links(bare.select("site", F.col("site").alias("section"), F.lit(1).alias("n"), F.col("site").alias("url")), pages)

    left, taken = sites.withColumn("have", F.lit(0).cast("long")), []
    for tier, read in enumerate([tier_0, lambda x: of_sections(x, True, LISTING_PAGES), lambda x: of_sections(x, False, 1), tier_3]):
        rows = read(left).join(skipped, ["site", "url"], "left_anti").groupBy("site", "url").agg(F.min("place").alias("place"))
        for above in taken:
            rows = rows.join(above.select("site", "url"), ["site", "url"], "left_anti")
        order = Window.partitionBy("site").orderBy("place", "url")
        rows = rows.withColumn("k", F.row_number().over(order)).where(F.col("k") <= limit).join(left, "site")
        rows = rows.withColumn("nth", (F.col("k") + F.col("have")).cast("int")).where(F.col("nth") <= limit)
        taken.append(written(rows.select("site", "url", F.lit(tier).alias("tier"), "nth"), "tier"))
        more = taken[-1].groupBy("site").agg(F.count("*").alias("more"))
        left = left.join(more, "site", "left").select("site", (F.col("have") + F.coalesce("more", F.lit(0))).alias("have")).where(F.col("have") < limit)
    return reduce(DataFrame.unionByName, taken)
