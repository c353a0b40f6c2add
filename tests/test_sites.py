"""Links, fingerprints, articles and matching on written cases."""

import random
import re
import timeit
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from siftwell.functions import articles, markdown, urls
from siftwell.operators import fingerprints, market, matching, names, navigation


def one(spark, expr, *values):
    names = "abcdefgh"[: len(values)]
    schema = ", ".join(f"{n} {'double' if isinstance(v, float) else 'string'}" for n, v in zip(names, values))
    return spark.createDataFrame([values], schema).select(expr(*[F.col(n) for n in names])).first()[0]


def test_absolute_urls_are_those_of_the_standard(spark):
    pages = ["https://h.com", "https://h.com/", "https://h.com/a/b/c.html", "http://h.com/a/?q=1#f", "https://h.com/a/b/"]
    links = ["x", "/x/y", "//cdn.z/y", "../up", "../../up/", "./here", "page2.html?k=/../v", "?q=1", "#top", "mailto:a@b.c", "javascript:go()", "https://o.org/z", "..", ".", "../..", "a/./b/../c", ""]
    rows = [(p, link) for p in pages for link in links]
    got = spark.createDataFrame(rows, "page string, link string").select("page", "link", urls.absolute(F.col("link"), F.col("page"))).collect()
    assert [(r[0], r[1], r[2]) for r in got] == [(p, link, urljoin(p, link) if link else p) for p, link in rows]


def test_page_links(spark):
    html = '<nav><a href="/menu">Menu</a></nav><p><a class=x href="mailto:a@b.c">Mail</a> <a href="../up">Up <b>there</b></a></p><footer><a href="/legal">L</a></footer>'
    pages = spark.createDataFrame([(1, "https://h.com/a/b/c", html), (2, None, None)], "page_id long, url string, html string")
    assert [r.href for r in matching.page_links(pages).orderBy("position").collect()] == ["https://h.com/menu", "https://h.com/a/up", "https://h.com/legal"]
    assert [(r.href, r.text) for r in matching.page_links(pages, boilerplate=False).collect()] == [("https://h.com/a/up", "Up there")]


def test_links_are_scored_and_picked(spark):
    base = "https://www.acme.com/"
    texts = [("/about-us", "About"), ("/team", "Our people"), ("/team/lead", "Leadership"), ("/team/third", "team 3"), ("/news/about-x", "About x"), ("/", "Home"), ("/xyz", "Misc"), ("/abc", "Other")]
    rows = [(1, base, urljoin(base, p), t, p.strip("/").replace("-", " ").replace("/", " "), k) for k, (p, t) in enumerate(texts)]
    rows.append((1, base, "https://sub.acme.com/contact", "Contact", "contact", 9))
    links = spark.createDataFrame(rows, "page_id long, url string, href string, text string, slug string, position int")
    labels = spark.createDataFrame([(1, base + "xyz", " Partners "), (1, base + "abc", "none")], "page_id long, href string, category string")
    scored = navigation.score_links(links, labels)
    assert {(r.href.split("/", 3)[3], r.category, r.score) for r in scored.collect()} == {("about-us", "about", 1.0), ("team", "team", 1.0), ("team/lead", "team", 1.0), ("team/third", "team", 1.0), ("xyz", "partners", 0.92)}
    picked = navigation.pick_links(scored, ["partners", "about", "team"], 2, 3)
    assert [r.href.split("/", 3)[3] for r in picked.orderBy("rank").collect()] == ["xyz", "about-us", "team"]
    found = navigation.link_maps(picked).first().links
    assert found["team"].url == base + "team" and found["partners"].source == "label"


def test_link_texts(spark):
    md = "start **bold** [a link](http://x.y) and ![pic](http://p.q) # end"
    assert one(spark, lambda c: navigation.context(c, F.lit(15), F.lit(20)), md) == "start bold a link and !pic end"
    assert one(spark, lambda t, s, c: navigation.scoring_text(t, s, c), "Team", "our team", "near") == "Team Team our team near"
    assert one(spark, lambda t, s, c: navigation.scoring_text(t, s, c), ">", "our team", "") == "our team our team our team"


@pytest.mark.parametrize("url,want", [("https://blog.a.com/x", True), ("https://a.com/newsroom/", True), ("https://a.com/press/2024", True), ("https://a.com/my-blog", True), ("https://a.com/x/y", False), ("https://a.com", False)])
def test_news_sections(spark, url, want):
    assert one(spark, navigation.news_section, url) is want


def test_article_candidates_and_next_pages(spark):
    base = "https://www.a.com/"
    rows = [(1, base, urljoin(base, p), k) for k, p in enumerate(["/other/x", "/news/", "/news/one", "/news/one/", "/f.pdf", "/", "https://b.org/news/z"])]
    links = spark.createDataFrame(rows, "page_id long, url string, href string, position int")
    assert {(r.href, r.tier) for r in navigation.article_candidates(links).collect()} == {(base + "news/one", 1), (base + "other/x", 2)}
    made = [r.candidate for r in navigation.next_pages(spark.createDataFrame([(base + "news",)], "url string"), 2).collect()]
    assert made == [base + "news" + x for x in ("/page/2/", "?page=2", "?paged=2", "/page-2", "/p/2")]


BS = "\\;"
FINGERPRINTS = {
    "jQuery": {"cats": [59], "scriptSrc": [r"jquery[.-]([\d.]*\d)[^/]*\.js" + BS + r"version:\1"]},
    "Shop": {"cats": [6], "headers": {"X-ShopId": ""}, "html": r"cdn\.shop\.example" + BS + "confidence:80", "implies": ["Liquid" + BS + "confidence:50", "Unknown"]},
    "Liquid": {"cats": [12]},
    "Broken((": {"html": "((bad" + BS + "confidence:60"},
    "Weak": {"html": "x" + BS + "confidence:40"},
    "Moment.js": {"html": "moment"},
    "Wp": {"cats": [999, 1, 11], "meta": {"generator": r"^WordPress ?([\d.]+)?" + BS + r"version:\1"}, "implies": "Php"},
    "Php": {"cats": [27], "cookies": {"PHPSESSID": ""}},
    "Pay": {"cats": [41], "js": {"Stripe.version": "", "ab": ""}},
    "Exact": {"js": {"Exact.v": r"Exact\.v\s*=\s*'([\d.]+)'" + BS + r"version:\1"}},
}
PAGE = '<script src="/a/jquery-3.6.1.min.js"></script><META name="Generator" content="WordPress 6.2"><script>var s = new Stripe("k"); Exact.v = \'1.2\'; ab</script> CDN.shop.example ((bad x moment'


def test_fingerprints(spark):
    rows = [(1, "https://a.com/x", PAGE, {"x-shopid": "1"}, {"phpsessid": ""}), (2, "b.org", PAGE.replace("jquery", "JQuery"), None, None), (3, None, None, None, None), (4, "c.org", " ", None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, headers map<string,string>, cookies map<string,string>")
    found = fingerprints.detect(pages, FINGERPRINTS)
    got = {(r.page_id, r.tech): (r.confidence, r.version, r.field) for r in found.collect()}
    always = {"jQuery": (1.0, "3.6.1", "js_libraries"), "Liquid": (0.75, "", "frontend_framework"), "Broken((": (0.6, "", ""), "Wp": (1.0, "6.2", "cms"), "Pay": (0.65, "", "payment_gateways"), "Exact": (0.85, "1.2", "")}
    assert got == {(p, t): v for p in (1, 2) for t, v in {**always, "Shop": (1.0 if p == 1 else 0.8, "", "platform"), "Php": (1.0 if p == 1 else 0.75, "", "")}.items()}
    weights = spark.createDataFrame(fingerprints.Detector(FINGERPRINTS).shop_weights(), "tech string, weight double")
    stack = {r.page_id: r for r in fingerprints.stacks(pages, found, matching.ecommerce(pages, found, weights)).collect()}
    assert (stack[1].domain, stack[1].ssl, stack[1].n_technologies, stack[1].fields["cms"], stack[1].technologies["Wp"]) == ("a.com", True, 8, ["Wp"], "6.2")
    assert stack[1].score == 43.0 and stack[2].domain == "b.org" and stack[3].n_technologies == 0 and stack[4].fields is None
    assert fingerprints.load([{"a": {"cats": [1]}}, {"a": {"cats": [2]}, "b": {}}]) == {"a": {"cats": [2]}, "b": {}}


def test_literals_are_in_every_match():
    for regex, want in [(r"jquery[.-]([\d.]*\d)\.js", "jquery"), ("(?:ab|cd)efg+", "ef"), ("a|b", ""), ("x(?:yz){2,}", "yz"), ("^Ab?c", "a"), ("(abc)?de", "de"), ("K", "k"), ("K", "")]:
        assert fingerprints.needed_literal(regex) == want, regex


@pytest.mark.parametrize("raw,want", [
    ("2024-03-05T10:11:12.123Z", "2024-03-05"), ("2024-03-05T10:11:12+02:00", "2024-03-05"), ("Tue, 05 Mar 2024 10:11:12 GMT", "2024-03-05"), ("5 mars", ""), ("March 5, 2024", "2024-03-05"),
    ("mar 5, 2024", "2024-03-05"), ("5 March 2024", "2024-03-05"), ("5th march 2024", "2024-03-05"), ("03/05/2024", "2024-03-05"), ("25/12/2024", "2024-12-25"), ("Published on 2024-03-05 by me", "2024-03-05"), ("20240305", "2024-03-05"), ("", ""), (None, ""), ("no date", ""),
])
def test_dates(spark, raw, want):
    assert one(spark, articles.iso_date, raw) == want


def test_metadata_and_articles(spark):
    html = '<html><head><title>A page</title><meta property="og:title" content="The real  title"><meta name="date" content="2024-01-02"><meta name="keywords" content="a, b,,c "><meta property="article:author" content="Ann"></head><body>x</body></html>'
    body = "The story of a product launch and the company that is behind it. " * 6
    m = one(spark, articles.metadata, html, "https://www.news.org/a", body)
    assert (m.title, m.source, m.published, m.author, m.keywords, m.language) == ("The real title", "news.org", "2024-01-02", "Ann", ["a", "b", "c"], "en")
    assert m.excerpt == body[:300] + "..."
    cases = [("<p>x", "https://a.com/f.pdf", body, False), ("<p>x", "https://a.com/careers/1", body, False), ("<p>x", "https://a.com/1", body, True), ("<article>x", "https://a.com/1", "", True), ('<meta property="og:type" content="website"><title>A title of more than twenty</title>', "https://a.com/1", "", False), ("<title>A title of more than twenty</title>", "https://a.com/1", "", True), ("<title>Short</title>", "https://a.com/1", None, False), (None, None, None, False)]
    for h, u, b, want in cases:
        assert one(spark, lambda x, y, z: articles.is_article(x, y, z, ["/careers"]), h, u, b) is want


def test_pages_made_by_script(spark):
    words = "<p>" + "some visible words here " * 40 + "</p>"
    for html, want in [(None, True), ("<body>short</body>", True), (f"<body>{words}</body>", False), (words, True), (f"<body>{words}</body>" + "<!--" + "x" * 60000 + "-->", True), (f'<body><div id="root"></div>{words}</body>', True), ("<body>" + "word " * 60 + "</body><script>" + "y" * 600 + "__NUXT__</script>", True)]:
        assert one(spark, articles.made_by_script, html) is want, html


def test_clean_articles_groups_and_order(spark):
    fields = "company string, url string, title string, rss_title string, published string, rss_date string, body string, excerpt string, language string, source string, author string"
    body = "The company is growing and the market is in a good state for this product. " * 3
    rows = [("A", "https://a.com/x/?q", "{ad} Title ", None, None, "Tue, 05 Mar 2024 10:11:12 GMT", body, "{x} short", "fr", "s", None), ("A", "ftp://x", None, "From feed", "?", None, None, None, None, None, None), ("B", None, None, None, None, None, None, None, None, None, None)]
    got = articles.clean(spark.createDataFrame(rows, fields)).collect()
    assert (got[0].title, got[0].url, got[0].published, got[0].language, got[0].missing, got[0].ready, got[0].author) == ("Title", "https://a.com/x", "2024-03-05", "en", [], True, "")
    assert got[1].title == "From feed" and got[1].missing == ["url", "published", "body"] and not got[1].ready and got[1].language == "unknown"
    items = spark.createDataFrame([("A", f"u{k}", f"2024-01-{k + 1:02}") for k in range(5)] + [("B", "v", None)], "company string, url string, published string")
    old, articles.PART = articles.PART, 2
    try:
        groups = articles.grouped(items, "company", ["url", "published"], "url")
        assert sorted((r.company, r.part, len(r.articles)) for r in groups.collect()) == [("A", 0, 2), ("A", 1, 2), ("A", 2, 1), ("B", 0, 1)]
        assert sorted(map(tuple, articles.flattened(groups, "company").collect())) == sorted(map(tuple, items.collect()))
    finally:
        articles.PART = old
    assert [r.url for r in articles.newest(items, 2).collect()] == ["u4", "u3"]
    found = spark.createDataFrame([("a", True, "x", None), ("b", False, "x", None), ("c", True, " ", None), ("d", None, None, "timeout")], "url string, is_article boolean, body string, error string")
    assert [(r.status, r.reason) for r in articles.sorted_out(found).orderBy("url").collect()] == [("ok", None), ("skipped", "pas un article"), ("skipped", "texte vide"), ("error", "timeout")]


def test_market_matching(spark):
    companies = spark.createDataFrame([(1, "https://www.capgemini.com/fr", "Capgemini SE", "France"), (2, "https://linkedin.com/x", "Blue Sky Corp", "usa"), (3, None, None, None), (4, "https://siemens.de", "Siemens", "Allemagne")], "company_id long, url string, name string, country string")
    quotes = spark.createDataFrame([("CAP.PA", "Capgemini SE", "CAPGEMINI", "PAR", "EQUITY", "https://www.capgemini.com"), ("CAPX", "Capgemini Fund", None, "NMS", "ETF", None), ("BLUE", "Blue Sky Inc", "Blue Sky", "NMS", "EQUITY", None), ("SIE", "Siemens AG", None, "ETR", "EQUITY", "https://siemens.com")], "symbol string, longname string, shortname string, exchange string, quote_type string, website string")
    best = {r.company_id: r for r in market.best_quotes(market.quote_candidates(companies, quotes)).collect()}
    assert {k: (r.symbol, r.score, r.method, r.level) for k, r in best.items()} == {1: ("CAP.PA", 1.0, "domain", "excellent"), 2: ("BLUE", 1.0, "name_country", "excellent"), 4: ("SIE", 0.8, "domain", "excellent")}
    entries = spark.createDataFrame([(1, "77", 60, "moyen")], "company_id long, entry_id string, score int, level string")
    found = {r.company_id: (r.source, r.key, r.confidence) for r in market.route(companies, entries, market.best_quotes(market.quote_candidates(companies, quotes))).collect()}
    assert found == {1: ("registry", "77", 0.6), 2: ("market", "BLUE", 1.0), 3: ("no_keys", None, None), 4: ("market", "SIE", 0.8)}
    assert market.best_quotes(market.quote_candidates(companies.limit(0), quotes)).count() == 0


@pytest.mark.parametrize("args,want", [
    (("Acme", "acme", "1 rue X 75001 Paris", "2 rue Y 75001 PARIS"), (100, "excellent")),
    (("Acme", "Acme Group", None, "x"), (25, "faible")),
    (("Blue Sky Ltd", "Sky Blue", "Lyon", "3 place de lyon"), (30, "faible")),
    (("a b", "c d", "", "x"), (0, "faible")),
])
def test_registry_scores(spark, args, want):
    assert tuple(one(spark, market.registry_score, *args)) == want


def test_addresses_and_countries(spark):
    assert one(spark, market.city, "12 rue X, 75001, Lyon, France", "France") == "Lyon"
    assert one(spark, market.city, "12 rue de la Paix Paris France", "france") == "de la Paix Paris"
    assert one(spark, market.city, None, "France") == ""
    assert [one(spark, market.iso2, c) for c in ("Pays-Bas", "United States", "Mars", None)] == ["NL", "US", "", ""]
    assert (one(spark, market.postcode, "1 rue X 75001 Paris"), one(spark, market.town, "1 rue X 75001  Saint Denis, x"), one(spark, market.postcode, None)) == ("75001", "Saint Denis", None)
    assert [one(spark, market.percent, 0.1234), one(spark, lambda c: market.percent(c, True), 0.05)] == ["12.3%", "+5.0%"]
    for answer in ('{"finance":{"result":[{"quotes":[{"symbol":"A"}]}]}}', '{"finance":{"result":{"quotes":[{"symbol":"A"}]}}}', '{"quotes":[{"symbol":"A"}]}'):
        assert [q.symbol for q in one(spark, lambda c: market.quotes_of(c, "struct<symbol:string>"), answer)] == ["A"]
    assert one(spark, lambda c: market.quotes_of(c, "struct<symbol:string>"), "no json") == []


def test_registry_history(spark):
    rows = [["Bilan", "2022", "2023"], ["Chiffre d'affaires", "1 000 €", "2,5 M€"], ["Résultat net", "nc", "250 000 €"], ["Capitaux propres", "1 M€", "1 M€"], ["Dettes financieres", "x", "1,5 M€"], ["Autre", "1", "2"], ["CA", "9 €"]]
    tables = spark.createDataFrame([(1, 0, [["no"], ["CA", "5 €"]]), (1, 1, rows), (2, 0, rows)], "company_id long, table_no int, rows array<array<string>>")
    answers = spark.createDataFrame([(2, 0, '{"a":{"ca_2023":7,"b":[{"resultat_2023":1}],"x":{"ca2023":8}}}'), (3, 0, "no json"), (3, 1, None)], "company_id long, position int, json string")
    contexts = spark.createDataFrame([(1, 0, "2023", "in 2023 about 900 000 €"), (3, 0, "2021", "some 1 200 000 € then"), (3, 1, "2021", "5 000 €"), (3, 2, None, "5 000")], "company_id long, position int, year string, context string")
    from siftwell.operators import registry

    got = {(r.company_id, r.source, r.year, r.field): r.value for r in registry.history(answers, tables, contexts).collect()}
    assert got == {(1, "html_table", 2022, "ca"): 1000.0, (1, "html_table", 2023, "ca"): 2.5e6, (1, "html_table", 2023, "resultat_net"): 250000.0, (1, "html_table", 2022, "capitaux_propres"): 1e6, (1, "html_table", 2023, "capitaux_propres"): 1e6, (1, "html_table", 2023, "dettes_financieres"): 1.5e6, (2, "xhr", 2023, "ca"): 8.0, (3, "regex_fallback", 2021, "ca_estimate"): 1200000.0}
    last = {r.company_id: r for r in registry.latest_ratios(registry.history(answers, tables, contexts)).collect()}
    assert (last[1].year, last[1].margin_pct, last[1].debt_ratio, last[1].debt_signal) == (2023, 10.0, 1.5, "surveiller") and last[2].margin_pct is None
    assert [r.year for r in registry.by_year(registry.of_tables(tables)).where("company_id = 1").collect()] == [2023, 2022]


def test_responses(spark):
    from siftwell.functions import responses

    raw = 'Here: {"company_name":" Acme ","description":["a ","b"],"services":["ok service","x",3],"clients":[],"team_leaders":[{"name":"Ann","title":null},{"title":"x"}],"founded_year":"1998","employees_count":12,"reviews":["short","long enough text"]} done'
    r = one(spark, responses.fields_of, raw)
    assert (r.company_name, r.description, r.services, r.clients, r.founded_year, r.employees_count, r.reviews) == ("Acme", "a b", ["ok service"], None, 1998, "12", ["long enough text"])
    assert [tuple(p) for p in r.team_leaders] == [("Ann", "")]
    assert all(x is None for bad in ("none {", "", None) for x in one(spark, responses.fields_of, bad))
    companies = spark.createDataFrame([(1, None, "x"), (2, "b", None)], "id long, name string, city string")
    found = spark.createDataFrame([(1, "A", "y"), (2, "B", "")], "id long, name string, city string")
    assert sorted(map(tuple, responses.fill(companies, found, "id").collect())) == [(1, "A", "x"), (2, "b", None)]


def test_reviews(spark):
    from siftwell.functions import reviews

    data = '<script id="__NEXT_DATA__" type="application/json">{"trustScore": 4.3, "numberOfReviews": {"total": 12345}, "starsString": "Excellent", "ratingDistribution": [{"stars": 5, "count": 1}, {"stars": 1, "count": 7}]}</script>'
    r = one(spark, reviews.score, data)
    assert (r.score, r.mention, r.n_reviews, r.stars[5].pct, r.stars[1].pct, r.stars[3]["count"]) == ("4,3", "Excellent", "12 345", 12, 88, 0)
    r = one(spark, reviews.score, '<script type="application/ld+json">[{"aggregateRating":{"ratingValue":3.5,"reviewCount":9}}]</script><p>Bien</p>')
    assert (r.score, r.mention, r.n_reviews, r.stars) == ("3,5", "Bien", "9", None)
    r = one(spark, reviews.score, None)
    assert (r.score, r.mention, r.n_reviews, r.stars) == (None, None, None, None)
    long = "A sentence that is long enough to be told in a summary. " * 3
    assert one(spark, reviews.summary, f'<section data-testid="ai-summary"><p>{long}</p><span>{long[:120]}</span><p>short</p></section><p>{long} other</p>') == long.strip()
    assert one(spark, reviews.summary, "<p>none</p>") is None
    quote = '"This product has changed the way in which we work" - JANE DOE, Head of sales at Client'
    text = "“An award for the best of all that was ever made here” BOB ROE, x" + " of it" * 20 + '\n"It is what the head of it all has said" ANN LEE, Chief of ACME' + " so" * 40 + f"\n{quote}" + " and" * 30 + '\n"It is the second thing that this person says here" JANE DOE'
    got = one(spark, lambda t: reviews.quotations(t, F.lit("Acme")), text)
    assert [(q.quote, q.author) for q in got] == [("This product has changed the way in which we work", "JANE DOE")] and got[0].role.startswith("Head of sales at Client")
    assert one(spark, lambda t: reviews.quotations(t, F.lit(None)), quote)[0].role == "Head of sales at Client" and one(spark, lambda t: reviews.quotations(t, t), None) == []


def test_bundles(spark):
    from siftwell.operators import bundles

    nav = "go to **x\nGo To **y\n" + "real words " * 30
    assert one(spark, bundles.after_navigation, nav) == ("real words " * 30).strip() and one(spark, bundles.after_navigation, "go to **x\nshort") == "go to **x\nshort"
    links = spark.createDataFrame([(1, "team", 1, "t"), (1, "welcome", 2, "w"), (1, "gone", 3, "g"), (2, "about", 1, "none")], "company_id long, category string, position int, url string")
    attempts = spark.createDataFrame([("t", "slow", "T slow", "valid"), ("t", "fast", "T fast", "valid"), ("w", "fast", "W bad", "too_short"), ("w", "slow", "W slow", "valid"), ("g", "fast", "x", "bot_blocked")], "url string, method string, content string, status string")
    pages = bundles.fetched(links, attempts, ["fast", "slow"])
    assert {(r.url, r.content, r.method) for r in pages.collect()} == {("t", "T fast", "fast"), ("w", "W slow", "slow"), ("g", "failed", "failed"), ("none", "failed", "failed")}
    made = {r.company_id: r for r in bundles.bundled(pages).collect()}
    assert made[1].raw_markdown == f"## TEAM\n\nT fast\n\n{'-' * 50}\n\n## WELCOME\n\nW slow" and (made[1].n_pages, made[1].n_failed, made[2].raw_markdown) == (2, 1, "")
    assert bundles.context(pages).where("company_id = 1").first().context == "=== WELCOME ===\nW slow\n\n=== TEAM ===\nT fast"
    assert bundles.context(pages, most=10).where("company_id = 1").first().context == "=== WELCOM\n[...]"


def test_profile_links(spark):
    from siftwell.functions import profile

    md = "[x](https://www.linkedin.com/a) [y](https://help.acme.com/z) [pic](https://acme.com/a.png) [o](https://other.org/q) [a](https://www.acme.com/about-us) [t](https://www.acme.com/about/team) ![l](https://cdn.x/hero-logo.png) ![l](https://cdn.x/acme-logo.svg)"
    assert one(spark, profile.website, md, "acme") == "https://www.acme.com" and one(spark, profile.website, md, "zzz") == "https://other.org" and one(spark, profile.website, None, "a") is None
    assert one(spark, profile.logo, md) == "https://cdn.x/acme-logo.svg" and one(spark, profile.logo, None) is None
    assert one(spark, profile.inner_urls, md, "https://www.acme.com/") == {"about": "https://www.acme.com/about-us", "team": "https://www.acme.com/about/team"}
    names = spark.createDataFrame([(["Bank of X", "bank of x", "1st Corp", "abc", "Acme Ltd", "A & B & C", "A & B Co"], ["Paris", ""], ["PARIS", "Rome"])], "n array<string>, c array<string>, g array<string>")
    r = names.select(profile.organisations(F.col("n"), F.lit("acme")).alias("o"), profile.places(F.col("c"), F.col("g")).alias("p")).first()
    assert (r.o, r.p) == (["Bank of X", "A & B Co"], ["Paris", "Rome"])


def test_small_sets(spark):
    from siftwell.operators import records

    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int")
    b = spark.createDataFrame([("x", 9), ("z", 3)], "k string, v int")
    assert sorted(map(tuple, records.union_distinct([a, b], ["k"]).collect())) == [("x", 1), ("y", 2), ("z", 3)]
    assert tuple(records.most_frequent(a.union(b), "k").first()) == ("x", 2)
    assert [tuple(r) for r in records.coverage(a.union(b), "k").collect()] == [("x", 2), ("y", 1), ("z", 1)]
    assert records.outcomes(a.union(b), "k").first().of_status == {"x": 2, "y": 1, "z": 1}
    assert [r.k for r in records.pending(a, b, "k").collect()] == ["y"]


def test_review_cards_and_units(spark):
    from siftwell.functions import dom

    html = """<article data-service-review-card-paper=1><span data-consumer-name-typography=1> Ann </span><time datetime="2024-02-01T00:00">1 Feb</time><div data-service-review-rating="4"></div><a href="/r"><h2>Fine <b>shop</b></h2></a><p>short</p><p>a longer text</p><p>l'entreprise a répondu</p></article>
    <article data-service-review-card-paper=2><img alt="Rated 2 out of 5"><h2>Bad</h2></article>"""
    data = '<script id="__NEXT_DATA__">{"a":[{"displayName":"Acme","identifyingName":"acme.com","numberOfReviews":{"total":12},"trustScore":4.5},{"x":{"displayName":"Acme","identifyingName":"acme.com"}},{"displayName":"B","identifyingName":"b"},{"displayName":"Cc","identifyingName":"c"}]}</script>'
    links = '<a href="/review/a.com?x"><span>4,5</span><p>A shop</p></a><a href="/review/a.com">again</a><a href="/review/b.com"></a>'
    pages = spark.createDataFrame([(1, html), (2, "<p>none</p>"), (3, None), (4, data), (5, links)], "page_id int, html string")
    got = [tuple(r) for r in dom.latest_cards(pages).orderBy("page_id", "position").collect()]
    assert got == [(1, 0, "Ann", "2024-02-01T00:00", "1 Feb", "4", "Fineshop", "l'entreprise a répondu", True), (1, 1, "", "", "", "2", "Bad", "", False)]
    assert [r.position for r in dom.latest_cards(pages, 1).collect()] == [0]
    assert [tuple(r) for r in dom.units(pages).orderBy("page_id", "position").collect()] == [(4, 0, "Acme", "acme.com", "12", "4,5"), (4, 1, "Cc", "c", "?", "?"), (5, 0, "A shop", "a.com", "?", "?"), (5, 1, "b.com", "b.com", "?", "?")]


def test_team_and_menus(spark):
    from siftwell.functions import profile

    rows = spark.createDataFrame([("Our Sara SANTOS CEO and Bo LI Legal; Sara SANTOS President", [("Ann Leemans", "the new Head of Sales here"), ("SARA santos", "CEO"), ("Nobody Known", "went home"), ("R&D Labs", "CEO")]), (None, None)], "t string, p array<struct<name:string,context:string>>")
    got = [r[0] for r in rows.select(profile.team_leaders(F.col("t"), F.col("p"))).collect()]
    assert [tuple(x) for x in got[0]] == [("Sara SANTOS", "CEO"), ("Ann Leemans", "Head of Sales here")] and got[1] == []
    menu = "About Team Contact\n\nNews > Blog > Press\nReal text\nAbout Team Contact\nmore"
    assert one(spark, profile.without_menu, menu) == "Real text\nAbout Team Contact\nmore" and one(spark, profile.without_menu, "plain\ntext") == "plain\ntext"
    assert one(spark, profile.without_menu, "x " * 200 + "Careers Home About us") == "Home About us" and one(spark, profile.without_menu, None) == ""


def many_rules(n):
    """n rules of all signals, and pages that hold what some of them look for."""
    rules = {}
    for k in range(n):
        rules[f"T{k}"] = {"cats": [1 + k % 60], "scriptSrc": rf"lib{k}[.-](\d+)\.js\;version:\1", "html": [rf"data-lib{k}=[\"']?(\w+)\;confidence:60\;version:\1", rf"<i>lib{k}</i>"], "headers": {f"X-Lib{k}": r"v(\d)\;version:\1"}, "cookies": {f"_c{k}": ""}, "meta": {"generator": rf"^Lib{k} ?([\d.]+)?\;version:\1"}, "js": {f"Lib{k}.v": ""}, "implies": [rf"T{(k * 7 + 1) % n}\;confidence:50"] if k % 5 == 0 else []}
    rules["Loose"] = {"html": r"(?:foo|bar)+x|\d{9}", "scriptSrc": "(["}
    pages = []
    for k in range(0, n, 3):
        pages.append((f'<script src="/LIB{k}-{k}.js"></script><p data-lib{k + 1}="a{k}"><I>lib{k + 2}</I> fooBARx<meta name="Generator" content="lib{k + 1} 2.{k}"><script>var Lib{k + 1} = 1; notLib{k}a()</script>', {f"x-LIB{k}": "v7", f"x-lib{k + 2}": ""}, {f"_C{k + 2}": ""}))
    return rules, pages + [("plain page, Kelvin and lonſ", None, None)]


def test_index_changes_no_result(monkeypatch):
    rules, pages = many_rules(120)
    found = [fingerprints.Detector(rules).detect(*p) for p in pages]

    def every_rule(self, seen, lower):
        return [n for n, r in enumerate(rules_of) if r.signal == seen.signal and (r.key == seen.key if seen.signal in ("headers", "cookies", "meta") else r.signal != "js" or re.search(rf"\b{r.key}\b", seen.text))]

    plain = fingerprints.Detector(rules)
    rules_of = [r._replace(literal="") for r in plain.rules]
    plain.rules = rules_of
    monkeypatch.setattr(fingerprints.Index, "candidates", every_rule)
    assert found == [plain.detect(*p) for p in pages] and sum(map(len, found)) > 200
    assert {("T0", 1.0, "0"), ("T1", 1.0, "2.0"), ("T2", 1.0, ""), ("Loose", 1.0, "")} <= {x[:3] for x in found[0]}


def test_detection_cost_hardly_grows_with_rules():
    """Ten times the rules take far less than ten times the time; with one test a rule it is ten."""
    page = ("<p>" + "Some words of a page that holds no library at all. " * 400, None, None)
    times = []
    for n in (300, 3000):
        detector = fingerprints.Detector(many_rules(n)[0])
        detector.detect(*page)
        times.append(min(timeit.repeat(lambda: detector.detect(*page), number=5, repeat=5)))
    assert times[1] < 4 * times[0]


@pytest.mark.parametrize("answer,want", [
    ('{"z": {"ca_2023": 1}, "ca_2023": 2, "net-2022": -1.5e3}', [(2023, "ca", 1.0), (2023, "ca", 2.0), (2022, "resultat_net", -1500.0)]),
    ('[{"turnover2021": 5}, [{"ca2021": 6}], 7, {"a": {"b": {"profit 2020": 8}}}]', [(2021, "ca", 5.0), (2020, "resultat_net", 8.0)]),
    ('{"a": [{"ca_2023": 1}], "ca_2024": [9], "ca_2025": "10", "ca_2026": null, "other_2023": 4, "ca_1999": 3, "x": "\\"ca_2020\\": 5, {", "y\\\\": 1, "ca_2019": 6}', [(2019, "ca", 6.0)]),
    ("[]", []), ("no json", []), ('{"ca_2023": 1', []), ("", []), (None, []), ("5", []), ('"ca_2023"', []),
])
def test_numbers_by_year(spark, answer, want):
    from siftwell.operators import registry

    assert [tuple(x) for x in one(spark, registry.numbers_by_year, answer)] == want


def test_markdown_links(spark):
    md = "# Menu\n[About *us*](https://acme.com/about) [![Team photo](https://cdn.x/t.png)](https://www.acme.com/our-team/) [see [our] work](https://acme.com/work#top) ![pic](https://acme.com/pic) [x](/rel) ] [](https://acme.com/) [fr](https://acme.com/fr-fr/) [Again](https://acme.com/about/) [Out](https://other.org/x) [Fb](https://facebook.com/acme) [Mentions legal](https://acme.com/legal) [open"
    pages = spark.createDataFrame([(1, "https://www.acme.com", md), (1, "https://www.acme.com", md), (2, "https://b.org", None), (3, None, "[a](https://c.org/a_b.html)")], "page_id long, url string, markdown string")
    rows = navigation.markdown_links(pages).orderBy("page_id", "start").collect()
    assert [(r.page_id, r.href, r.text, r.slug) for r in rows] == [(1, "https://acme.com/about", "About *us*", "about"), (1, "https://www.acme.com/our-team", "Team photo", "our team"), (1, "https://acme.com/work", "see our work", "work"), (1, "https://acme.com/pic", "pic", "pic"), (3, "https://c.org/a_b.html", "a", "a b")]
    assert rows[0].near == "Menu About us Team photo](https://www.acme.com/our-team/"[: len(rows[0].near)] or rows[0].near.startswith("Menu About us")
    assert md[rows[1].start : rows[1].start + rows[1].size] == "[![Team photo](https://cdn.x/t.png)](https://www.acme.com/our-team/)"
    assert {r.href for r in navigation.markdown_links(pages, internal_only=False).collect()} - {r.href for r in rows} == {"https://other.org/x"}


def test_scanning_links_takes_linear_time():
    one = "word [a [b] c](https://x.org/1) [[[ ]] ![i](https://x.org/i) "
    times = []
    for n in (1000, 16_000):  # the longer one is a page of 1 MB
        times.append(min(timeit.repeat(lambda: markdown.scan_links(one * n), number=1, repeat=3)))
    assert times[1] < 16 * 3 * times[0] and len(markdown.scan_links(one * 16_000)) == 32_000


def alike(a, b):
    a, b = set(a) - {"", None}, set(b) - {"", None}
    shared = len(a & b)
    return shared > 0 and (shared == min(len(a), len(b)) or 3 * shared >= 2 * len(a | b))


def test_alike_names_are_those_of_brute_force(spark):
    """Skewed words, names of one to fifty words, names that repeat, several names of one id."""
    rng = random.Random(4)
    words = ["group", "energy", "bank"] * 30 + ["data", "blue"] * 8 + [f"w{k}" for k in range(40)]
    make = lambda n: [(rng.randrange(n), [rng.choice(words) for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 3, 4, 6, 9, 14, 50]))]) for _ in range(n)]
    left, right = make(150), make(200) + [(7, None), (8, ["", None]), (9, ["group"] * 3)]
    schema = "id long, words array<string>"
    got = names.pairs(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)).collect()
    want = {(i, j) for i, a in left for j, b in right if alike(a, b or ())}
    assert len(got) == len(want) and {tuple(r) for r in got} == want and len(want) > 500
    assert names.pairs(spark.createDataFrame([], schema), spark.createDataFrame(right, schema)).count() == 0


def test_hot_words_do_not_meet_alone(spark):
    """Names of one rare word and two that all have: what meets grows with the names, not their square."""
    for n in (100, 400):
        sets = spark.range(n).select(F.array_sort(F.array(F.concat(F.lit("own"), F.col("id").cast("string")), F.lit("energy"), F.lit("group"), F.lit("holding"))).alias("s"))
        extra = spark.createDataFrame([(["energy"],), (["energy", "group"],)], "s array<string>")
        assert names.met(sets.unionAll(extra), sets).count() <= 5 * n


def test_an_address_is_not_made_anew_for_each_check(spark, capsys):
    pages = spark.createDataFrame([(1, "https://s.com/", "[a](https://s.com/a)")], "page_id int, url string, markdown string")
    navigation.markdown_links(pages).explain("extended")
    told = capsys.readouterr().out.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    filters = [line for line in told.split("\n") if "Filter" in line]
    assert filters and sum(line.count("([^:])//+") for line in filters) <= 1


def test_texts_of_articles_are_lowered_once(spark):
    from siftwell.functions import text
    from siftwell.plans import catalog, content  # noqa: F401

    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    rows = spark.createDataFrame([(1, "Une LEVEE de fonds pour la startup est dans les comptes"), (2, ""), (3, None)], "k long, x string")
    for f, none in ((text.language, "en"), (text.article_type, "general"), (text.subjects, ["autre"])):
        df = rows.select("k", f(F.col("x")).alias("y"))
        assert plan(df).count("lower(") == 1
        assert [r.y for r in df.orderBy("k").collect()][1:] == [none, none]
    # the query returns nothing of the language, subjects and type, so it needs no lowered text
    assert "lower(coalesce(body" not in plan(catalog.QUERIES["article_metadata"](spark, "/root/testdata/sf0.001"))
