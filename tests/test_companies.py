"""Smaller operators on companies, links, files and older article rules."""

import time

from pyspark.sql import functions as F

from siftwell.functions import articles, structure, text, urls
from siftwell.operators import bundles, discovery, market, navigation, registry
from siftwell.sources import landed


def values(spark, expr, *given):
    rows = spark.createDataFrame([(k, g) for k, g in enumerate(given)], "k int, x string")
    return [r.v for r in rows.select("k", expr(F.col("x")).alias("v")).orderBy("k").collect()]


def test_small_column_functions(spark):
    assert values(spark, urls.of_file_name, "www_acme_com.md", "acme_fr_about_team_.md", "a_b_zz.md", "x_Com_.md") == ["https://www.acme.com", "https://acme.fr/about/team", "https://a.b.zz", "https://x.Com"]
    assert values(spark, text.squeeze_visible, " a​\n b​c ", None) == ["a bc", ""]
    assert values(spark, urls.asset, "https://a.b/x.PNG", "https://a.b/x.png?y", "https://a.b/png", "https://a.b/f.js#x", None) == [True, True, False, True, False]
    assert values(spark, articles.is_listing, "https://a.b/tag/x", "https://a.b", "https://a.b/post", "https://a.b/searching") == [True, True, False, True]


def test_prepared_pages(spark):
    menu = "\n".join(f"* go to **{k}**" for k in range(30)) + "\n" + "What the page is about, in words. " * 30
    valid = "A sentence of a page that is long enough to count. " * 20
    rows = values(spark, bundles.prepared, menu, valid, "short", None)
    assert [r.status for r in rows] == ["nav_dump", "valid", "too_short", "too_short"]
    assert rows[0].content.startswith("What the page") and rows[1].content == valid and rows[2].content is None


def test_bundle_links(spark):
    pages = spark.createDataFrame([(1, "about", 2, "https://a.org", "[B](https://a.org/b) [C](https://a.org/c)"), (1, "welcome", 1, "https://a.org", "[Bee](https://a.org/b/)"), (1, "none", 0, "https://a.org", None), (2, "welcome", 1, "https://a.org", "[Out](https://b.org/x)")], "company_id int, category string, page_no int, url string, markdown string")
    assert sorted((r.company_id, r.href, r.text, r.source_page) for r in navigation.bundle_links(pages).collect()) == [(1, "https://a.org/b", "Bee", "welcome"), (1, "https://a.org/c", "C", "about")]
    assert navigation.bundle_links(pages, internal_only=False).where("not is_internal").count() == 1


def test_quote_info(spark):
    answers = spark.createDataFrame([("A", '{"longName": "Acme", "52WeekChange": -0.5, "grossMargins": 0.0625, "revenueGrowth": -0.125, "marketCap": 12, "sector": null, "dividendYield": {"raw": 1}}'), ("B", None)], "symbol string, json string")
    a, b = market.quote_info(answers).orderBy("symbol").collect()
    assert (a.longName, a["52WeekChange"], a.grossMargins_pct, a.revenueGrowth_pct, a.marketCap, a.sector, a.rejected) == ("Acme", -0.5, "6.2%", "-12.5%", 12, None, ["$['dividendYield']"])
    assert '"longName":"Acme"' in a.info and "sector" not in a.info and b.info == "{}"


def test_indicators(spark):
    rows = [(1, 2021, "ca", 100.0), (1, 2022, "ca", 120.0), (1, 2022, "resultat_net", 24.0), (1, 2022, "capitaux_propres", 10.0), (1, 2022, "dettes_financieres", 25.0), (2, 2021, "ca", 100.0), (2, 2022, "ca", 80.0), (2, 2022, "resultat_net", -1.0), (3, 2020, "ca", 5.0)]
    got = {r.company_id: r for r in registry.indicators(spark.createDataFrame(rows, "company_id long, year int, field string, value double")).collect()}
    assert (got[1].growth_label, got[1].margin_label, got[1].debt_label, got[1].signals) == ("+20.0%", "+20.0%", "2.50x", [registry.GROWING, registry.PROFITABLE, registry.INDEBTED])
    assert got[2].signals == [registry.SHRINKING, registry.LOSING] and (got[3].signals, got[3].growth_label) == ([], None)


def test_anchors_and_plain_discovery(spark):
    html = '<a href="/x">short</a><div class="big Post-list"><p><a href=" /a1 ">one</a></p></div><article><div><span><b><a href="/a2">two</a></b></span></div></article><a href="/a3">a text of twenty letters</a><a>no</a><a href="/tag/b">a text of twenty letters</a>'
    got = structure.anchors_of(html)
    assert [(a["href"], a["may_be_article"]) for a in got] == [("/x", False), ("/a1", True), ("/a2", False), ("/a3", True), ("/tag/b", True)]
    assert structure.anchors_of(None) == []
    pages = spark.createDataFrame([("https://s.org/news", html + "." * 300), ("https://s.org/fr/blog/", '<article><a href="../deep/a4">x</a></article>' + "." * 300), ("https://s.org/press", "too short"), ("https://o.org/news", html + "." * 300)], "url string, html string")
    sites = spark.createDataFrame([("https://s.org",), (None,)], "site string")
    assert sorted(r.url for r in discovery.plain_articles(sites, pages).collect()) == ["https://s.org/a1", "https://s.org/a3", "https://s.org/fr/deep/a4"]


def test_discovery_of_odd_sites(spark):
    sites = spark.createDataFrame([("https://s.org",), ("https://empty.org",), (None,), ("https://s.org",)], "site string")
    body = "." * 600
    pages = [
        ("https://s.org/", f'<a href="/our-blog">Blog</a><a href="/old-blog">Old blog</a>{body}', "https://s.org/"), ("https://s.org/our-blog", f'<a href="/p1">1</a><a href="/p2.pdf">f</a><a href="/uploads/x">u</a><a href="/our-blog/">self</a><a href="https://o.org/y">out</a><a href="/our-blog?page=2">2</a>{body}', "https://s.org/our-blog"),
        ("https://s.org/old-blog", f'<a href="/p9">never</a>{body}', "https://s.org/our-blog"), ("https://s.org/our-blog?page=2", f'<a href="/p3">3</a>{body}', None), ("https://s.org/our-blog?page=3", f'<a href="/p4">4</a>', None), (None, body, None), ("https://s.org/our-blog", None, None),
    ]
    pages = spark.createDataFrame(pages, "url string, html string, final_url string")
    entries = spark.createDataFrame([("https://s.org/sitemap.xml", "sitemap", "https://s.org/blog-map.xml"), ("https://s.org/blog-map.xml", "sitemap", "https://s.org/sitemap.xml"), ("https://s.org/blog-map.xml", "sitemap", "https://s.org/blog-map.xml"), ("https://s.org/blog-map.xml", "url", "https://s.org/post/1"), ("https://s.org/blog-map.xml", "url", "https://other.com/post/2"), ("https://s.org/blog-map.xml", "url", None), ("https://s.org/post-sitemap.xml", "url", "https://s.org/post/never")], "parent string, kind string, url string")
    got = discovery.discover(sites, pages, entries).orderBy("nth").collect()
    # two sections that lead to one page are one: the first by address, whose own page is read
    assert [(r.url.removeprefix("https://s.org"), r.tier) for r in got] == [("/post/1", 0), ("/p9", 1)]
    assert discovery.discover(sites, pages.drop("final_url"), entries, limit=3).count() == 3
    assert discovery.discover(sites.limit(0), pages, entries).count() == 0
    deep = spark.createDataFrame([(f"m{k}-blog", "sitemap", f"m{k + 1}-blog") for k in range(12)] + [("m12-blog", "url", "u"), ("m12-blog", "sitemap", "m3-blog")], "parent string, kind string, url string")
    assert [tuple(r) for r in discovery.sitemap_closure(deep, spark.createDataFrame([("m0-blog",)], "root string")).collect()] == [("m0-blog", "u")]


def test_files_of_companies(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(r, "name string, members array<string>")
    landed.save_companies(rows(("A & B", ["x", "y"]), ("C", None)), f"{tmp_path}/each", f"{tmp_path}/all", "name")
    landed.save_companies(rows(("C", ["z"])), f"{tmp_path}/each", f"{tmp_path}/all", "name")
    read = lambda p: sorted(((r.name, r.members) for r in spark.read.option("header", True).csv(f"{tmp_path}/{p}").collect()), key=str)
    assert read("each/_folder=A__B") == [("A & B", "x | y")] and read("each/_folder=C") == [("C", "z")] and len(read("all")) == 3
    (tmp_path / "raw").mkdir()
    for k in (1, 2):
        (tmp_path / "raw" / f"{3 - k}_raw.json").write_text("{}")
        time.sleep(1.1)
    (tmp_path / "raw" / "later.txt").write_text("")
    assert landed.newest_file(spark, f"{tmp_path}/raw", "*_raw.json").first().path.endswith("1_raw.json")
    items = spark.createDataFrame([("u", 1.0), ("v", None), ("w", 3.0)], "url string, relevance double")
    assert [r.url for r in articles.most_relevant(items, 2).collect()] == ["w", "u"]


def test_numbers_in_groups_of_any_size(spark):
    from siftwell.operators import records

    rows = [(None if k % 10 == 0 else "hot" if k % 3 else f"g{k % 7}", k * 37 % 500, k) for k in range(500)] + [("hot", 5, 1000), ("hot", 5, 1000)]
    df = spark.createDataFrame(rows, "`a.b` string, o int, v int").repartition(7)
    got = records.numbered(df, ["a.b"], ["o", "v"]).collect()
    want = {}
    for g, o, v in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        want.setdefault(g, []).append((o, v))
    assert sorted((str(r[0]), r.nth, r.o, r.v) for r in got) == sorted((str(g), k, o, v) for g, x in want.items() for k, (o, v) in enumerate(x))
    assert records.numbered(df.limit(0), ["a.b"], ["o"]).count() == 0
