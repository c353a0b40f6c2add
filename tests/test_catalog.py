"""Every query with SQL against DuckDB, on the smallest tables; some functions on written cases."""

import html
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from siftwell.functions import company, fuzzy, text, urls
from siftwell.operators import fingerprints, matching, records
from siftwell.plans import catalog
from siftwell.sources import landed
from siftwell.streaming import incremental

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return f"{v:.6g}"
    return "-" if v is None else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}{'/*' if os.path.isdir(p) else ''}')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_same_rows_as_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = duck.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert sorted(tuple(norm(r[c]) for c in columns) for r in got.collect()) == sorted(tuple(norm(r[i]) for i in at) for r in want.fetchall())


def one(spark, expr, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(expr).first()[0]


def test_clean_for_nlp(spark):
    raw = "{ap}Hello &amp; <b>world</b>!!!! https://x.y/z\nab\nMali\nread more here\n\n\n\nSecond   line"
    assert one(spark, text.clean_for_nlp(F.col("t")), t=raw) == "Hello & world !\n\nSecond line"
    assert one(spark, text.clean_for_nlp(F.col("t")), t=None) == ""


def test_all_character_references(spark):
    raw = "Soci&eacute;t&eacute; g&eacute;n&eacute;rale &rsquo;&euro;&#233;&#xe9;&#X1F600; &amp;lt; &copy &notit; &#128; &unknown; &Aacute;&frac12;&NotEqualTilde;"
    assert one(spark, text.unescape(F.col("t")), t=raw) == html.unescape(raw)
    assert one(spark, text.unescape(F.lit(None).cast("string"))) is None
    assert one(spark, text.clean_for_nlp(F.col("t")), t="Soci&eacute;t&eacute; g&#233;n&#xe9;rale, l&rsquo;avenir &agrave; 5&nbsp;&euro;") == "Société générale, l’avenir à 5\u00a0€"


@pytest.mark.parametrize("raw,value", [("1 234 567 €", 1234567.0), ("22,5 M€", 22500000.0), ("430M", 430000000.0), ("n/a", None), ("1.234.567", 1234.567), ("", None)])
def test_amount(spark, raw, value):
    got = one(spark, company.amount(F.col("t")), t=raw)
    assert got == (None if value is None else pytest.approx(value, abs=0.01))


def test_headcount_and_numbers(spark):
    h = one(spark, company.headcount(F.col("t")), t="50 à 99 salariés")
    assert (h.low, h.high, h.label) == (50, 99, "ME")
    assert one(spark, company.digits_of(F.col("t"), 9), t="732 829 320") == "732829320"
    assert one(spark, company.digits_of(F.col("t"), 9), t="73") is None
    assert one(spark, company.year(F.col("t")), t="en 1998, puis 2001") == 1998


def test_domains_and_names(spark):
    d = lambda u: one(spark, urls.domain(F.col("t")), t=u)
    assert [d("https://www.Capgemini.com:80/fr"), d("careers.siemens.de"), d("x"), d(None)] == ["capgemini.com", "careers.siemens.de", "", ""]
    assert one(spark, urls.root_domain(F.col("t")), t="a.b.co.uk") == "b.co.uk"
    score = lambda q, w: one(spark, company.domain_score(F.col("q"), F.col("w")), q=q, w=w)
    assert [score("siemens.de", "https://careers.siemens.de"), score("siemens.com", "siemens.de"), score("ab.com", "lab.com"), score("", "x.com")] == [1.0, 0.6, 0.85, 0.0]
    assert one(spark, fuzzy.name_score(F.col("q"), F.col("w")), q="Acme SA", w="ACME Inc.") == 1.0


def test_pages(spark):
    assert one(spark, text.page_status(F.col("t")), t="x").status == "too_short"
    assert one(spark, text.page_status(F.col("t")), t="word " * 200 + "Cloudflare").status == "bot_blocked"
    assert one(spark, text.page_status(F.col("t")), t="Privacy Policy " + "word " * 200).status == "wrong_page"


def test_ecommerce_patterns(spark, tmp_path):
    every = '{"@type": "Product"} {"@TYPE":"offer"} "@type":"ItemList" add-to-cart data-product-id /Checkout? "sku" : "price": 9 type="number" id="quantite" livraison gratuite en stock'
    rows = [(1, '{"@type": "Product"}'), (2, "plain"), (3, None), (4, "<b>TrackMe</b> <a href=/cart>"), (5, every), (6, "/cartoon")]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    rules = {"Track": {"html": "TrackMe", "implies": "Pay", "cats": [99]}, "Pay": {"cats": [41]}}
    weights = spark.createDataFrame(fingerprints.Detector(rules).shop_weights(), "tech string, weight double")
    got = {r.page_id: tuple(r)[1:] for r in matching.ecommerce(pages, fingerprints.detect(pages, rules), weights).collect()}
    assert got[1] == (20.0, True, ["schema:Product"]) and got[2] == got[3] == got[6] == (0.0, False, [])
    assert got[4] == (35.0, True, ["Pay", "Track", "pattern:cart-url"])
    assert got[5] == (96.0, True, [name for _, _, name in matching.SHOP_PATTERNS])
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    shops = entry.queries()["ecommerce_scores"](spark, str(tmp_path))
    assert {r.page_id: r.score for r in shops.collect()} == {1: 20.0, 4: 8.0, 5: 96.0}


def test_empty_inputs(spark):
    empty = spark.createDataFrame([], "k string, v long")
    assert records.keep_first(empty, ["k"], ["v"]).count() == 0
    new = spark.createDataFrame([("a", 1), ("a", 2), ("", 3), (None, 4)], "k string, v long")
    assert records.merge_new(empty, new, "k", ["v"]).collect() == [("a", 1)]
    assert {tuple(r) for r in records.upsert(new.where("k = 'a'").limit(1), new, "k", "v").where("k = 'a'").collect()} == {("a", 2)}


def test_sources(spark, tmp_path):
    (tmp_path / "u.txt").write_text("﻿https://a.b\n\n# no\n  c.d \n")
    assert [r.url for r in landed.url_list(spark, str(tmp_path / "u.txt")).collect()] == ["https://a.b", "c.d"]
    (tmp_path / "s.xml").write_text("<urlset><url><loc> https://a.b/1 </loc></url><url><loc>https://a.b/2</loc></url></urlset>")
    assert [r.url for r in landed.sitemap_urls(spark, str(tmp_path / "s.xml")).collect()] == ["https://a.b/1", "https://a.b/2"]
    df = spark.createDataFrame([(["a", "b"], None)], "x array<string>, y string")
    assert landed.flat(df).collect() == [("a | b", "")]


def test_streaming(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("", 3)], "k string, v long")
    rows.write.parquet(str(tmp_path / "in"))
    stream = incremental.new_by_key(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), "k")
    q = stream.writeStream.format("memory").queryName("seen").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.k for r in spark.table("seen").collect()) == ["a", "b"]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
