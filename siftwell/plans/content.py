"""Queries over review pages, articles, answers, bundles, identifiers and people; registered in the catalog.

The tables hold no such pages, so rows are made of them by formulas; the SQL never reads the made texts,
it says what they were made to hold."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwell.functions import articles, company, profile, responses, reviews, text, urls
from siftwell.operators import bundles, market, navigation, records, registry
from siftwell.plans.catalog import _dealt, _t, query
from siftwell.sources import landed


def _html(spark, sf_dir, expr: str):
    return _dealt(spark, sf_dir, "customer", "c_custkey").selectExpr("c_custkey AS k", f"{expr} AS x")


@query("""
WITH c AS (
    SELECT c_custkey AS k, c_custkey % 50 + 1 AS n5, c_custkey % 7 AS n4, c_custkey % 3 AS n1 FROM customer
), s AS (
    SELECT *, n5 + n4 + n1 AS n FROM c
)
SELECT k, CASE k % 4 WHEN 3 THEN NULL ELSE (k % 5) || ',' || (k % 9) END AS score, CASE k % 4 WHEN 0 THEN 'Excellent' WHEN 3 THEN 'Moyen' END AS mention,
    CASE k % 4 WHEN 0 THEN replace(format('{:,}', CAST(k * 7 + 1000 AS BIGINT)), ',', ' ') WHEN 1 THEN CAST(k AS VARCHAR) WHEN 2 THEN NULL ELSE k || ' avis' END AS n_reviews,
    CASE WHEN k % 4 = 0 THEN CAST(round_even(n5 * 100.0 / n, 0) AS INTEGER) END AS five, CASE WHEN k % 4 = 0 THEN CAST(round_even(n1 * 100.0 / n, 0) AS INTEGER) END AS one
FROM s""")
def review_scores(spark, sf_dir):
    """Review pages with data, with JSON-LD (alone or in a list), or with shown texts only."""
    html = """CASE c_custkey % 4
        WHEN 0 THEN concat('<script id="__NEXT_DATA__">{"trustScore": ', c_custkey % 5, '.', c_custkey % 9, ', "starsString": "Excellent", "numberOfReviews": {"x": 1, "total": ', c_custkey * 7 + 1000, '}, "ratingDistribution": [{"stars": 5, "count": ', c_custkey % 50 + 1, '}, {"count": ', c_custkey % 7, ', "stars": 4}, {"stars": 1, "count": ', c_custkey % 3, '}]}</script>')
        WHEN 1 THEN concat('<script type="application/ld+json">{"@type": "x"}</script><script type="application/ld+json">{"aggregateRating": {"ratingValue": "', c_custkey % 5, '.', c_custkey % 9, '", "reviewCount": ', c_custkey, '}}</script>')
        WHEN 2 THEN concat('<script type="application/ld+json">[{"aggregateRating": {"ratingValue": "', c_custkey % 5, '.', c_custkey % 9, '"}}]</script>')
        ELSE concat('<p> Moyen </p><span>', c_custkey, ' avis</span>') END"""
    s = _html(spark, sf_dir, html).select("k", reviews.score(F.col("x")).alias("s"))
    return s.select("k", "s.score", "s.mention", "s.n_reviews", F.col("s.stars")[5]["pct"].alias("five"), F.col("s.stars")[1]["pct"].alias("one"))


@query("""
WITH d AS (
    SELECT doc_id, regexp_replace(text, '[<>"&]', '', 'g') AS body FROM documents
)
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'Og title ' || doc_id ELSE 'Title ' || doc_id END AS title, 'site' || (doc_id % 9) || '.org' AS source, CASE WHEN doc_id % 3 = 0 THEN '2024-01-' || lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0') ELSE '' END AS published,
    CASE WHEN doc_id % 4 = 0 THEN 'Ann ' || doc_id ELSE '' END AS author, CASE WHEN doc_id % 5 = 0 THEN 'Described' WHEN length(body) > 300 THEN substr(body, 1, 300) || '...' ELSE body END AS excerpt, CASE WHEN doc_id % 6 = 0 THEN 'a|b c' ELSE '' END AS keywords,
    doc_id % 7 <> 0 AND (length(body) > 300 OR doc_id % 3 = 0) AS is_article
FROM d""")
def article_metadata(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").selectExpr("doc_id", "regexp_replace(text, '[<>\\\"&]', '') AS body", "concat('https://www.site', doc_id % 9, '.org/', IF(doc_id % 7 = 0, 'careers/', ''), doc_id) AS url")
    metas = [("doc_id % 2 = 0", "property", "og:title", "concat('Og title ', doc_id)"), ("doc_id % 3 = 0", "name", "date", "concat('2024-01-', lpad(1 + doc_id % 28, 2, '0'))"), ("doc_id % 4 = 0", "property", "article:author", "concat('Ann ', doc_id)"), ("doc_id % 5 = 0", "name", "description", "'Described'"), ("doc_id % 6 = 0", "name", "keywords", "'a, b c,,'")]
    head = ", ".join(f"IF({w}, concat('<meta {a}=\"{n}\" content=\"', {v}, '\">'), '')" for w, a, n, v in metas)
    pages = d.selectExpr("doc_id", "url", "body", f"concat('<html><head><title>Title ', doc_id, '</title>', {head}, '</head></html>') AS html")
    m = articles.metadata(F.col("html"), F.col("url"), F.col("body"))
    # fields are taken from the struct itself, so that those of the text that aren't asked for aren't made
    fields = [m[f].alias(f) for f in ("title", "source", "published", "author", "excerpt")]
    return pages.select("doc_id", *fields, F.array_join(m["keywords"], "|").alias("keywords"), articles.is_article(F.col("html"), F.col("url"), F.col("body"), ["/careers"]).alias("is_article"))


@query("""
SELECT c_custkey AS company_id, CASE WHEN c_custkey % 3 = 0 THEN 'known' WHEN c_custkey % 5 <> 4 THEN c_name END AS company_name, CASE WHEN c_custkey % 5 IN (0, 1) THEN 'one two' WHEN c_custkey % 5 IN (2, 3) THEN 'plain' END AS description,
    CASE WHEN c_custkey % 5 < 4 THEN 'consulting|cloud' END AS services, CASE WHEN c_custkey % 5 < 4 THEN CAST(1990 + c_custkey % 30 AS INTEGER) END AS founded_year, CASE WHEN c_custkey % 5 < 4 AND c_custkey % 2 = 0 THEN 'Ann:CEO' END AS leaders
FROM customer""")
def answers_fill(spark, sf_dir):
    """Model answers with words around them, or broken, fill what isn't known of companies."""
    described = "CASE WHEN c_custkey % 5 IN (0, 1) THEN '[\"one \", \"\", \"two\"]' ELSE '\" plain \"' END"
    answer = f"""concat(IF(c_custkey % 5 = 1, 'Here it is: ', ''), '{{"company_name": "', c_name, '", "description": ', {described}, ', "services": ["consulting", "x", 5, " cloud "], "founded_year": "', 1990 + c_custkey % 30, '"',
        IF(c_custkey % 2 = 0, ', "team_leaders": [{{"name": "Ann", "title": "CEO"}}, {{"title": "none"}}]', ''), IF(c_custkey % 5 = 4, '', '}}'), IF(c_custkey % 5 = 2, ' done', ''))"""
    c = _dealt(spark, sf_dir, "customer", "c_custkey", "c_name")
    found = c.selectExpr("c_custkey AS company_id", f"{answer} AS a").select("company_id", responses.fields_of(F.col("a")).alias("f")).select("company_id", "f.*")
    known = c.selectExpr("c_custkey AS company_id", "IF(c_custkey % 3 = 0, 'known', null) AS company_name", "CAST(null AS STRING) AS description", "CAST(null AS array<string>) AS services", "CAST(null AS INT) AS founded_year", "CAST(null AS array<struct<name:string,title:string>>) AS team_leaders")
    out = responses.fill(known, found, "company_id")
    return out.select("company_id", "company_name", "description", F.when(F.col("services").isNotNull(), F.array_join("services", "|")).alias("services"), "founded_year", F.when(F.col("team_leaders").isNotNull(), F.array_join(F.transform("team_leaders", lambda p: F.concat(p["name"], F.lit(":"), p["title"])), "|")).alias("leaders"))


@query("""
WITH p AS (
    SELECT o_custkey AS company_id, 'cat' || (o_orderkey % 4) AS category, o_orderkey AS position, CASE WHEN o_orderkey % 6 = 0 THEN 'failed' WHEN o_orderkey % 3 = 0 THEN 'deep ' || o_orderkey ELSE 'text ' || o_orderkey END AS content FROM orders
)
SELECT company_id, CAST(count(*) FILTER (content <> 'failed') AS BIGINT) AS n_pages, CAST(count(*) FILTER (content = 'failed') AS BIGINT) AS n_failed,
    coalesce(string_agg('## ' || upper(category) || chr(10) || chr(10) || content, chr(10) || chr(10) || repeat('-', 50) || chr(10) || chr(10) ORDER BY position) FILTER (content <> 'failed'), '') AS raw_markdown,
    CASE WHEN length(coalesce(string_agg('=== ' || upper(category) || ' ===' || chr(10) || content, chr(10) || chr(10) ORDER BY category <> 'cat2', position) FILTER (content <> 'failed'), '')) > 200
        THEN substr(string_agg('=== ' || upper(category) || ' ===' || chr(10) || content, chr(10) || chr(10) ORDER BY category <> 'cat2', position) FILTER (content <> 'failed'), 1, 200) || chr(10) || '[...]'
        ELSE coalesce(string_agg('=== ' || upper(category) || ' ===' || chr(10) || content, chr(10) || chr(10) ORDER BY category <> 'cat2', position) FILTER (content <> 'failed'), '') END AS context
FROM p GROUP BY company_id""")
def page_bundles(spark, sf_dir):
    """Pages by their first good attempt, as one text and as a model's context."""
    o = _t(spark, sf_dir, "orders")
    links = o.selectExpr("o_custkey AS company_id", "concat('cat', o_orderkey % 4) AS category", "o_orderkey AS position", "concat('u', o_orderkey) AS url")
    tries = o.selectExpr("concat('u', o_orderkey) AS url", """explode(array(named_struct('method', 'plain', 'content', concat('text ', o_orderkey), 'status', IF(o_orderkey % 3 = 0, 'too_short', 'valid')),
        named_struct('method', 'deep', 'content', concat('deep ', o_orderkey), 'status', IF(o_orderkey % 6 = 0, 'bot_blocked', 'valid')), named_struct('method', 'other', 'content', 'never', 'status', 'valid'))) AS a""").select("url", "a.*")
    pages = bundles.fetched(links, tries, ["plain", "deep"])
    return bundles.bundled(pages).join(bundles.context(pages, first="cat2", most=200), "company_id")


@query("""
WITH c AS (
    SELECT c_custkey AS company_id, 2018 + c_custkey % 6 AS year, CASE c_custkey % 4 WHEN 0 THEN (c_custkey % 900 + 100) * 1000.0 WHEN 1 THEN (c_custkey % 90 + 10) * 1000.0 WHEN 2 THEN c_custkey % 900 + 100 END AS value FROM customer
)
SELECT company_id, CAST(year AS INTEGER) AS year, 'ca_estimate' AS field, CAST(value AS DOUBLE) AS value, 'regex_fallback' AS source FROM c WHERE value IS NOT NULL""")
def history_of_contexts(spark, sf_dir):
    """Years with amounts beside them, the last source of a history; the first amount of a year counts."""
    said = "CASE c_custkey % 4 WHEN 0 THEN concat('environ ', c_custkey % 900 + 100, ' 000 € de ventes') WHEN 1 THEN concat('total: ', c_custkey % 90 + 10, ' k€') WHEN 2 THEN concat('de ', c_custkey % 900 + 100, ' €') ELSE 'rien' END"
    c = _dealt(spark, sf_dir, "customer", "c_custkey").selectExpr("c_custkey AS company_id", "CAST(2018 + c_custkey % 6 AS STRING) AS year", f"explode(array(named_struct('position', 1, 'context', '5 555 €'), named_struct('position', 0, 'context', {said}))) AS p").where("p.position = 0 or company_id % 4 <> 3").select("company_id", "p.position", "year", "p.context")
    nothing = spark.createDataFrame([], "company_id long, position int, json string"), spark.createDataFrame([], "company_id long, table_no int, rows array<array<string>>")
    return registry.history(*nothing, c).select("company_id", "year", "field", "value", "source")


@query("""
SELECT c_custkey AS k, CASE WHEN c_custkey % 3 <> 0 THEN '123456' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') END AS siren, CAST(1950 + c_custkey % 70 AS INTEGER) AS founded, CAST(2026 - (1950 + c_custkey % 70) AS INTEGER) AS age, '62' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') || 'Z' AS naf,
    'SAS ' || c_mktsegment AS form, lower(c_mktsegment) || ' & co' AS plain_words, lower(c_mktsegment) AS plain_name, CAST(CASE c_custkey % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.85 WHEN 2 THEN 0.6 ELSE 0 END AS DOUBLE) AS domain_score,
    CAST(CASE c_custkey % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.5 WHEN 2 THEN 0.1 ELSE 0.3 END AS DOUBLE) AS exchange_score, CAST(CASE c_custkey % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.5 WHEN 2 THEN 0.2 ELSE 0.1 END AS DOUBLE) AS type_score, CAST(CASE WHEN c_custkey % 2 = 0 THEN 1.0 / 3 ELSE 0.5 END AS DOUBLE) AS jaccard
FROM customer""")
def company_identifiers(spark, sf_dir):
    k = F.col("k")
    c = _dealt(spark, sf_dir, "customer", "c_custkey", "c_mktsegment").selectExpr(
        "c_custkey AS k", "IF(c_custkey % 3 = 0, '12 34', concat('123 456 ', lpad(c_custkey % 1000, 3, '0'))) AS siren", "concat('le 1er mai ', 1950 + c_custkey % 70) AS founded", "concat('code 62', lpad(c_custkey % 100, 2, '0'), 'z') AS naf",
        "concat('SAS  ', c_mktsegment, ' Capital de 10') AS form", "concat(c_mktsegment, ' & Co') AS words", "concat(c_mktsegment, ' Holding S') AS x", "concat(c_mktsegment, ' SARL') AS name",
        "element_at(array('https://www.acme.com/x', 'acme.com.tn', 'acme.fr', 'other.org'), CAST(c_custkey % 4 + 1 AS INT)) AS site", "element_at(array('PAR', 'NYQ', 'LSE', ''), CAST(c_custkey % 4 + 1 AS INT)) AS exchange",
        "element_at(array('equity', 'FUND', 'ETF', 'x'), CAST(c_custkey % 4 + 1 AS INT)) AS kind", "IF(c_custkey % 2 = 0, 'a b', 'a') AS other",
    )
    plain = F.replace(company.plain_words(F.col("words")), F.lit("  "), F.lit(" "))
    return c.select(
        k, company.digits_of(F.col("siren"), 9).alias("siren"), company.year(F.col("founded")).alias("founded"), company.age(company.year(F.col("founded")), 2026).alias("age"), company.activity_code(F.col("naf")).alias("naf"), company.legal_form(F.col("form")).alias("form"),
        F.replace(plain, F.lit(" co"), F.lit(" & co")).alias("plain_words"), company.plain_name(F.col("name")).alias("plain_name"), company.domain_score(F.lit("acme.com"), F.col("site")).alias("domain_score"),
        company.exchange_score(F.col("exchange"), F.lit("FR")).alias("exchange_score"), company.type_score(F.col("kind")).alias("type_score"), company.jaccard(F.when(k % 2 == 0, "b c").otherwise("a b"), F.col("other")).alias("jaccard"),
    )


@query("""
SELECT c_custkey AS k, lpad(CAST(c_custkey % 90000 + 10000 AS VARCHAR), 5, '0') AS postcode, 'Ville' AS town, CASE c_custkey % 3 WHEN 0 THEN 'FR' WHEN 1 THEN 'MA' ELSE '' END AS iso, CASE WHEN c_custkey % 2 = 0 THEN 'Ville' ELSE 'rue de la Ville' END AS city,
    CAST(CASE WHEN c_custkey % 2 = 0 THEN 0.725 ELSE 0.865 END AS DOUBLE) AS score, CASE WHEN c_custkey % 2 = 0 THEN 'bon' ELSE 'excellent' END AS level
FROM customer""")
def addresses_read(spark, sf_dir):
    c = _dealt(spark, sf_dir, "customer", "c_custkey").selectExpr("c_custkey AS k", "concat('1 rue X ', c_custkey % 90000 + 10000, ' Ville') AS address", "element_at(array('France', 'Maroc', 'Mars'), CAST(c_custkey % 3 + 1 AS INT)) AS country", "IF(c_custkey % 2 = 0, '3 rue X, 75001, Ville, France', '3 rue de la Ville France') AS place", "IF(c_custkey % 2 = 0, 0.0, 1.0) AS d")
    score = market.match_score(F.col("d"), F.when(F.col("k") % 2 == 0, 1.0).otherwise(0.9), F.lit(0.3), F.when(F.col("k") % 2 == 0, 0.5667).otherwise(1.0))
    rounded = F.round(score, 3)
    return c.select("k", market.postcode(F.col("address")).alias("postcode"), market.town(F.col("address")).alias("town"), market.iso2(F.col("country")).alias("iso"), market.city(F.col("place"), F.lit("France")).alias("city"), rounded.alias("score"), market.level(rounded).alias("level"))


@query("""
WITH s AS (
    SELECT o_orderstatus AS item, count(*) AS n FROM orders GROUP BY 1
), u AS (
    SELECT o_custkey AS k, 0 AS f FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT c_custkey, 1 FROM customer
)
SELECT 'coverage' AS what, item, n FROM s
UNION ALL (SELECT 'most_frequent', item, n FROM s ORDER BY n DESC, item LIMIT 1)
UNION ALL SELECT 'outcome', coalesce(CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END, 'none'), count(*) FROM orders GROUP BY 2
UNION ALL SELECT 'union', 'frame' || f, count(*) FROM (SELECT k, min(f) AS f FROM u GROUP BY k) GROUP BY f""")
def order_statistics(spark, sf_dir):
    o, c = _t(spark, sf_dir, "orders"), _t(spark, sf_dir, "customer")
    tell = lambda what, df: df.select(F.lit(what).alias("what"), F.col(df.columns[0]).alias("item"), "n")
    status = o.withColumn("s", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")))
    outcome = records.outcomes(status, "s").select(F.explode("of_status").alias("item", "n"))
    ids = lambda df, key, frame: df.select(F.col(key).alias("k"), F.lit(frame).alias("item"))
    union = records.union_distinct([ids(o.where("o_orderkey % 2 = 0"), "o_custkey", "frame0"), ids(c, "c_custkey", "frame1")], ["k"]).groupBy("item").agg(F.count("*").alias("n"))
    return tell("coverage", records.coverage(o, "o_orderstatus")).unionByName(tell("most_frequent", records.most_frequent(o, "o_orderstatus"))).unionByName(tell("outcome", outcome)).unionByName(tell("union", union))


@query("""
SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 2 THEN 'https://first.org' ELSE 'https://www.acme' || c_custkey || '.com' END AS website, CASE WHEN c_custkey % 2 = 0 THEN 'https://cdn.x/logo' || c_custkey || '.png' END AS logo,
    'https://www.acme' || c_custkey || '.com/about-us' AS about, CASE WHEN c_custkey % 4 = 0 THEN 'https://www.acme' || c_custkey || '.com/team/x' END AS team
FROM customer""")
def markdown_fields(spark, sf_dir):
    """Site, logo and inner links of markdown pages."""
    site = "concat('https://www.acme', c_custkey, '.com')"
    md = f"""concat('[In](https://linkedin.com/x) [F](https://first.org/a) ![hero](https://cdn.x/hero-logo.png) ', IF(c_custkey % 2 = 0, concat('![l](https://cdn.x/logo', c_custkey, '.png) '), ''), IF(c_custkey % 3 = 0, concat('[Home](', {site}, '/home) '), ''), IF(c_custkey % 3 = 1, concat({site}, '/bare '), ''),
        '[A](', {site}, '/about-us) [Again](', {site}, '/about) ', IF(c_custkey % 4 = 0, concat('[T](', {site}, '/team/x "title")'), ''))"""
    c = _dealt(spark, sf_dir, "customer", "c_custkey").selectExpr("c_custkey AS k", f"{md} AS md", f"{site} AS site")
    hint = F.when(F.col("k") % 3 == 2, "nothing").otherwise(F.concat(F.lit("acme"), F.col("k").cast("string")))
    inner = profile.inner_urls(F.col("md"), F.col("site"))
    return c.select("k", profile.website(F.col("md"), hint).alias("website"), profile.logo(F.col("md")).alias("logo"), F.try_element_at(inner, F.lit("about")).alias("about"), F.try_element_at(inner, F.lit("team")).alias("team"))


@query("""
SELECT c_custkey AS k, CASE c_custkey % 3 WHEN 0 THEN 'Ann Doe/Présidente directrice/50/true' WHEN 1 THEN 'Bob Roe/Gérant//false' ELSE '' END AS leaders, CASE WHEN c_custkey % 2 = 0 THEN 'Globex|Initech' ELSE 'Globex' END AS organisations, 'Lyon|Paris' AS places,
    CASE WHEN c_custkey % 2 = 0 THEN 'Jane DOE: CEO|Max Power: Head of Sales' ELSE 'Max Power: Head of Sales' END AS team, CASE WHEN c_custkey % 2 = 0 THEN 'This product has changed the way we all work/JOHN SMITH/Director at Globex' ELSE '' END AS quotes
FROM customer""")
def people_and_places(spark, sf_dir):
    c = _dealt(spark, sf_dir, "customer", "c_custkey").selectExpr(
        "c_custkey AS k",
        "CASE c_custkey % 3 WHEN 0 THEN array(array('Ann  Doe', 'Présidente directrice', '50 ans'), array('Ann Doe', 'présidente directrice'), array('KPMG SA', 'Gérant')) WHEN 1 THEN array(array('Bob Roe', 'Gérant', 'x'), array('Old Man', 'Ancien gérant')) ELSE array(array('One')) END AS people",
        "IF(c_custkey % 2 = 0, array('Globex', 'GLOBEX', '3M Corp', 'Acme Labs', 'Initech', 'abc'), array('Globex', 'A & B & C')) AS orgs", "array('Lyon', null, '') AS cities", "array('lyon', 'Paris') AS named",
        "IF(c_custkey % 2 = 0, concat('Jane DOE CEO of all. ', chr(10), '\\\"This product has changed the way we all work\\\" JOHN SMITH, Director at Globex'), 'nothing') AS text",
        "array(named_struct('name', 'Max Power', 'context', 'says Max Power, Head of Sales'), named_struct('name', 'Tiny', 'context', 'CEO'), named_struct('name', 'No Title', 'context', 'x')) AS persons",
    )
    joined = lambda c, f: F.array_join(F.transform(c, f), "|")
    return c.select(
        "k", joined(profile.leaders(F.col("people")), lambda p: F.concat(p["name"], F.lit("/"), p["title"], F.lit("/"), F.coalesce(p["age"].cast("string"), F.lit("")), F.lit("/"), F.when(F.lower(p["title"]).contains("directrice"), F.lit("true")).otherwise("false"))).alias("leaders"),
        F.array_join(profile.organisations(F.col("orgs"), F.lit("acme")), "|").alias("organisations"), F.array_join(profile.places(F.col("cities"), F.col("named")), "|").alias("places"),
        joined(profile.team_leaders(F.col("text"), F.col("persons")), lambda p: F.concat(p["name"], F.lit(": "), p["title"])).alias("team"), joined(reviews.quotations(F.col("text"), F.lit("acme")), lambda q: F.concat_ws("/", q["quote"], q["author"], q["role"])).alias("quotes"),
    )


@query("""
SELECT p_partkey AS k, 'https://h.com' || CASE p_partkey % 6 WHEN 0 THEN '/a/up' || p_partkey WHEN 1 THEN '/' WHEN 2 THEN '/a/b/x/y' WHEN 3 THEN '/up/' WHEN 4 THEN '/a/b/c?q=' || p_partkey ELSE '/a/b/x' END AS href,
    'https://h.com/a/b' AS parent_form, CASE p_partkey % 6 WHEN 1 THEN true WHEN 3 THEN false ELSE false END AS is_root
FROM part""")
def relative_links(spark, sf_dir):
    """Links with dots, resolved against a page."""
    link = "CASE p_partkey % 6 WHEN 0 THEN concat('../up', p_partkey) WHEN 1 THEN '../../../..' WHEN 2 THEN './x/./y' WHEN 3 THEN '../../up/z/..' WHEN 4 THEN concat('?q=', p_partkey) ELSE 'q/../x' END"
    p = _t(spark, sf_dir, "part").selectExpr("p_partkey AS k", f"{link} AS link").withColumn("href", urls.absolute(F.col("link"), F.lit("https://h.com/a/b/c#f")))
    return p.select("k", "href", urls.validated(F.lit(" https://h.com/a/b/?x#y")).alias("parent_form"), (F.col("href") == "https://h.com/").alias("is_root"))


@query("""
SELECT user_id, md5(lower('User' || user_id)) AS key, event_id, event_type FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 5 DAY
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def fresh_entries(spark, sf_dir):
    """The latest entry of each key that is younger than the time to live."""
    e = _t(spark, sf_dir, "events").withColumn("key", landed.cache_key(F.concat(F.lit("User"), F.col("user_id").cast("string"))))
    once = records.keep_first(e.withColumn("ts", F.col("ts").cast("timestamp")), ["user_id", "ts"], [-F.col("event_id")])
    return landed.fresh(once, "2024-01-20 00:00:00", 5 * 86_400).select("user_id", "key", "event_id", "event_type")


@query("""
WITH i AS (
    SELECT doc_id, 'https://n.org/' || (doc_id % 300) AS url, CASE WHEN doc_id % 4 = 0 THEN '' ELSE 'T' || doc_id END AS title, 'src' || (doc_id % 3) AS source, lang AS excerpt FROM documents WHERE doc_id % 7 <> 0
)
SELECT url, title AS rss_title, '' AS rss_date, source, excerpt FROM i QUALIFY row_number() OVER (PARTITION BY url ORDER BY doc_id) = 1""")
def news_items(spark, sf_dir):
    items = _t(spark, sf_dir, "documents").selectExpr("IF(doc_id % 7 = 0, ' ', concat('https://n.org/', doc_id % 300)) AS url", "IF(doc_id % 4 = 0, null, concat(' T', doc_id, ' ')) AS title", "CAST(null AS STRING) AS published", "concat('src', doc_id % 3) AS source", "lang AS description", "doc_id AS position")
    return landed.news(items)


@query("""
WITH d AS (
    SELECT doc_id, repeat('* go to **x**' || chr(10), 25) AS menu, regexp_replace(text, '\\s+', ' ', 'g') AS body FROM documents
), p AS (
    SELECT *, trim(body) AS rest, length(regexp_replace(menu || body, '\\s+', '', 'g')) AS dense FROM d
)
SELECT doc_id, CASE WHEN dense < 500 THEN 'too_short' ELSE 'nav_dump' END AS status, CASE WHEN dense < 500 THEN NULL WHEN length(rest) >= 200 THEN rest ELSE menu || body END AS content FROM p""")
def prepared_pages(spark, sf_dir):
    """Pages that begin with a menu: what follows it is used, if that is enough."""
    md = "concat(repeat('* go to **x**\\n', 25), regexp_replace(text, '\\\\s+', ' '))"
    return _t(spark, sf_dir, "documents").selectExpr("doc_id", f"{md} AS md").select("doc_id", bundles.prepared(F.col("md")).alias("p")).select("doc_id", "p.status", "p.content")


@query("""
WITH l AS (
    SELECT o_custkey AS page_id, o_orderkey AS position, CASE o_orderkey % 5 WHEN 0 THEN 'https://s.org/news/n' || (o_orderkey % 40) WHEN 1 THEN 'https://s.org/p' || (o_orderkey % 60) WHEN 2 THEN 'https://o.org/x' WHEN 3 THEN 'https://s.org/f.pdf' ELSE 'https://s.org/blog' END AS href FROM orders
), k AS (
    SELECT page_id, href, min(position) AS position, CASE WHEN href LIKE '%/news/%' THEN 1 ELSE 2 END AS tier FROM l WHERE position % 5 < 2 GROUP BY ALL
)
SELECT page_id, href, CAST(tier AS INTEGER) AS tier FROM k QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY tier, position, href) <= 3""")
def article_links(spark, sf_dir):
    href = "CASE o_orderkey % 5 WHEN 0 THEN concat('https://s.org/news/n', o_orderkey % 40) WHEN 1 THEN concat('https://s.org/p', o_orderkey % 60) WHEN 2 THEN 'https://o.org/x' WHEN 3 THEN 'https://s.org/f.pdf' ELSE 'https://s.org/blog' END"
    links = _t(spark, sf_dir, "orders").selectExpr("o_custkey AS page_id", "'https://s.org/' AS url", "o_orderkey AS position", f"{href} AS href")
    return navigation.article_candidates(links, 3)


@query("""
SELECT p_partkey AS k, CASE WHEN p_partkey % 3 = 0 THEN 'a b' END AS squeezed, CASE WHEN p_partkey % 2 = 0 THEN 'https://x.org' ELSE 'http://x.org' END AS url, CASE WHEN p_partkey % 2 = 0 THEN 'About About about us near' ELSE 'about us about us about us near' END AS scoring
FROM part""")
def link_texts(spark, sf_dir):
    p = _t(spark, sf_dir, "part").selectExpr("p_partkey AS k", "IF(p_partkey % 3 = 0, ' a  b ', '  ') AS raw", "IF(p_partkey % 2 = 0, ' x.org', 'http://x.org') AS url", "IF(p_partkey % 2 = 0, ' About ', '>') AS t")
    return p.select("k", text.squeeze_or_null(F.col("raw")).alias("squeezed"), urls.with_scheme(F.col("url")).alias("url"), navigation.scoring_text(F.col("t"), F.lit("about us"), F.lit("near")).alias("scoring"))
