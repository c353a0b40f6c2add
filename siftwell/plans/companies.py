"""Queries over companies' links, figures and files, with their SQL; registered in the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwell.functions import articles, text, urls
from siftwell.operators import enrichment, market, navigation, records, registry
from siftwell.plans.catalog import _dealt, _list, _t, query

_names = [*navigation.CATEGORIES]
_least = ", ".join(f"('{n}', {k}, {t})" for k, (n, t) in enumerate(navigation.CATEGORIES.items()))


@query(f"""
WITH known(category, priority, least) AS (VALUES {_least}), e AS (
    SELECT vec_id, embedding::DOUBLE[] AS v, list_extract({_list(_names)}, label % 7 + 1) AS own FROM embeddings
), anchors AS (
    SELECT own AS category, v AS anchor FROM e QUALIFY row_number() OVER (PARTITION BY own ORDER BY vec_id) <= 5
), c AS (
    SELECT vec_id, category, list_dot_product(v, anchor) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(anchor, anchor)) + 1e-9) AS c FROM e CROSS JOIN anchors
), t AS (
    SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY vec_id, category ORDER BY c DESC) <= 3
), s AS (
    SELECT vec_id, category, round(avg(c), 4) AS score FROM t GROUP BY ALL
), r AS (
    SELECT *, row_number() OVER w AS k, lead(score) OVER w AS nxt FROM s WINDOW w AS (PARTITION BY vec_id ORDER BY score DESC, category)
), p AS (
    SELECT vec_id % 25 AS page_id, vec_id, category, priority, least, CASE WHEN score - nxt < 0.04 THEN round(score * 0.85, 4) ELSE score END AS score FROM r JOIN known USING (category) WHERE k = 1
), capped AS (
    SELECT * FROM p WHERE score >= least QUALIFY row_number() OVER (PARTITION BY page_id, category ORDER BY score DESC, vec_id) <= 2
)
SELECT page_id, 'https://s.com/' || vec_id AS href, category, score, CAST(row_number() OVER (PARTITION BY page_id ORDER BY priority, score DESC, vec_id) AS INTEGER) AS rank
FROM capped QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY priority, score DESC, vec_id) <= 9""")
def embedding_links(spark, sf_dir):
    """Links scored by embedding, with each category's threshold, in the order of priorities and scores, under both caps."""
    e = _t(spark, sf_dir, "embeddings").withColumn("own", F.get(F.array(*[F.lit(n) for n in _names]), (F.col("label") % 7).cast("int")))
    anchors = records.top_of_each(e, ["own"], [F.asc("vec_id")], 5).select(F.col("own").alias("category"), F.col("embedding").alias("anchor"))
    links = e.select("vec_id", (F.col("vec_id") % 25).alias("page_id"), F.concat(F.lit("https://s.com/"), F.col("vec_id").cast("string")).alias("href"), F.col("vec_id").alias("position"))
    return navigation.pick_links(navigation.score_by_embedding(links, e, anchors), _names, 2, 9).select("page_id", "href", "category", "score", "rank")


@query("""
SELECT 'S' || s_suppkey AS symbol, CASE WHEN s_suppkey % 4 <> 3 THEN s_name END AS "longName", CASE WHEN s_suppkey % 4 = 0 THEN s_suppkey * 10 END AS "fullTimeEmployees", CASE WHEN s_suppkey % 4 < 2 THEN CAST((s_suppkey % 100) / 128.0 AS DOUBLE) END AS "profitMargins",
    CASE WHEN s_suppkey % 4 < 2 THEN printf('%.1f%%', (s_suppkey % 100) / 128.0 * 100) END AS "profitMargins_pct", CASE WHEN s_suppkey % 4 = 0 THEN printf('%+.1f%%', (s_suppkey % 16 - 8) / 32.0 * 100) END AS "revenueGrowth_pct",
    CASE s_suppkey % 4 WHEN 3 THEN '$' WHEN 2 THEN '$[''profitMargins'']' WHEN 1 THEN '$[''fullTimeEmployees'']' ELSE '' END AS rejected
FROM supplier""")
def quote_infos(spark, sf_dir):
    """Market answers, some with texts where numbers belong, some that are no JSON."""
    json = """concat('{"longName": "', s_name, '", "sector": null, "fullTimeEmployees": ', CASE s_suppkey % 4 WHEN 0 THEN string(s_suppkey * 10) WHEN 1 THEN '"some"' ELSE 'null' END, ', "profitMargins": ', IF(s_suppkey % 4 < 2, string(s_suppkey % 100 / 128), '[1]'),
        IF(s_suppkey % 4 = 0, concat(', "revenueGrowth": ', (s_suppkey % 16 - 8) / 32), ''), IF(s_suppkey % 4 = 3, '', '}'))"""
    out = market.quote_info(_t(spark, sf_dir, "supplier").selectExpr("concat('S', s_suppkey) AS symbol", f"{json} AS json"))
    return out.select("symbol", "longName", "fullTimeEmployees", "profitMargins", "profitMargins_pct", "revenueGrowth_pct", F.array_join("rejected", ",").alias("rejected"))


@query(f"""
WITH h AS (
    SELECT c_custkey AS k, y, 1000 + c_custkey % 40 + CASE y WHEN 2023 THEN (c_custkey % 11 - 5) * 32 WHEN 2022 THEN 0 ELSE -64 END AS ca FROM customer, (VALUES (2020), (2022), (2023)) t(y)
), f AS (
    SELECT k, max(ca) FILTER (y = 2023) AS ca, max(ca) FILTER (y = 2022) AS before, max(ca) FILTER (y = 2020) AS first, (k % 9 - 3) * 50 AS net, 100 + k % 5 * 100 AS own, 300 AS debt FROM h GROUP BY k
), i AS (
    SELECT *, round(CAST(ca - before AS DOUBLE) / before * 100, 1) AS growth, CASE WHEN net <> 0 THEN round(CAST(net AS DOUBLE) / ca * 100, 1) END AS margin, round(CAST(debt AS DOUBLE) / own, 2) AS ratio FROM f
)
SELECT k AS company_id, CAST(2023 AS INTEGER) AS year, CAST(growth AS DOUBLE) AS growth_pct, CAST(margin AS DOUBLE) AS margin_pct, CAST(ratio AS DOUBLE) AS debt_ratio, CAST(round((pow(CAST(ca AS DOUBLE) / first, 1.0 / 3) - 1) * 100, 1) AS DOUBLE) AS cagr_pct,
    printf('%+.1f%%', growth) AS growth_label, printf('%.2fx', ratio) AS debt_label,
    concat_ws('|', CASE WHEN growth > 5 THEN '{registry.GROWING}' WHEN growth <= -5 THEN '{registry.SHRINKING.replace("'", "''")}' END, CASE WHEN margin > 10 THEN '{registry.PROFITABLE.replace("'", "''")}' WHEN margin < 0 THEN '{registry.LOSING}' END, CASE WHEN ratio >= 2 THEN '{registry.INDEBTED}' END) AS signals
FROM i""")
def registry_indicators(spark, sf_dir):
    years = F.explode(F.array(*[F.lit(y) for y in (2020, 2022, 2023)])).alias("year")
    c = _dealt(spark, sf_dir, "customer", "c_custkey").select(F.col("c_custkey").alias("company_id"), years)
    k, y = F.col("company_id"), F.col("year")
    ca = 1000 + k % 40 + F.when(y == 2023, (k % 11 - 5) * 32).when(y == 2022, 0).otherwise(-64)
    last = lambda v: F.when(y == 2023, v)
    rows = c.select("company_id", "year", F.explode(F.create_map(F.lit("ca"), ca.cast("double"), F.lit("resultat_net"), last((k % 9 - 3) * 50).cast("double"), F.lit("capitaux_propres"), last(100 + k % 5 * 100).cast("double"), F.lit("dettes_financieres"), last(F.lit(300)).cast("double"))).alias("field", "value")).where("value is not null")
    out = registry.indicators(rows)
    return out.select("company_id", "year", "growth_pct", "margin_pct", "debt_ratio", "cagr_pct", "growth_label", "debt_label", F.array_join("signals", "|").alias("signals"))


@query(f"""
SELECT c_custkey, 'https://www.' || replace(lower(c_mktsegment), ' ', '') || '.' || CASE c_custkey % 3 WHEN 0 THEN 'com' WHEN 1 THEN 'fr' ELSE 'zz' END || CASE WHEN c_custkey % 2 = 0 THEN CASE WHEN c_custkey % 3 = 2 THEN '.' ELSE '/' END || 'about' || CASE WHEN c_custkey % 3 = 2 THEN '.' ELSE '/' END || c_custkey ELSE '' END AS url,
    'a ' || c_custkey AS clean FROM customer""")
def file_urls(spark, sf_dir):
    name = "concat('www_', replace(lower(c_mktsegment), ' ', ''), '_', element_at(array('com', 'fr', 'zz'), CAST(c_custkey % 3 + 1 AS INT)), IF(c_custkey % 2 = 0, concat('_about_', c_custkey), '__'), '.md')"
    c = _t(spark, sf_dir, "customer").selectExpr("c_custkey", f"{name} AS file", "concat(' a\\u200b \\n', c_custkey, '\\u200b') AS raw")
    return c.select("c_custkey", urls.of_file_name(F.col("file")).alias("url"), text.squeeze_visible(F.col("raw")).alias("clean"))


@query(f"""
WITH d AS (
    SELECT doc_id, text, 'https://Site.org/' || CASE doc_id % 6 WHEN 0 THEN 'page/2' WHEN 1 THEN '' WHEN 2 THEN 'our-Team/x' WHEN 3 THEN 'post/tags/a' WHEN 4 THEN 'feedback' ELSE 'item-' || doc_id END AS url FROM documents
)
SELECT doc_id, doc_id % 6 IN (0, 1, 3, 4) AS is_listing, doc_id % 6 <> 2 AND length(text) >= 400 AND len(string_split(text, chr(10))) > 5 AS is_plain_article FROM d""")
def plain_article_rules(spark, sf_dir):
    path = "CASE doc_id % 6 WHEN 0 THEN 'page/2' WHEN 1 THEN '' WHEN 2 THEN 'our-Team/x' WHEN 3 THEN 'post/tags/a' WHEN 4 THEN 'feedback' ELSE concat('item-', doc_id) END"
    d = _t(spark, sf_dir, "documents").selectExpr("doc_id", "text", f"concat('https://Site.org/', {path}) AS url")
    return d.select("doc_id", articles.is_listing(F.col("url")).alias("is_listing"), articles.is_plain_article(F.col("url"), F.col("text")).alias("is_plain_article"))


@query("""
WITH w AS (
    SELECT doc_id % 97 AS company_id, doc_id AS page_no, unnest(string_split(replace(replace(text, '[', ''), ']', ''), ' ')) AS word, unnest(range(len(string_split(replace(replace(text, '[', ''), ']', ''), ' ')))) AS k FROM documents
), f AS (
    SELECT company_id, word, min(page_no) AS page_no FROM w WHERE regexp_full_match(word, '[a-z]{9}') GROUP BY ALL
)
SELECT company_id, 'https://s.com/a/' || word AS href, word AS text, CAST(page_no AS INTEGER) AS page_no, 'page' || page_no AS source_page FROM f""")
def bundle_links(spark, sf_dir):
    """Words of nine letters are links; each is a company's once, from the first page that has it."""
    md = "array_join(transform(split(replace(replace(text, '[', ''), ']', ''), ' '), w -> IF(w rlike '^[a-z]{9}$', concat('[', w, '](https://s.com/a/', w, ')'), w)), ' ')"
    pages = _t(spark, sf_dir, "documents").selectExpr("doc_id % 97 AS company_id", "concat('page', doc_id) AS category", "CAST(doc_id AS INT) AS page_no", "'https://s.com' AS url", f"{md} AS markdown")
    return navigation.bundle_links(pages).select("company_id", "href", "text", "page_no", "source_page")


@query("SELECT o_custkey AS company_id, CAST(coalesce(sum(CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 4 END), 0) AS BIGINT) AS total FROM orders GROUP BY 1")
def list_totals(spark, sf_dir):
    items = "IF(o_orderkey % 5 <> 0, filter(sequence(0L, 4L), x -> x < o_orderkey % 4), null)"
    return enrichment.list_totals(_t(spark, sf_dir, "orders").selectExpr("o_custkey AS company_id", f"{items} AS items"), ["company_id"], "items")
