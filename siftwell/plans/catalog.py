"""Queries over the landed tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from siftwell.functions import articles, company, text, urls
from siftwell.operators import fingerprints, market, matching, navigation, records
from siftwell.shared import spread

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dealt(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table of narrow rows from which pages or texts are made, dealt before that."""
    return spread(_t(spark, sf_dir, name).select(*columns))


def _list(words: list[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _hits(column: str, words: list[str]) -> str:
    return f"len(list_filter({_list(words)}, lambda k: contains({column}, k)))"


def _case(column: str, rules: list[tuple[str, list[str]]], other: str) -> str:
    return "CASE " + " ".join(f"WHEN {_hits(column, ws)} > 0 THEN '{name}'" for name, ws in rules) + f" ELSE '{other}' END"


@query("SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS cleaned FROM documents")
def clean_space(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", text.squeeze(F.col("text")).alias("cleaned"))


@query(f"""
SELECT doc_id, CASE WHEN {_hits('p', text.FR_MARKERS)} > {_hits('p', text.EN_MARKERS)} THEN 'fr' ELSE 'en' END AS language
FROM (SELECT doc_id, ' ' || lower(text) || ' ' AS p FROM documents)""")
def detect_language(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", text.language(F.col("text")).alias("language"))


@query(f"""
SELECT doc_id, CASE WHEN n < 50 OR (f = 0 AND e = 0) THEN CASE WHEN lang IN ('fr', 'en') THEN lang ELSE 'unknown' END WHEN f >= e THEN 'fr' ELSE 'en' END AS language
FROM (SELECT doc_id, lang, n, {_hits('p', text.FR_RELIABLE)} AS f, {_hits('p', text.EN_RELIABLE)} AS e
      FROM (SELECT doc_id, lang, length(text) AS n, ' ' || lower(left(text, 2000)) || ' ' AS p FROM documents))""")
def detect_language_reliable(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", text.language_reliable(F.col("text"), F.col("lang")).alias("language"))


@query(f"SELECT doc_id, {_case('lower(text)', text.ARTICLE_TYPES, 'general')} AS article_type FROM documents")
def detect_article_type(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", text.article_type(F.col("text")).alias("article_type"))


_subject_rows = ", ".join(f"CASE WHEN {_hits('lower(text)', ws)} > 0 THEN '{name}' END" for name, ws in text.SUBJECTS)


@query(f"""
SELECT doc_id, CASE WHEN s = '' THEN 'autre' ELSE s END AS subjects
FROM (SELECT doc_id, concat_ws(',', {_subject_rows}) AS s FROM documents)""")
def classify_subject(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.array_join(text.subjects(F.col("text")), ",").alias("subjects"))


@query(f"""
WITH t AS (SELECT doc_id, lower(split_part(text, ' ', 1)) AS c, lower(split_part(text, chr(10), 1)) AS title, lower(text) AS b FROM documents),
u AS (SELECT *, CASE WHEN c = '' THEN 0 ELSE (length(b) - length(replace(b, c, ''))) // length(c) END AS n, len(list_filter({_list(text.NEGATIVE)}, lambda k: contains(title, k) OR contains(b, k))) AS bad FROM t)
SELECT doc_id, CAST((CASE WHEN c <> '' AND contains(title, c) THEN 3 ELSE 0 END) + (CASE WHEN n >= 1 THEN 2 ELSE 0 END) + (CASE WHEN n >= 2 THEN 1 ELSE 0 END) - 3 * bad AS INTEGER) AS score,
       CAST(n AS BIGINT) AS company_count, length(b) > 200 AS has_full_text FROM u""")
def relevance(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents")
    info = text.relevance(F.substring_index("text", " ", 1), F.substring_index("text", "\n", 1), F.col("text"))
    return docs.select("doc_id", info.alias("r")).select("doc_id", "r.score", "r.company_count", "r.has_full_text")


_count = lambda w: f"(length(b) - length(replace(b, '{w}', ''))) / {len(w)}"


@query(f"""
WITH t AS (SELECT page_id, html AS h, lower(html) AS b, regexp_replace(lower(html), '\\s+', '', 'g') AS d FROM pages)
SELECT page_id,
  length(d) >= 500 AND {_hits('d', text.BLOCKED)} = 0 AS is_valid,
  {_hits('left(b, 500)', text.LEGAL_TITLES)} > 0 OR ({' + '.join(_count(w) for w in text.LEGAL_TERMS)}) / (greatest(length(b), 1) / 1000.0) > 5 AS is_legal,
  CASE WHEN length(d) < 500 THEN 'too_short' WHEN {_hits('d', text.BLOCKED)} > 0 THEN 'bot_blocked' WHEN {_hits('b', text.JS_BLOCKED)} > 0 THEN 'js_blocked'
       WHEN {_count('go to **')} > 20 OR ({_hits('b', text.NAV_SIGNS)} >= 2 AND len(list_filter(string_split(h, chr(10)), lambda x: trim(x) <> '')) > 150) THEN 'nav_dump'
       WHEN {_hits('left(b, 500)', text.LEGAL_TITLES)} > 0 OR ({' + '.join(_count(w) for w in text.LEGAL_TERMS)}) / (greatest(length(b), 1) / 1000.0) > 5 THEN 'wrong_page' ELSE 'valid' END AS status
FROM t""")
def evaluate_pages(spark, sf_dir):
    h = F.col("html")
    return _t(spark, sf_dir, "pages").select("page_id", text.content_valid(h).alias("is_valid"), text.legal_page(h).alias("is_legal"), text.page_status(h)["status"].alias("status"))


@query("""
WITH t AS (SELECT page_id, url, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS h, regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS p FROM pages),
u AS (SELECT *, regexp_replace(split_part(lower(h), ':', 1), '^www\\.', '') AS d FROM t)
SELECT page_id, regexp_replace(regexp_extract(trim(url), '^(https?://[^/?#]+[^?#]*)', 1), '/+$', '') AS valid_url,
  regexp_replace(split_part(url, '?', 1), '/+$', '') AS clean_url,
  regexp_replace(regexp_replace(regexp_replace(url, '#.*$', ''), '([^:])//+', '\\1/', 'g'), '/+$', '') AS normal_url,
  array_to_string(string_split(url, '/')[1:3], '/') AS site,
  lower(trim(regexp_replace(regexp_replace(translate(regexp_replace(p, '\\.[a-z]{2,4}$', ''), '-_/', '   '), '\\b\\d+\\b', '', 'g'), '\\s+', ' ', 'g'))) AS slug,
  translate(regexp_replace(regexp_replace(url, '^https?://', ''), '/+$', ''), '/.', '__') AS file_name,
  d AS domain, array_to_string(string_split(d, '.')[-2:], '.') AS root_domain, replace(h, 'www.', '') AS source_host
FROM u""")
def url_forms(spark, sf_dir):
    u = F.col("url")
    return _t(spark, sf_dir, "pages").select("page_id", urls.validated(u).alias("valid_url"), urls.without_query(u).alias("clean_url"), urls.normalized(u).alias("normal_url"), urls.site(u).alias("site"), urls.slug(u).alias("slug"), urls.file_name(u).alias("file_name"), urls.domain(u).alias("domain"), urls.root_domain(urls.domain(u)).alias("root_domain"), urls.source_host(u).alias("source_host"))


_links_sql = """
links AS (
  SELECT page_id, url, unnest(range(0, len(hs))) AS position, unnest(hs) AS h, unnest(ts) AS t
  FROM (SELECT page_id, url, regexp_extract_all(html, '(?is)<a\\s[^>]*?href\\s*=\\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 1) AS hs, regexp_extract_all(html, '(?is)<a\\s[^>]*?href\\s*=\\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 2) AS ts FROM pages)),
based AS (SELECT page_id, url, position, trim(h) AS h, trim(regexp_replace(t, '<[^>]*>', '', 'g')) AS text, regexp_extract(url, '^[a-z]+://[^/?#]*') AS root, regexp_extract(url, '^[^?#]*') AS own FROM links),
joined AS (
  SELECT *, CASE WHEN regexp_matches(h, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN h WHEN h = '' THEN url WHEN starts_with(h, '//') THEN split_part(url, ':', 1) || ':' || h WHEN starts_with(h, '#') THEN split_part(url, '#', 1) || h
    WHEN starts_with(h, '?') THEN own || h WHEN starts_with(h, '/') THEN root || h WHEN own = root THEN root || '/' || h ELSE regexp_replace(own, '[^/]*$', '') || h END AS href
  FROM based),
absolute AS (SELECT page_id, url, position, text, href FROM joined WHERE regexp_matches(href, '(?i)^https?://'))"""


@query(f"WITH {_links_sql} SELECT page_id, CAST(position AS INTEGER) AS position, href, text FROM absolute")
def extract_links(spark, sf_dir):
    return matching.page_links(_t(spark, sf_dir, "pages")).select("page_id", "position", "href", "text")


@query(f"""
WITH {_links_sql},
n AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(href, '#.*$', ''), '([^:])//+', '\\1/', 'g'), '/+$', '') AS u FROM absolute),
s AS (SELECT *, lower(trim(regexp_replace(regexp_replace(translate(regexp_replace(regexp_extract(u, '^[a-z]+://[^/?#]*([^?#]*)', 1), '\\.[a-z]{{2,4}}$', ''), '-_/', '   '), '\\b\\d+\\b', '', 'g'), '\\s+', ' ', 'g'))) AS slug FROM n),
ok AS (SELECT * FROM s WHERE contains(replace(regexp_extract(u, '://([^/?#]*)', 1), 'www.', ''), replace(regexp_extract(url, '://([^/?#]*)', 1), 'www.', ''))
  AND {_hits('lower(u)', urls.EXTERNAL)} = 0 AND NOT regexp_matches(u, '(?i)^https?://[^/]+/(?:{urls.LOCALES})/?$') AND NOT (slug = '' AND text = '')
  AND len(list_intersect(regexp_split_to_array(lower(text || ' ' || slug), '[\\s/]+'), {_list(urls.UNWANTED_TOKENS)})) = 0 AND NOT contains(lower(text || ' ' || slug), 'accueil'))
SELECT page_id, u AS href, text, slug, CAST(position AS INTEGER) AS position FROM ok QUALIFY row_number() OVER (PARTITION BY page_id, u ORDER BY position) = 1""")
def select_links(spark, sf_dir):
    return matching.wanted_links(matching.page_links(_t(spark, sf_dir, "pages")))


@query("""
SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g')) AS title,
  trim(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '\\s+', ' ', 'g')) AS h1,
  regexp_extract(html, '(?is)<html[^>]*\\slang="([^"]*)"', 1) AS declared,
  regexp_matches(html, '(?i)<article[\\s>]') AND length(html) > 300 AS is_article
FROM pages""")
def page_fields(spark, sf_dir):
    field = lambda p: text.squeeze(F.regexp_extract("html", p, 1))
    return _t(spark, sf_dir, "pages").select("page_id", field(r"(?is)<title[^>]*>(.*?)</title>").alias("title"), field(r"(?is)<h1[^>]*>(.*?)</h1>").alias("h1"), F.regexp_extract("html", r'(?is)<html[^>]*\slang="([^"]*)"', 1).alias("declared"), (F.col("html").rlike(r"(?i)<article[\s>]") & (F.length("html") > 300)).alias("is_article"))


@query("""
SELECT doc_id, source, title FROM (SELECT doc_id, source, split_part(text, chr(10), 1) AS title FROM documents)
QUALIFY row_number() OVER (PARTITION BY lower(trim(title)), lower(trim(source)) ORDER BY doc_id) = 1""")
def deduplicate_articles(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").select("doc_id", "source", F.substring_index("text", "\n", 1).alias("title"))
    return records.keep_first(d, [F.lower(F.trim("title")), F.lower(F.trim("source"))], ["doc_id"])


@query("""
SELECT page_id, url FROM (SELECT page_id, url, regexp_extract(url, '://([^/?#]*)', 1) AS h FROM pages)
QUALIFY row_number() OVER (PARTITION BY h ORDER BY page_id) = 1""")
def first_page_of_host(spark, sf_dir):
    p = _t(spark, sf_dir, "pages").select("page_id", "url")
    return records.keep_first(p, [urls.host(F.col("url"))], ["page_id"])


@query("""
SELECT source, CAST(count(*) AS BIGINT) AS n_articles, array_to_string(list(CAST(doc_id AS VARCHAR) ORDER BY doc_id), ' ') AS ids, CAST(count(*) FILTER (length(text) >= 100) AS BIGINT) AS n_ready
FROM documents GROUP BY source""")
def group_articles(spark, sf_dir):
    ready = F.when(F.length("text") >= 100, 1).otherwise(0)
    groups = articles.grouped(_t(spark, sf_dir, "documents").select("source", "doc_id", ready.alias("ready")), "source", ["doc_id", "ready"], "doc_id")
    whole = groups.groupBy("source").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("part", "articles"))), lambda p: p["articles"])).alias("a"))  # the SQL has one row for each
    ids = F.transform("a", lambda x: x["doc_id"].cast("string"))
    return whole.select("source", F.size("a").cast("long").alias("n_articles"), F.array_join(ids, " ").alias("ids"), F.size(F.filter("a", lambda x: x["ready"] == 1)).cast("long").alias("n_ready"))


@query("""
WITH old AS (SELECT o_custkey AS k, min(o_orderkey) AS first_order, max(o_totalprice) AS price FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1),
new AS (SELECT o_custkey AS k, o_orderkey AS first_order, o_totalprice AS price FROM orders WHERE o_orderkey % 2 = 1 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
SELECT coalesce(o.k, n.k) AS custkey, coalesce(o.first_order, n.first_order) AS first_order, coalesce(n.price, o.price) AS price FROM old o FULL JOIN new n ON o.k = n.k""")
def upsert_customers(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("first_order"), F.col("o_totalprice").alias("price"))
    old = o.where("first_order % 2 = 0").groupBy("custkey").agg(F.min("first_order").alias("first_order"), F.max("price").alias("price"))
    return records.upsert(old, o.where("first_order % 2 = 1"), "custkey", "first_order", keep=("first_order",))


@query("""
WITH known AS (SELECT event_type || '-' || user_id AS k, min(event_id) AS event_id FROM events WHERE event_id % 3 = 0 GROUP BY 1),
new AS (SELECT event_type || '-' || user_id AS k, min(event_id) AS event_id FROM events WHERE event_id % 3 <> 0 GROUP BY 1)
SELECT * FROM known UNION ALL SELECT n.* FROM new n WHERE NOT EXISTS (SELECT 1 FROM known WHERE known.k = n.k)""")
def merge_by_key(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select(F.concat_ws("-", "event_type", "user_id").alias("k"), "event_id")
    known = e.where("event_id % 3 = 0").groupBy("k").agg(F.min("event_id").alias("event_id"))
    return records.merge_new(known, e.where("event_id % 3 <> 0"), "k", ["event_id"])


@query("""
SELECT p.page_id, p.url FROM pages p WHERE NOT EXISTS (SELECT 1 FROM pages d WHERE d.page_id % 4 = 0 AND d.url = p.url)""")
def resume_pending(spark, sf_dir):
    p = _t(spark, sf_dir, "pages").select("page_id", "url")
    return records.pending(p, p.where("page_id % 4 = 0"), "url")


@query("""
SELECT o.o_orderkey, c.c_name, o.o_orderdate, CAST(row_number() OVER (PARTITION BY c.c_custkey ORDER BY o.o_orderdate DESC, o.o_orderkey) AS INTEGER) AS rank
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey QUALIFY rank <= 2""")
def latest_by_company(spark, sf_dir):
    j = _t(spark, sf_dir, "orders").join(_t(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return records.top_of_each(j, ["c_custkey"], [F.desc("o_orderdate"), F.asc("o_orderkey")], 2).select("o_orderkey", "c_name", "o_orderdate", "rank")


_history = "SELECT o_custkey AS k, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS DOUBLE) AS v FROM orders GROUP BY 1, 2"


def _by_year(spark, sf_dir):
    return _t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("custkey"), F.year("o_orderdate").alias("year")).agg(F.sum(F.round("o_totalprice").cast("long")).cast("double").alias("value"))


@query(f"""
WITH h AS ({_history}), w AS (SELECT *, lag(v) OVER (PARTITION BY k ORDER BY y) AS b FROM h WHERE v <> 0),
z AS (SELECT k, max(y) AS y, arg_max(v, y) AS v, (SELECT w2.b FROM w w2 WHERE w2.k = w.k ORDER BY w2.y DESC LIMIT 1) AS b, min(y) AS ay, arg_min(v, y) AS av, count(*) AS n FROM w GROUP BY k),
g AS (SELECT *, round((v - b) / abs(b) * 100, 1) AS growth_pct FROM z)
SELECT k AS custkey, y AS year, v AS value, growth_pct, CASE WHEN n >= 3 AND av > 0 AND y > ay THEN round((pow(v / av, 1.0 / (y - ay)) - 1) * 100, 1) END AS cagr_pct,
  CASE WHEN growth_pct > 15 THEN 'strong growth' WHEN growth_pct > 5 THEN 'growth' WHEN growth_pct > -5 THEN 'stable' WHEN growth_pct IS NOT NULL THEN 'decline' END AS signal
FROM g""")
def revenue_indicators(spark, sf_dir):
    return records.yearly_indicators(_by_year(spark, sf_dir), "custkey", "year", "value")


_years = ", ".join(f"max(v) FILTER (y = {y}) AS y{y}" for y in range(1995, 2002))


@query(f"SELECT k AS custkey, {_years} FROM ({_history}) GROUP BY k")
def history_pivot(spark, sf_dir):
    p = _by_year(spark, sf_dir).groupBy("custkey").pivot("year", list(range(1995, 2002))).agg(F.max("value"))
    return p.select("custkey", *[F.col(str(y)).alias(f"y{y}") for y in range(1995, 2002)])


@query("""
SELECT c_custkey, n, CASE WHEN n = 0 THEN 'holding_ou_vide' WHEN n < 10 THEN 'TPE' WHEN n < 50 THEN 'PE' WHEN n < 250 THEN 'ME' WHEN n < 5000 THEN 'ETI' ELSE 'GE' END AS label
FROM (SELECT c_custkey, CAST(floor(abs(c_acctbal)) AS INTEGER) AS n FROM customer)""")
def size_labels(spark, sf_dir):
    n = F.floor(F.abs("c_acctbal")).cast("int")
    parsed = company.headcount(F.concat(n.cast("string"), F.lit(" salariés")))
    return _t(spark, sf_dir, "customer").select("c_custkey", parsed["high"].alias("n"), parsed["label"].alias("label"))


@query("""
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(n AS DOUBLE) WHEN 1 THEN n * 1e6 WHEN 2 THEN n * 1e3 END AS amount
FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS n FROM orders)""")
def parse_amounts(spark, sf_dir):
    n = F.floor("o_totalprice").cast("long").cast("string")
    k = F.col("o_orderkey") % 4
    raw = F.when(k == 0, F.concat(n, F.lit(" €"))).when(k == 1, F.concat(n, F.lit(",0 M€"))).when(k == 2, F.concat(n, F.lit(" k€"))).otherwise("Confidentiel")
    return _t(spark, sf_dir, "orders").select("o_orderkey", company.amount(raw).alias("amount"))


@query(f"""
WITH h AS ({_history}), w AS (SELECT *, lag(v) OVER (PARTITION BY k ORDER BY y) AS b FROM h),
z AS (SELECT k, arg_max(round((v - b) / abs(b) * 100, 1), y) AS g, max(y) AS y FROM w WHERE b IS NOT NULL GROUP BY k),
c AS (SELECT c_custkey, c_mktsegment, CAST(floor(abs(c_acctbal)) AS INTEGER) AS n, g FROM customer LEFT JOIN z ON k = c_custkey),
s AS (SELECT c_custkey, least(100, 4 + 4 + CASE WHEN n = 0 THEN 0 WHEN n < 10 THEN 5 WHEN n < 50 THEN 10 WHEN n < 250 THEN 15 ELSE 20 END
  + CASE WHEN g > 20 THEN 30 WHEN g > 10 THEN 25 WHEN g > 5 THEN 20 WHEN g > 0 THEN 10 ELSE 0 END) AS score FROM c)
SELECT c_custkey, CAST(score AS INTEGER) AS score, CASE WHEN score >= 75 THEN 'A' WHEN score >= 50 THEN 'B' WHEN score >= 25 THEN 'C' ELSE 'D' END AS label, CASE WHEN score >= 75 THEN 'haute' WHEN score >= 50 THEN 'moyenne' ELSE 'basse' END AS priority FROM s""")
def sales_scores(spark, sf_dir):
    w = Window.partitionBy("custkey").orderBy("year")
    h = _by_year(spark, sf_dir).withColumn("b", F.lag("value").over(w)).where("b is not null")
    growth = h.groupBy("custkey").agg(F.max_by(F.round((F.col("value") - F.col("b")) / F.abs("b") * 100, 1), "year").alias("g"))
    c = _t(spark, sf_dir, "customer").join(growth, F.col("custkey") == F.col("c_custkey"), "left").withColumn("n", F.floor(F.abs("c_acctbal")).cast("int"))
    none = F.lit(None).cast("string")
    s = company.sales_score(none, none, F.col("c_mktsegment"), F.col("n"), F.lit(0), company.headcount_label(F.col("n")), F.col("g"), F.lit(None).cast("double"), F.lit(None).cast("int"))
    return c.select("c_custkey", s.alias("s")).select("c_custkey", "s.score", "s.label", "s.priority")


_anchors = "anchors AS (SELECT label AS category, embedding AS anchor FROM embeddings QUALIFY row_number() OVER (PARTITION BY label ORDER BY vec_id) <= 5)"


@query(f"""
WITH {_anchors}, c AS (SELECT e.vec_id, a.category, list_dot_product(e.embedding::DOUBLE[], a.anchor::DOUBLE[]) / (sqrt(list_dot_product(e.embedding::DOUBLE[], e.embedding::DOUBLE[])) * sqrt(list_dot_product(a.anchor::DOUBLE[], a.anchor::DOUBLE[])) + 1e-9) AS c FROM embeddings e CROSS JOIN anchors a),
t AS (SELECT vec_id, category, c FROM c QUALIFY row_number() OVER (PARTITION BY vec_id, category ORDER BY c DESC) <= 3),
s AS (SELECT vec_id, category, round(avg(c), 4) AS score FROM t GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, category) AS k, lead(score) OVER (PARTITION BY vec_id ORDER BY score DESC, category) AS nxt FROM s),
p AS (SELECT vec_id, category, CASE WHEN score - nxt < 0.04 THEN round(score * 0.85, 4) ELSE score END AS score FROM r WHERE k = 1)
SELECT * FROM p WHERE score >= 0.33""")
def embedding_categories(spark, sf_dir):
    e = _t(spark, sf_dir, "embeddings")
    anchors = records.top_of_each(e, ["label"], [F.asc("vec_id")], 5).select(F.col("label").alias("category"), F.col("embedding").alias("anchor"))
    return matching.best_category(matching.category_scores(e.select("vec_id", "embedding"), anchors))


#: Example rules: technology, pattern of the html, confidence.  Users supply their own fingerprints.
RULES = [("Tracker", r"track\(\d+\)", 1.0), ("Inline style", r"<style>", 0.75), ("Utf8", r'charset="utf-8"', 0.9), ("Ads", r'class="ad"', 0.4)]
FINGERPRINTS = {t: {"html": f"{p}\\;confidence:{round(c * 100)}"} for t, p, c in RULES}
FINGERPRINTS["Tracker"] |= {"cats": [41], "implies": "Analytics"}
FINGERPRINTS["Inline style"]["cats"] = [99]
FINGERPRINTS["Analytics"] = {"cats": [10]}
_rules = ", ".join(f"('{t}', '{p}', {c}, '{fingerprints.FIELD_OF.get((FINGERPRINTS[t].get('cats') or [0])[0], '')}')" for t, p, c in RULES)
_found = f"""rules(tech, pattern, confidence, field) AS (VALUES {_rules}),
f AS (SELECT page_id, tech, field, max(confidence) AS confidence FROM pages JOIN rules ON regexp_matches(html, '(?i)' || pattern) GROUP BY 1, 2, 3 HAVING max(confidence) >= 0.5)"""


@query(f"""
WITH {_found}
SELECT page_id, tech, CAST(confidence AS DOUBLE) AS confidence, '' AS version, field FROM f
UNION ALL SELECT DISTINCT page_id, 'Analytics', 0.75, '', 'analytics' FROM f WHERE tech = 'Tracker'""")
def detect_technologies(spark, sf_dir):
    return fingerprints.detect(_t(spark, sf_dir, "pages"), FINGERPRINTS)


@query(f"""
WITH {_found}, weights(tech, weight) AS (VALUES ('Tracker', 20.0), ('Inline style', 12.0))
SELECT page_id, CAST(round(least(100, sum(weight * confidence)), 1) AS DOUBLE) AS score, round(least(100, sum(weight * confidence)), 1) >= 15 AS is_ecommerce FROM f JOIN weights USING (tech) GROUP BY page_id""")
def ecommerce_scores(spark, sf_dir):
    weights = spark.createDataFrame(fingerprints.Detector(FINGERPRINTS).shop_weights(), "tech string, weight double")
    pages = _t(spark, sf_dir, "pages").select("page_id", "html")
    scores = matching.ecommerce(pages, fingerprints.detect(pages, FINGERPRINTS), weights)
    return scores.where("score > 0").drop("signals")  # the SQL has no row for a page without points


@query(f"""
WITH {_found}, every AS (SELECT page_id, tech, field FROM f UNION SELECT page_id, 'Analytics', 'analytics' FROM f WHERE tech = 'Tracker')
SELECT p.page_id, regexp_extract(p.url, '://([^/?#]*)', 1) AS domain, starts_with(p.url, 'https:') AS ssl, coalesce(string_agg(tech, ',' ORDER BY tech), '') AS techs, CAST(count(tech) AS INTEGER) AS n_technologies
FROM pages p LEFT JOIN every USING (page_id) GROUP BY ALL""")
def technology_stacks(spark, sf_dir):
    pages = _t(spark, sf_dir, "pages")
    found = fingerprints.detect(pages, FINGERPRINTS)
    weights = spark.createDataFrame(fingerprints.Detector(FINGERPRINTS).shop_weights(), "tech string, weight double")
    out = fingerprints.stacks(pages, found, matching.ecommerce(pages, found, weights))
    return out.select("page_id", "domain", "ssl", F.coalesce(F.array_join(F.array_sort(F.map_keys("technologies")), ","), F.lit("")).alias("techs"), "n_technologies")


@query("""
SELECT user_id, event_type, CAST(count(*) AS BIGINT) AS n, CAST(round_even(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY user_id), 0) AS INTEGER) AS pct FROM events GROUP BY 1, 2""")
def star_distribution(spark, sf_dir):
    return records.shares(_t(spark, sf_dir, "events"), "user_id", "event_type")


@query("SELECT event_id, user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE) DESC, event_id) <= 15")
def latest_reviews(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("event_id", "user_id", F.to_date("ts").cast("string").alias("day"))
    return records.top_of_each(e, ["user_id"], [F.desc("day"), F.asc("event_id")], 15).drop("rank")


@query("""
SELECT count(*) AS n_documents, count(*) FILTER (length(text) >= 100) AS n_ready, count(*) FILTER (length(text) < 100) AS n_incomplete, count(DISTINCT source) AS n_sources, max(length(text)) AS longest FROM documents""")
def run_statistics(spark, sf_dir):
    n = F.length("text")
    return _t(spark, sf_dir, "documents").agg(F.count("*").alias("n_documents"), F.count_if(n >= 100).alias("n_ready"), F.count_if(n < 100).alias("n_incomplete"), F.countDistinct("source").alias("n_sources"), F.max(n).cast("long").alias("longest"))


@query("SELECT doc_id, coalesce(upper(lang), '') || ' | ' || source AS joined, CAST(to_json({'lang': lang, 'n': n_chars}) AS VARCHAR) AS packed FROM documents")
def flatten_for_csv(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.array_join(F.array(F.coalesce(F.upper("lang"), F.lit("")), "source"), " | ").alias("joined"), F.to_json(F.struct("lang", F.col("n_chars").alias("n"))).alias("packed"))


@query()
def clean_for_nlp(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", text.clean_for_nlp(F.col("html")).alias("cleaned"))


def _category_sql(column: str) -> str:
    return "CASE " + " ".join(f"WHEN {_hits(column, ws)} > 0 THEN '{name}'" for name, ws in navigation.LINK_RULES) + " END"


PRIORITY = ["services", "about", "team", "contact", "clients", "technology", "partners"]


@query(f"""
WITH d AS (SELECT doc_id, 'https://site' || (doc_id % 97) || '.org/' AS url, 'https://site' || (doc_id % 97) || '.org/' || CASE WHEN doc_id % 5 = 0 THEN 'news/' ELSE '' END || lower(split_part(text, ' ', 2)) || '-' || CASE doc_id % 7 WHEN 0 THEN 'team' WHEN 1 THEN 'our-service' WHEN 2 THEN 'contact' WHEN 3 THEN 'cloud' ELSE 'page' END AS href FROM documents WHERE regexp_matches(split_part(text, ' ', 2), '^[a-z]+$')),
c AS (SELECT doc_id % 97 AS page_id, href, doc_id AS position, {_category_sql("lower(replace(regexp_extract(href, 'org/(.*)$', 1), '-', ' ')) || ' '")} AS category FROM d WHERE NOT contains(href, '/news/')),
k AS (SELECT *, list_position({_list(PRIORITY)}, category) AS o, row_number() OVER (PARTITION BY page_id, category ORDER BY position, href) AS nth FROM c WHERE category IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY o, position, href) AS rank FROM k WHERE nth <= 2)
SELECT page_id, href, category, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5""")
def pick_site_links(spark, sf_dir):
    d = _t(spark, sf_dir, "documents").withColumn("w", F.get(F.split("text", " ", -1), F.lit(1))).where(F.col("w").rlike("^[a-z]+$"))
    base = F.concat(F.lit("https://site"), (F.col("doc_id") % 97).cast("string"), F.lit(".org/"))
    name = F.when(F.col("doc_id") % 7 == 0, "team").when(F.col("doc_id") % 7 == 1, "our-service").when(F.col("doc_id") % 7 == 2, "contact").when(F.col("doc_id") % 7 == 3, "cloud").otherwise("page")
    href = F.concat(base, F.when(F.col("doc_id") % 5 == 0, "news/").otherwise(""), F.lower("w"), F.lit("-"), name)
    links = d.select((F.col("doc_id") % 97).alias("page_id"), base.alias("url"), href.alias("href"), F.lit("").alias("text"), urls.slug(href).alias("slug"), F.col("doc_id").alias("position"))
    return navigation.pick_links(navigation.score_links(links), PRIORITY, 2, 5).select("page_id", "href", "category", "rank")


@query("""
WITH c AS (SELECT c_custkey AS company_id, c_name AS name, 'x 12 ' || lpad(CAST(c_custkey % 500 AS VARCHAR), 5, '0') || ' town' || (c_custkey % 500) AS address FROM customer),
r AS (SELECT s_suppkey AS entry_id, s_name AS entry_name, 'y 9 ' || lpad(CAST(s_suppkey % 500 AS VARCHAR), 5, '0') || ' town' || (s_suppkey % 500) AS entry_address FROM supplier),
s AS (SELECT company_id, entry_id, 40 AS score FROM c JOIN r ON company_id % 500 = entry_id % 500)
SELECT company_id, entry_id, score, 'faible' AS level FROM s QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY score DESC, entry_id) = 1""")
def match_registry(spark, sf_dir):
    place = lambda prefix, key: F.concat(F.lit(prefix), F.lpad((F.col(key) % 500).cast("string"), 5, "0"), F.lit(" town"), (F.col(key) % 500).cast("string"))
    companies = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("company_id"), F.col("c_name").alias("name"), place("x 12 ", "c_custkey").alias("address"))
    registry = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("entry_id"), F.col("s_name").alias("entry_name"), place("y 9 ", "s_suppkey").alias("entry_address"))
    return market.best_entries(companies, registry)


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders""")
def normalize_dates(spark, sf_dir):
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 5
    written = lambda f: F.date_format(d, f)
    raw = F.when(k == 0, written("yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 1, written("d MMMM yyyy")).when(k == 2, written("EEE, dd MMM yyyy HH:mm:ss 'GMT'")).when(k == 3, written("MMM d, yyyy")).otherwise(F.concat(F.lit("published on "), written("MM/dd/yyyy")))
    return _t(spark, sf_dir, "orders").select("o_orderkey", articles.iso_date(raw).alias("iso"))


@query("""
SELECT event_id, url, news, bad FROM (SELECT event_id, 'https://' || CASE event_id % 4 WHEN 0 THEN 'blog.' WHEN 1 THEN 'www.' ELSE '' END || 'a.org/' || CASE event_id % 6 WHEN 0 THEN 'news/' WHEN 1 THEN 'x/press' WHEN 2 THEN 'my-blog' WHEN 3 THEN 'x/y.PDF' WHEN 4 THEN 'press/x' ELSE '' END AS url,
  event_id % 4 = 0 OR event_id % 6 IN (0, 1, 2, 4) AS news, event_id % 6 = 3 AS bad FROM events)""")
def classify_sections(spark, sf_dir):
    e = F.col("event_id")
    url = F.concat(F.lit("https://"), F.when(e % 4 == 0, "blog.").when(e % 4 == 1, "www.").otherwise(""), F.lit("a.org/"), F.when(e % 6 == 0, "news/").when(e % 6 == 1, "x/press").when(e % 6 == 2, "my-blog").when(e % 6 == 3, "x/y.PDF").when(e % 6 == 4, "press/x").otherwise(""))
    rows = _t(spark, sf_dir, "events").select("event_id", url.alias("url"))
    return rows.select("event_id", "url", navigation.news_section(F.col("url")).alias("news"), navigation.bad_extension(F.col("url")).alias("bad"))


@query("""
WITH c AS (SELECT c_custkey AS company_id, CASE c_nationkey % 3 WHEN 0 THEN 'France' WHEN 1 THEN 'Germany' ELSE '' END AS country, CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_name END AS name FROM customer),
e AS (SELECT c_custkey AS company_id, c_custkey AS entry_id, CAST(c_custkey % 100 AS INTEGER) AS score FROM customer WHERE c_custkey % 2 = 0),
q AS (SELECT c_custkey AS company_id, 'S' || c_custkey AS symbol, (c_custkey % 10) / 10.0 AS score FROM customer WHERE c_custkey % 3 = 0),
j AS (SELECT c.company_id, country = 'France' AS fr, name = '' AS nokey, CAST(e.entry_id AS VARCHAR) AS entry, e.score / 100.0 AS es, q.symbol, CAST(q.score AS DOUBLE) AS qs FROM c LEFT JOIN e ON e.company_id = c.company_id AND e.score >= 50 LEFT JOIN q ON q.company_id = c.company_id AND q.score >= 0.35)
SELECT company_id, CASE WHEN nokey THEN 'no_keys' WHEN fr AND entry IS NOT NULL THEN 'registry' ELSE CASE WHEN fr THEN 'registry_fallback_' ELSE '' END || CASE WHEN symbol IS NOT NULL THEN 'market' ELSE 'market_no_match' END END AS source,
  CASE WHEN nokey THEN NULL WHEN fr AND entry IS NOT NULL THEN entry ELSE symbol END AS key, CAST(CASE WHEN nokey THEN NULL WHEN fr AND entry IS NOT NULL THEN es ELSE qs END AS DOUBLE) AS confidence FROM j""")
def route_companies(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "company_id")
    k = F.col("company_id")
    companies = c.select("company_id", F.when(F.col("c_nationkey") % 3 == 0, "France").when(F.col("c_nationkey") % 3 == 1, "Germany").otherwise("").alias("country"), F.when(k % 11 == 0, "").otherwise(F.col("c_name")).alias("name"), F.lit("").alias("url"))
    entries = c.where("company_id % 2 = 0").select("company_id", k.alias("entry_id"), (k % 100).cast("int").alias("score"))
    quotes = c.where("company_id % 3 = 0").select("company_id", F.concat(F.lit("S"), k.cast("string")).alias("symbol"), ((k % 10) / 10).alias("score"))
    return market.route(companies, entries, quotes)
