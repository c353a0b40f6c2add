"""Queries over sites: detection on all signals, registry history, discovery and links, with their SQL.

What the landed tables don't hold (script sources, headers, nested answers, site maps) is derived from
their rows by the same formulas on both sides, so the work grows with the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwell.functions import urls
from siftwell.operators import discovery, enrichment, fingerprints, market, navigation, registry
from siftwell.plans.catalog import _dealt, _list, _t, query

#: Technologies of the example, each with a rule of every signal.
N_TECHS = 50
CONFIDENCES = [100, 60, 90, 75, 40]
CATS = [6, 1, 12, 59, 66, 10, 42, 31, 88, 500]
#: Signal, which technology's marks a page has, and the versions that they name.
_MARKS = [("scriptSrc", "p % 50", "p % 9"), ("html", "(3 * p) % 50", "p % 4"), ("headers", "(7 * p) % 50", "p % 5"), ("cookies", "(11 * p) % 50", ""), ("meta", "(13 * p) % 50", "p % 6"), ("js", "(17 * p) % 50", "p % 3")]


def _confidence(t: int, k: int) -> int:
    return CONFIDENCES[(t + 2 * k) % 5]


def example_rules() -> dict[str, dict]:
    rules = {}
    for t in range(N_TECHS):
        c = [rf"\;confidence:{_confidence(t, k)}" for k in range(6)]
        rules[f"Tech{t}"] = {
            "cats": [CATS[t % 10]], "implies": f"Base{t % 5}" if t % 3 == 0 else [],
            "scriptSrc": [rf"/lib{t}-([\d.]+)\.js{c[0]}\;version:\1"], "html": rf'data-lib{t}="(\d+)"{c[1]}\;version:\1',
            "headers": {f"X-Lib{t}": rf"lib/(\d+){c[2]}\;version:\1"}, "cookies": {f"lib{t}_id": c[3]},
            "meta": {f"Lib{t}": rf"^release (\d+){c[4]}\;version:\1"}, "js": {f"Lib{t}.version": rf"Lib{t} = \W(\d+)\W{c[5]}\;version:\1"},
        }
    return rules | {f"Base{b}": {"cats": [CATS[b]]} for b in range(5)}


def marked_pages(spark, sf_dir):
    """The pages with a script, element, header, cookie, meta element and global of some technologies."""
    of = {s: (f"({t})", f"({v})") for s, t, v in _MARKS}
    marks = f"""concat('<script src="https://cdn.x/lib', {of['scriptSrc'][0]}, '-', {of['scriptSrc'][1]}, '.2.js"></script><div data-lib', {of['html'][0]}, '="', {of['html'][1]}, '"></div><meta name="Lib', {of['meta'][0]}, '" content="release ', {of['meta'][1]}, '"><script>var Lib', {of['js'][0]}, ' = "', {of['js'][1]}, '";</script>')"""
    pages = _t(spark, sf_dir, "pages").withColumn("p", F.col("page_id"))
    return pages.selectExpr(
        "page_id", "url", f"concat(html, {marks}) AS html",
        f"map(concat('x-LIB', {of['headers'][0]}), concat('lib/', {of['headers'][1]})) AS headers", f"map(concat('lib', {of['cookies'][0]}, '_ID'), '') AS cookies",
    )


_hits = " UNION ALL ".join(
    f"SELECT page_id, {t} AS t, {k} AS k, {f'CAST({v} AS VARCHAR)' + (chr(124) * 2 + repr('.2') if k == 0 else '') if v else repr('')} AS version FROM (SELECT page_id, page_id AS p FROM pages WHERE trim(html) <> '')"
    for k, (_, t, v) in enumerate(_MARKS)
)
_table = ", ".join(f"({t}, {k}, {_confidence(t, k) / 100})" for t in range(N_TECHS) for k in range(6))
_fields = ", ".join(f"({c}, '{fingerprints.FIELD_OF.get(c, '')}')" for c in CATS)


@query(f"""
WITH rules(t, k, given) AS (VALUES {_table}), fields(cat, field) AS (VALUES {_fields}),
hits AS (
    SELECT page_id, t, k, version, CASE WHEN k = 5 THEN given * 0.85 ELSE given END AS c FROM ({_hits}) JOIN rules USING (t, k)
), counted AS (
    SELECT * FROM hits QUALIFY k = 0 OR NOT coalesce(max(c) FILTER (k = 0) OVER (PARTITION BY page_id, t) >= 0.9, false)
), raised AS (
    SELECT * FROM counted QUALIFY c > coalesce(max(c) OVER (PARTITION BY page_id, t ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
), best AS (
    SELECT page_id, t, CAST(max(c) AS DOUBLE) AS confidence, coalesce(max_by(version, k) FILTER (version <> ''), '') AS version FROM raised GROUP BY ALL HAVING max(c) >= 0.5
), every AS (
    SELECT page_id, 'Tech' || t AS tech, confidence, version, list_extract({CATS}, t % 10 + 1) AS cat FROM best
    UNION ALL SELECT DISTINCT page_id, 'Base' || (t % 5), CAST(0.75 AS DOUBLE), '', list_extract({CATS}, t % 5 + 1) FROM best WHERE t % 3 = 0
)
SELECT page_id, tech, confidence, version, field FROM every JOIN fields USING (cat)""")
def detect_all_signals(spark, sf_dir):
    return fingerprints.detect(marked_pages(spark, sf_dir), example_rules())


@query("""
WITH numbered AS (
    SELECT c_custkey AS company_id, c_custkey % 4 AS kind, 2019 + c_custkey % 5 AS y, c_acctbal AS v FROM customer
)
SELECT company_id, CAST(y AS INTEGER) AS year, 'ca' AS field, CAST(CASE WHEN kind = 3 THEN v + 2 ELSE v END AS DOUBLE) AS value FROM numbered WHERE kind <> 2
UNION ALL SELECT company_id, CAST(y - 1 AS INTEGER), 'resultat_net', CAST(-v AS DOUBLE) FROM numbered WHERE kind IN (0, 1)""")
def history_of_answers(spark, sf_dir):
    """Nested answers: kind 0 in objects, 1 in a list of objects, 2 below a list (not looked for), 3 with
    a later entry that replaces the first."""
    year, v = "(2019 + c_custkey % 5)", "c_acctbal"
    inner = f"concat('{{\"chiffre_affaires_', {year}, '\": ', {v}, ', \"note\": \"in 2020: {{\", \"sub\": {{\"Net', {year} - 1, '\": ', -{v}, '}}}}')"
    kinds = f"""CASE c_custkey % 4 WHEN 0 THEN concat('{{"data": ', {inner}, '}}') WHEN 1 THEN concat('[', {inner}, ', 5]')
        WHEN 2 THEN concat('{{"rows": [', {inner}, ']}}') ELSE concat('{{"CA {{', {year}, '": ', {v}, ', "z": {{"turnover', {year}, '": ', {v} + 2, '}}}}') END"""
    return registry.of_answers(_dealt(spark, sf_dir, "customer", "c_custkey", "c_acctbal").selectExpr("c_custkey AS company_id", "0 AS position", f"{kinds} AS json"))


@query("""
WITH RECURSIVE m AS (
    SELECT c_custkey AS i, (CASE WHEN c_custkey % 11 = 0 THEN 'https://s/shop' ELSE 'https://s/blog' END) || c_custkey AS map FROM customer
), below AS (
    SELECT m.i, c.map FROM m JOIN m c ON c.i IN (2 * m.i, 2 * m.i + 1, m.i // 3) WHERE c.i % 11 <> 0
), reach(root, i) AS (
    SELECT map, i FROM m WHERE i IN (1, 6, 22)
    UNION SELECT r.root, c.i FROM reach r JOIN below b ON b.i = r.i JOIN m c ON c.map = b.map
)
SELECT DISTINCT root, 'https://s/p/' || p AS url FROM (SELECT root, unnest([i, i % 50]) AS p FROM reach)""")
def sitemap_pages(spark, sf_dir):
    """Maps that list two others each, and one back up, so that there are cycles; some ten levels deep."""
    i = F.col("c_custkey")
    name = lambda k: F.concat(F.when(k % 11 == 0, "https://s/shop").otherwise("https://s/blog"), k.cast("string"))
    maps = _dealt(spark, sf_dir, "customer", "c_custkey").select(name(i).alias("parent"), i)
    entry = lambda kind, url: F.struct(F.lit(kind).alias("kind"), url.alias("url"))
    up = F.floor(i / 3).cast("long")
    listed = F.array(entry("sitemap", name(2 * i)), entry("sitemap", name(2 * i + 1)), entry("sitemap", name(up)), *[entry("url", F.concat(F.lit("https://s/p/"), p.cast("string"))) for p in (i, i % 50)])
    entries = maps.select("parent", F.explode(listed).alias("e")).select("parent", "e.*")
    roots = maps.where("c_custkey in (1, 6, 22)").select(F.col("parent").alias("root"))
    return discovery.sitemap_closure(entries, roots)


def example_sites(spark, sf_dir):
    """(sites, pages, entries) of a site for each customer: what it has follows from its number."""
    k = _dealt(spark, sf_dir, "customer", "c_custkey").selectExpr("c_custkey AS k", "concat('https://s', c_custkey, '.com') AS site")
    links = lambda path, n: f"array_join(transform(filter(sequence(0, 40), j -> j < {n}), j -> concat('<a href=\"{path}', j, '\">t</a>')), ' ')"
    pad = "repeat('.', 600)"
    nav = "concat('<nav>', IF(k % 3 = 0, '<a href=\"/news\">All News</a>', ''), IF(k % 2 = 0, '<a href=\"/learn/more?x=1\">Topics</a>', ''), '<a href=\"/contact\">Contact</a></nav>')"
    page = lambda where, path, html: (where, f"named_struct('url', concat(site, '{path}'), 'html', concat({html}, {pad}))")
    made = [
        page("true", "/", f"{nav}, {links('/home/a', 'k % 4')}"),
        page("k % 3 = 0", "/news", f"'<nav><a href=\"', IF(k % 5 = 0, '/news/page/2/', '/x'), '\">Next</a></nav>', {links('/news/x', 'k % 20')}"),
        page("k % 5 = 0", "/news/page/2/", links("y", "k % 15")), page("k % 10 = 0", "/news/page/3/", links("z", "6")),
        page("k % 2 = 0", "/learn/more", links("/learn/w", "k % 9")), page("k % 7 = 0", "/blog", f"'<header><a href=\"/blog/no\">x</a></header>', {links('/blog/b', '4')}"),
    ]
    pages = k.selectExpr(f"explode(filter(array({', '.join(f'IF({w}, {p}, null)' for w, p in made)}), p -> p is not null)) AS p").select("p.*")
    entries = k.where("k % 4 = 1").selectExpr("concat(site, '/sitemap.xml') AS parent", "'url' AS kind", "explode(filter(sequence(0L, 40L), j -> j < k % 35)) AS j", "site").selectExpr("parent", "kind", "concat(site, '/post/s', j) AS url")
    return k.select("site"), pages, entries


@query("""
WITH s AS (
    SELECT c_custkey AS k, 'https://s' || c_custkey || '.com' AS site FROM customer
), j AS (
    SELECT unnest(range(40)) AS j
), c AS (
    SELECT k, site, 0 AS tier, '' AS section, 0 AS n, 0 AS j, site || '/post/s' || j AS url FROM s, j WHERE k % 4 = 1 AND j < k % 35
    UNION ALL SELECT k, site, 1, '/news', 1, j, site || '/news/x' || j FROM s, j WHERE k % 3 = 0 AND j < k % 20
    UNION ALL SELECT k, site, 1, '/news', 2, j, site || '/news/page/2/y' || j FROM s, j WHERE k % 15 = 0 AND j < k % 15
    UNION ALL SELECT k, site, 1, '/news', 3, j, site || '/news/page/3/z' || j FROM s, j WHERE k % 30 = 0 AND j < 6
    UNION ALL SELECT k, site, 1, '/blog', 1, j, site || '/blog/b' || j FROM s, j WHERE k % 7 = 0 AND j < 4
    UNION ALL SELECT k, site, 2, '/learn', 1, j, site || '/learn/w' || j FROM s, j WHERE k % 2 = 0 AND j < k % 9
    UNION ALL SELECT k, site, 3, '', 1, j, site || '/home/a' || j FROM s, j WHERE j < k % 4 AND k % 3 <> 0 AND k % 7 <> 0 AND NOT (k % 4 = 1 AND k % 35 > 0) AND NOT (k % 2 = 0 AND k % 9 > 0)
)
SELECT site, url, tier, CAST(nth AS INTEGER) AS nth FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY tier, section, n, j, url) AS nth FROM c) WHERE nth <= 25""")
def discover_articles(spark, sf_dir):
    return discovery.discover(*example_sites(spark, sf_dir))


_linked = "regexp_replace(replace(text, '[', '('), ' ([a-z]{7}) ', ' [%1](https://s.com/a/%1) ' %g)"


@query(rf"""
WITH m AS (
    SELECT doc_id, {_linked.replace('%1', chr(92) + '1').replace('%g', ", 'g'")} AS md FROM documents
), pieces AS (
    SELECT doc_id, md, unnest(regexp_split_to_array(md, '\[[a-z]+\]\(https://s\.com/a/[a-z]+\)')) AS piece, unnest(regexp_extract_all(md, '\[[a-z]+\]\(https://s\.com/a/[a-z]+\)')) AS link, unnest(range(length(md))) AS k FROM m
), placed AS (
    SELECT doc_id, md, regexp_extract(link, '[a-z]+') AS word, length(link) AS size, k,
        CAST(sum(length(piece)) OVER w + coalesce(sum(length(link)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
    FROM pieces WHERE link IS NOT NULL WINDOW w AS (PARTITION BY doc_id ORDER BY k)
), ok AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id, word ORDER BY start) AS nth FROM placed WHERE len(list_intersect([word], {_list(urls.UNWANTED_TOKENS)})) = 0 AND word <> 'accueil'
)
SELECT doc_id AS page_id, 'https://s.com/a/' || word AS href, word AS text, 'a ' || word AS slug, CAST(start AS INTEGER) AS start, CAST(size AS INTEGER) AS size, CAST(k AS INTEGER) AS position,
    trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(substr(md, greatest(start - 80, 0) + 1, start + size + 80 - greatest(start - 80, 0)),
        '\[([^\]]*)\]\([^)]+\)', '\1', 'g'), '!\[[^\]]*\]\([^)]+\)', '', 'g'), '#{{1,4}}\s*', '', 'g'), '[*_`]', '', 'g'), '\s+', ' ', 'g')) AS near
FROM ok WHERE nth = 1""")
def markdown_links(spark, sf_dir):
    """Every word of seven letters between spaces is a link."""
    md = _linked.replace("%1", "$1").replace("%g", "")
    pages = _t(spark, sf_dir, "documents").selectExpr("doc_id AS page_id", "'https://www.s.com/' AS url", f"{md} AS markdown")
    return navigation.markdown_links(pages).select("page_id", "href", "text", "slug", "start", "size", "position", "near")


@query("""
WITH c AS (
    SELECT c_custkey AS company_id, c_custkey % 20 AS w, c_custkey % 4 AS z, c_custkey % 3 AS kind FROM customer
), q AS (
    SELECT 'S' || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS symbol, s_suppkey % 20 AS w, s_suppkey % 40 >= 20 AS longer, s_suppkey % 3 = 0 AS has_site FROM supplier
), s AS (
    SELECT company_id, symbol, CASE WHEN longer THEN 0.9 ELSE 1.0 END AS name, CASE WHEN has_site AND kind = 1 THEN 0.6 WHEN has_site AND kind = 2 THEN 1.0 ELSE 0 END AS domain,
        CASE WHEN kind = 0 THEN 0.3 ELSE 1.0 END AS exchange, kind
    FROM c JOIN q USING (w)
), t AS (
    SELECT company_id, symbol, CAST(round(CASE WHEN domain > 0 THEN 0.5 * domain + 0.3 * name + 0.15 * exchange + 0.05 ELSE 0.55 * name + 0.3 * exchange + 0.15 END, 4) AS DOUBLE) AS score,
        CASE WHEN kind > 0 THEN 'domain' ELSE 'name_country' END AS method FROM s
)
SELECT company_id, symbol, score, method, CASE WHEN score >= 0.8 THEN 'excellent' WHEN score >= 0.6 THEN 'bon' ELSE 'moyen' END AS level
FROM t QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY method <> 'domain', score DESC, symbol) = 1""")
def match_quotes(spark, sf_dir):
    """Names with two words that all share; some quotes have a longer name, some a site."""
    companies = _t(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS company_id", "concat('Word', c_custkey % 20, ' Zeta', c_custkey % 4, ' Energy') AS name", "IF(c_custkey % 3 = 0, null, 'France') AS country",
        "concat('https://www.word', c_custkey % 20, element_at(array('.fr', '.com'), CAST(greatest(c_custkey % 3, 1) AS INT)), '/') AS site", "c_custkey % 3 AS kind",
    ).selectExpr("company_id", "name", "country", "IF(kind = 0, null, site) AS url")
    quotes = _t(spark, sf_dir, "supplier").selectExpr(
        "concat('S', lpad(CAST(s_suppkey AS STRING), 9, '0')) AS symbol", "concat('Word', s_suppkey % 20, ' Zeta', s_suppkey % 4, ' Energy', IF(s_suppkey % 40 >= 20, ' Trust', '')) AS longname",
        "CAST(null AS STRING) AS shortname", "'PAR' AS exchange", "'EQUITY' AS quote_type", "IF(s_suppkey % 3 = 0, concat('https://word', s_suppkey % 20, '.com'), null) AS website",
    )
    return market.match_quotes(companies, quotes)


@query("""
WITH c AS (
    SELECT c_custkey AS company_id, 'maison ' || (c_custkey % 30) || CASE WHEN c_custkey % 2 = 0 THEN ' verte' ELSE '' END AS name, 10000 + c_custkey % 50 AS code FROM customer
), r AS (
    SELECT s_suppkey AS entry_id, 'maison ' || (s_suppkey % 30) || CASE WHEN s_suppkey % 3 = 0 THEN ' verte et fils' ELSE '' END AS entry_name, 10000 + s_suppkey % 50 AS code FROM supplier
), s AS (
    SELECT company_id, entry_id, (CASE WHEN name = entry_name THEN 60 WHEN contains(name, entry_name) OR contains(entry_name, name) THEN 25
        ELSE 15 * len(list_intersect(string_split(name, ' '), string_split(entry_name, ' '))) // greatest(len(string_split(name, ' ')), len(string_split(entry_name, ' '))) END)
        + CASE WHEN c.code = r.code THEN 40 ELSE 20 END AS score
    FROM c JOIN r ON true
)
SELECT company_id, entry_id, CAST(score AS INTEGER) AS score, CASE WHEN score >= 80 THEN 'excellent' WHEN score >= 50 THEN 'moyen' ELSE 'faible' END AS level
FROM s QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY score DESC, entry_id) = 1""")
def match_registry_names(spark, sf_dir):
    """Names of which all share a word, addresses of which all share a town."""
    place = lambda key: f"concat('4 rue X ', 10000 + {key} % 50, ' Lyon')"
    companies = _t(spark, sf_dir, "customer").selectExpr("c_custkey AS company_id", "concat('Maison ', c_custkey % 30, IF(c_custkey % 2 = 0, ' Verte', '')) AS name", f"{place('c_custkey')} AS address")
    entries = _t(spark, sf_dir, "supplier").selectExpr("s_suppkey AS entry_id", "concat('maison ', s_suppkey % 30, IF(s_suppkey % 3 = 0, ' verte et fils', '')) AS entry_name", f"{place('s_suppkey')} AS entry_address")
    return market.best_entries(companies, entries)


_figures = """
k AS (
    SELECT c_custkey AS k, 2015 + c_custkey % 8 AS y, 1000 + c_custkey % 50 AS a, 1000 + c_custkey % 50 + (c_custkey % 7 - 2) * 45 AS b, (c_custkey % 5) * 60 - 60 AS r, c_custkey % 6000 AS m FROM customer
), f AS (
    SELECT *, CAST(round(CAST(b - a AS DOUBLE) / a * 100, 1) AS DOUBLE) AS growth, CASE WHEN r <> 0 THEN CAST(round(CAST(r AS DOUBLE) / b * 100, 1) AS DOUBLE) END AS margin, 1950 + k % 70 AS founded FROM k
)"""


def registry_pages(spark, sf_dir):
    """A page of a registry for each customer, whose table has spans in its head."""
    c = _dealt(spark, sf_dir, "customer", "c_custkey").selectExpr("c_custkey AS k").selectExpr("k", "2015 + k % 8 AS y", "1000 + k % 50 AS a", "1000 + k % 50 + (k % 7 - 2) * 45 AS b", "(k % 5) * 60 - 60 AS r")
    html = """concat('<h1> Maison ', k, '</h1><p>SIREN : 123 456 ', lpad(k % 1000, 3, '0'), '</p>', IF(k % 2 = 0, '<p>TVA FR12 123456789</p>', ''),
        '<div class="table-container"><b>Création:</b><i>01/02/', 1950 + k % 70, '</i><b>Effectif:</b><i>', k % 6000, ' salariés</i></div>', IF(k % 3 = 0, '<div class="x dirigeant"><a>Ann Doe</a><span>Président</span><span>50 ans</span></div>', ''),
        '<table><tr><th rowspan="2">Poste</th><th colspan="2">Exercices</th></tr><tr><th>', y, '</th><th>', y + 1, '</th></tr><tr><td>Chiffre d''affaires</td><td>', a, ' €</td><td>', b, ' €</td></tr><tr><td>Résultat net</td><td colspan=2>', r, '</td></tr></table>')"""
    return c.selectExpr("k AS company_id", "concat('https://r.fr/', k) AS url", f"{html} AS html")


@query(f"""
WITH {_figures}, s AS (
    SELECT *, 4 + CASE WHEN k % 2 = 0 THEN 4 ELSE 0 END + 4 + CASE WHEN k % 3 = 0 THEN 9 ELSE 0 END + CASE WHEN m = 0 THEN 0 WHEN m < 10 THEN 5 WHEN m < 50 THEN 10 WHEN m < 250 THEN 15 ELSE 20 END
        + CASE WHEN growth > 20 THEN 30 WHEN growth > 10 THEN 25 WHEN growth > 5 THEN 20 WHEN growth > 0 THEN 10 ELSE 0 END + CASE WHEN margin > 10 THEN 15 WHEN margin > 5 THEN 10 WHEN margin > 0 THEN 5 ELSE 0 END + CASE WHEN 2026 - founded > 10 THEN 10 WHEN 2026 - founded > 5 THEN 7 ELSE 4 END AS score
    FROM f
)
SELECT k AS company_id, 'Maison ' || k AS name, '123456' || lpad(CAST(k % 1000 AS VARCHAR), 3, '0') AS siren, CASE WHEN k % 2 = 0 THEN 'FR12123456789' END AS vat, CAST(founded AS INTEGER) AS founded, CAST(2026 - founded AS INTEGER) AS age, CAST(m AS INTEGER) AS employees,
    CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END AS n_leaders, CAST(y + 1 AS INTEGER) AS year, CAST(b AS DOUBLE) AS ca, CAST(CASE WHEN r <> 0 THEN r END AS DOUBLE) AS resultat_net, growth AS growth_pct, margin AS margin_pct,
    CAST(least(score, 100) AS INTEGER) AS score, CASE WHEN score >= 75 THEN 'A' WHEN score >= 50 THEN 'B' WHEN score >= 25 THEN 'C' ELSE 'D' END AS label
FROM s""")
def registry_profiles(spark, sf_dir):
    out = registry.composed(registry.raw_of_pages(registry_pages(spark, sf_dir)), 2026)
    return out.select("company_id", "name", "siren", "vat", "founded", "age", F.col("headcount.high").alias("employees"), F.size("leaders").alias("n_leaders"), "year", "ca", "resultat_net", "growth_pct", "margin_pct", F.col("sales.score").alias("score"), F.col("sales.label").alias("label"))


@query("""
SELECT c_custkey AS company_id, CASE WHEN c_custkey % 10 <> 9 THEN c_name END AS name, CASE WHEN c_custkey % 10 <> 9 THEN '123456' || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') END AS siren,
    CASE WHEN c_custkey % 10 < 7 THEN c_acctbal END AS match_score, CASE WHEN c_custkey % 10 <> 9 THEN CAST(1990 + c_custkey % 30 AS INTEGER) END AS founded, CASE WHEN c_custkey % 10 < 8 THEN 1 ELSE 0 END AS n_leaders,
    CASE WHEN c_custkey % 10 < 7 THEN CAST(c_custkey + 1 AS DOUBLE) END AS ca, CASE c_custkey % 10 WHEN 9 THEN '$' WHEN 8 THEN '$._meta.match_score,$.dirigeants' WHEN 7 THEN '$._meta.match_score' ELSE '' END AS rejected
FROM customer""")
def registry_records(spark, sf_dir):
    """Raw records, some of which hold texts and objects where numbers and lists belong, or are no JSON."""
    json = """concat('{"_meta": {"match_score": ', CASE c_custkey % 10 WHEN 7 THEN '"high"' WHEN 8 THEN '{"a": 1}' ELSE string(c_acctbal) END, '}, "identite": {"company_name_raw": "', c_name, '", "siren_raw": "123 456 ', lpad(c_custkey % 1000, 3, '0'),
        '", "main_bloc_pairs": {"Création": "en ', 1990 + c_custkey % 30, '"}}, "dirigeants": ', IF(c_custkey % 10 = 8, '"none"', '[{"parts_raw": ["Ann Doe", "Gérant"]}, {"parts_raw": ["KPMG SA", "Commissaire"]}]'),
        ', "xhr_finances": ', IF(c_custkey % 10 < 7, concat('{"api": {"data": {"ca_2020": ', c_custkey, ', "turnover_2021": ', c_custkey + 1, '}}}'), 'null'), IF(c_custkey % 10 = 9, '', '}'))"""
    landed = _dealt(spark, sf_dir, "customer", "c_custkey", "c_name", "c_acctbal").selectExpr("c_custkey AS company_id", f"{json} AS json")
    out = registry.composed(registry.raw_of_records(landed), 2026)
    return out.select("company_id", "name", "siren", "match_score", "founded", F.size("leaders").alias("n_leaders"), "ca", F.array_join("rejected", ",").alias("rejected"))


_categories = "CASE doc_id % 8 WHEN 0 THEN 'contact' WHEN 1 THEN 'clients' WHEN 2 THEN 'welcome' WHEN 3 THEN 'about' WHEN 4 THEN 'team' WHEN 5 THEN 'leadership' WHEN 6 THEN 'news' ELSE 'blog' END"


def company_pages(spark, sf_dir):
    """Documents as the pages of companies."""
    return _t(spark, sf_dir, "documents").selectExpr("doc_id % 97 AS company_id", f"{_categories} AS category", "CAST(doc_id AS INT) AS position", "text")


@query(f"""
WITH p AS (
    SELECT doc_id % 97 AS company_id, {_categories} AS category, doc_id AS position, text, substr(text, 1, 60000) AS used FROM documents WHERE text <> ''
), o AS (
    SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY coalesce(list_position({_list(enrichment.FIRST)}, category), 7), position) AS nth FROM p
), b AS (
    SELECT *, coalesce(sum(length(used)) OVER (PARTITION BY company_id ORDER BY nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM o
)
SELECT company_id, category, CAST(position AS INTEGER) AS position, CAST(nth AS INTEGER) AS nth, CAST(least(length(used), 20000 - before) AS INTEGER) AS n_used FROM b WHERE before < 20000""")
def reading_budget(spark, sf_dir):
    return enrichment.reading_order(company_pages(spark, sf_dir), budget=20_000).select("company_id", "category", "position", "nth", F.char_length("used").alias("n_used"))


@query(rf"""
WITH n AS (
    SELECT n_name AS name, CASE WHEN n_nationkey % 5 = 0 THEN 'org' ELSE 'place' END AS kind FROM nation
), d AS (
    SELECT doc_id % 97 AS company_id, {_categories} AS category, doc_id AS position, CASE WHEN doc_id % 3 = 0 THEN 'Founded in ' || (1950 + doc_id % 60) || ' in ' || n_name || '. ' ELSE 'Offices: x' || n_name || ', ' || n_name || '! ' END AS head, name, kind
    FROM documents JOIN nation ON n_nationkey = doc_id % 25 JOIN n ON name = n_name
), o AS (
    SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY coalesce(list_position({_list(enrichment.FIRST)}, category), 7), position) AS nth FROM d
), f AS (
    SELECT company_id, kind, name, min(nth) AS nth FROM o GROUP BY ALL
)
SELECT company_id, (SELECT CAST(regexp_extract(head, 'Founded in (\d+)', 1) AS INTEGER) FROM o WHERE o.company_id = c.company_id AND head LIKE 'Founded%' ORDER BY nth LIMIT 1) AS founded_year,
    (SELECT string_agg(name, '|' ORDER BY nth) FROM f WHERE f.company_id = c.company_id AND kind = 'place') AS locations,
    CASE WHEN company_id % 2 = 0 THEN (SELECT string_agg(name, '|' ORDER BY nth) FROM f WHERE f.company_id = c.company_id AND kind = 'org' AND length(name) BETWEEN 4 AND 60) END AS orgs_mentioned
FROM (SELECT DISTINCT company_id FROM d) c""")
def enriched_profiles(spark, sf_dir):
    """Each page begins with a sentence about a nation; a fifth of those are taken for firms."""
    nations = _t(spark, sf_dir, "nation")
    docs = _t(spark, sf_dir, "documents").selectExpr("doc_id % 97 AS company_id", f"{_categories} AS category", "CAST(doc_id AS INT) AS position", "doc_id", "doc_id % 25 AS n_nationkey").join(F.broadcast(nations.select(F.col("n_nationkey").cast("long").alias("n_nationkey"), "n_name")), "n_nationkey")
    head = "IF(doc_id % 3 = 0, concat('Founded in ', 1950 + doc_id % 60, ' in ', n_name, '. '), concat('Offices: x', n_name, ', ', n_name, '! '))"
    pages = docs.selectExpr("company_id", "category", "position", f"{head} AS text")
    names = nations.selectExpr("n_name AS name", "IF(n_nationkey % 5 = 0, 'org', 'place') AS kind")
    companies = pages.select("company_id").distinct().selectExpr(
        "company_id", "CAST(null AS STRING) AS company_name", "IF(company_id % 2 = 0, null, array('known')) AS clients", "CAST(null AS array<struct<name:string,title:string>>) AS team_leaders",
        "CAST(null AS array<string>) AS reviews", "CAST(null AS INT) AS founded_year", "CAST(null AS STRING) AS employees_count", "CAST(null AS STRING) AS revenue",
    )
    out = enrichment.enriched(companies, pages, names)
    return out.select("company_id", "founded_year", F.array_join("locations", "|").alias("locations"), F.array_join("orgs_mentioned", "|").alias("orgs_mentioned"))
