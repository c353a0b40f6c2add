"""Queries that read company profiles out of texts and pages; registered in the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from siftwell.functions import markdown, profile
from siftwell.plans.catalog import _t, query


def _sql(pattern: str) -> str:
    """The pattern as an SQL string that RE2 reads the same way."""
    return "'" + pattern.replace("(?iu)", "(?i)").replace("'", "''") + "'"


def _first(pattern: str) -> str:
    return f"nullif(regexp_extract(text, {_sql(pattern)}, 1), '')"


@query(f"""
SELECT doc_id, CASE WHEN NOT regexp_matches(email, '\\.(?:png|jpg|svg|gif|webp)$') THEN email END AS email, trim(phone) AS phone, regexp_replace(linkedin, '/+$', '') AS linkedin, founded
FROM (SELECT doc_id, {_first(profile.EMAIL)} AS email, {_first(profile.PHONE)} AS phone, {_first(profile.LINKEDIN)} AS linkedin, CAST({_first(profile.FOUNDED)} AS INTEGER) AS founded FROM documents)""")
def contact_fields(spark, sf_dir):
    t = F.col("text")
    return _t(spark, sf_dir, "documents").select("doc_id", profile.email(t).alias("email"), profile.phone(t).alias("phone"), profile.linkedin(t).alias("linkedin"), profile.founded_year(t).alias("founded"))


@query("SELECT doc_id, " + ", ".join(f"{_first(p)} AS {name}" for name, p in profile.METRICS) + " FROM documents")
def key_metrics(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", profile.key_metrics(F.col("text")).alias("m")).select("doc_id", "m.*")


def _phrase_sql(phrases: list[str]) -> str:
    return "concat_ws('|', " + ", ".join(f"CASE WHEN regexp_matches(text, '(?i)(?:^|[^\\pL\\pM\\pN_]){p}(?:$|[^\\pL\\pM\\pN_])') THEN '{p}' END" for p in phrases) + ")"


@query(f"SELECT doc_id, {_phrase_sql(profile.TECHNOLOGIES)} AS technologies, {_phrase_sql(profile.SECTORS)} AS sectors FROM documents")
def phrases(spark, sf_dir):
    t = F.col("text")
    return _t(spark, sf_dir, "documents").select("doc_id", F.array_join(profile.technologies(t), "|").alias("technologies"), F.array_join(profile.sectors(t), "|").alias("sectors"))


@query(f"""
WITH f AS (SELECT doc_id, list_transform(regexp_extract_all(text, {_sql(profile.CERTIFICATION)}, 1), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))) AS c FROM documents),
k AS (SELECT doc_id, c, list_transform(c, lambda x: upper(replace(x, ' ', ''))) AS k FROM f)
SELECT doc_id, coalesce(array_to_string(list_filter(c, lambda x, i: list_position(k, upper(replace(x, ' ', ''))) = i), '|'), '') AS certifications FROM k""")
def certifications(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.array_join(profile.certifications(F.col("text")), "|").alias("certifications"))


_beside = " ".join(f"WHEN regexp_matches(text, '(?i)(?:{profile.PLACE_WORDS})[^\\n]{{0,80}}{label}') THEN '{name}'" for label, name in profile.COUNTRIES)
_anywhere = " ".join(f"WHEN contains(lower(text), '{label.lower()}') THEN '{name}'" for label, name in profile.COUNTRIES)


@query(f"""
SELECT doc_id, CASE WHEN regexp_matches(text, 'https?://[^\\s]*\\.tn[/\\s")]') OR regexp_matches(text, '(?i)(?:adresse|address|headquarter|siege|located)[^\\n]{{0,100}}(?:Tunis\\b|Tunisia)') OR regexp_matches(text, '(?i)\\d{{4}}\\s+Tunis') THEN 'Tunisia'
  {_beside} {_anywhere} END AS country FROM documents""")
def countries(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", profile.country(F.col("text")).alias("country"))


@query()
def company_of_pages(spark, sf_dir):
    found = profile.company_of_page(F.col("html"), F.col("url"))
    return _t(spark, sf_dir, "pages").select("page_id", found.alias("c")).select("page_id", "c.*")


@query()
def addresses(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", profile.address(F.col("text")).alias("address"))


@query()
def markdown_pages(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", markdown.page(F.col("text")).alias("p")).select("doc_id", "p.status", "p.clean_text", F.size("p.paragraphs").alias("n_paragraphs"))
