"""Profile fields and markdown on written cases; the queries with SQL are compared in test_catalog."""

import pytest
from pyspark.sql import functions as F

from siftwell.functions import markdown, profile


def one(spark, expr, value, kind="string"):
    return spark.createDataFrame([(value,)], f"t {kind}").select(expr(F.col("t"))).first()[0]


@pytest.mark.parametrize("f,text,want", [
    (profile.email, "a logo@2x.png and me@x.org", None),
    (profile.email, "write to me@x.org.", "me@x.org"),
    (profile.phone, "call +33 1 23 45 67 89 now", "+33 1 23 45 67 89"),
    (profile.phone, "call 01 23 45 67 89", None),
    (profile.linkedin, "see https://www.linkedin.com/company/acme/ there", "https://www.linkedin.com/company/acme"),
    (profile.founded_year, "Founded in 1998", 1998),
    (profile.employees, "12 people, 1,200 employees", "1200"),
    (profile.revenue, "Turnover: 12  M€", "12 M€"),
    (profile.certifications, "ISO 27001, iso 27001 and PCI-DSS", ["ISO 27001", "PCI-DSS"]),
    (profile.technologies, "Cloud and REST, not resting", ["REST", "cloud"]),
    (profile.country, "Head office in Spain.\nClients in France", "Spain"),
    (profile.country, "Italy, then France", "France"),
    (profile.country, "https://a.tn/x", "Tunisia"),
    (profile.country, None, None),
    (profile.address, "At 12 rue de la Paix, Paris, Tel 01", "12 rue de la Paix, Paris"),
    (profile.address, "nowhere", None),
    (profile.company_name, "A co - B | C", "A co - B"),
    (profile.company_name, "Home", ""),
    (profile.company_name, None, ""),
])
def test_fields(spark, f, text, want):
    assert one(spark, f, text) == want


def test_company_of_page(spark):
    html = '<html><head><title>Home</title><meta content="Acme Corp | Welcome" property="og:title"><meta name="description" content=" We  do "></head><h1>x</h1></html>'
    row = spark.createDataFrame([(html, "https://www.acme-corp.com/a")], "h string, u string").select(profile.company_of_page(F.col("h"), F.col("u"))).first()[0]
    assert (row.company_name, row.domain, row.aliases, row.description) == ("Acme Corp", "acme-corp.com", ["Acme Corp", "acme-corp"], "We do")


def test_leaders(spark):
    items = [["Ann  LEE", "Président du conseil", "54 ans", "03/1970"], ["ann lee", "président du conseil"], ["KPMG SA", "Directeur"], ["Bo", "ancien directeur"], ["Cy"], ["Sara SANTOS", "Directrice générale"]]
    got = one(spark, profile.leaders, items, "array<array<string>>")
    assert [tuple(x) for x in got] == [("Ann LEE", "Président du conseil", 54, "03/1970", True, False), ("Sara SANTOS", "Directrice générale", None, None, False, True)]


def test_markdown(spark):
    md = "## HOME\n![x](u)\n[Link](http://a.b) text of some length\n\n5+\nYears Experience\n\nRead more\n\n© 2020 all\nServices > Partners\n### Part\nbody of the part\n### CONTACT\ngone"
    cleaned = one(spark, markdown.clean, md)
    assert "gone" not in cleaned and "©" not in cleaned and "Services" not in cleaned
    assert one(spark, markdown.paragraphs, cleaned) == ["Link text of some length", "5+ Years Experience", "Part body of the part"]
    assert one(spark, markdown.plain, cleaned) == "Link text of some length 5+ Years Experience Part body of the part"
    assert one(spark, markdown.page, md).status == "ok"
    assert [one(spark, markdown.page, t).status for t in (None, "", "failed", "short")] == ["failed"] * 4
