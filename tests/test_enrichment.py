"""Names in texts against brute force, the reading order and what pages fill."""

import random
import re
import time

from pyspark.sql import functions as F

from siftwell.functions import profile, reviews
from siftwell.operators import enrichment

NAMES = [("Acme", "org"), ("Acme Corp", "org"), ("Corp of X", "org"), ("New York", "place"), ("York", "place"), ("Ann Doe", "person"), ("Doe Inc.", "org"), ("Élise", "person"), ("X", "org"), ("Ann", "person")]


def plain(text, names):
    """Every place, the longest whole-word name that stands there, on from its end."""
    names, out, at = dict(names), [], 0
    while at < len(text):
        here = [n for n in names if text.startswith(n, at) and not (at and re.match(r"\w\w", text[at - 1] + n[0])) and not re.match(r"\w\w", n[-1] + text[at + len(n) : at + len(n) + 1])]
        if here:
            name = max(here, key=len)
            out.append((at, len(name), name, names[name]))
            at += len(name)
        else:
            at += 1
    return out


def test_tagging_is_that_of_brute_force(spark, monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["Acme", "Corp", "of", "X", "New", "York", "Ann", "Doe", "Inc.", "Élise", "xAcme", "Acmes", "Ann_Doe", "York!", "(Acme", "\n"]) for _ in range(60)) for _ in range(30)]
    names = [n for n in NAMES if n[1] == "org" and len(n[0]) >= 3 or n[1] == "place" or len(n[0]) >= 5]
    pages = spark.createDataFrame([(k, t, t) for k, t in enumerate(texts)] + [(99, None, None)], "k int, used string, text string")
    known = spark.createDataFrame([*NAMES, ("Acme", "zoo"), (" York ", "place")], "name string, kind string")
    for size in (100_000, 3):  # in one slice, and in several
        monkeypatch.setattr(enrichment, "SLICE", size)
        got = {r.k: [tuple(e)[:4] for e in r.entities] for r in enrichment.tagged(pages, known).collect()}
        assert got == {**{k: plain(t, names) for k, t in enumerate(texts)}, 99: []} and sum(map(len, got.values())) > 300


def test_reading_order(spark):
    pages = spark.createDataFrame([(1, "blog", 0, "x" * 50), (1, "team", 2, "notre équipe avec vous"), (1, "about", 1, "the team of our firm"), (1, "empty", 3, ""), (1, "none", 4, None), (2, "news", 0, "y" * 70_000)], "company_id int, category string, position int, text string")
    got = enrichment.reading_order(pages).orderBy("company_id", "nth").collect()
    assert [(r.category, r.language, len(r.used)) for r in got] == [("team", "fr", 22), ("about", "en", 20), ("blog", "en", 50), ("news", "en", 60_000)]
    cut = enrichment.reading_order(pages, budget=50).orderBy("company_id", "nth").collect()
    assert [(r.category, len(r.used)) for r in cut] == [("team", 22), ("about", 20), ("blog", 8), ("news", 50)]


def test_profiles_are_filled_where_null(spark):
    text = 'Ann DOE CEO of the firm. Founded in 1987. We have 250 employees. ISO 27001 certified.\n"This product has changed the way in which we work every day" John SMITH Director at Globex\nOffices in Paris and with Initech'
    fields = "company_id int, company_name string, clients array<string>, team_leaders array<struct<name:string,title:string>>, reviews array<string>, founded_year int, employees_count string, revenue string"
    companies = spark.createDataFrame([(1, "Acme", None, None, None, None, None, None), (2, "Other", ["c"], [("Z", "t")], ["r"], 1900, "1", "2"), (3, "None", None, None, None, None, None, None)], fields)
    pages = spark.createDataFrame([(c, "about", 0, text) for c in (1, 2)], "company_id int, category string, position int, text string")
    names = spark.createDataFrame([("Paris", "place"), ("Initech", "org"), ("Acme Labs", "org")], "name string, kind string")
    got = {r.company_id: r for r in enrichment.enriched(companies, pages, names).collect()}
    assert (got[1].founded_year, got[1].locations, got[1].orgs_mentioned, got[1].team_leaders[0].title) == (1987, ["Paris"], ["Initech"], "CEO") and got[1].certifications
    assert (got[2].founded_year, got[2].reviews, got[2].team_leaders[0].name, got[2].orgs_mentioned, got[2].locations) == (1900, ["r"], "Z", None, ["Paris"])
    assert all(got[3][c] is None for c in ("team_leaders", "reviews", "founded_year", "certifications", "locations", "orgs_mentioned"))
    totals = enrichment.list_totals(spark.createDataFrame([(1, ["a", "b"]), (1, None), (2, None)], "g int, xs array<string>"), ["g"], "xs").orderBy("g").collect()
    assert [tuple(r) for r in totals] == [(1, 2), (2, 0)]


def test_long_lists_are_made_distinct_in_little_time(spark):
    lists = spark.createDataFrame([(["b", "a", None, "B", "c", "A", "C"],), ([],), (None,)], "xs array<string>")
    got = [r.d for r in lists.select(profile.distinct_by(F.col("xs"), F.upper).alias("d")).collect()]
    assert got == [["b", "a", "c"], [], None]
    said = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(10_000)), lambda k: F.format_string("\"We have worked with them for very many years %d\" ANN %s\n", k, F.translate((k % 500).cast("string"), "0123456789", "ABCDEFGHIJ"))), "")
    names = F.transform(F.sequence(F.lit(1), F.lit(60_000)), lambda k: F.concat(F.lit("name"), (k % 30_000).cast("string")))
    began = time.perf_counter()
    r = spark.range(1).select(F.size(profile.distinct_by(names, F.upper)).alias("n"), F.size(profile.organisations(names, F.lit("x"))).alias("m"), F.size(reviews.quotations(said, F.lit("x"))).alias("q")).first()
    assert (r.n, r.m, r.q) == (30_000, 25, 8) and time.perf_counter() - began < 20
