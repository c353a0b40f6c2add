"""Profiles filled from a company's pages: which text is read, which landed names are in it, what they fill.

Pages come in the order of their category, each cut at ``PAGE_CHARS`` for names, and together up to a
budget if one is given.  Names come from a landed table (name, kind: person, org or place), in place of a
language model: a page's names are the longest ones that begin first, by whole words, found in one scan by
an automaton.  The table is dealt into slices of ``SLICE`` names, each broadcast by itself; what
overlaps is settled after all slices.

Defined cases: pages without text are left out; a name that is landed twice counts once, with the
first of its kinds by name; a company without pages keeps what it has; case counts in names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from siftwell.functions import profile, reviews
from siftwell.functions.text import blank

# The categories that are read first, and the words that tell a text's language.
FIRST = ["leadership", "team", "about", "welcome", "clients", "contact"]
FR_WORDS, EN_WORDS = "nous|notre|les|des|est|son|sur|avec|pour", "the|our|we|is|are|with|for|and|of"
LEAST_CHARS = {"person": 5, "org": 3, "place": 3}

PAGE_CHARS, WINDOW, SLICE = 60_000, 80, 100_000
_MATCHES = ArrayType(StructType([StructField("start", IntegerType()), StructField("size", IntegerType()), StructField("name", StringType()), StructField("kind", StringType())]))


def reading_order(pages: DataFrame, budget: int | None = None) -> DataFrame:
    """pages(company_id, category, position, text) -> the same with nth, language and used: the text that names
    are looked for in.  With a ``budget`` a company's texts together are cut at so many characters; pages
    beyond it are left out."""
    at = F.array_position(F.array(*[F.lit(c) for c in FIRST]), F.col("category"))
    order = [F.when(at > 0, at).otherwise(F.lit(len(FIRST) + 1)), F.col("position"), F.col("category")]
    hits = lambda words: F.size(F.regexp_extract_all("text", F.lit(rf"(?iU)\b(?:{words})\b"), F.lit(0)))
    told = pages.where(blank(F.col("text")) != "").withColumns({"used": F.left("text", F.lit(PAGE_CHARS)), "language": F.when(hits(FR_WORDS) > hits(EN_WORDS), "fr").otherwise("en")})
    by_order = Window.partitionBy("company_id").orderBy(*order)
    told = told.withColumn("nth", F.row_number().over(by_order))
    if budget is None:
        return told
    before = F.coalesce(F.sum(F.char_length("used")).over(Window.partitionBy("company_id").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return told.withColumn("before", before).where(F.col("before") < budget).withColumn("used", F.left("used", (F.lit(budget) - F.col("before")).cast("int"))).drop("before")


def scanner(names: list[tuple[str, str]]) -> Callable[[str], list[tuple[int, int, str, str]]]:
    """What finds names (name, kind) in a text: all that stand as whole words, (start, size, name, kind)."""
    automaton = ahocorasick.Automaton()
    for name, kind in names:
        automaton.add_word(name, (name, kind))
    if len(automaton):
        automaton.make_automaton()
    word = lambda c: c.isalnum() or c == "_"

    def found(text: str) -> list[tuple[int, int, str, str]]:
        out = []
        for last, (name, kind) in automaton.iter(text) if len(automaton) else ():
            start = last + 1 - len(name)
            if not (start and word(text[start - 1]) and word(name[0])) and not (last + 1 < len(text) and word(text[last + 1]) and word(name[-1])):
                out.append((start, len(name), name, kind))
        return out

    return found


def _slice_udf(spark, names: list[tuple[str, str]]):
    shared = spark.sparkContext.broadcast(names)  # SLICE names at most

    @F.pandas_udf(_MATCHES)
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scan = scanner(shared.value)
        for batch in texts:
            yield batch.map(lambda t: [dict(zip(("start", "size", "name", "kind"), x)) for x in scan(t or "")])

    return run


def longest(matches: Column) -> Column:
    """Of matches those that begin first and are longest, none of which overlap, in order."""
    ordered = F.transform(F.sort_array(F.transform(matches, lambda m: F.struct(m["start"].alias("start"), (-m["size"]).alias("less"), m["name"].alias("name"), m["kind"].alias("kind")))), lambda m: F.struct(m["start"].alias("start"), (-m["less"]).alias("size"), m["name"].alias("name"), m["kind"].alias("kind")))
    start = F.struct(F.lit(0).alias("end"), F.array().cast(_MATCHES).alias("kept"))
    step = lambda s, m: F.when(m["start"] >= s["end"], F.struct((m["start"] + m["size"]).alias("end"), F.concat(s["kept"], F.array(m)).alias("kept"))).otherwise(s)
    return F.aggregate(ordered, start, step, lambda s: s["kept"])


def tagged(pages: DataFrame, names: DataFrame) -> DataFrame:
    """pages(..., used, text) with ``entities``: array<struct<start, size, name, kind, context>> of names(name, kind);
    those with fewer characters than their kind needs don't count."""
    enough = reduce(lambda a, b: a | b, [(F.col("kind") == k) & (F.char_length("name") >= n) for k, n in LEAST_CHARS.items()])
    known = names.select(F.trim("name").alias("name"), "kind").where(enough).groupBy("name").agg(F.min("kind").alias("kind"))
    slices = max(1, -(-known.count() // SLICE))
    dealt = known.withColumn("part", F.pmod(F.xxhash64("name"), F.lit(slices)))
    parts = [[(r.name, r.kind) for r in dealt.where(F.col("part") == k).select("name", "kind").collect()] for k in range(slices)]
    found = pages
    for k, part in enumerate(parts):
        found = found.withColumn(f"_m{k}", _slice_udf(pages.sparkSession, part)(F.col("used")))
    context = lambda m: F.replace(F.substring("text", F.greatest(m["start"] - WINDOW, F.lit(0)) + 1, m["start"] + m["size"] + WINDOW - F.greatest(m["start"] - WINDOW, F.lit(0))), F.lit("\n"), F.lit(" "))
    entities = F.transform(longest(F.concat(*[F.col(f"_m{k}") for k in range(slices)])), lambda m: F.struct(m["start"].alias("start"), m["size"].alias("size"), m["name"].alias("name"), m["kind"].alias("kind"), context(m).alias("context")))
    return found.withColumn("entities", entities).drop(*[f"_m{k}" for k in range(slices)])


def enriched(companies: DataFrame, pages: DataFrame, names: DataFrame, noise: list[str] = []) -> DataFrame:
    """companies(company_id, company_name, clients, team_leaders, reviews, founded_year, employees_count, revenue) with
    what is null filled from their pages, and key_metrics, certifications, technologies, sectors, locations and
    orgs_mentioned (only where clients are null).  A company has a bounded number of pages."""
    read = tagged(reading_order(pages), names)
    one = read.groupBy("company_id").agg(F.sort_array(F.collect_list(F.struct("nth", "category", "text", "entities"))).alias("p"))
    of = lambda kind: F.filter(F.flatten(F.transform("p", lambda x: x["entities"])), lambda e: e["kind"] == kind)
    told = one.select(
        "company_id", F.array_join(F.transform("p", lambda x: x["text"]), "\n\n").alias("all_text"),
        F.transform(of("person"), lambda e: F.struct(e["name"].alias("name"), e["context"].alias("context"))).alias("persons"), F.transform(of("org"), lambda e: e["name"]).alias("orgs"), F.transform(of("place"), lambda e: e["name"]).alias("named_places"),
    )
    rows = companies.join(told, "company_id", "left")
    text = blank(F.col("all_text"))
    some = lambda c: F.when(F.size(c) > 0, c)
    persons = F.coalesce("persons", F.array().cast("array<struct<name:string,context:string>>"))
    names_of = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    fill = {
        "team_leaders": some(profile.team_leaders(text, persons)), "reviews": some(F.transform(reviews.quotations(text, F.col("company_name")), lambda q: F.concat_ws(", ", F.concat(q["quote"], F.lit(" - "), q["author"]), F.nullif(q["role"], F.lit(""))))),
        "founded_year": profile.founded_year(text), "employees_count": profile.employees(text), "revenue": profile.revenue(text),
    }
    return rows.select(
        *[F.coalesce(F.col(c), fill[c]).alias(c) if c in fill else F.col(c) for c in companies.columns],
        profile.key_metrics(text).alias("key_metrics"), some(profile.certifications(text)).alias("certifications"), some(profile.technologies(text)).alias("technologies"), some(profile.sectors(text)).alias("sectors"),
        some(profile.places(F.array().cast("array<string>"), names_of("named_places"))).alias("locations"),
        F.when(F.col("clients").isNull(), some(profile.organisations(names_of("orgs"), F.col("company_name"), noise))).alias("orgs_mentioned"),
    )


def list_totals(df: DataFrame, group: list[str], column: str) -> DataFrame:
    """(group, total): how many items the lists of a group hold together; null lists hold none."""
    return df.groupBy(*group).agg(F.coalesce(F.sum(F.size(F.coalesce(F.col(column), F.array()))), F.lit(0)).alias("total"))
