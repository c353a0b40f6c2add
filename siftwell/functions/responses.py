"""Answers of models, landed as text: read leniently, cleaned, and used only where nothing is known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siftwell.functions.text import blank, let


def json_of(raw: Column) -> Column:
    """The JSON text of an answer: all of it, or from its first to its last brace; null if neither is JSON."""
    inner = F.regexp_extract(blank(raw), r"(?s)\{.*\}", 0)
    valid = lambda c: (F.trim(c) != "") & F.try_parse_json(c).isNotNull()
    return F.when(valid(blank(raw)), raw).when(valid(inner), inner)


def _value(answer: Column, name: str) -> Column:
    return F.get_json_object(answer, f"$.{name}")


def _texts(answer: Column, name: str, least: int) -> Column:
    """A list's texts of more than ``least`` characters; null if there are none.  A value that is no list
    has none; elements that are no texts are left out."""
    items = F.from_json(_value(answer, name), "array<variant>")
    texts = F.transform(F.filter(items, lambda x: F.schema_of_variant(x) == "STRING"), lambda x: F.trim(F.try_variant_get(x, "$", "string")))
    kept = F.filter(texts, lambda t: F.char_length(t) > least)
    return F.when(F.size(kept) > 0, kept)


def fields_of(raw: Column) -> Column:
    """struct of the fields of a company profile that an answer holds; its JSON is looked for once."""
    return let(json_of(raw), _fields)


def _fields(answer: Column) -> Column:
    listed = F.from_json(_value(answer, "description"), "array<string>")
    is_list = F.coalesce(_value(answer, "description"), F.lit("")).startswith("[")
    described = F.when(is_list, F.array_join(F.filter(F.transform(listed, lambda x: F.trim(x)), lambda x: x != ""), " ")).otherwise(F.trim(_value(answer, "description")))
    people = F.filter(F.from_json(_value(answer, "team_leaders"), "array<struct<name:string,title:string>>"), lambda p: blank(p["name"]) != "")
    people = F.transform(people, lambda p: F.struct(F.trim(p["name"]).alias("name"), F.trim(blank(p["title"])).alias("title")))
    return F.struct(
        F.trim(_value(answer, "company_name")).alias("company_name"),
        described.alias("description"),
        _texts(answer, "services", 2).alias("services"),
        _texts(answer, "clients", 1).alias("clients"),
        F.when(F.size(people) > 0, people).alias("team_leaders"),
        F.floor(F.trim(_value(answer, "founded_year")).try_cast("double")).cast("int").alias("founded_year"),
        _value(answer, "employees_count").alias("employees_count"),
        _value(answer, "revenue").alias("revenue"),
        _texts(answer, "reviews", 10).alias("reviews"),
    )


def fill(companies: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """``companies`` with what ``found`` has for columns that are null; empty texts fill nothing."""
    kinds = dict(found.dtypes)
    value = lambda c: F.nullif(F.col(f"f.`{c}`"), F.lit("")) if kinds[c] == "string" else F.col(f"f.`{c}`")
    new = lambda c: F.coalesce(F.col(f"c.`{c}`"), value(c)).alias(c) if c in kinds and c != key else F.col(f"c.`{c}`")
    return companies.alias("c").join(found.alias("f"), F.col(f"c.`{key}`") == F.col(f"f.`{key}`"), "left").select(*[new(c) for c in companies.columns])
