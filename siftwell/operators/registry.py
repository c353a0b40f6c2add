"""Registry entries: the history of a company's figures from three kinds of sources, and what it tells."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window, functions as F

from siftwell.functions import company, profile, structure
from siftwell.functions.shredding import shred_variant
from siftwell.functions.text import blank, squeeze_or_null
from siftwell.operators import records
from siftwell.shared import written

# A row's label holds all words of an entry; the first entry counts.
LABELS = [
    ("ca", ["chiffre", "affaires"]), ("ca", ["ca"]), ("ca", ["revenus"]), ("ca", ["turnover"]),
    ("resultat_net", ["resultat", "net"]), ("resultat_net", ["benefice", "net"]), ("resultat_net", ["profit", "net"]),
    ("ebitda", ["ebitda"]), ("ebitda", ["ebe"]), ("ebitda", ["excedent", "brut"]),
    ("resultat_exploitation", ["resultat", "exploit"]), ("resultat_exploitation", ["ebit"]),
    ("capitaux_propres", ["capitaux", "propres"]), ("capitaux_propres", ["fonds", "propres"]),
    ("total_bilan", ["total", "bilan"]), ("total_bilan", ["total", "actif"]),
    ("dettes_financieres", ["dettes", "financ"]), ("dettes_financieres", ["endettement"]),
    ("effectif", ["effectif"]), ("effectif", ["salaries"]), ("effectif", ["employes"]),
]
FIELDS = list(dict.fromkeys(name for name, _ in LABELS))
# The words of a key that name a figure.
JSON_FIELDS = [("ca", ["ca", "chiffre", "turnover", "revenue"]), ("resultat_net", ["resultat", "net", "profit", "benefice"])]
YEAR = r"^20\d{2}$"
CONTEXT_AMOUNT = r"([\d\s]{3,}(?:,\d+)?\s*(?:€|k€|M€|G€)?)"
SOURCES = ["xhr", "html_table", "regex_fallback"]


def field_of(label: Column) -> Column:
    """The figure that a table's row is about; null if it isn't known.  Accents don't count; a word of the
    list must begin a word of the label, one of up to three letters be one."""
    folded = F.translate(F.lower(blank(label)), "àâäéèêëîïôöùûüç", "aaaeeeeiioouuuc")
    plain = F.concat(F.lit(" "), F.regexp_replace(folded, r"[^\w\s]|\s", " "), F.lit(" "))

    def holds(words: list[str]) -> Column:
        return functools.reduce(operator.and_, [plain.contains(f" {w} " if len(w) <= 3 else f" {w}") for w in words])

    return F.coalesce(*[F.when(holds(words), name) for name, words in LABELS])


def of_tables(tables: DataFrame) -> DataFrame:
    """tables(company_id, table_no, rows: array<array<string>>) -> (company_id, year, field, value).  A row
    with two years or more says which columns the rows after it have; the first value counts."""
    rows = tables.select("company_id", "table_no", F.posexplode("rows").alias("row_no", "cells"))
    cells = F.transform("cells", lambda c, i: F.struct(i.alias("at"), F.trim(blank(c)).alias("year")))
    years = F.filter(cells, lambda c: c["year"].rlike(YEAR))
    head = F.when(F.size(years) >= 2, years)
    above = Window.partitionBy("company_id", "table_no").orderBy("row_no")
    rows = rows.withColumn("head", head).withColumn("columns", F.last("head", True).over(above)).where("head is null and columns is not null")
    rows = rows.withColumn("field", field_of(F.get("cells", F.lit(0)))).where("field is not null")
    values = rows.select("company_id", "table_no", "row_no", "field", F.explode("columns").alias("c"), "cells")
    values = values.select("company_id", F.col("c.year").cast("int").alias("year"), "field", company.amount(F.get("cells", F.col("c.at"))).alias("value"), F.struct("table_no", "row_no").alias("place")).where("value <> 0")
    return values.groupBy("company_id", "year", "field").agg(F.min_by("value", "place").alias("value"))


_NUMBER = "array<struct<year:int,field:string,value:double>>"
#: A text without escapes as keys and strings, brackets, numbers and words.
_TOKEN = r'"[^"]*"\s*:?|[{}\[\]]|-?\d[\d.eE+-]*|[a-z]+'
#: Brackets that are open where a number counts: objects in objects, the outermost perhaps in a list.
_REACHED = r"^\[?\{+$"


def numbers_by_year(answer: Column) -> Column:
    """array<struct<year, field, value>>: the numbers of a JSON text whose keys name a year and a figure,
    in order of the text, read in one pass over its tokens.  Those below a list inside an object aren't
    looked for; none of a text that is no JSON."""
    text = F.regexp_replace(F.when(F.get_json_object(answer, "$").isNotNull(), answer), r"(?s)\\.", "")
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_TOKEN), F.lit(0))

    def read(state: Column, token: Column) -> Column:
        first, is_open, key = F.substring(token, 1, 1), state["open"], F.lower(state["key"])
        field = F.coalesce(*[F.when(functools.reduce(operator.or_, [key.contains(w) for w in words]), name) for name, words in JSON_FIELDS])
        year = F.nullif(F.regexp_extract(key, r"20\d{2}", 0), F.lit("")).cast("int")
        counts = token.rlike(r"^-?\d") & is_open.rlike(_REACHED) & year.isNotNull() & field.isNotNull()
        return F.struct(
            F.when(first.isin("{", "["), F.concat(is_open, first)).when(first.isin("}", "]"), F.left(is_open, F.char_length(is_open) - 1)).otherwise(is_open).alias("open"),
            F.when(token.endswith(":"), token).alias("key"),
            F.when(counts, F.concat(state["found"], F.array(F.struct(year.alias("year"), field.alias("field"), token.cast("double").alias("value"))))).otherwise(state["found"]).alias("found"),
        )

    start = F.struct(F.lit("").alias("open"), F.lit(None).cast("string").alias("key"), F.array().cast(_NUMBER).alias("found"))
    return F.aggregate(tokens, start, read, lambda state: state["found"])


def of_answers(answers: DataFrame) -> DataFrame:
    """answers(company_id, position, json) -> (company_id, year, field, value): numbers whose keys name a
    year, wherever ``numbers_by_year`` reaches; the last one counts.  An answer that is no JSON has none."""
    rows = answers.select("company_id", "position", F.posexplode(numbers_by_year(F.col("json"))).alias("nth", "e")).select("company_id", F.struct("position", "nth").alias("place"), "e.*")
    return rows.groupBy("company_id", "year", "field").agg(F.max_by("value", "place").alias("value"))


def of_contexts(contexts: DataFrame) -> DataFrame:
    """contexts(company_id, position, year, context) -> (company_id, year, field, value): the first amount
    beside a year, as an estimate of the turnover."""
    rows = contexts.select("company_id", "position", F.col("year").cast("int").alias("year"), company.amount(F.regexp_extract(blank(F.col("context")), CONTEXT_AMOUNT, 1)).alias("value"))
    rows = rows.where("year is not null and value <> 0")
    return rows.groupBy("company_id", "year").agg(F.min_by("value", "position").alias("value")).select("company_id", "year", F.lit("ca_estimate").alias("field"), "value")


def history(answers: DataFrame, tables: DataFrame, contexts: DataFrame) -> DataFrame:
    """(company_id, source, year, field, value) from each company's best source: answers, then tables, then
    contexts."""
    every = [f(x).withColumn("rank", F.lit(k)) for k, (f, x) in enumerate([(of_answers, answers), (of_tables, tables), (of_contexts, contexts)])]
    rows = every[0].unionByName(every[1]).unionByName(every[2])
    # a company's rows are few, a figure each; a join with the best ranks would read all sources twice
    names = F.array(*[F.lit(s) for s in SOURCES])
    best = rows.withColumn("best", F.min("rank").over(Window.partitionBy("company_id"))).where("rank = best and company_id is not null")
    return best.select("company_id", F.get(names, F.col("rank")).alias("source"), "year", "field", "value")


def by_year(rows: DataFrame) -> DataFrame:
    """(company_id, year, a column for each figure), the latest year first."""
    return rows.groupBy("company_id", "year").pivot("field", FIELDS).agg(F.first("value")).orderBy("company_id", F.desc("year"))


def latest_ratios(rows: DataFrame) -> DataFrame:
    """(company_id, year, figures, margin_pct, debt_ratio, debt_signal) of each company's latest year."""
    wide = rows.groupBy("company_id", "year").pivot("field", FIELDS).agg(F.first("value"))
    last = wide.groupBy("company_id").agg(F.max_by(F.struct("year", *FIELDS), "year").alias("x")).select("company_id", "x.*")
    margin = F.when(F.col("ca") > 0, F.round(F.nullif("resultat_net", F.lit(0.0)) / F.col("ca") * 100, 1))
    ratio = F.when(F.col("capitaux_propres") != 0, F.round(F.nullif("dettes_financieres", F.lit(0.0)) / F.col("capitaux_propres"), 2))
    signal = F.when(ratio < 1, "sain").when(ratio < 2, "surveiller").when(ratio.isNotNull(), "risque")
    return last.withColumns({"margin_pct": margin, "debt_ratio": ratio, "debt_signal": signal})


# What figures say to a seller.
GROWING, SHRINKING = "CA en hausse → budget probablement disponible", "CA en baisse → cycle d'achat prudent"
PROFITABLE, LOSING, INDEBTED = "Bonne rentabilité → capacité d'investissement", "Pertes nettes → risque de credit", "Endettement élevé → prudence"


def indicators(rows: DataFrame) -> DataFrame:
    """(company_id, year, the latest year's figures, margin_pct, debt_ratio, debt_signal, growth_pct, cagr_pct,
    growth_signal, margin_label, growth_label, debt_label, signals) of each company's history(company_id, year, field, value)."""
    ratios = latest_ratios(rows)
    yearly = records.yearly_indicators(rows.where("field = 'ca'"), "company_id", "year", "value").select("company_id", "growth_pct", "cagr_pct", F.col("signal").alias("growth_signal"))
    growth, margin = F.col("growth_pct"), F.col("margin_pct")
    told = F.array_compact(F.array(
        F.when(growth > 5, GROWING).when(growth <= -5, SHRINKING), F.when(margin > 10, PROFITABLE).when(margin < 0, LOSING), F.when(F.col("debt_signal") == "risque", INDEBTED),
    ))
    signed = lambda c: F.when(c.isNotNull(), F.format_string("%+.1f%%", c))
    return ratios.join(yearly, "company_id", "left").withColumns({"margin_label": signed(margin), "growth_label": signed(growth), "debt_label": F.when(F.col("debt_ratio").isNotNull(), F.format_string("%.2fx", "debt_ratio")), "signals": told})


#: A raw record's fields: where they are in its JSON, and their types.
RECORD = {
    "source_url": ("$._meta.url", "string"), "scraped_at": ("$._meta.scraped_at", "string"), "match_score": ("$._meta.match_score", "double"), "match_level": ("$._meta.match_level", "string"),
    "name": ("$.identite.company_name_raw", "string"), "pairs": ("$.identite.main_bloc_pairs", "map<string,string>"),
    **{k: (f"$.identite.{raw}", "string") for k, raw in [("siren", "siren_raw"), ("siret", "siret_raw"), ("vat", "vat_raw"), ("naf", "naf_raw"), ("capital", "capital_raw"), ("legal_form", "legal_form_raw"), ("founded", "creation_raw"), ("headcount", "effectif_raw"), ("address", "adresse_raw"), ("activity", "activite_raw")]},
    "people": ("$.dirigeants", "array<struct<parts_raw:array<string>>>"), "tables": ("$.html_tables", "array<struct<rows:array<array<string>>>>"),
    "contexts": ("$.finances_raw.year_contexts_raw", "array<struct<year:string,context:string>>"), "answers": ("$.xhr_finances", "string"),
}
_RAW = ["company_id", "source_url", "scraped_at", "match_score", "match_level", "name", "pairs", *structure.IDENTIFIERS, "people", "tables", "contexts", "answers", "rejected"]


def raw_of_pages(pages: DataFrame) -> DataFrame:
    """pages(company_id, url, html[, answers: array<string>]) -> the raw frame that ``composed`` takes."""
    read = pages.withColumn("s", structure.structure("html")).withColumn("i", structure.identifiers(F.col("s.text")))
    answers = F.col("answers") if "answers" in pages.columns else F.array().cast("array<string>")
    none = lambda kind: F.lit(None).cast(kind)
    return read.select(
        "company_id", F.col("url").alias("source_url"), none("string").alias("scraped_at"), none("double").alias("match_score"), none("string").alias("match_level"),
        F.col("s.title").alias("name"), F.col("s.pairs").alias("pairs"), "i.*", F.col("s.people").alias("people"), F.col("s.tables").alias("tables"),
        structure.years_with_context(F.col("s.text")).alias("contexts"), answers.alias("answers"), F.array().cast("array<string>").alias("rejected"),
    ).select(*_RAW)


def raw_of_records(landed: DataFrame) -> DataFrame:
    """landed(company_id, json) -> the raw frame that ``composed`` takes; ``rejected`` names what of a
    record couldn't be read, the rest of it counts."""
    answers = F.from_json(F.get_json_object("json", "$.xhr_finances"), "map<string,string>")
    parsed = landed.select("company_id", F.try_parse_json("json").alias("v"), F.col("json").isNotNull().alias("given"), F.map_values(answers).alias("answers"))
    rows = parsed.select("company_id", shred_variant(F.col("v"), F.col("given"), {k: v for k, v in RECORD.items() if k != "answers"}).alias("r"), "answers").select("company_id", "r.*", "answers")
    people = F.transform("people", lambda p: p["parts_raw"])
    return rows.withColumns({"people": people, "tables": F.transform("tables", lambda t: t["rows"])}).select(*_RAW)


def composed(raw: DataFrame, as_of: int) -> DataFrame:
    """One row for each company of a raw frame (its rows that repeat an id: the first by their content):
    identity, place, activity, head count, leaders, the latest year's figures, growth, and a prospect's
    score.  ``as_of`` is the year in which ages are counted."""
    once = records.keep_first(raw.withColumn("_order", F.xxhash64(*[F.to_json(F.struct(c)) for c in _RAW if c != "company_id"])), ["company_id"], ["_order"]).drop("_order")
    once = written(once, "raw")  # read four times; a page is parsed once
    told = lambda c, label: F.coalesce(F.nullif(F.trim(c), F.lit("")), F.try_element_at("pairs", F.lit(label)))
    founded = company.year(told("founded", "Création"))
    people = F.coalesce(profile.leaders(F.coalesce("people", F.array().cast("array<array<string>>"))), F.array().cast("array<struct<name:string,title:string,age:int,born:string,is_chair:boolean,is_chief:boolean>>"))
    known = once.select(
        "company_id", "source_url", "scraped_at", "match_score", "match_level", squeeze_or_null(told("name", "Raison sociale")).alias("name"),
        company.digits_of(F.col("siren"), 9).alias("siren"), company.digits_of(F.col("siret"), 14).alias("siret"), F.nullif(F.regexp_replace("vat", r"\s", ""), F.lit("")).alias("vat"),
        company.activity_code(F.col("naf")).alias("naf"), company.legal_form(F.col("legal_form")).alias("legal_form"), squeeze_or_null(F.col("capital")).alias("capital"),
        squeeze_or_null(told("address", "Adresse")).alias("address"), F.nullif(F.regexp_extract("address", r"\b(\d{5})\b", 1), F.lit("")).alias("postcode"),
        F.nullif(F.trim(F.regexp_extract("address", r"\d{5}\s+([A-ZÀÂÄÉÈÊËÏÎÔÙÛÜ][A-Za-zÀ-ÿ\s\-]+)", 1)), F.lit("")).alias("city"), F.lit("France").alias("country"),
        squeeze_or_null(told("activity", "Activité")).alias("sector"), founded.alias("founded"), company.headcount(told("headcount", "Effectif")).alias("headcount"), people.alias("leaders"), "rejected",
    ).withColumn("age", company.age(F.col("founded"), as_of))
    nested = lambda column, nth, alias: once.select("company_id", F.posexplode(column).alias(nth, alias))
    contexts = nested("contexts", "position", "c").select("company_id", "position", "c.year", "c.context")
    figures = written(history(nested("answers", "position", "json"), nested("tables", "table_no", "rows"), contexts), "figures")
    out = known.join(indicators(figures), "company_id", "left")
    score = company.sales_score(F.col("siren"), F.col("vat"), F.col("sector"), F.col("headcount.low"), F.size("leaders"), F.col("headcount.label"), F.col("growth_pct"), F.col("margin_pct"), F.col("age"))
    return out.withColumn("sales", score)
