"""What a registry page says by its structure: title, labelled values, people, tables as grids, sections.

One Arrow pass over small batches parses a page once; what can be read from its text is left to column
expressions (``identifiers``, ``lines_about``, ``years_with_context``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, BooleanType, MapType, StringType, StructField, StructType

from siftwell.functions import articles
from siftwell.functions.dom import Element, parsed
from siftwell.functions.text import blank

# Where a page has what, and the texts that identify a company.
PAIRS_CLASS, PERSON_CLASS = "table-container", "dirigeant"
SECTION_CLASSES = {"finances_bloc": "finances-bloc", "section_finances": "section-finances", "chiffres_cles": "chiffres-cles", "bilans": "bilans"}
SECTION_IDS = ["finances", "financier", "bilans", "chiffres"]
IDENTIFIERS = {
    "siren": r"(?:SIREN|Siren)[^\d]*(\d[\d\s]{8,10})", "siret": r"(?:SIRET|Siret)[^\d]*(\d[\d\s]{13,16})", "vat": r"(FR\s?\d{2}\s?\d{9})", "naf": r"(\d{4}[A-Z])",
    "capital": r"Capital social[^\d]*([\d\s \xa0,\.]+\s*(?:€|EUR)?)", "legal_form": r"Forme juridique\s*:?\s*([^\n]{3,80})",
    "founded": r"(?:Cr[eé]ation|Immatriculat[^\n]{0,20})\s*:?\s*([^\n]{4,30})", "headcount": r"(?:Effectif|Salari[eé]s?)[^\n]*\n([^\n]{1,50})",
    "address": r"(?:Adresse|Si[eè]ge)[^\n]*\n([^\n]{5,120})", "activity": r"(?:Activit[eé]|Secteur)[^\n]*\n([^\n]{5,100})",
}
LINES = {
    "ca_lines": r"(?:Chiffre d.affaires|CA\b)[^\n]*\n[^\n]+", "resultat_lines": r"(?:R[eé]sultat net|B[eé]n[eé]fice net)[^\n]*\n[^\n]+", "ebitda_lines": r"(?:EBITDA|EBE|Exc[eé]dent brut)[^\n]*\n[^\n]+",
    "bilan_lines": r"(?:Total.*bilan|Total.*actif)[^\n]*\n[^\n]+", "capitaux_lines": r"(?:Capitaux propres|Fonds propres)[^\n]*\n[^\n]+", "dettes_lines": r"(?:Dettes financ|Endettement)[^\n]*\n[^\n]+",
    "effectif_hist": r"(?:Effectif|Salari[eé]s?).*?(\d{4}).*?\n[^\n]+",
}
MOST_LINES, MOST_YEARS = 10, 30
#: The widest cell that HTML knows.
WIDEST = 1000

_UNSEEN = frozenset(["script", "style", "template", "noscript"])
_GRID = ArrayType(ArrayType(StringType()))
STRUCTURE = StructType([
    StructField("title", StringType()), StructField("text", StringType()), StructField("pairs", MapType(StringType(), StringType())),
    StructField("people", _GRID), StructField("tables", ArrayType(_GRID)), StructField("sections", MapType(StringType(), ArrayType(StringType()))),
])
_ARROW_GRID = pa.list_(pa.list_(pa.string()))
_ARROW = pa.struct([("title", pa.string()), ("text", pa.string()), ("pairs", pa.map_(pa.string(), pa.string())), ("people", _ARROW_GRID), ("tables", pa.list_(_ARROW_GRID)), ("sections", pa.map_(pa.string(), pa.list_(pa.string())))])


def texts(e: Element, without: frozenset[str] = _UNSEEN) -> list[str]:
    """The texts below an element, trimmed, without empty ones."""
    out, stack = [], [e]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            if x.strip():
                out.append(x.strip())
        elif x is e or x.tag not in without:
            stack += x.children[::-1]
    return out


def _own(e: Element, names: tuple[str, ...], beyond: tuple[str, ...]) -> Iterator[Element]:
    """Elements below, but for what is below those of ``beyond``.  Rows and cells that nothing closes hold
    those after them in the tree, so what is found is looked into as well."""
    stack = e.children[::-1]
    while stack:
        x = stack.pop()
        if isinstance(x, Element) and x.tag not in beyond:
            if x.tag in names:
                yield x
            stack += x.children[::-1]


def _span(cell: Element, name: str) -> int:
    given = cell.attributes.get(name, "").strip()
    return int(given) if given.isdigit() else 1


def grid(table: Element) -> list[list[str]]:
    """A table's rows as lists of one text for each column: a cell that spans columns or rows is in all
    of them, a span of no rows reaches to the end, what nothing covers is empty.  Rows without text are
    left out; a table in a cell isn't part of its text."""
    rows, below = [], {}  # column -> (rows still to fill, text)
    for row in _own(table, ("tr",), ("table",)):
        filled, at = {}, 0
        for column, (left, text) in [*below.items()]:
            filled[column] = text
            below[column] = (left - 1, text)
        for cell in _own(row, ("td", "th"), ("table", "tr")):
            while at in filled:
                at += 1
            text, down = "".join(texts(cell, _UNSEEN | {"table", "tr", "td", "th"})), _span(cell, "rowspan")
            for column in range(at, at + max(1, min(_span(cell, "colspan"), WIDEST))):
                filled[column] = text
                if down != 1:
                    below[column] = (down - 1 if down else 1 << 30, text)
            at += 1
        below = {c: b for c, b in below.items() if b[0] > 0}
        rows.append([filled.get(c, "") for c in range(max(filled, default=-1) + 1)])
    return [r for r in rows if any(r)]


_SECTION_CLASSES = {name: re.compile(part, re.I) for name, part in SECTION_CLASSES.items()}
_SECTION_IDS = {f"id_{part}": re.compile(part, re.I) for part in SECTION_IDS}


def structure_of(html: str | None) -> dict:
    page = parsed(html)
    every = [*page.all(lambda e: True)]
    classed = [(e, e.attributes["class"]) for e in every if "class" in e.attributes]
    named = [(e, e.attributes["id"]) for e in every if "id" in e.attributes]
    with_class = lambda name: (e for e, c in classed if name in c.split())
    block = next((e for e in with_class(PAIRS_CLASS) if e.tag == "div"), None)
    lines = [line.strip() for t in texts(block) for line in t.split("\n") if line.strip()] if block else []
    sections = {}
    for name, part in _SECTION_CLASSES.items():
        found = [e for e, c in classed if part.search(c)]
        if found:
            sections[name] = ["\n".join(texts(e)) for e in found]
    for name, part in _SECTION_IDS.items():
        found = next((e for e, i in named if part.search(i)), None)
        if found:
            sections[name] = ["\n".join(texts(found))]
    head = next((e for e in every if e.tag == "h1"), None)
    return {
        "title": "".join(texts(head)) if head else None,
        "text": "\n".join(texts(page)),
        "pairs": {a.rstrip(":"): b for a, b in zip(lines, lines[1:]) if a.endswith(":")},
        "people": [p for e in with_class(PERSON_CLASS) if (p := texts(e))],
        "tables": [g for t in every if t.tag == "table" and (g := grid(t))],
        "sections": sections,
    }


ANCHORS = ArrayType(StructType([StructField("href", StringType()), StructField("text", StringType()), StructField("may_be_article", BooleanType())]))


def anchors_of(html: str | None) -> list[dict]:
    """(href, text, may_be_article) of a page's anchors, in order: a long text, or an element among the
    nearest OLD_ABOVE that is an article or has a class of one, says that it may lead to one."""
    out, stack = [], [(parsed(html), ())]
    while stack:
        e, above = stack.pop()
        near = (*above, e)[-articles.OLD_ABOVE :]
        if e.tag == "a" and "href" in e.attributes:
            text = " ".join(" ".join(texts(e)).split())
            marked = any(x.tag == "article" or any(k in x.attributes.get("class", "").lower() for k in articles.OLD_CLASSES) for x in near)
            out.append({"href": e.attributes["href"].strip(), "text": text, "may_be_article": len(text) >= articles.OLD_ANCHOR or marked})
        stack += [(c, near) for c in reversed(e.children) if isinstance(c, Element)]
    return out


@F.pandas_udf(ANCHORS)
def anchors(html: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """A page's anchors; none of a null page."""
    for batch in html:
        yield batch.map(anchors_of)


@F.arrow_udf(STRUCTURE)
def structure(html: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """A page's structure; a null page has no title, an empty text and nothing else."""
    for batch in html:
        found = [structure_of(page) for page in batch.to_pylist()]
        for s in found:
            s["pairs"], s["sections"] = [*s["pairs"].items()], [*s["sections"].items()]
        yield pa.array(found, _ARROW)


def identifiers(text: Column) -> Column:
    """struct of the raw texts that stand for registry numbers, legal form, address and so on."""
    return F.struct(*[F.nullif(F.trim(F.regexp_extract(blank(text), f"(?iu){p}", 1)), F.lit("")).alias(name) for name, p in IDENTIFIERS.items()])


def lines_about(text: Column) -> Column:
    """map of figure to the first MOST_LINES places (a line and the next, or the year on it) that name it;
    figures without any aren't in it."""
    hits = lambda p: F.slice(F.regexp_extract_all(blank(text), F.lit(f"(?iu){p}"), F.lit(int(r"(\d" in p))), 1, MOST_LINES)
    found = [F.struct(F.lit(name).alias("key"), hits(p).alias("value")) for name, p in LINES.items()]
    return F.map_from_entries(F.filter(F.array(*found), lambda x: F.size(x["value"]) > 0))


def years_with_context(text: Column) -> Column:
    """array<struct<year, context>>: years of this century and the line after each, the first MOST_YEARS."""
    part = lambda k: F.slice(F.regexp_extract_all(blank(text), F.lit(r"(20\d{2})[^\n]*\n([^\n]{0,100})"), F.lit(k)), 1, MOST_YEARS)
    return F.arrays_zip(part(1).alias("year"), part(2).alias("context"))
