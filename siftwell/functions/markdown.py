"""Markdown pages to clean text and paragraphs, as Column expressions."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from siftwell.functions.text import blank, let

# Lines and headings that are not content.
NOISE_LINES = ["read more", "contactdemo", "contact demo", "contact", "demo", "learn more", "watch", "subscribe", "view blogs?", "view analyst reports?", "no news available", "explore vision", "schedule demo", "vision journey", "see what we deliver", "view all stories"]
FOOTER_HEADINGS = ["SERVICES", "VISION", "EXPERIENCE", "COMPANY", "CONTACT", "ABOUT"]
NAV_WORDS = ["Services", "Industries", "Customers", "Partners", "Company", "Vision Journey"]
LEGAL_LINES = r"confidentiality|terms|cookies|all rights reserved|©|\bprivacy\b"
COOKIE_BLOCKS = [
    r"Customise\s+Reject All\s+Accept All.*?(?=Skip to content|Home\s|$)",
    r"(?:NecessaryAlways Active|Functional\s+Analytics|Performance\s+Advertisement).*?(?=\n\n|\z)",
]

#: Shorter pages count as failed.
LEAST = 50


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def _replaced(c: Column, *steps: tuple[str, str]) -> Column:
    for pattern, to in steps:
        c = F.regexp_replace(c, pattern, to)
    return c


def _noise(line: Column) -> Column:
    return line.rlike(rf"(?iu)^(?:{'|'.join(NOISE_LINES)})[\s▶]*$")


def clean(c: Column) -> Column:
    """Without cookie blocks, images, link targets, bare URLs, what follows a footer heading, and
    legal and navigation lines.  Null gives the empty string."""
    text = _replaced(
        blank(c),
        *[("(?is)" + p, "") for p in COOKIE_BLOCKS],
        (r"(?md)^##\s+[A-Z]+\s*\n", ""),
        (r"\[!\[[^\]]*\]\([^)]+\)\]\([^)]+\)", ""),
        (r"!\[[^\]]*\]\([^)]+\)", ""),
        (r"\[\]\([^)]+\)", ""),
        (r"\[([^\]]+)\]\([^)]+\)", "$1"),
        (r"(?md)^\s*https?://\S+\s*$", ""),
        (rf"(?is)###\s+(?:{'|'.join(FOOTER_HEADINGS)}).*", ""),
    )
    menu = rf"(?i)^(?:(?:{'|'.join(NAV_WORDS)})\s*+(?:[>|]\s*+)?+)+$"
    lines = F.filter(F.split(text, "\n"), lambda x: ~x.rlike(rf"(?iu){LEGAL_LINES}") & ~strip(x).rlike(menu))
    return strip(_replaced(F.array_join(lines, "\n"), (r"[ \t]+", " "), (r"\n{3,}", "\n\n")))


def _figures_joined(c: Column) -> Column:
    """A number alone on its line joins the label below it."""
    return F.regexp_replace(c, r"(\d+\+?)\s*\n\s*([A-Za-z][^\n]{2,40})", "$1 $2")


def paragraphs(cleaned: Column) -> Column:
    """array<string>: blocks between blank lines or from third and fourth level headings on, of five
    characters and more."""

    def block(b: Column) -> Column:
        b = _replaced(strip(b), (r"(?md)^#{1,4}\s+", ""), (r"(?md)^\s*\*\s*\*\s*\*\s*$", ""))
        lines = F.transform(F.split(b, "\n"), strip)
        return F.array_join(F.filter(lines, lambda x: (x != "") & ~_noise(x)), " ")

    blocks = F.transform(F.split(_figures_joined(blank(cleaned)), r"\n\n+|\n(?=#{3,4}\s)"), block)
    return F.filter(blocks, lambda b: F.char_length(b) >= 5)


def plain(cleaned: Column) -> Column:
    """One line of text, without heading and emphasis marks and noise lines."""
    text = _replaced(_figures_joined(blank(cleaned)), (r"(?md)^#{1,4}\s+", ""), (r"[*_`]", ""))
    lines = F.filter(F.split(text, "\n"), lambda x: (strip(x) != "") & ~_noise(strip(x)))
    return strip(F.regexp_replace(F.array_join(lines, " "), r"(?U)\s+", " "))


def page(c: Column) -> Column:
    """struct (status, clean_text, paragraphs); null, "failed" and short pages have status failed and
    nulls."""

    def told(cleaned: Column) -> Column:
        ok = c.isNotNull() & (c != "failed") & (F.char_length(cleaned) >= LEAST)
        return F.struct(F.when(ok, "ok").otherwise("failed").alias("status"), F.when(ok, plain(cleaned)).alias("clean_text"), F.when(ok, paragraphs(cleaned)).alias("paragraphs"))

    return let(clean(c), told)


#: A bracket, or one that closes a link's text with the address that follows.
_mark = re.compile(r"\[|\](?:\((https?://[^)\s]+)\))?")
_ARROW = [pa.field("start", pa.int32()), pa.field("size", pa.int32()), *[pa.field(x, pa.string()) for x in ("text", "url", "near")]]
_LINK = ArrayType(StructType([StructField("start", IntegerType()), StructField("size", IntegerType()), *[StructField(x, StringType()) for x in ("text", "url", "near")]]))


def scan_links(markdown: str, window: int = 80) -> list[tuple[int, int, str, str, str]]:
    """(start, size, text, url, near) of the links to web pages, by start, in one pass.

    A link's text begins at the bracket that its closing one belongs to, so a linked image is a link,
    with the image inside it.  Places are code points from 0; ``near`` is the text with ``window``
    code points on either side.
    """
    opened: list[int] = []
    found = []
    for m in _mark.finditer(markdown):
        if m[0] == "[":
            opened.append(m.start())
        elif opened:
            start = opened.pop()
            if m[1]:
                found.append((start, m.end() - start, markdown[start + 1 : m.start()].strip(), m[1], markdown[max(0, start - window) : m.end() + window]))
    return sorted(found)


@F.arrow_udf(_LINK)
def links(markdown: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The links of markdown texts; none for null."""
    for batch in markdown:
        found = [scan_links(text or "") for text in batch.to_pylist()]
        columns = [*zip(*(x for of_text in found for x in of_text))] or [()] * len(_ARROW)
        offsets = [0, *itertools.accumulate(map(len, found))]
        values = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], fields=_ARROW)
        yield pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
