"""A small element tree of HTML, for what has to be read by structure: review cards, company search.

Built in Arrow batches by the standard library's parser; memory is bounded by one page.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from siftwell.operators import records

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Where a card says what, best places first.
CARD = [("data-service-review-card-paper", None), ("data-testid", "review-card")]
AUTHOR = [("data-consumer-name-typography", None), ("data-testid", "consumer-name")]
RATING = [("data-service-review-rating", None), ("data-testid", "review-rating")]
TITLE = [("data-service-review-title-typography", None), ("data-testid", "review-title")]
CONTENT = [("data-service-review-text-typography", None), ("data-testid", "review-content")]
STARS = re.compile(r"(\d)\s*[ée]toile|rated?\s+(\d)", re.I)
ANSWERED = re.compile(r"l.entreprise a répondu", re.I)
UNITS, DEPTH = 8, 10


class Element:
    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []

    def all(self, test: Callable[["Element"], bool]) -> Iterator["Element"]:
        """What is below and passes, in page order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Element)]
        while stack:
            e = stack.pop()
            if test(e):
                yield e
            stack += [c for c in reversed(e.children) if isinstance(c, Element)]

    def having(self, places: list[tuple[str, str | None]]) -> list["Element"]:
        """The elements of the first place that has any."""
        for name, value in places:
            found = [*self.all(lambda e: name in e.attributes and value in (None, e.attributes[name]))]
            if found:
                return found
        return []

    def tags(self, *names: str) -> list["Element"]:
        return [*self.all(lambda e: e.tag in names)]

    def text(self) -> str:
        """Its texts, each trimmed, one after the other."""
        out, stack = [], [self]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                out.append(x.strip())
            else:
                stack += x.children[::-1]
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open = [Element("#root", {})]

    def handle_starttag(self, tag, attrs):
        e = Element(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(e)
        if tag not in VOID:
            self.open.append(e)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.open.pop()

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                break

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parsed(page: str | None) -> Element:
    builder = _Builder()
    builder.feed(page or "")
    builder.close()
    return builder.open[0]


def _first_text(elements: list[Element]) -> str | None:
    return elements[0].text() if elements else None


def _rating(card: Element) -> str:
    for e in card.having(RATING)[:1]:
        digit = re.search(r"\d", e.attributes.get("data-service-review-rating") or e.attributes.get("aria-label", ""))
        if digit:
            return digit[0]
    said = [e.attributes.get("alt") or e.attributes.get("aria-label", "") for e in card.tags("img")]
    said += [e.attributes["aria-label"] for e in card.all(lambda e: "aria-label" in e.attributes)]
    return next((m[1] or m[2] for s in said if (m := STARS.search(s))), "")


def _card(card: Element) -> dict:
    when = card.tags("time")[:1]
    linked = [h for a in card.tags("a") if "href" in a.attributes for h in a.tags("h2")]
    paragraphs = sorted((p.text() for p in card.tags("p")), key=len, reverse=True)
    title = next((t for t in (_first_text(card.having(TITLE)), _first_text(linked), _first_text(card.tags("h2"))) if t is not None), "")
    content = _first_text(card.having(CONTENT))
    return {
        "author": _first_text(card.having(AUTHOR)) or "",
        "date_iso": when[0].attributes.get("datetime", "") if when else "",
        "date": when[0].text() if when else "",
        "rating": _rating(card),
        "title": title,
        "content": content if content is not None else paragraphs[0] if paragraphs else "",
        "answered": bool(card.having([("data-testid", "company-reply")]) or ANSWERED.search(card.text())),
    }


def _struct(*names: str, **more) -> ArrayType:
    return ArrayType(StructType([*(StructField(n, StringType()) for n in names), *(StructField(n, t) for n, t in more.items())]))


@F.pandas_udf(_struct("author", "date_iso", "date", "rating", "title", "content", answered=BooleanType()))
def review_cards(html: pd.Series) -> pd.Series:
    """The reviews that a page shows, in page order; none for null."""

    def cards(page: str | None) -> list[dict]:
        root = parsed(page)
        return [_card(c) for c in root.having(CARD) or root.tags("article")]

    return html.map(cards)


def latest_cards(pages: DataFrame, most: int = 15) -> DataFrame:
    """(page_id, position, author, date_iso, ...): the newest reviews of each page(page_id, html), those
    without a date last."""
    rows = pages.select("page_id", F.posexplode(review_cards("html")).alias("position", "c")).select("page_id", "position", "c.*")
    day = F.when(F.col("date_iso") == "", "0000").otherwise(F.col("date_iso"))
    return records.top_of_each(rows, ["page_id"], [F.desc(day), F.asc("position")], most).drop("rank")


def _units(data: object) -> list[dict]:
    out: dict[str, dict] = {}
    stack = [(data, 0)]
    while stack and len(out) < UNITS:
        x, depth = stack.pop()
        if depth > DEPTH:
            continue
        if isinstance(x, dict) and isinstance(x.get("displayName"), str) and len(x["displayName"]) > 1 and "identifyingName" in x:
            n, score = x.get("numberOfReviews"), x.get("trustScore")
            n = n.get("total") if isinstance(n, dict) else n if isinstance(n, int) else None
            slug = str(x["identifyingName"])
            out.setdefault(slug, {"name": x["displayName"], "slug": slug, "n_reviews": str(n) if n else "?", "score": "?" if score is None else str(score).replace(".", ",")})
        elif isinstance(x, (dict, list)):
            below = [*x.values()] if isinstance(x, dict) else x
            stack += [(y, depth + 1) for y in reversed(below)]
    return [*out.values()]


@F.pandas_udf(_struct("name", "slug", "n_reviews", "score"))
def business_units(html: pd.Series) -> pd.Series:
    """The companies that a review site's search page names, from its data or else its links; each once,
    at most 8."""

    def units(page: str | None) -> list[dict]:
        root = parsed(page)
        for script in root.all(lambda e: e.tag == "script" and e.attributes.get("id") == "__NEXT_DATA__"):
            try:
                found = _units(json.loads("".join(c for c in script.children if isinstance(c, str))))
            except ValueError:
                found = []
            if found:
                return found
        linked: dict[str, dict] = {}
        for a in root.tags("a"):
            slug = re.search(r"/review/([^/?#]+)", a.attributes.get("href", ""))
            if slug and slug[1] not in linked:
                names = [t for e in a.tags("h2", "h3", "p", "span") if len(t := e.text()) > 2 and not re.fullmatch(r"[\d,.]+", t)]
                linked[slug[1]] = {"name": names[0] if names else slug[1], "slug": slug[1], "n_reviews": "?", "score": "?"}
        return [*linked.values()][:UNITS]

    return html.map(units)


def units(pages: DataFrame) -> DataFrame:
    """(page_id, position, name, slug, n_reviews, score)."""
    return pages.select("page_id", F.posexplode(business_units("html")).alias("position", "u")).select("page_id", "position", "u.*")
