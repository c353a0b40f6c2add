"""Technology detection: thousands of fingerprint rules against the signals of pages.

A rule names a technology, a signal (script source, html, header, cookie, meta, script global) and a
pattern with options (regex, version:..., confidence:..., parted by a backslash and a semicolon).

A page is a list of observations (signal, key, text), the rules are rows of a table, and detection is
their join through an index: by key where a signal has keys, and for free text by one automaton over
the longest literal that any match of a pattern must hold, so one scan of a text names the rules worth
trying, however many there are.  Hits are rows (order, confidence, version) again, of which each
technology takes its best once.  Rules are of bounded size and broadcast; pages pass through in small
Arrow batches, one narrow pass without a join or shuffle.

Defined cases: a null or blank page has no technologies; keys of headers, cookies and meta elements are
compared without case; an invalid pattern counts as a literal; an empty one as presence; of equal
confidences the first rule's counts.
"""

from __future__ import annotations

import itertools
import re
import re._parser as sre
from collections import defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from siftwell.batches import bounded

# Fixed values.
CATEGORY_FIELDS = {
    "platform": [6, 108], "cms": [1, 11, 51], "frontend_framework": [12, 18, 26, 57], "js_libraries": [59], "css_framework": [66],
    "analytics": [10, 74, 78, 83], "tag_managers": [42], "advertising": [36, 77, 71, 94], "crm_marketing": [32, 53, 75, 76, 86, 97, 98],
    "payment_gateways": [41, 91], "review_platform": [90, 84], "live_chat": [52, 58], "search_engines": [29], "cdn": [31], "hosting": [88, 62, 63],
    "server": [22, 64, 65], "caching": [23], "security": [16, 67, 69, 70], "shipping": [99, 107, 102], "other": [73, 72, 89, 110],
}
SHOP_CATEGORIES = [6, 41, 91, 98, 99, 100, 102, 106, 107, 108]
SHOP_WEIGHTS = {6: 30.0, 41: 20.0, 91: 15.0}
OTHER_SHOP_WEIGHT = 12.0
LEFT_OUT = ["@sulu/web", "Docusaurus", "HeadJS", "jQuery DevBridge Autocomplete", "jQuery-pjax", "jQuery Migrate", "Moment.js"]

LEAST, IMPLIED, SURE = 0.5, 0.75, 0.9
#: Of a global: the share of a pattern's confidence that counts, the most that its presence counts, and the shortest name that tells.
OF_GLOBAL, MOST_GLOBAL, SHORTEST_GLOBAL = 0.85, 0.65, 3
COOKIE = 0.75
FIELD_OF = {cat: field for field, cats in CATEGORY_FIELDS.items() for cat in cats}


def needed_literal(regex: str) -> str:
    """The longest run of characters, in lower case, that every match holds; may be empty."""
    runs, now = [""], ""

    def take(parsed) -> None:
        nonlocal now
        for op, value in parsed:
            if op is sre.LITERAL and chr(value).lower() == chr(value).lower().casefold() and ord(chr(value)) < 128:
                now += chr(value).lower()
                continue
            if op is sre.SUBPATTERN and not value[1] and not value[2]:
                take(value[3])
                continue
            if op is sre.AT:
                continue
            runs.append(now)
            now = ""
            if op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and value[0] > 0:
                take(value[2])
                runs.append(now)
                now = ""

    take(sre.parse(regex, re.I))
    return max([*runs, now], key=len)


class Rule(NamedTuple):
    """One row of the rule table; rules of a technology are tried, and count, in their order."""

    tech: str
    order: int
    signal: str
    key: str  # of a header, cookie or meta element; the name of a global
    regex: str  # empty: presence is enough
    version: str
    confidence: float
    literal: str  # in lower case, in every match
    as_written: bool  # the pattern has capitals: versions are read from the text as it is


#: The signals in the order in which they count, and whether they are found by key.
SIGNALS = {"scriptSrc": False, "html": False, "headers": True, "cookies": True, "meta": True, "js": True}


def _usable(regex: str) -> str:
    if not regex.strip():
        return ""
    try:
        re.compile(regex, re.I)
    except re.error:
        return re.escape(regex)
    return regex


def rule_table(fingerprints: dict[str, dict], left_out: Iterable[str] = LEFT_OUT) -> list[Rule]:
    """All rules of all technologies but those left out."""
    skip, out = set(left_out), []
    for tech in (t for t in fingerprints if t not in skip):
        given = fingerprints[tech]
        raws = [(signal, key, raw) for signal in SIGNALS for key, raws in _entries(given.get(signal)) for raw in ([raws] if SIGNALS[signal] else _listed(raws))]
        for order, (signal, key, raw) in enumerate(raws):
            text = " ".join(raw) if isinstance(raw, list) else str(raw or "")
            pattern, *options = text.split("\\;")
            option = dict(o.partition(":")[::2] for o in options)
            percent = re.fullmatch(r"\s*([+-]?\d+)\s*", option.get("confidence", ""))
            regex = _usable(pattern)
            key = key.split(".")[0] if signal == "js" else key.lower()
            if (regex or SIGNALS[signal]) and (signal != "js" or len(key) >= SHORTEST_GLOBAL):
                out.append(Rule(tech, order, signal, key, regex, option.get("version", ""), int(percent[1]) / 100 if percent else 1.0, needed_literal(regex) if regex else "", signal != "html" or pattern != pattern.lower()))
    return out


def _listed(value) -> list:
    return value if isinstance(value, list) else [] if value is None else [value]


def _entries(value) -> list[tuple[str, object]]:
    return list(value.items()) if isinstance(value, dict) else [] if value is None else [("", value)]


_script = re.compile(r"<script\b([^>]*)>(.*?)</script\s*>", re.I | re.S)
_meta = re.compile(r"<meta\b([^>]*)>", re.I | re.S)
_attribute = re.compile(r"""([a-z:-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _attribute.finditer(raw)}


class Observation(NamedTuple):
    signal: str
    key: str
    text: str


def observations(html: str, headers: dict | None, cookies: dict | None) -> Iterator[Observation]:
    """What a page shows, signal by signal."""
    yield Observation("html", "", html)
    for m in _script.finditer(html):
        source = _attributes(m[1]).get("src")
        if source:
            yield Observation("scriptSrc", "", source)
        elif m[2].strip():
            yield Observation("js", "", m[2])
    metas = [_attributes(m[1]) for m in _meta.finditer(html)]
    keyed = {"meta": {a.get("name") or a.get("property") or "": a.get("content", "") for a in metas}, "headers": headers or {}, "cookies": cookies or {}}
    for signal, values in keyed.items():
        for key, value in {k.lower(): v or "" for k, v in values.items()}.items():
            if value or signal == "cookies":
                yield Observation(signal, key, value)


def folded(text: str) -> str:
    """Lower case, as patterns that ignore case compare."""
    return text.lower().replace("\u017f", "s")


class Literals:
    """Which of many literals a text holds, in one scan."""

    def __init__(self, literals: Iterable[str]):
        self.scan = ahocorasick.Automaton()
        for x in literals:
            if x:
                self.scan.add_word(x, x)
        if len(self.scan):
            self.scan.make_automaton()

    def within(self, text: str) -> set[str]:
        return {x for _, x in self.scan.iter(text)} if len(self.scan) else set()


class Index:
    """The rules that an observation can match."""

    def __init__(self, rules: list[Rule]):
        self.by_key, self.by_literal = defaultdict(list), defaultdict(list)
        for n, rule in enumerate(rules):
            if SIGNALS[rule.signal]:
                self.by_key[rule.signal, rule.key].append(n)
            else:
                self.by_literal[rule.signal, rule.literal].append(n)
        self.literals = {s: Literals(x for of, x in self.by_literal if of == s) for s, keyed in SIGNALS.items() if not keyed}
        self.globals = Literals(key for of, key in self.by_key if of == "js")

    def candidates(self, seen: Observation, lower: str) -> Iterator[int]:
        if seen.signal == "js":
            for name in self.globals.within(seen.text):
                if re.search(rf"\b{re.escape(name)}\b", seen.text):
                    yield from self.by_key["js", name]
        elif SIGNALS[seen.signal]:
            yield from self.by_key.get((seen.signal, seen.key), ())
        else:
            for literal in ["", *self.literals[seen.signal].within(lower)]:
                yield from self.by_literal.get((seen.signal, literal), ())


class Detector:
    """A rule table with its index.  Patterns are compiled when they are first tried."""

    def __init__(self, fingerprints: dict[str, dict], left_out: Iterable[str] = LEFT_OUT):
        self.known = fingerprints
        self.rules = rule_table(fingerprints, left_out)
        self.index = Index(self.rules)
        self.compiled: dict[int, re.Pattern] = {}

    def hit(self, n: int, seen: Observation, lower: str) -> tuple[float, str] | None:
        """(confidence, version) if rule ``n`` matches an observation."""
        rule = self.rules[n]
        is_global = rule.signal == "js"
        if not rule.regex or is_global and re.search(r"^\(?\.\*\)\??\$?", rule.regex):  # a pattern that takes anything is presence
            c = rule.confidence
            return (min(c, MOST_GLOBAL) if is_global else c or (COOKIE if rule.signal == "cookies" else 0.0)), ""
        if rule.literal not in lower:
            return None
        if n not in self.compiled:
            self.compiled[n] = re.compile(rule.regex, re.I)
        m = self.compiled[n].search(seen.text if rule.as_written else lower)
        if not m:
            return None
        version = rule.version
        for k, group in enumerate(m.groups() if version else (), 1):
            version = version.replace(f"\\{k}", group or "")
        return rule.confidence * (OF_GLOBAL if is_global else 1.0), version.strip(" \\").strip()

    def hits(self, page: Iterable[Observation]) -> dict[str, list[tuple[Rule, float, str]]]:
        """For each technology the hits of its rules in order; a rule hits where it first matches."""
        found: dict[int, tuple[float, str]] = {}
        for seen in page:
            lower = folded(seen.text)
            for n in self.index.candidates(seen, lower):
                if n not in found and (hit := self.hit(n, seen, lower)):
                    found[n] = hit
        out = defaultdict(list)
        for n in sorted(found):
            out[self.rules[n].tech].append((self.rules[n], *found[n]))
        return out

    def detect(self, html: str | None, headers: dict | None = None, cookies: dict | None = None) -> list[tuple[str, float, str, str]]:
        """(technology, confidence, version, field) of a page, implied technologies last."""
        if not html or not html.strip():
            return []
        best = {tech: _best(hits) for tech, hits in self.hits(observations(html, headers, cookies)).items()}
        found = {tech: best[tech] for tech in self.known if tech in best and best[tech][0] >= LEAST}
        implied = [other.split("\\;")[0] for tech in found for other in _listed(self.known[tech].get("implies"))]
        found |= {tech: (IMPLIED, "") for tech in implied if tech in self.known and tech not in found}
        return [(tech, c, v, self.field(tech)) for tech, (c, v) in found.items()]

    def field(self, tech: str) -> str:
        return next((FIELD_OF[c] for c in self.known[tech].get("cats", []) if c in FIELD_OF), "")

    def shop_weights(self) -> list[tuple[str, float]]:
        """(technology, weight) of those whose categories tell a shop."""
        cats = {tech: [c for c in SHOP_CATEGORIES if c in f.get("cats", [])] for tech, f in self.known.items()}
        return [(tech, max(SHOP_WEIGHTS.get(c, OTHER_SHOP_WEIGHT) for c in own)) for tech, own in cats.items() if own]


def _best(hits: list[tuple[Rule, float, str]]) -> tuple[float, str]:
    """The highest confidence, with the version of the last hit that raised it and had one.  Where script
    sources are sure, nothing else counts."""
    sources = [h for h in hits if h[0].signal == "scriptSrc"]
    counted = sources if any(c >= SURE for _, c, _ in sources) else hits
    before = itertools.accumulate((c for _, c, _ in counted), max, initial=0.0)
    raised = [(c, v) for (_, c, v), high in zip(counted, before) if c > high]
    return (raised[-1][0] if raised else 0.0), next((v for _, v in reversed(raised) if v), "")


def load(sources: Iterable[dict[str, dict]]) -> dict[str, dict]:
    """Several rule files as one; a later file's technology replaces an earlier one's."""
    out: dict[str, dict] = {}
    for source in sources:
        out.update(source)
    return out


def detect(pages: DataFrame, fingerprints: dict[str, dict], left_out: Iterable[str] = LEFT_OUT) -> DataFrame:
    """(page_id, tech, confidence, version, field) of pages(page_id, html[, headers, cookies: maps])."""
    columns = [c for c in ("headers", "cookies") if c in pages.columns]
    shared = pages.sparkSession.sparkContext.broadcast(Detector(fingerprints, left_out))  # a rule table, some MB

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bounded(batches):
            values = {name: column.to_pylist() for name, column in zip(batch.schema.names, batch.columns)}
            maps = [[dict(m or ()) for m in values[c]] if c in values else [None] * batch.num_rows for c in ("headers", "cookies")]
            rows = [(page, *x) for page, *given in zip(values["page_id"], values["html"], *maps) for x in shared.value.detect(*given)]
            if rows:
                types = [batch.schema.field("page_id").type, pa.string(), pa.float64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], ["page_id", "tech", "confidence", "version", "field"])

    return pages.select("page_id", "html", *columns).mapInArrow(run, f"page_id {dict(pages.dtypes)['page_id']}, tech string, confidence double, version string, field string")


def stacks(pages: DataFrame, found: DataFrame, scores: DataFrame) -> DataFrame:
    """A row for each page(page_id, url): domain, ssl, technologies with their versions, technologies of
    each field, their number, and the shop score (as ``matching.ecommerce`` gives it)."""
    url = F.when(F.col("url").contains("://"), F.col("url")).otherwise(F.concat(F.lit("https://"), F.col("url")))
    of_page = found.groupBy("page_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("tech", "version")))).alias("technologies"),
        F.sort_array(F.collect_list(F.when(F.col("field") != "", F.struct("field", "tech")))).alias("f"),
    )
    fields = F.transform(F.array_distinct(F.transform("f", lambda x: x["field"])), lambda n: F.struct(n.alias("field"), F.transform(F.filter("f", lambda x: x["field"] == n), lambda x: x["tech"]).alias("techs")))
    of_page = of_page.select("page_id", "technologies", F.map_from_entries(fields).alias("fields"), F.size("technologies").alias("n_technologies"))
    out = pages.select("page_id", F.regexp_extract(url, "://([^/?#]*)", 1).alias("domain"), url.startswith("https:").alias("ssl"))
    return out.join(of_page, "page_id", "left").join(scores, "page_id", "left").withColumn("n_technologies", F.coalesce("n_technologies", F.lit(0)))
