"""Secrets by linking the parts of credentials, in DataFrame functions only.

Plain patterns find what is a secret by itself (``assign``, ``access``, ``hex``).  Besides, weak
parts are collected: bare tokens that might be a secret (``bare``) and endpoints (``endpoint``: URLs,
IPv4 addresses with an optional port).  Parts are intervals of code points.  Within a document's
scopes, an interval join links them: a bare token counts only if an access identifier or an endpoint
lies within ``SCOPE`` code points of it, an endpoint only if a secret of any other kind does.

Spans come from splitting a text at a pattern: the lengths of the parts between and of the matches
add up to positions; sorted lists of ends and starts are merged to find what lies next to a part, so
that a text with very many parts takes little more than linear time.  Everything is one narrow pass,
without a shuffle.  Null texts count as empty; rows that repeat are scanned each time; very long texts
are scanned whole.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, functions as F

from siftwell.llm.common import let

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"  # greedy runs: the same as AKIA[A-Z0-9]+ of 16 characters or more
HEX = r"[0-9a-f]{32,}"  # likewise
BARE = r"[A-Za-z0-9+/_=-]{20,}+"  # with a letter and a digit
ENDPOINT = r"https?://[^\x20\x09-\x0D\"'<>]+|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]{1,5})?(?![0-9.])"
ASSIGN_LEAST = 8
#: Code points between parts of one credential.
SCOPE = 200
KINDS = ["assign", "access", "hex", "bare", "endpoint"]
#: Spans up to which each part of a text is cut out by itself.
FEW = 32
#: What a redacted span becomes.
MASK = "[secret]"

_SPAN = "array<struct<start:int,stop:int,rank:int>>"


def _none(kind: str = _SPAN) -> Column:
    return F.array().cast(kind)


def _scan(values: Column, merge) -> Column:
    """The running ``merge`` of an array of integers; it skips nulls.  Arrays grow only within blocks
    of about the root of the length, so n values cost n ** 1.5 copies at most."""

    def run(v: Column) -> Column:
        grow = lambda a: F.aggregate(a, _none("array<int>"), lambda s, x: F.concat(s, F.array(merge(F.get(s, F.size(s) - 1), x))))
        block = F.ceil(F.sqrt(F.size(v))).cast("int")
        cut = lambda b: F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / b).cast("int")), lambda k: grow(F.slice(v, k * b + 1, b)))

        def joined(parts: Column) -> Column:
            ends = grow(F.transform(parts, lambda p: F.get(p, F.size(p) - 1)))
            return let(ends, lambda e: F.flatten(F.transform(parts, lambda p, k: F.transform(p, lambda x: merge(F.get(e, k - 1), x)))))

        return F.when(F.size(v) > 0, let(block, lambda b: let(cut(b), joined))).otherwise(_none("array<int>"))

    return let(values, run)


def _plus(a: Column, b: Column) -> Column:
    return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))


def _latest(at: Column, value: Column, asked: Column) -> Column:
    """For each of the ascending numbers ``asked``, the largest ``value`` whose ``at`` isn't larger;
    null if there is none.  A merge of sorted lists."""
    entry = lambda x, ask, v: F.struct(x.alias("at"), F.lit(ask).alias("ask"), v.cast("int").alias("v"))
    events = F.array_sort(F.concat(F.zip_with(at, value, lambda x, v: entry(x, 0, v)), F.transform(asked, lambda x: entry(x, 1, F.lit(None)))))

    def answers(e: Column) -> Column:
        best = _scan(F.transform(e, lambda x: x["v"]), F.greatest)
        return let(best, lambda b: F.transform(F.filter(F.transform(e, lambda x, i: F.struct(x["ask"].alias("ask"), F.get(b, i).alias("v"))), lambda x: x["ask"] == 1), lambda x: x["v"]))

    return let(events, answers)


def _all(spans: Column, name: str, sign: int = 1) -> Column:
    return F.transform(spans, lambda s: s[name] * sign)


class _Steps:
    """A frame that gets helper columns, whose names clash with none, one after the other.  (One nested
    expression would take the analyzer too many rounds.)"""

    def __init__(self, docs: DataFrame):
        self.frame, self.added = docs, []

    def add(self, value: Column) -> Column:
        name = _name(self.frame, f"_{len(self.added)}")
        self.frame = self.frame.withColumn(name, value)
        self.added.append(name)
        return F.col(f"`{name}`")

    def beside(self, spans: Column, others: Column) -> Column:
        """Those of ``spans`` (sorted, none overlapping another) that have one of ``others`` within
        SCOPE code points before their start or after their end."""
        asked = (F.size(spans) > 0) & (F.size(others) > 0)
        unless = lambda x: F.when(asked, x).otherwise(_none("array<int>"))
        stops, starts = (self.add(unless(F.array_sort(_all(others, *x)))) for x in (("stop",), ("start", -1)))
        before = self.add(unless(_latest(stops, stops, _all(spans, "start"))))
        after = self.add(unless(_latest(starts, starts, F.reverse(_all(spans, "stop", -1)))))
        near = lambda b, a: F.filter(spans, lambda s, i: F.coalesce(s["start"] - F.get(b, i) <= SCOPE, F.lit(False)) | F.coalesce(-F.get(a, F.size(a) - 1 - i) - s["stop"] <= SCOPE, F.lit(False)))
        return self.add(F.when(asked, let(before, lambda b: let(after, lambda a: near(b, a)))).otherwise(_none()))

    def free(self, spans: Column, others: Column) -> Column:
        """Those of ``spans`` (sorted, none overlapping another) that none of ``others`` overlaps."""
        asked = (F.size(spans) > 0) & (F.size(others) > 0)
        x = self.add(F.when(asked, F.array_sort(others)).otherwise(_none()))
        ends = F.transform(_all(spans, "stop"), lambda s: s - 1)  # an overlap begins before the end
        covers = self.add(F.when(asked, _latest(_all(x, "start"), _all(x, "stop"), ends)).otherwise(_none("array<int>")))
        clear = lambda c: F.filter(spans, lambda s, i: F.coalesce(F.get(c, i) <= s["start"], F.lit(True)))
        return self.add(F.when(asked, let(covers, clear)).otherwise(spans))


def _spans(text: Column, pattern: str, rank: int, hint: str, least: int = 0, also: tuple[str, ...] = ()) -> Column:
    """The matches, leftmost and without overlap, as (start, end, rank); those whose second group is
    shorter than ``least``, or that don't match all of ``also``, are dropped afterwards.  ``hint`` is a cheaper
    pattern that any text with a match matches."""
    matches = F.regexp_extract_all(text, F.lit(f"(?:{pattern})"), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if least else matches
    between = F.split(text, pattern, -1)

    def placed(parts: Column) -> Column:
        steps = F.zip_with(parts["m"], F.slice(parts["b"], 1, F.size(parts["m"])), lambda m, b: F.char_length(b) + F.char_length(m))

        def spans(stops: Column) -> Column:
            all_spans = F.transform(parts["m"], lambda m, i: F.struct((F.get(stops, i) - F.char_length(m)).alias("start"), F.get(stops, i).alias("stop"), F.lit(rank).alias("rank")))
            if least:
                return F.filter(all_spans, lambda s, i: F.char_length(F.get(parts["v"], i)) >= least)
            if also:
                return F.filter(all_spans, lambda s, i: functools.reduce(operator.and_, [F.get(parts["m"], i).rlike(x) for x in also]))
            return all_spans

        return let(_scan(steps, _plus), spans)

    found = let(F.struct(matches.alias("m"), between.alias("b"), values.alias("v")), placed)
    return F.when(text.rlike(hint), found).otherwise(_none())


def _name(docs: DataFrame, wish: str) -> str:
    """``wish``, made longer until no column has that name."""
    taken = {c.lower() for c in docs.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def scan(docs: DataFrame, text_col: str = "text", base: str = "base", spans: str = "spans") -> DataFrame:
    """``docs`` with two more columns: ``base`` (spans that are secrets by themselves) and ``spans``
    (with the linked ones), each sorted by start, then kind.  Columns of those names are replaced."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    steps = _Steps(docs)
    strong = steps.add(F.concat(_spans(text, ASSIGN, 0, r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", ASSIGN_LEAST), _spans(text, ACCESS, 1, ACCESS), _spans(text, HEX, 2, HEX)))
    ends = steps.add(_spans(text, ENDPOINT, 4, r"https?://|[0-9]\.[0-9]"))
    # bare tokens are looked for only where a complementary part is
    ids = steps.add(F.concat(F.filter(strong, lambda s: s["rank"] == 1), ends))
    weak = steps.add(F.when(F.size(ids) > 0, _spans(text, BARE, 3, BARE, also=("[0-9]", "[A-Za-z]"))).otherwise(_none()))
    secrets = steps.add(F.concat(strong, steps.free(steps.beside(weak, ids), strong)))
    kept = steps.beside(ends, secrets)
    by_place = lambda x: F.array_sort(F.transform(x, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["stop"].alias("stop"))))
    return steps.frame.withColumns({base: by_place(strong), spans: by_place(F.concat(secrets, kept))}).drop(*steps.added)


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined; the empty string if there are none."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every secret of a text (endpoints stay) replaced by a mask; ``n_chars`` follows
    if it is there.  Texts without secrets, null ones too, stay as they are."""
    base = _name(docs, "_base")
    spans = _name(docs, "_spans")
    found = scan(docs, text_col, base, spans)
    old = F.col(f"`{text_col}`")

    def cut(text: Column, spans: Column) -> Column:
        # an overlapping span only moves the end on
        upto = _scan(_all(spans, "stop"), F.greatest)

        def parts(end: Column, part) -> Column:
            at = lambda i: F.coalesce(F.get(end, i - 1), F.lit(0))
            piece = lambda s, i: F.when(s["start"] >= at(i), F.concat(part(at(i), s["start"] - at(i)), F.lit(MASK))).otherwise("")
            return F.concat(F.array_join(F.transform(spans, piece), ""), part(F.get(end, F.size(end) - 1), F.char_length(text)))

        few = let(upto, lambda end: parts(end, lambda at, n: F.substring(text, at + 1, n)))
        # each substring counts code points from the start; an array of them is counted once
        many = let(F.split(text, ""), lambda c: let(upto, lambda end: parts(end, lambda at, n: F.array_join(F.slice(c, at + 1, n), ""))))
        return F.when(F.size(spans) <= FEW, few).otherwise(many)

    secrets = F.filter(spans, lambda s: s["rank"] < 4)
    masked = F.when(F.size(secrets) > 0, let(secrets, lambda x: cut(old, x))).otherwise(old)
    out = [masked.alias(c) if c == text_col else F.when(F.size(secrets) > 0, F.char_length(masked).cast("long")).otherwise(F.col(c)).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns]
    return found.select(*out)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    found = scan(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    count = lambda rank: F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
