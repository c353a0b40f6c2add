"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A seed is a fixed mask over SPAN successive words that reads some positions and ignores the others,
so a hash of what it reads survives substitutions at ignored positions.  The hashes of all windows of
the benchmark and of the documents are joined; around each hit the document's and the item's words
are compared along the diagonal, and an overlap is a run of RUN words of which NEED agree (of the
whole item, if it is shorter).  Items of fewer than SPAN words have seeds of their own length, made
only for lengths that the benchmark has.  The masks leave out no overlap that the rule accepts.

The benchmark's hashes are broadcast while they are at most BROADCAST rows and joined by shuffle
beyond; likewise what was hit.  Documents are exploded into windows by codegen and only hits leave
that stage, so a hot document, source or passage doesn't gather anywhere.  Defined cases: null or
empty texts and items have no windows; an item of a few words is an overlap wherever it is; repeated rows
of either table give the same verdict for each; columns of other names are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siftwell.llm.common import let, stored, words

SPAN = 10
MASKS = ["1110010101", "1010111001", "1101001011", "0111011010"]
RUN, NEED = 13, 11
#: Words beyond either end of a document that windows take in: as many as a run may lack.
BEYOND = RUN - NEED
#: Rows of fixed width that may be broadcast: 200,000 * 32 bytes.
BROADCAST = 200_000


def _tokens(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(F.lower(w)))


def masks_of(span: int) -> list[str]:
    """The masks for items of ``span`` words, or of SPAN and more.  A shorter item must agree whole, or
    but for one word: then each mask ignores a third of it."""
    if span == SPAN:
        return MASKS
    if -(-span * NEED // RUN) == span:
        return ["1" * span]
    return ["".join("0" if 3 * i // span == k else "1" for i in range(span)) for k in range(3)]


def _windows(df: DataFrame, keep: list[str], span: int = SPAN) -> DataFrame:
    """(keep, seed, at): a row for every mask and window of ``span`` of the word hashes in column w."""
    n = F.size("w") - (span - 1)
    rows = F.arrays_zip(F.sequence(F.lit(0), n - 1).alias("at"), *[F.slice("w", i + 1, n).alias(f"w{i}") for i in range(span)])
    rows = df.where(F.size("w") >= span).select(*keep, F.inline(rows))
    tag = 0 if span == SPAN else 3 * span + len(MASKS)
    seeds = [F.xxhash64(F.lit(tag + k), *[F.col(f"w{i}") for i, c in enumerate(mask) if c == "1"]) for k, mask in enumerate(masks_of(span))]
    return rows.select(*keep, "at", F.explode(F.array(*seeds)).alias("seed"))


def _small(df: DataFrame) -> DataFrame:
    """A stored table, to be broadcast if its counted size allows."""
    return F.broadcast(df) if df.count() <= BROADCAST else df


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, shift): diagonals on which some seed agrees."""
    items = benchmark.select("item_id", _tokens(F.col("text")).alias("w"))
    length = F.least(F.size("w"), F.lit(SPAN))
    spans = sorted(x.n for x in items.select(length.alias("n")).where("n > 0").distinct().collect())  # SPAN rows at most
    ends = F.array_repeat(F.lit(0).cast("long"), BEYOND)
    padded = docs.select("doc_id", F.concat(ends, _tokens(F.col("text")), ends).alias("w"))
    out = None
    for span in spans or [SPAN]:
        own = _windows(items.where(length == span), ["item_id"], span)
        seeds = stored(own.select("item_id", F.col("at").alias("item_at"), "seed").distinct(), "seeds")
        found = _windows(padded, ["doc_id"], span).join(_small(seeds), "seed")
        found = found.select("doc_id", "item_id", (F.col("at") - F.col("item_at") - BEYOND).alias("shift"))
        out = found if out is None else out.unionByName(found)
    return out.distinct()


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, shift, matched): verified overlaps; matched is the largest number of equal
    words in RUN successive ones."""
    docs = docs.select("doc_id", "text")
    diagonals = stored(hits(docs, benchmark), "hits")
    items = stored(benchmark.select("item_id", _tokens(F.col("text")).alias("y")).distinct(), "items")
    # a document comes once with all its diagonals, and each of those takes only the words beside its item
    sizes = items.groupBy("item_id").agg(F.max(F.size("y")).alias("n"))
    listed = diagonals.join(_small(sizes), "item_id").groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "shift", "n")).alias("h"))
    few = diagonals.count() <= BROADCAST

    def beside(words: Column) -> Column:
        first = lambda d: F.greatest(d["shift"], F.lit(0))
        part = lambda d: F.slice(words, (first(d) + 1).cast("int"), F.greatest(d["n"] + F.least(d["shift"], F.lit(0)), F.lit(0)).cast("int"))
        return F.transform("h", lambda d: F.struct(d["item_id"].alias("item_id"), d["shift"].alias("shift"), (d["shift"] - first(d)).alias("from"), part(d).alias("x")))

    found = docs.join(F.broadcast(listed) if few else listed, "doc_id").select("doc_id", F.explode(let(_tokens(F.col("text")), beside)).alias("d")).select("doc_id", "d.*")
    pairs = found.join(_small(items), "item_id")

    # 1 where the words agree, along the item; beyond the document's ends they don't
    same = F.transform("y", lambda y, i: F.when(F.get("x", (i + F.col("from")).cast("int")) == y, 1).otherwise(0))

    def best(m: Column) -> Column:
        run = F.least(F.lit(RUN), F.size(m))
        total = lambda a: F.aggregate(a, F.lit(0), lambda s, v: s + v)
        return F.array_max(F.transform(F.sequence(F.lit(1), F.size(m) - run + 1), lambda i: total(F.slice(m, i, run))))

    need = F.ceil(F.least(F.lit(RUN), F.size("y")) * F.lit(NEED / RUN))
    return pairs.select("doc_id", "item_id", "shift", let(same, best).alias("matched"), need.alias("need")).where("matched >= need").drop("need")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, n_items, first_item) of the contaminated documents."""
    found = overlaps(docs, benchmark).select("doc_id", "item_id").distinct()
    return found.groupBy("doc_id").agg(F.count("*").alias("n_items"), F.min("item_id").alias("first_item"))


def flags(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, contaminated, n_items, first_item) of every row; first_item is null if there is none."""
    found = stored(report(docs, benchmark), "leaks")
    out = docs.select("doc_id").join(_small(found), "doc_id", "left")
    return out.select("doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"), "first_item")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without an overlap, all columns as they were."""
    found = stored(report(docs, benchmark).select("doc_id"), "leaks")
    return docs.join(_small(found), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
