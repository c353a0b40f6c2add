"""Names that share enough words: an exact set-similarity join in which common words don't meet alone.

Two names are alike if one's words are all among the other's, or if they share at least ``LEAST`` of all
their words.  Words are ordered rarest first.  For sizes a and b the rule asks for some number o of shared
words, and then the rarest shared one is among the first a - o + 1 of the one and the first b - o + 1 of
the other; only those are sent, under a key of the word and both sizes.  So a word that half of all
names have brings together only names that have little else, and those are few once equal names are one.
A pair is told where its rarest shared word meets, so no pair comes twice.

Sizes are dealt into classes, within which the smallest size tells how many words are sent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Share of both names' words that must be the same, where neither holds the other.
LEAST = 2 / 3
#: The smallest sizes of the classes.
SIZES = [1, 2, 3, 4, 5, 6, 7, 9, 13, 21, 41]
#: Words that are told apart by how common they are; all others come first.
COMMON = 5000


def _needed(a: Column, b: Column) -> Column:
    """Shared words that sets of a and b words need."""
    return F.least(a, b, F.ceil(F.lit(LEAST / (1 + LEAST)) * (a + b) - 1e-9)).cast("int")


def _class(size: Column) -> Column:
    return sum((F.when(size >= s, 1).otherwise(0) for s in SIZES[1:]), F.lit(0))


def _sets(names: DataFrame) -> DataFrame:
    """names(id, words) -> (id, s): the distinct words in one order; none of a name without words."""
    s = F.array_sort(F.array_distinct(F.filter("words", lambda w: w.isNotNull() & (w != ""))))
    return names.select("id", s.alias("s")).where(F.size("s") > 0)


def _rarest_first(sets: DataFrame, common: DataFrame) -> DataFrame:
    """sets(s) -> (s, words, n)."""
    known = sets.select("s", F.explode("s").alias("word")).join(F.broadcast(common), "word", "left")
    order = F.sort_array(F.collect_list(F.struct(F.coalesce("count", F.lit(0)).alias("k"), "word")))
    return known.groupBy("s").agg(F.transform(order, lambda x: x["word"]).alias("words")).withColumn("n", F.size("words"))


def _sent(sets: DataFrame, is_left: bool) -> DataFrame:
    """(key, word, words, s, n) of what a side sends for the sizes that the other side may have."""
    own = _class(F.col("n"))

    def towards(k: int, size: int) -> Column:
        first = F.slice("words", 1, F.col("n") - _needed(F.col("n"), F.lit(size)) + 1)
        classes = [own, F.lit(k)] if is_left else [F.lit(k), own]
        return F.transform(first, lambda w: F.struct(w.alias("word"), F.xxhash64(w, *classes).alias("key")))

    return sets.select("words", "s", "n", F.explode(F.concat(*[towards(k, size) for k, size in enumerate(SIZES)])).alias("x")).select("x.key", "x.word", "words", "s", "n")


def met(left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, b, words_a, words_b, word, n_a, n_b) of the sets that meet, before they are compared."""
    words = left.select(F.explode("s").alias("word")).unionAll(right.select(F.explode("s").alias("word")))
    common = words.groupBy("word").count().orderBy(F.desc("count"), "word").limit(COMMON)
    a = _sent(_rarest_first(left, common), True).select("key", "word", F.col("words").alias("words_a"), F.col("s").alias("a"), F.col("n").alias("n_a"))
    b = _sent(_rarest_first(right, common), False).select("key", "word", F.col("words").alias("words_b"), F.col("s").alias("b"), F.col("n").alias("n_b"))
    return a.join(b, ["key", "word"])


def pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """left(id, words), right(id, words) -> (left_id, right_id) of names that are alike.  An id may have
    several names; a pair of ids comes once."""
    of_left, of_right = _sets(left), _sets(right)
    together = met(of_left.select("s").distinct(), of_right.select("s").distinct()).withColumn("shared", F.array_intersect("words_a", "words_b"))
    alike = together.where((F.get("shared", F.lit(0)) == F.col("word")) & (F.size("shared") >= _needed(F.col("n_a"), F.col("n_b")))).select("a", "b")
    of_left, of_right = of_left.select(F.col("id").alias("left_id"), F.col("s").alias("a")), of_right.select(F.col("id").alias("right_id"), F.col("s").alias("b"))
    return alike.join(of_left, "a").join(of_right, "b").select("left_id", "right_id").distinct()
