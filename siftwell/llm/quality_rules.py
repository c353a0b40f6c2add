"""Quality rules by weak supervision, in DataFrame functions only.

Each rule votes good (1), bad (-1) or abstains (0) on a document; traits that come together (capitals
and exclamation marks) share a rule, and none repeats the base rules, so that rules may be taken as
independent within a kind.  How often documents show each pattern of votes is counted over the whole
corpus (at most 3 ** rules rows, whatever its size); expectation-maximisation on those counts
estimates, without labels, how each rule votes on good and on bad documents and how common good ones
are.  A rule is held to be no worse than chance: its bad votes are at least as likely on bad documents
and its good votes on good ones, which keeps the two kinds what they are called.  A document's posterior of being good, a sum of
log-likelihood ratios, replaces a filter that all rules must pass.

One narrow pass computes counts and votes, written small to the shared folder; one aggregation with
map-side combination counts patterns; a second narrow pass over the small table scores.  Nulls count
as empty texts; an empty text fails the base rules.  Rows that repeat are judged each time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from siftwell.llm.common import SPACE, let, stored, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: Words so common that running text of the language holds several of them.  Fixed values.
COMMON = ["the", "of", "and", "to", "in", "a", "is", "that", "de", "la", "le", "les", "et", "des", "en", "un", "une", "du", "der", "die", "und", "das", "den", "von", "zu", "mit", "el", "los", "las", "que", "y", "por", "para", "con"]
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÂÄÇÉÈÊËÎÏÔÖÙÛÜÑÍÓÚ"
#: Signs that stand by themselves in menus and tables.
SIGNS = ["|", "-", "–", "—", "•", "·", "*", "&", "/", "#", ">", "<", "+", "=", ":"]
RULES = ["vote_word_length", "vote_symbols", "vote_shouting", "vote_distinct", "vote_common_words", "vote_signs", "vote_lines"]


def repeat_words(w: Column) -> Column:
    """Words in windows of 8 words that the array holds twice or more, the first time included."""

    def covered(hashes: Column) -> Column:
        def spread(p: Column) -> Column:  # p: (hash, position), sorted, so equal hashes are neighbours
            last = F.size(p) - 1
            alike = lambda i, j: F.get(p, i)["h"] == F.get(p, j)["h"]
            at = F.filter(F.sequence(F.lit(0), last), lambda i: F.coalesce(alike(i, i - 1), F.lit(False)) | F.coalesce(alike(i, i + 1), F.lit(False)))
            at = F.array_sort(F.transform(at, lambda i: F.get(p, i)["i"]))
            start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
            return F.aggregate(at, start, lambda s, i: F.struct((s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n"), i.alias("last")), lambda s: s["n"])

        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(pairs, spread))

    hashes = F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
    return F.when(F.size(w) > WINDOW, let(hashes, covered)).otherwise(F.lit(0)).cast("long")


def base(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed) and votes."""
    t = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).withColumn("w", words(F.col("t")))
    size = lambda c: F.char_length(c).cast("long")
    without = lambda chars: size(F.translate("t", chars, ""))
    lines = F.filter(F.split("t", "\n"), lambda x: F.trim(x, F.lit(SPACE)) != "")
    t = t.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        without(SPACE).alias("word_chars"),
        (size(F.col("t")) - without(SYMBOLS)).alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).alias("all"), (F.size(x) - F.size(F.array_distinct(x))).alias("again"))).alias("lines"),
        repeat_words(F.col("w")).alias("n_repeat_words"),
        F.size(F.array_distinct("w")).alias("distinct"),
        F.size(F.array_intersect(F.transform("w", lambda x: F.lower(F.left(x, F.lit(8)))), F.array(*[F.lit(x) for x in COMMON]))).alias("common"),
        (size(F.col("t")) - without(CAPITALS)).alias("capitals"),
        (size(F.col("t")) - without("!?")).alias("marks"),
        F.size(F.filter("w", lambda x: x.isin(SIGNS))).alias("signs"),
    )
    n = F.greatest(F.col("n_words"), F.lit(1))
    ratio = lambda a, b: a / F.greatest(b, F.lit(1))

    def vote(bad: Column, good: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    length, symbols, again = F.col("word_chars") / n, F.col("n_symbols") / n, ratio(F.col("lines")["again"], F.col("lines")["all"])
    marks, capitals, distinct, signs = F.col("marks") / n, ratio(F.col("capitals"), F.col("word_chars")), F.col("distinct") / n, F.col("signs") / n
    return t.select(
        "doc_id", "n_words", "word_chars", "n_symbols",
        F.col("lines")["again"].cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        ((F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).alias("base_failed"),
        vote((length < 3.5) | (length > 9), length.between(4.2, 6.8)).alias("vote_word_length"),
        vote(symbols > 0.1, symbols < 0.02).alias("vote_symbols"),
        vote((marks > 0.1) | (capitals > 0.2), (marks < 0.02) & (capitals < 0.06)).alias("vote_shouting"),
        vote((distinct < 0.35) & (F.col("n_words") < 3000), distinct > 0.5).alias("vote_distinct"),
        vote(F.col("common") < 2, F.col("common") >= 5).alias("vote_common_words"),
        vote(signs > 0.05, signs < 0.01).alias("vote_signs"),
        vote(again > 0.2, again == 0).alias("vote_lines"),
    )


def fit(patterns: list[tuple[tuple[int, ...], int]], rules: int, rounds: int = 200) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """Expectation-maximisation on (votes, documents): the share of good documents, and for every
    rule and vote its probability on (good, bad) documents.  Starts from the balance of votes, so
    that good is what most rules call good; counts are smoothed by one document."""
    total = sum(n for _, n in patterns)
    share = [1 / (1 + math.exp(-sum(v))) for v, _ in patterns]
    prior, table = 0.5, [{v: (1 / 3, 1 / 3) for v in (-1, 0, 1)} for _ in range(rules)]
    for _ in range(rounds):
        good = sum(p * n for p, (_, n) in zip(share, patterns))
        new = (good + 1) / (total + 2)
        table = []
        for r in range(rules):
            row = {}
            for v in (-1, 0, 1):
                a = sum(p * n for p, (x, n) in zip(share, patterns) if x[r] == v)
                b = sum((1 - p) * n for p, (x, n) in zip(share, patterns) if x[r] == v)
                of_good, of_bad = (a + 1) / (good + 3), (b + 1) / (total - good + 3)
                if v * (of_good - of_bad) < 0:  # no worse than chance
                    of_good = of_bad = (a + b + 2) / (total + 6)
                row[v] = (of_good, of_bad)
            table.append(row)
        done, prior = abs(new - prior) < 1e-9, new
        share = []
        for x, _ in patterns:
            odds = math.log(prior / (1 - prior)) + sum(math.log(table[r][v][0] / table[r][v][1]) for r, v in enumerate(x))
            share.append(1 / (1 + math.exp(-max(-60.0, min(60.0, odds)))))
        if done:
            break
    return prior, table


def judge(docs: DataFrame, limit: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base counts, base_failed, kept, posterior)."""
    known = stored(base(docs, id_col, text_col), "votes")
    counted = known.groupBy(*RULES).agg(F.count("*").alias("n")).collect()  # at most 3 ** 7 rows
    patterns = sorted((tuple(r[x] for x in RULES), r.n) for r in counted)
    prior, table = fit(patterns, len(RULES))
    odds = F.lit(math.log(prior / (1 - prior)))
    for name, row in zip(RULES, table):
        gain = {v: math.log(a / b) for v, (a, b) in row.items()}
        odds = odds + F.when(F.col(name) == 1, gain[1]).when(F.col(name) == -1, gain[-1]).otherwise(gain[0])
    posterior = 1 / (1 + F.exp(-odds))
    return known.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (posterior >= limit)).alias("kept"), posterior.alias("posterior"))
