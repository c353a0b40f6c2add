"""Keep-first, upsert, merge, caps and other operators on rows, in DataFrame form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from siftwell.shared import written


def keep_first(df: DataFrame, keys: list[Column | str], order: list[Column | str]) -> DataFrame:
    """The first row of each key.  A struct minimum: combined before the shuffle, so a hot key is no
    hot task, as a window would make it."""
    named = df.select(F.struct(*order).alias("_o"), F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_r"), *[(F.col(k) if isinstance(k, str) else k).alias(f"_k{i}") for i, k in enumerate(keys)])
    best = named.groupBy(*[f"_k{i}" for i in range(len(keys))]).agg(F.min_by("_r", "_o").alias("_r"))
    return best.select("_r.*")


def upsert(old: DataFrame, new: DataFrame, key: str, order: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of ``new`` (the last by ``order`` for each key) replace those of ``old``; columns in
    ``keep`` stay as they were."""
    last = new.groupBy(key).agg(F.max_by(F.struct(*[c for c in new.columns if c != key]), order).alias("n"))
    both = old.alias("o").join(last.alias("l"), key, "full_outer")
    pick = lambda c: F.coalesce(F.col(f"o.{c}"), F.col(f"n.{c}")) if c in keep else F.when(F.col("n").isNotNull(), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
    return both.select(key, *[pick(c).alias(c) for c in old.columns if c != key])


def merge_new(known: DataFrame, new: DataFrame, key: str, order: list[Column | str]) -> DataFrame:
    """``known`` and what of ``new`` has a key that is nowhere yet; blank keys are left out."""
    fresh = keep_first(new.where(F.coalesce(F.col(key), F.lit("")) != ""), [key], order)
    return known.unionByName(fresh.join(known.select(key), key, "left_anti"))


def top_of_each(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """At most n rows of each key; Spark limits within groups before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


#: Rows of the table of pieces that may be broadcast.
PIECES = 20_000


def numbered(df: DataFrame, group: list[str], order: list[str], name: str = "nth") -> DataFrame:
    """Rows with their number (from 0) in their group, however large a group is.

    One range shuffle sorts all rows by group and order, so a group may lie in many partitions; a row's
    number is its place in its partition, less that of its group's first row there, plus what earlier
    partitions hold of the group.  Null groups are one; of rows that are equal any comes first.
    """
    cols = [F.col(f"`{c}`") for c in [*group, *order]]
    rows = df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn("_at", F.monotonically_increasing_id())
    rows = written(rows, "numbered").withColumn("_part", F.shiftright("_at", 33))
    keys = [F.col(f"`{c}`").alias(f"_g{k}") for k, c in enumerate(group)]
    named = [f"_g{k}" for k in range(len(group))]
    pieces = rows.groupBy(*keys, F.col("_part").alias("_p")).agg(F.min("_at").alias("_first"), F.count("*").alias("_m"))
    before = Window.partitionBy(*named).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    shifts = written(pieces.select(*named, "_p", (F.coalesce(F.sum("_m").over(before), F.lit(0)) - F.col("_first")).alias("_shift")), "pieces")
    few = F.broadcast(shifts) if shifts.count() <= PIECES else shifts
    same = F.col("_part") == F.col("_p")
    for c, g in zip(group, named):
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(g))
    return rows.join(few, same).select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_at") + F.col("_shift")).alias(name))


def yearly_indicators(history: DataFrame, key: str, year: str, value: str) -> DataFrame:
    """Latest value, growth over the year before (of those there are), compound growth over three
    years or more, for each key.  Zeros count as missing."""
    w = Window.partitionBy(key).orderBy(year)
    seen = history.where(F.col(value) != 0).withColumn("before", F.lag(value).over(w))
    one = seen.groupBy(key).agg(F.max_by(F.struct(F.col(year).alias("year"), F.col(value).alias("value"), "before"), year).alias("z"), F.min_by(F.struct(F.col(year).alias("year"), F.col(value).alias("value")), year).alias("a"), F.count("*").alias("n"))
    growth = F.round((F.col("z.value") - F.col("z.before")) / F.abs("z.before") * 100, 1)
    span = F.col("z.year") - F.col("a.year")
    compound = F.when((F.col("n") >= 3) & (F.col("a.value") > 0) & (span > 0), F.round((F.pow(F.col("z.value") / F.col("a.value"), 1 / span) - 1) * 100, 1))
    signal = F.when(growth > 15, "strong growth").when(growth > 5, "growth").when(growth > -5, "stable").when(growth.isNotNull(), "decline")
    return one.select(key, F.col("z.year").alias("year"), F.col("z.value").alias("value"), growth.alias("growth_pct"), compound.alias("cagr_pct"), signal.alias("signal"))


def pending(todo: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What of ``todo`` isn't done yet."""
    return todo.join(done.select(key).distinct(), key, "left_anti").select(*todo.columns)


def shares(df: DataFrame, group: str, item: str) -> DataFrame:
    """(group, item, n, pct): how often each item is in its group, and its share; halves round to even."""
    n = df.groupBy(group, item).agg(F.count("*").alias("n"))
    every = n.groupBy(group).agg(F.sum("n").alias("every"))
    return n.join(every, group).select(group, item, "n", F.bround(F.col("n") * 100 / F.col("every")).cast("int").alias("pct"))


def most_frequent(df: DataFrame, item: str) -> DataFrame:
    """(item, n): the most frequent item, the first of equals."""
    n = df.where(F.col(item).isNotNull()).groupBy(item).agg(F.count("*").alias("n"))
    return n.orderBy(F.desc("n"), F.asc(item)).limit(1)


def coverage(df: DataFrame, item: str) -> DataFrame:
    """(item, n) by falling numbers."""
    return df.groupBy(item).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(item))


def union_distinct(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """All rows, the first frame's before the next one's; of each key the first."""
    out = frames[0].withColumn("_frame", F.lit(0))
    for k, f in enumerate(frames[1:], 1):
        out = out.unionByName(f.withColumn("_frame", F.lit(k)))
    return keep_first(out, keys, ["_frame", *keys]).drop("_frame")


def outcomes(df: DataFrame, status: str) -> DataFrame:
    """One row: how many rows have each status, as a map, and how many there are."""
    n = df.groupBy(F.coalesce(F.col(status), F.lit("none")).alias("s")).agg(F.count("*").alias("n"))
    return n.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("s", "n")))).alias("of_status"), F.sum("n").alias("n"))
