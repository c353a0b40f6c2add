"""Versions of a slowly changing dimension from a log of changes, in window SQL.

``row_number`` drops what is superseded, a running count of the changes that start anew (D, I) makes
epochs, ``last`` without nulls fills what an update leaves open, ``lag`` flags changes of the state, a
running sum numbers the versions and ``lead`` closes them.

An entity with more changes than a fair share of one shuffle partition would fill a task with its
windows.  Such entities (their number is bounded by that of the shuffle partitions) are cut along time
at approximate quantiles, and all windows run within (entity, piece).  What crosses the cuts is carried
by a table with one row for each piece of such an entity: first the state that a piece ends with, then
how many versions it starts and when its first one does.  That table has at most some 2 * ``FINE`` rows for each shuffle
partition, whatever the input, and is broadcast.

Defined cases: rows without a time are ignored; rows without an entity are one entity, null; null
sequence numbers are equal to each other and come after all others; of rows that are equal in entity,
sequence and change id the one that is later, then largest, stays; a change with an operation other
than D, I and U takes part in that, counts as a change and sets nothing; a null change id isn't counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from siftwell.llm.common import let, stored

#: Pieces that a fair share of one partition is cut into, and the quantiles known of an entity.
FINE, GRID, ACCURACY = 8, 1000, 20_000
_COARSE = 32


def micros(df: DataFrame, name: str) -> Column:
    """Microseconds since 1970 of a time; one without a zone is UTC, whatever the session's zone."""
    c = F.col(f"`{name}`")
    if df.schema[name].dataType.typeName() != "timestamp_ntz":
        return F.unix_micros(c.cast("timestamp"))
    day = F.unix_date(c.cast("date")).cast("long")
    return ((day * 24 + F.hour(c)) * 60 + F.minute(c)) * 60_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")


def _cuts(rows: DataFrame, partitions: int) -> DataFrame:
    """(e, cuts) of the entities with more rows than a fair share: the times that their pieces begin at."""
    fair = max(1, rows.count() // partitions)
    large = F.broadcast(rows.groupBy("e").agg(F.count("*").alias("n")).where(F.col("n") > fair).withColumnRenamed("e", "large"))  # fewer than partitions
    grid = [k / GRID for k in range(1, GRID)]
    found = rows.select("e", "t").join(large, F.col("e").eqNullSafe(F.col("large"))).groupBy("e").agg(F.max("n").alias("n"), F.percentile_approx("t", grid, ACCURACY).alias("cuts"))
    step = F.greatest(F.lit(1), F.floor(F.lit(GRID * fair / FINE) / F.col("n")))
    return found.select("e", F.array_distinct(F.filter("cuts", lambda _, i: (i + 1) % step == 0)).alias("cuts"))


def _piece(cuts: Column, t: Column) -> Column:
    """How many of the ascending cuts are at or before t, looked up in two steps."""

    def upto(values: Column) -> Column:
        return F.size(F.filter(values, lambda c: c <= t))

    coarse = upto(F.filter(cuts, lambda _, i: i % _COARSE == 0))
    return let(coarse, lambda k: F.when(k == 0, 0).otherwise((k - 1) * _COARSE + upto(F.slice(cuts, F.greatest(k - 1, F.lit(0)) * _COARSE + 1, _COARSE))))


def _along(*part: str):
    return Window.partitionBy("e", "piece", *part).orderBy("t", F.desc("kept"))


def _so_far(*part: str):
    return _along(*part).rowsBetween(Window.unboundedPreceding, 0)


def _pieces():
    return Window.partitionBy("e").orderBy("piece")


def _with(rows: DataFrame, carry: DataFrame | None, columns: list[str], types: dict[str, str]) -> DataFrame:
    """The rows with what is carried into their piece; nothing is, into the only one of an entity."""
    if carry is None:
        return rows.select("*", *[F.lit(None).cast(types[c]).alias(c) for c in columns])
    carry = F.broadcast(carry.select(F.col("e").alias("_e"), F.col("piece").alias("_piece"), *columns))
    return rows.join(carry, F.col("e").eqNullSafe(F.col("_e")) & (F.col("piece") == F.col("_piece")), "left").drop("_e", "_piece")


def _filled(rows: DataFrame, fields: list[str]) -> DataFrame:
    """Every row with the state that its piece's rows up to it give: ``epoch``, ``gone``, the fields."""
    kept, op = F.col("kept"), F.col("o")
    rows = rows.withColumn("epoch", F.sum(F.when(kept & op.isin("D", "I"), 1).otherwise(0)).over(_so_far()))
    return rows.select(
        "e", "piece", "t", "kept", "c", "s", "epoch",
        F.last(F.when(kept, op == "D"), ignorenulls=True).over(_so_far()).alias("gone"),
        *[F.last(F.when(kept & (op != "D"), F.col(f)), ignorenulls=True).over(_so_far("epoch")).alias(f) for f in fields],
    )


def _carried_state(filled: DataFrame, fields: list[str]) -> DataFrame:
    """(e, piece, in_gone, in_<field>): the state before each piece's first row."""
    ends = filled.withColumn("more", F.lead(F.lit(True)).over(_along())).where("more is null")
    ends = ends.withColumn("run", F.sum(F.when(F.col("epoch") > 0, 1).otherwise(0)).over(_pieces()))
    run = Window.partitionBy("e", "run").orderBy("piece").rowsBetween(Window.unboundedPreceding, 0)
    ends = ends.select("e", "piece", F.last("gone", ignorenulls=True).over(_pieces().rowsBetween(Window.unboundedPreceding, 0)).alias("gone"), *[F.last(f, ignorenulls=True).over(run).alias(f) for f in fields])
    return ends.select("e", "piece", *[F.lag(x).over(_pieces()).alias(f"in_{x}") for x in ["gone", *fields]])


def _flagged(filled: DataFrame, fields: list[str], carry: DataFrame | None) -> DataFrame:
    """(e, piece, t, kept, c, s, state, changed, nth): versions are numbered within their piece."""
    rows = _with(filled, carry, [f"in_{x}" for x in ["gone", *fields]], {f"in_{f.name}": f.dataType.simpleString() for f in filled.schema})
    values = [F.coalesce(F.col(f), F.when(F.col("epoch") == 0, F.col(f"in_{f}"))).alias(f) for f in fields]
    before = F.when(F.col("in_gone").isNotNull(), F.struct(F.col("in_gone").alias("gone"), *[F.col(f"in_{f}").alias(f) for f in fields]))
    gone = F.coalesce("gone", "in_gone")
    rows = rows.select("e", "piece", "t", "kept", "c", "s", F.when(gone.isNotNull(), F.struct(gone.alias("gone"), *values)).alias("state"), before.alias("before"))
    rows = rows.withColumn("changed", F.col("kept") & ~F.col("state").eqNullSafe(F.coalesce(F.lag("state").over(_along()), "before"))).drop("before")
    return rows.withColumn("nth", F.sum(F.col("changed").cast("long")).over(_so_far()))


def _carried_numbers(flagged: DataFrame) -> DataFrame:
    """(e, piece, in_nth, in_next): versions that begin before the piece, and when the next one after it does."""
    ends = flagged.groupBy("e", "piece").agg(F.max("nth").alias("n"), F.min(F.when(F.col("changed"), F.col("t"))).alias("first"))
    return ends.select("e", "piece", F.sum("n").over(_pieces().rowsBetween(Window.unboundedPreceding, -1)).alias("in_nth"), F.first("first", ignorenulls=True).over(_pieces().rowsBetween(1, Window.unboundedFollowing)).alias("in_next"))


def versions(changes: DataFrame, entity: str, change: str, seq: str, op: str, at: Column, attributes: dict[str, Column]) -> DataFrame:
    """(entity, version, valid_from, valid_to, is_deleted, the attributes, first_<seq>, n_changes).

    ``at`` is the time in microseconds since 1970; valid_from and valid_to are whole seconds.
    """
    spark = changes.sparkSession
    fields = [f"f{k}" for k in range(len(attributes))]
    rows = changes.select(
        F.col(f"`{entity}`").alias("e"), F.col(f"`{change}`").alias("c"), F.col(f"`{seq}`").alias("s"), F.col(f"`{op}`").alias("o"), at.alias("t"),
        *[value.alias(f) for f, value in zip(fields, attributes.values())],
    ).where("t is not null")
    cuts = stored(_cuts(rows, int(spark.conf.get("spark.sql.shuffle.partitions"))), "cuts")
    cut = not cuts.isEmpty()

    newest = Window.partitionBy("e", "s").orderBy(F.desc("c"), F.desc("t"), *[F.desc(x) for x in ["o", *fields]])
    rows = rows.withColumn("kept", F.row_number().over(newest) == 1)
    if cut:
        known = F.broadcast(cuts.withColumnRenamed("e", "_e"))
        rows = rows.join(known, F.col("e").eqNullSafe(F.col("_e")), "left").withColumn("piece", F.when(F.col("cuts").isNull(), 0).otherwise(_piece(F.col("cuts"), F.col("t")))).drop("_e", "cuts")
    else:
        rows = rows.withColumn("piece", F.lit(0))
    instant = Window.partitionBy("e", "piece", "t").orderBy(F.desc("kept"), F.desc("s"), F.desc("c"))
    rows = rows.repartition("e", "piece").withColumn("kept", F.col("kept") & (F.row_number().over(instant) == 1) & F.coalesce(F.col("o").isin("D", "I", "U"), F.lit(False)))

    carry = numbers = None
    if cut:
        rows = stored(rows, "changes")
        of_cut = rows.join(F.broadcast(cuts.select(F.col("e").alias("_e"))), F.col("e").eqNullSafe(F.col("_e")), "left_semi").repartition("e", "piece")
        filled = _filled(of_cut, fields)
        carry = stored(_carried_state(filled, fields), "states")
        numbers = stored(_carried_numbers(_flagged(filled, fields, carry)), "numbers")
        rows = rows.repartition("e", "piece")

    rows = _flagged(_filled(rows, fields), fields, carry)
    rows = _with(rows, numbers, ["in_nth", "in_next"], {"in_nth": "long", "in_next": "long"})
    following = F.lead("t").over(Window.partitionBy("e", "piece", "changed").orderBy("t"))
    rows = rows.select(
        "e", (F.col("nth") + F.coalesce("in_nth", F.lit(0))).alias("version"), "c",
        F.when(F.col("changed"), F.struct("t", F.coalesce(following, "in_next").alias("until"), "state", "s")).alias("start"),
    ).where("version > 0")
    found = rows.groupBy("e", "version").agg(F.max("start").alias("start"), F.count_distinct("c").alias("n_changes"))

    def seconds(us: Column) -> Column:
        return F.floor(us / 1_000_000).cast("long")

    return found.select(
        F.col("e").alias(entity), F.col("version").cast("int"), seconds(F.col("start.t")).alias("valid_from"), seconds(F.col("start.until")).alias("valid_to"),
        F.col("start.state.gone").alias("is_deleted"), *[F.col(f"start.state.{f}").alias(name) for f, name in zip(fields, attributes)], F.col("start.s").alias(f"first_{seq}"), "n_changes",
    )
