"""A Merkle manifest of a dataset: trees of fan-out 3 per group, and one over the groups' roots.

A group's leaves ascend by key, the groups by name (null first), all strings by their UTF-8 bytes.
Rows get their place by one range shuffle of (group, key, digests): texts don't move, and a group that
holds a third of all rows is dealt out like any other.  ``BLOCK`` consecutive leaves make one ordered
array, whose levels are collapsed inside one expression (sequence, transform, slice, aggregate); the
blocks' roots are the leaves of the next round, until a group is one block.  What a proof needs above
its block is found for blocks, not for leaves.

H is the lowercase hex sha256 of its inputs, concatenated.  While several nodes remain, every FAN
consecutive ones (of the last run fewer, even one) become their H; a lone leaf is its own root.

Defined cases: a group without a name (null) differs from an empty name; rows without a key come
first; rows that repeat a key are leaves of their own, ordered by digest; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from siftwell.llm.common import let, stored

FAN = 3
#: Leaves of a block: FAN ** DEPTH.
DEPTH = 6
BLOCK = FAN**DEPTH
#: Rows that may be broadcast: a piece's or block's address with its proof, some 2 KB.
BROADCAST = 20_000

_PATH = "array<struct<left:string,right:string>>"


def leaf(*fields: Column) -> Column:
    """H of the fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and value."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]), 256)


def _hash(nodes: Column) -> Column:
    return F.sha2(F.array_join(nodes, ""), 256)


def _levels(leaves: Column, depth: Column) -> Column:
    """The block's levels, leaves first: ``depth`` times every FAN nodes become one."""

    def collapse(level: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(level) - 1) / FAN).cast("int")), lambda i: _hash(F.slice(level, i * FAN + 1, FAN)))

    steps = F.slice(F.array(*[F.lit(k) for k in range(DEPTH)]), 1, depth)
    return F.aggregate(steps, F.array(leaves), lambda levels, _: F.concat(levels, F.array(let(F.element_at(levels, -1), collapse))))


def _siblings(levels: Column, i: Column) -> Column:
    """What stands left and right of leaf i's ancestors in their runs, level by level below the root."""

    def at(level: Column, k: Column) -> Column:
        def beside(p: Column) -> Column:
            place = (p % FAN).cast("int")
            return F.struct(F.array_join(F.slice(level, p - place + 1, place), "").alias("left"), F.array_join(F.slice(level, p + 2, FAN - 1 - place), "").alias("right"))

        return let(F.floor(i / F.pow(F.lit(float(FAN)), k)).cast("int"), beside)

    return F.transform(F.slice(levels, 1, F.size(levels) - 1), at)


def _ranked(nodes: DataFrame) -> DataFrame:
    """nodes(group, key, digest, ...) with their place in the group (rank, from 0) and its size (n).

    One range shuffle sorts all rows; a row's number within its partition, less that of its group's
    first row there and plus what earlier partitions hold of the group, is its rank.
    """
    nodes = nodes.repartitionByRange("group", "key", "digest").sortWithinPartitions("group", "key", "digest")
    nodes = stored(nodes.withColumn("at", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("at", 33).alias("part")
    pieces = nodes.groupBy("group", part).agg(F.min("at").alias("first"), F.count("*").alias("m"))
    group = Window.partitionBy("group")
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = stored(pieces.select("group", "part", (F.coalesce(F.sum("m").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("m").over(group).alias("n")), "pieces")
    small = F.broadcast(pieces) if pieces.count() <= BROADCAST else pieces
    return nodes.withColumn("part", part).join(small, ["group", "part"]).select(*[c for c in nodes.columns if c != "at"], (F.col("at") + F.col("shift")).alias("rank"), "n")


def _blocks(ranked: DataFrame, what: list[str]) -> DataFrame:
    """(group, block, n, nodes, levels): nodes in order, each with its rank, digest and ``what``."""
    depth = sum(F.when(F.col("n") > FAN**k, 1).otherwise(0) for k in range(DEPTH))
    made = ranked.groupBy("group", "n", F.floor(F.col("rank") / BLOCK).alias("block")).agg(F.sort_array(F.collect_list(F.struct("rank", "digest", *what))).alias("nodes"))
    return made.withColumn("levels", _levels(F.col("nodes.digest"), depth))


def _above(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The roots of the groups, and (group, block, path): what stands beside the ancestors of blocks."""
    roots = blocks.select("group", F.col("block").alias("rank"), F.ceil(F.col("n") / BLOCK).alias("n"), F.element_at(F.element_at("levels", -1), 1).alias("digest"))
    roots = stored(roots, "roots")
    if not roots.where("n > 1").isEmpty():
        up = stored(_blocks(roots, []), "blocks")
        tops, paths = _above(up)
        found = up.join(_few(paths), ["group", "block"]).select("group", "path", "levels", F.explode("nodes").alias("node"))
        own = _siblings(F.col("levels"), (F.col("node.rank") % BLOCK).cast("int"))
        return tops, stored(found.select("group", F.col("node.rank").alias("block"), F.concat(own, "path").alias("path")), "paths")
    return roots.select("group", "digest"), roots.select("group", F.col("rank").alias("block"), F.array().cast(_PATH).alias("path"))


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST else df


def fold(path: Column, node: Column) -> Column:
    """The root that ``node`` leads to."""
    return F.aggregate(path, node, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proofs(rows: DataFrame, group: str, key: str, digest: Column, claimed: Column | None = None) -> DataFrame:
    """(key, group, leaf, subroot, root, path, proof_sha256, folded_root, verified) of every row.

    ``digest`` is a row's leaf, ``claimed`` what is held against the manifest (by default the same);
    ``path`` are the siblings, level by level up to the root.  folded_root is what ``claimed`` leads to.
    """
    name = F.col(f"`{group}`").cast("string")
    named = F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("group")
    leaves = rows.select(named, F.col(f"`{key}`").alias("key"), digest.alias("digest"), (digest if claimed is None else claimed).alias("claimed"))
    blocks = stored(_blocks(_ranked(leaves), ["key", "claimed"]), "blocks")
    tops, paths = _above(blocks)

    # the groups' roots are the leaves of one more tree
    tops = stored(tops, "tops")
    ranked = _ranked(tops.select(F.lit("").alias("group"), F.col("group").alias("key"), "digest"))
    over = stored(_blocks(ranked, ["key"]), "blocks")
    root, rest = _above(over)
    over = over.join(_few(rest), ["group", "block"]).join(F.broadcast(root.select("group", F.col("digest").alias("root"))), "group")
    over = over.select("levels", "path", "root", F.explode("nodes").alias("node"))
    over = over.select(F.col("node.key").alias("group"), F.col("node.digest").alias("subroot"), "root", F.concat(_siblings(F.col("levels"), (F.col("node.rank") % BLOCK).cast("int")), "path").alias("over"))
    over = stored(over, "groups")

    heads = stored(paths.join(_few(over), "group").select("group", "block", "subroot", "root", F.concat("path", "over").alias("path")), "heads")
    found = blocks.join(_few(heads), ["group", "block"]).select("group", "subroot", "root", "path", "levels", F.explode("nodes").alias("node"))
    own = _siblings(F.col("levels"), (F.col("node.rank") % BLOCK).cast("int"))
    found = found.select("group", "subroot", "root", F.concat(own, "path").alias("path"), "node")
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), ""), 256)
    found = found.select(
        F.col("node.key").alias(key), F.when(F.col("group") != "", F.substring("group", 2, 1 << 30)).alias(group),
        F.col("node.digest").alias("leaf"), "subroot", "root", "path", proof.alias("proof_sha256"), fold(F.col("path"), F.col("node.claimed")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
