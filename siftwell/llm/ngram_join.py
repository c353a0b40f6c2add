"""Jaccard self-join of documents on word n-grams, with R-trees over count vectors.

A document's set holds the 64-bit hashes of its distinct 4-word shingles.  Two documents link when
100 * |A n B| >= 85 * |A u B|; the operator returns the components of that graph.

1. *Classes.*  Documents with equal sets are one class, named by 64 bits of the set's digest.  From
   here on only classes count, so copies cost nothing.
2. *Routing.*  The tokens of a set are hashed into g groups.  Sets that link differ in at most k
   tokens, k following from their size class; with g > k at least g - k groups are alike.  Each
   group that has tokens gives a key (a hash of its tokens); linked sets share a key.  A set
   with so many empty groups that the shared one might be empty is hashed again with another seed,
   and at last routed by its smallest tokens (prefix filter).  Nothing linked is missed.
3. *R-trees.*  A point holds the counts of a set's tokens in 128 hash groups; two sets share at most
   the sum of their coordinate minima, and pairs of nodes for which that falls short of what a link
   needs are left out.  First each class is put beside the smallest class of the bucket it shares
   most often with one (its hub), in blocks of bounded size; the pairs that the block's tree leaves,
   most room first, are verified on the sets unless they are tied already.  Buckets that then still
   hold several components are searched by trees over their points: of the pairs that survive, spanning
   forests are verified, in rounds (with more forests each time) until no tree has an untold pair.
   Pairs that could only tie what is tied are not made.  Large buckets are dealt out as tiles of
   bounded size; two parts of one component never meet in one.

Every link comes from a tree's pair.  One R-tree over the whole corpus would need every task to see every
other one's nodes, and in that many dimensions prunes little; so keys route points to small trees,
and exactness is kept.

Everything but shingling, buckets, trees and verification is DataFrame code; what Python gets is
streamed in the order of its groups.  Intermediate tables are written to the shared folder, so lost
executors cost little, and deleted when nothing reads them any more.  Defined cases: null or empty
texts have an empty set (n_shingles 0) and link with nothing; rows that repeat a doc_id are one
document for reachability and each keep their row; a row without a doc_id takes the component of its
class, null if that has no ids, and ties nothing; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from siftwell.llm.common import drop_stored, small_batches, stored, unload

NUM, DEN = 85, 100
GRAM = 4
#: Dimensions of the count vectors, points in a leaf, members in a block or tile's side.
DIMS, LEAF, TILE = 128, 16, 512
FULL = 255
#: Rows of three longs that may be broadcast: some 100 MB as a hash table.
BROADCAST = 2_000_000
SMALLEST, SEEDS = 6, 6  # smaller sets link only when equal
#: Bytes of text that are hashed at once.
BLOCK = 1 << 20
#: Edges that one task ties at once.
FOREST = 100_000
#: Spanning forests that a tile tells in the first round, and how many times as many in each next one.
FORESTS, MORE = 16, 16
#: Rows that a task gathers before it gives them back.
ROWS = 8192
#: Parts that the rows of one class are dealt into when they get their component.
SALTS = 64

_M1, _M2, _M3 = (np.uint64(x) for x in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x9E3779B97F4A7C15))
_33, _32 = np.uint64(33), np.uint64(32)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _33)) * _M1
    x = (x ^ (x >> _33)) * _M2
    return x ^ (x >> _33)


_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256))
#: A number for each byte, the same for A and a; and odd powers, by which places in a word differ.
_BYTE = mix((_LOWER + 1).astype(np.uint64) * _M3)
_POWER = np.cumprod(np.full(64, 0x5851F42D4C957F2D, np.uint64))


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word data[start:end], A-Z as a-z: the sum of its bytes' numbers by powers."""
    global _POWER
    size, out = end - start, np.zeros(len(start), np.uint64)
    if len(size) and size.max() > len(_POWER):
        _POWER = np.cumprod(np.full(int(size.max()), _POWER[0], np.uint64))
    at = 0
    while at < len(start):
        upto = max(at + 1, int(np.searchsorted(np.cumsum(size[at : at + BLOCK]), BLOCK)) + at)
        n = size[at:upto]
        first = np.cumsum(n) - n
        place = np.arange(first[-1] + n[-1]) - np.repeat(first, n)
        out[at:upto] = np.add.reduceat(_BYTE[data[np.repeat(start[at:upto], n) + place]] * _POWER[place], first)
        at = upto
    return mix(out)


class Shingler:
    """texts -> the sorted distinct shingle hashes of each."""

    def __init__(self, gram: int = GRAM):
        self.gram = gram

    def __call__(self, text: str | None) -> np.ndarray:
        return self.sets(pa.array([text], pa.string()))[0]

    def sets(self, texts: pa.Array) -> list[np.ndarray]:
        texts = texts.cast(pa.large_string())
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
        at = at - at[0]
        if not len(data):
            return [np.zeros(0, np.uint64)] * len(texts)
        word = ~_SPACE[data]
        before, after = np.r_[False, word[:-1]], np.r_[word[1:], False]
        edges = at[(at > 0) & (at < len(data))]  # words end where texts do
        before[edges], after[edges - 1] = False, False
        start, end = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
        h, first = _word_hashes(data, start, end), np.searchsorted(start, at)
        out = []
        for low, high in zip(first[:-1].tolist(), first[1:].tolist()):
            n = min(self.gram, high - low)
            shingles = np.full(max(0, high - low - n + 1) if n else 0, n, np.uint64)
            for i in range(n):
                shingles = mix(shingles * _M3 + h[low + i : high - n + 1 + i])
            out.append(np.unique(shingles))
        return out


def class_of(tokens: np.ndarray) -> int | None:
    """The name of the class of all documents with this set; none of an empty one."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "big", signed=True) if len(tokens) else None


def size_classes(upto: int = 1 << 40) -> list[tuple[int, int]]:
    out, low = [], SMALLEST
    while low <= upto:
        out.append((low, low * 16 // 10))
        low = out[-1][1] + 1
    return out


CLASSES = size_classes()


def families(n: int) -> list[tuple[int, int, int]]:
    """(family, most tokens that differ, groups) of a set of n tokens: of its own size class, and of
    the next one if a set there could link with it."""
    if n < SMALLEST:
        return []
    c = next(i for i, (_, high) in enumerate(CLASSES) if n <= high)
    out = []
    for f in (c, c + 1):
        if f == c or n * DEN // NUM >= CLASSES[f][0]:
            k = (DEN - NUM) * 2 * CLASSES[f][1] // (DEN + NUM)
            out.append((f, k, k + 1 + k // 16))
    return out


def keys(tokens: np.ndarray) -> np.ndarray:
    """The routing keys of a set."""
    out = []
    n = len(tokens)
    for family, k, g in families(n):
        for seed in range(SEEDS):
            salt = np.uint64(family * 64 + seed + 1)
            spread = mix(tokens + np.uint64(int(salt) * int(_M3) & (1 << 64) - 1))
            group = ((spread >> _32) * np.uint64(g) >> _32).astype(np.int64)
            order = np.argsort(group)
            group = group[order]
            first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            total, full = np.add.reduceat(mix(spread + _M1)[order], first), group[first]
            out.append(mix(total + mix((full.astype(np.uint64) << _32) + salt)))
            if len(full) > k:  # of the groups alike, at least g - k, one has tokens
                break
        else:
            prefix = np.sort(mix(tokens))[: n - (n * NUM + DEN - 1) // DEN + 1]
            out.append(mix(prefix + np.uint64(family * int(_M2) & (1 << 64) - 1)))
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def counts(tokens: np.ndarray) -> np.ndarray:
    return np.bincount((mix(tokens + _M2) >> np.uint64(40)).astype(np.int64) % DIMS, minlength=DIMS)


def needed(a: int | np.ndarray, b: int | np.ndarray):
    """Least overlap with which sets of a and b tokens link."""
    return -(-NUM * (a + b) // (NUM + DEN))


def links(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and DEN * both >= NUM * (len(a) + len(b) - both)


class RTree:
    """Points packed by halving the widest coordinate; a node keeps its points' largest counts and
    smallest size, and their component if they have one in common.  Searched for all pairs of points of
    different components whose coordinate minima allow a link."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, component: np.ndarray | None = None):
        self.points, self.sizes = points, sizes
        self.component = np.arange(len(sizes)) if component is None else component
        self.nodes: list[tuple] = []
        self.root = self._pack(np.arange(len(sizes))) if len(sizes) else -1

    def _pack(self, at: np.ndarray) -> int:
        top, least, most = self.points[at].max(0), int(self.sizes[at].min()), int(self.sizes[at].max())
        own = self.component[at]
        one = int(own[0]) if (own == own[0]).all() else None
        below = rows = None
        if len(at) <= LEAF:
            rows = at
        else:
            values = np.column_stack([self.points[at], self.sizes[at]])
            order = at[np.argsort(values[:, np.ptp(values, 0).argmax()], kind="stable")]
            half = len(at) // 2
            below = (self._pack(order[:half]), self._pack(order[half:]))
        self.nodes.append((top, least, most, below, rows, one))
        return len(self.nodes) - 1

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(i, j, the room that the bound leaves) of the pairs."""
        stack = [(self.root, self.root)] if self.root >= 0 else []
        while stack:
            x, y = stack.pop()
            (tx, lx, mx, bx, rx, cx), (ty, ly, my, by, ry, cy) = self.nodes[x], self.nodes[y]
            if cx is not None and cx == cy:
                continue
            if x != y and (np.minimum(tx, ty).sum() < needed(lx, ly) or mx * DEN < ly * NUM or my * DEN < lx * NUM):
                continue
            if rx is not None and ry is not None:
                bound = np.minimum(self.points[rx][:, None, :], self.points[ry][None, :, :]).sum(2)
                room = bound - needed(self.sizes[rx][:, None], self.sizes[ry][None, :])
                ok = (room >= 0) & (self.component[rx][:, None] != self.component[ry][None, :])
                if x == y:
                    ok &= np.arange(len(rx))[:, None] < np.arange(len(ry))[None, :]
                i, j = np.nonzero(ok)
                yield rx[i], ry[j], room[i, j]
            elif x == y:
                stack += [(bx[0], bx[0]), (bx[1], bx[1]), (bx[0], bx[1])]
            elif rx is None and (ry is not None or mx >= my):
                stack += [(bx[0], y), (bx[1], y)]
            else:
                stack += [(x, by[0]), (x, by[1])]

    def by_room(self) -> np.ndarray:
        """All pairs, most room first."""
        found = [np.stack(x) for x in self.pairs()]
        found = np.concatenate(found, 1) if found else np.zeros((3, 0), np.int64)
        return found[:2, np.argsort(-found[2], kind="stable")].T


class Ties:
    """Which things are tied together."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    def tie(self, a: int, b: int) -> bool:
        """Tie both; were they apart?"""
        a, b = self.root(a), self.root(b)
        self.up[a] = b
        return a != b


def _tied(edges: DataFrame, parts: int) -> DataFrame:
    """edges(u, v) -> (u, v): what each FOREST edges of a task tie, as u with the smallest v of its kind."""

    def tied(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        ties, least = Ties(), {}
        for batch in rows:
            for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ties.tie(u, v)
        nodes = list(ties.up)
        for x in nodes:
            r = ties.root(x)
            least[r] = min(x, least.get(r, x))
        found = np.array([(x, m) for x in nodes if (m := least[ties.root(x)]) != x], np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["u", "v"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in small_batches(batches, FOREST):
            if rows and size + batch.num_rows > FOREST:
                yield tied(rows)
                rows, size = [], 0
            rows.append(batch)
            size += batch.num_rows
        if rows:
            yield tied(rows)

    return edges.coalesce(parts).mapInArrow(run, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes that have edges (a, b): the smallest node reachable.

    Tasks first tie the edges they have, FOREST at a time, which leaves a star for each part of what they
    hold; so few edges are done at once.  Then alternating stars: every node's larger neighbours, then its smaller ones, are tied to the
    smallest one known, until nothing changes; the number of rounds is logarithmic.  Smallest
    neighbours are pre-aggregated, so a node with very many edges is no hot group there; edges are
    then joined with them, which Spark splits where a key is skewed.
    """

    def star(e: DataFrame, larger: bool) -> DataFrame:
        """e(u, v): u's neighbours v."""
        least = e.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = e.join(least, "u")
        if larger:
            return e.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        return e.select(F.col("v").alias("u"), F.col("m").alias("v")).union(e.select("u", F.col("m").alias("v"))).where("u > v").distinct()

    now = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v"), "edges")
    n = now.count()
    now = stored(_tied(now, max(1, -(-n // FOREST))), "stars")
    before = None
    while n > FOREST:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        now = stored(star(star(both, True), False), "stars")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _profiles(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, n_shingles, class)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unload()
        shingle = Shingler()
        for batch in small_batches(batches):
            sets = shingle.sets(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([class_of(s) for s in sets], pa.int64())], ["doc_id", "n_shingles", "class"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, class long")


def _routes(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> (key, class); equal sets of one batch are routed once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unload()
        shingle = Shingler()
        for batch in small_batches(batches):
            found = {class_of(s): s for s in shingle.sets(batch.column(1)) if len(s) >= SMALLEST}
            made = [keys(s) for s in found.values()]
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(made)), pa.array(np.repeat(np.array([*found], np.int64), [*map(len, made)]))], ["key", "class"])

    return docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(run, "key long, class long")


def _met(routes: DataFrame) -> DataFrame:
    """(key, class, hub) of the buckets with several classes; the hub is the smallest.  The rows of a
    partition come sorted, so only the first class of the last bucket is held from one batch to the next."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.zeros((0, 2), np.int64)  # the row before, if any
        hub, told = 0, True  # its bucket's first class; was that given?
        for batch in batches:
            rows = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], 1)
            if len(rows):
                both = np.concatenate([last, rows])
                new = np.r_[len(last) == 0, (both[1:] != both[:-1]).any(1)][len(last) :]
                rows = rows[new]
            if not len(rows):
                continue
            key, name = rows.T
            begins = np.r_[not len(last) or key[0] != last[0, 0], key[1:] != key[:-1]]
            first = np.maximum.accumulate(np.where(begins, np.arange(len(key)), -1))
            hubs = np.where(first >= 0, name[first], hub)
            more = ~begins  # a class beside the hub
            out = [np.stack([key[more], name[more], hubs[more]], 1)]
            own = np.unique(first[more & (first >= 0)])  # hubs of this batch that aren't alone
            out.append(np.stack([key[own], name[own], name[own]], 1))
            if more[0] and not told:
                out.append(np.array([[key[0], hub, hub]]))
                told = True
            if first[-1] >= 0:
                hub, told = int(hubs[-1]), bool(more[-1])
            last = rows[-1:]
            out = np.concatenate(out)
            yield pa.RecordBatch.from_arrays([pa.array(out[:, k]) for k in range(3)], ["key", "class", "hub"])

    return routes.repartition("key").sortWithinPartitions("key", "class").mapInArrow(run, "key long, class long, hub long")


def _sets(docs: DataFrame) -> DataFrame:
    """docs(text, class, hub, blocks, own) -> the sets that are of the class."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unload()
        shingle = Shingler()
        for batch in small_batches(batches, 256):
            found = shingle.sets(batch.column(0))
            right = [class_of(s) == c for s, c in zip(found, batch.column(1).to_pylist())]  # a doc_id may repeat with another text
            sets, batch = [s for s, ok in zip(found, right) if ok], batch.filter(pa.array(right, pa.bool_()))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array([len(s) for s in sets], pa.int64()), pa.array([np.minimum(counts(s), FULL).astype(np.uint8).tobytes() for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], ["class", "hub", "blocks", "own", "size", "point", "tokens"])

    return docs.select("text", "class", "hub", "blocks", "own").mapInArrow(run, "class long, hub long, blocks long, own long, size long, point binary, tokens binary")


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of sorted batches, group by group; the first column tells groups apart."""
    rows = (row for batch in small_batches(batches, 1024) for row in zip(*(c.to_pylist() for c in batch.columns)))
    for _, group in groupby(rows, key=lambda row: row[0]):
        yield list(group)


def _edges(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    a = np.array(rows, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["a", "b"])


def _hub_links(sets: DataFrame) -> DataFrame:
    """(a, b): links that tie together what links within each hub's blocks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: list[tuple[int, int]] = []
        for rows in _groups(batches):
            known = {name: np.frombuffer(tokens, np.uint64) for _, name, tokens in rows}
            names, own = [*known], [*known.values()]
            ties, found = Ties(), []
            for i, j in RTree(np.array([counts(s) for s in own]), np.array([*map(len, own)])).by_room().tolist():
                if ties.root(i) != ties.root(j) and links(own[i], own[j]):
                    ties.tie(i, j)
                    found.append((names[i], names[j]))
            told += found
            if len(told) >= ROWS:
                yield _edges(told)
                told = []
        if told:
            yield _edges(told)

    block = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    as_member = F.when(F.col("hub").isNotNull(), F.array(F.xxhash64("hub", block))).otherwise(F.array().cast("array<bigint>"))
    as_hub = F.when(F.col("own") > 0, F.transform(F.sequence(F.lit(0), F.greatest(F.col("own"), F.lit(1)).cast("int") - 1), lambda k: F.xxhash64("class", k))).otherwise(F.array().cast("array<bigint>"))
    placed = sets.select(F.explode(F.concat(as_member, as_hub)).alias("block"), "class", "tokens")
    return placed.repartition("block").sortWithinPartitions("block").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, linked) of the pairs (a, b)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 256):
            ok = [links(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok, pa.bool_())], ["a", "b", "linked"])

    # where few sets are asked for, the others don't move
    names = stored(pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "asked")
    if names.count() <= BROADCAST:
        sets = sets.join(F.broadcast(names), "class", "left_semi")
    left = sets.select(F.col("class").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("class").alias("b"), F.col("tokens").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long, linked boolean")


def _tiles(members: DataFrame, large: bool) -> DataFrame:
    """members(key, n, class, component, point, size) -> (tile, key, class, component, point, size).  A
    bucket of up to TILE members is a tile.  Of a larger one, components of over TILE members are cut
    into blocks and the others gathered in blocks, and each two blocks make a tile, but for two of one
    component."""
    what = ["class", "component", "point", "size"]
    small = members.where(F.col("n") <= TILE).select(F.col("key").alias("tile"), "key", *what)
    if not large:
        return small
    rest = members.where(F.col("n") > TILE).select("key", "n", *what)
    parts = rest.groupBy("key", "component").agg(F.count("*").alias("m"))
    rest = rest.join(parts, ["key", "component"])
    is_big = F.col("m") > TILE
    one = F.when(is_big, F.col("component"))
    block = F.when(is_big, F.pmod(F.xxhash64("class"), F.ceil(F.col("m") / TILE))).otherwise(F.pmod(F.xxhash64("component"), F.ceil(F.col("n") / TILE)))
    rest = rest.withColumn("one", one).withColumn("block", F.xxhash64(is_big, F.when(is_big, F.col("component")), block))
    blocks = stored(rest.select("key", "one", "block").distinct(), "blocks")
    x, y = blocks.select("key", F.col("one").alias("one_x"), F.col("block").alias("x")), blocks.select("key", F.col("one").alias("one_y"), F.col("block").alias("y"))
    pairs = x.join(y, "key").where((F.col("x") <= F.col("y")) & ~F.coalesce(F.col("one_x") == F.col("one_y"), F.lit(False)))
    pairs = pairs.select(F.xxhash64("key", "x", "y").alias("tile"), "key", F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
    return small.unionByName(rest.join(stored(pairs, "tiles"), ["key", "block"]).select("tile", "key", *what))


def _forests(pairs: np.ndarray, component: np.ndarray, forests: int) -> tuple[np.ndarray, bool]:
    """The pairs (i, j), first ones first, that lie in ``forests`` spanning forests of the components, each
    of what the forests before it left; and whether some are left.  All, if they are no more than such
    forests can hold.  What a forest ties is tied in those before it too, so a pair's forest is found by halving."""
    names, own = np.unique(component, return_inverse=True)
    most = forests * (len(names) - 1)
    if len(pairs) <= most:
        return pairs, False
    levels: list[Ties] = []
    chosen = []
    for nth, (x, y) in enumerate(own[pairs].tolist()):
        low, high = 0, len(levels)
        while low < high:
            mid = (low + high) // 2
            if levels[mid].root(x) == levels[mid].root(y):
                low = mid + 1
            else:
                high = mid
        if low == forests:
            continue
        if low == len(levels):
            levels.append(Ties())
        levels[low].tie(x, y)
        chosen.append(nth)
        if len(chosen) == most:
            break
    return pairs[chosen], len(chosen) < len(pairs)


def _tree_pairs(tiles: DataFrame, forests: int, rows: int) -> DataFrame:
    """(key, a, b, rest): pairs of different components in one tile that the count vectors don't rule
    out, as many as ``forests`` spanning forests of its components can hold; rest says that the tile has
    more.  Points are few bytes but much work, so the number of tasks follows from the ``rows``."""

    def batch(told: list[tuple]) -> pa.RecordBatch:
        ab = np.concatenate([a for _, a, _ in told])
        size = [len(a) for _, a, _ in told]
        return pa.RecordBatch.from_arrays([pa.array(np.repeat([k for k, _, _ in told], size), pa.int64()), pa.array(ab[:, 0]), pa.array(ab[:, 1]), pa.array(np.repeat([r for _, _, r in told], size), pa.bool_())], ["key", "a", "b", "rest"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, n = [], 0
        for group in _groups(batches):
            _, key, names, component, points, sizes = zip(*group)
            points = np.frombuffer(b"".join(points), np.uint8).reshape(-1, DIMS).astype(np.int64)
            points[points == FULL] = 1 << 40  # counts that didn't fit may be any
            component = np.array(component)
            chosen, rest = _forests(RTree(points, np.array(sizes), component).by_room(), component, forests)
            if len(chosen):
                told.append((key[0], np.sort(np.array(names, np.int64)[chosen], 1), rest))
                n += len(chosen)
            if n >= ROWS:
                yield batch(told)
                told, n = [], 0
        if told:
            yield batch(told)

    parts = max(4 * tiles.sparkSession.sparkContext.defaultParallelism, rows // ROWS)
    return tiles.select("tile", "key", "class", "component", "point", "size").repartition(parts, "tile").sortWithinPartitions("tile").mapInArrow(run, "key long, a long, b long, rest boolean")


def _small(df: DataFrame) -> DataFrame:
    """A stored table of ids, to be broadcast if its counted size allows."""
    return F.broadcast(df) if df.count() <= BROADCAST else df


def _named(met: DataFrame, final: DataFrame) -> DataFrame:
    """met(key, class) with each class's component."""
    names = final.select(F.col("node").alias("class"), "component")
    return met.select("key", "class").join(_small(names), "class", "left").withColumn("component", F.coalesce("component", "class"))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    profiles = stored(_profiles(docs), "profiles")
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt")
    salted = stored(profiles.where("class is not null").groupBy("class", salt).agg(F.min("doc_id").alias("id"), F.count("*").alias("copies")), "salted")
    classes = salted.groupBy("class").agg(F.min("id").alias("id"), F.sum("copies").alias("copies"))

    met = stored(_met(_routes(docs)), "met")
    often = Window.partitionBy("class").orderBy(F.desc("shared"), "hub")
    tries = met.where("class <> hub").groupBy("class", "hub").agg(F.count("*").alias("shared"))
    tries = stored(tries.withColumn("nth", F.row_number().over(often)).where("nth = 1").select("class", "hub"), "tries")
    hubs = tries.groupBy("hub").agg(F.ceil(F.count("*") / TILE).alias("blocks"))
    wanted = met.select("class").distinct().join(tries.join(hubs, "hub"), "class", "left").join(hubs.select(F.col("hub").alias("class"), F.col("blocks").alias("own")), "class", "left")
    wanted = stored(wanted.join(classes.where("id is not null").select("class", F.col("id").alias("doc_id")), "class"), "wanted")
    sets = stored(_sets(docs.join(_small(wanted), "doc_id")), "sets")

    # rows that repeat a doc_id tie their classes
    again = stored(profiles.where("class is not null and doc_id is not null").groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a < b").select("doc_id", "a"), "again")
    edges = stored(_hub_links(sets).unionByName(profiles.join(_small(again), "doc_id").where("class <> a").select("a", F.col("class").alias("b"))), "edges")
    final = components(edges)

    points = sets.select("class", "point", "size").dropDuplicates(["class"])
    judged, forests = None, FORESTS
    while True:
        spread = Window.partitionBy("key")
        mixed = _named(met, final).withColumn("low", F.min("component").over(spread)).withColumn("high", F.max("component").over(spread)).where("low < high").select("key", "class", "component")
        # buckets with the same members are searched once
        mixed = stored(mixed, "mixed")
        content = mixed.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.xxhash64("class").cast("decimal(38,0)")).alias("sum"), F.bit_xor(F.xxhash64("class", F.lit(1))).alias("xor"))
        once = stored(content.groupBy("n", "sum", "xor").agg(F.min("key").alias("key")).select("key", "n"), "once")
        most, rows = once.agg(F.coalesce(F.max("n"), F.lit(0)), F.sum("n")).first()
        if not most:
            break
        tiles = _tiles(mixed.join(once, "key").join(points, "class"), most > TILE)
        pairs = stored(_tree_pairs(tiles, forests, rows), "pairs")
        asked = pairs.select("a", "b").distinct()
        asked = stored(asked if judged is None else asked.join(judged, ["a", "b"], "left_anti"), "asked")
        more = stored(_verified(asked, sets), "judged")
        judged = more.select("a", "b") if judged is None else judged.unionByName(more.select("a", "b"))
        # a bucket that has told all its pairs has nothing more to tell
        before, met = met, stored(met.join(pairs.where("rest").select("key").distinct(), "key", "left_semi"), "met")
        drop_stored(before, mixed)
        new = more.where("linked").select("a", "b")
        if not new.isEmpty():
            edges = edges.unionByName(new)
            final = components(edges)
        if met.isEmpty():
            break
        forests *= MORE

    # the component of a class is the smallest id of all its classes
    names = classes.join(final.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    names = stored(names, "names")
    alone = names.groupBy("component").agg(F.min("id").alias("component_id"), F.sum("copies").alias("rows")).where("rows > 1").drop("rows")
    named = stored(salted.select("class", "salt").join(names.join(alone, "component").select("class", "component_id"), "class"), "named")
    out = profiles.withColumn("salt", salt).join(named, ["class", "salt"], "left")
    drop_stored(sets)
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of the smallest doc_id of each component, all columns as they were.  Rows without a
    doc_id can't be told apart by it and are all kept, and so are rows that repeat the kept doc_id."""
    found = join(docs).where("component_id = doc_id").select("doc_id").distinct()
    id_first = [F.col(f"`{c}`") for c in docs.columns]
    kept = docs.where("doc_id is not null").join(found, "doc_id", "left_semi").select(*id_first)
    return kept.unionByName(docs.where("doc_id is null"))
