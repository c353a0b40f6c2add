"""Near duplicates by SimHash: 64-bit fingerprints, linked where at most 3 bits differ.

Bits are dealt into 4 blocks; two fingerprints that differ in at most 3 bits share one whole, so rows
that share a block (and its number) are compared.  Where more than ``TILE`` fingerprints share one, the
bits outside it are dealt into 4 blocks again, and so on: fewer and fewer differ, and none of those
pairs is lost, for their 3 bits still spare a block of what is left.  When at most 3 bits are left, all
that meet there link.  So work grows with what is alike in many bits, not with the square of a bucket.

Only distinct fingerprints are compared; equal ones are linked by being one.  A bucket gives links that
tie together what links in it, at most one fewer than it has members, never all its pairs.

Words are runs of other than ASCII white space, A-Z as a-z; a shingle is 3 words joined by single
spaces, or all words if there are fewer; a bit is set if it is in over half of the shingles' XXH64
hashes, repeats included.  Very long texts are read a part at a time.  Defined cases: a text without words, or null, has
fingerprint zero and links like any other; rows that repeat a doc_id are one document for reachability
and each keep their row; a row without a doc_id takes the component of its fingerprint, null if no
row of that has an id; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from siftwell.llm.common import small_batches, stored, unload
from siftwell.llm.ngram_join import SALTS, components

BITS, BLOCKS, NEAR = 64, 4, 3
GRAM, SEED = 3, 42
#: Fingerprints of a bucket that are compared with each other.
TILE = 256
#: Bytes of a text that are looked at together.
PART = 1 << 20
#: Rows of three longs that may be broadcast.
BROADCAST = 1_000_000

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


class _Votes:
    """How many of the hashes seen have each bit."""

    def __init__(self) -> None:
        self.n, self.ones = 0, np.zeros((8, 8), np.int64)

    def add(self, hashes: list[int]) -> None:
        self.n += len(hashes)
        octets = np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8)
        if len(hashes) < 128:
            self.ones += np.unpackbits(octets, axis=1).sum(0, dtype=np.int64).reshape(8, 8)
        else:
            for k in range(8):
                self.ones[k] += np.bincount(octets[:, k], minlength=256) @ _ONES

    def bits(self) -> int:
        return int.from_bytes(np.packbits(2 * self.ones.reshape(-1) > self.n).tobytes(), "big") if self.n else 0


def fingerprint(text: str | bytes | None) -> int:
    """The unsigned fingerprint of a text."""
    data = (text.encode() if isinstance(text, str) else text or b"").lower()
    votes, hashed, last, at = _Votes(), xxhash.xxh64_intdigest, [], 0
    while at < len(data):
        gap = _SPACE.search(data, at + PART)  # no word is cut
        end = gap.start() if gap else len(data)
        words = last + data[at:end].split()
        if len(words) >= GRAM:
            joined = b" ".join(words)
            gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
            begins, ends = np.r_[0, gaps[: len(words) - GRAM] + 1].tolist(), np.r_[gaps[GRAM - 1 :], len(joined)].tolist()
            votes.add([hashed(joined[a:b], SEED) for a, b in zip(begins, ends)])
        last, at = words[1 - GRAM :], end
    if not votes.n and last:
        votes.add([hashed(b" ".join(last), SEED)])
    return votes.bits()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, print) of every row: the fingerprint as a signed long."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unload()
        for batch in small_batches(batches):
            found = np.array([fingerprint(t.as_buffer().to_pybytes() if t.is_valid else None) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "print"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("text")).mapInArrow(run, "doc_id long, print long")


def _masks(left: Column) -> Column:
    """The bits of ``left`` in BLOCKS masks, bit by bit in turn."""
    each = F.array(*[F.lit((1 << i) - ((1 << BITS) if i == BITS - 1 else 0)).cast("long") for i in range(BITS)])
    bits = F.filter(each, lambda bit: bit.bitwiseAND(left) != 0)

    def block(b: int) -> Column:
        own = F.filter(bits, lambda _, k: k % BLOCKS == b)
        return F.aggregate(own, F.lit(0).cast("long"), lambda mask, bit: mask.bitwiseOR(bit))

    return F.array(*[block(b) for b in range(BLOCKS)])


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST else df


def _dealt(rows: DataFrame) -> DataFrame:
    """rows(bucket, print[, left]) -> the same, one for each block of the bits left; all are at first."""
    if "left" in rows.columns:
        masks = stored(rows.select("left").distinct().withColumn("mask", F.explode(_masks(F.col("left")))), "masks")
        rows = rows.join(_few(masks), "left")
    else:
        all_bits = F.lit(-1).cast("long")
        rows = rows.select("bucket", "print", all_bits.alias("left"), F.explode(_masks(all_bits)).alias("mask"))
    return rows.select(F.xxhash64("bucket", "mask", F.col("print").bitwiseAND(F.col("mask"))).alias("bucket"), "print", F.col("left").bitwiseAND(F.bitwise_not("mask")).alias("left"))


def _tied(bucket: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by bucket: each print but the smallest of what links in its bucket, with that one."""
    at, lag, label = np.arange(len(bucket)), 0, np.arange(len(bucket))
    found = []
    while True:
        lag += 1
        at = at[: np.searchsorted(at, len(bucket) - lag)]
        at = at[bucket[at] == bucket[at + lag]]
        if not len(at):
            break
        near = at[np.bitwise_count(prints[at] ^ prints[at + lag]) <= NEAR]
        found.append((near, near + lag))
    if found:
        a, b = (np.concatenate(x) for x in zip(*found))
        while True:
            low, before = np.minimum(label[a], label[b]), label.copy()
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            label = label[label]
            if (label == before).all():
                break
    more = np.flatnonzero(label != np.arange(len(label)))
    return prints[more], prints[label[more]]


def _links(rows: DataFrame) -> DataFrame:
    """rows(bucket, print) -> (a, b): links that tie together what links in each bucket."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.zeros((2, 0), np.int64)
        for last, batch in _marked(batches):
            kept = np.concatenate([kept, np.stack([c.to_numpy() for c in batch])], 1) if batch else kept
            upto = kept.shape[1] if last else int(np.searchsorted(kept[0], kept[0, -1])) if kept.size else 0
            bucket, prints = kept[:, :upto]
            kept = kept[:, upto:]
            a, b = _tied(bucket, prints.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return rows.select("bucket", "print").repartition("bucket").sortWithinPartitions("bucket", "print").mapInArrow(run, "a long, b long")


def _marked(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bool, list | None]]:
    """The batches' columns, and at last one mark that there are no more."""
    for batch in batches:
        yield False, batch.columns
    yield True, None


def links(prints: DataFrame) -> DataFrame:
    """prints(print), distinct -> (a, b): links of at most NEAR bits that tie together all that links."""
    rows = prints.select(F.lit(0).cast("long").alias("bucket"), "print")
    found = None
    while True:
        dealt = stored(_dealt(rows), "blocks")
        large = stored(dealt.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > TILE).select("bucket"), "large")
        none = large.isEmpty()
        more = stored(_links(dealt if none else dealt.join(_few(large), "bucket", "left_anti")).distinct(), "links")
        found = more if found is None else found.unionByName(more)
        if none:
            return found.distinct()
        rows = dealt.join(_few(large), "bucket", "left_semi")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    profiles = stored(fingerprints(docs, id_col, text_col), "prints")
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt")
    salted = stored(profiles.groupBy("print", salt).agg(F.min("doc_id").alias("id"), F.count("*").alias("copies")), "salted")
    classes = salted.groupBy("print").agg(F.min("id").alias("id"), F.sum("copies").alias("copies"))
    edges = links(salted.select("print").distinct())
    # rows that repeat a doc_id tie their fingerprints
    again = profiles.where("doc_id is not null").groupBy("doc_id").agg(F.min("print").alias("a"), F.max("print").alias("b")).where("a < b").select("doc_id", "a")
    edges = edges.unionByName(profiles.join(_few(stored(again, "again")), "doc_id").where("print <> a").select("a", F.col("print").alias("b")))
    final = components(edges).withColumnRenamed("node", "print")
    names = stored(classes.join(final, "print", "left").withColumn("component", F.coalesce("component", "print")), "names")
    tied = names.groupBy("component").agg(F.min("id").alias("component_id"), F.sum("copies").alias("rows")).where("rows > 1").drop("rows")
    named = stored(salted.select("print", "salt").join(names.join(tied, "component").select("print", "component_id"), "print"), "named")
    out = profiles.withColumn("salt", salt).join(named, ["print", "salt"], "left")
    return out.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), F.coalesce("component_id", "doc_id").alias("component_id"))
