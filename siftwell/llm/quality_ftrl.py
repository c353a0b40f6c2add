"""Quality by logistic regression over hashed word n-grams, learnt with follow-the-regularised-leader.

Two streams of words are hashed: the words as they stand (lower case; runs of one and two) and their
shapes (letters as classes, other characters kept, a mark where a word repeats the one before; runs
of one to three).  A document is a sparse vector of logarithmic counts of unit length, its score the
logistic of a sparse dot product.  Learning is per-coordinate FTRL-proximal in one pass over at most
``sample`` labelled rows, on the driver; scoring is one narrow pass over whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from siftwell.llm.common import bounded_sample, fold_of, small_batches

BITS = 18
#: Labelled rows that training reads at most, and passes over them.
SAMPLE, PASSES = 8000, 2
WORDS_KEPT = 200_000
_lower, _upper, _digit = re.compile(r"[^\W\d_A-Z]+"), re.compile(r"[A-Z]+"), re.compile(r"\d+")
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class Features:
    """Sparse vectors of texts; the hashes of words are kept, in bounded number."""

    def __init__(self, bits: int = BITS):
        self.shift = np.uint64(64 - bits)
        self.words: dict[str, tuple[int, int]] = {}

    def _word(self, word: str) -> tuple[int, int]:
        found = self.words.get(word)
        if found is None:
            shape = _digit.sub("0", _upper.sub("A", _lower.sub("a", word[:64])))[:12]
            found = xxhash.xxh64_intdigest(word.lower(), 1), xxhash.xxh64_intdigest(shape, 2)
            if len(word) <= 64:
                if len(self.words) >= WORDS_KEPT:
                    self.words.clear()
                self.words[word] = found
        return found

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = (text or "").split()
        if not words:
            return np.zeros(1, np.int64), np.ones(1)
        get, make = self.words.get, self._word
        pairs = np.array([get(w) or make(w) for w in words], np.uint64)
        w, s = pairs[:, 0], pairs[:, 1].copy()
        s[1:][w[1:] == w[:-1]] ^= _C
        streams = [w * _A, s * _B]
        if len(words) > 1:
            streams += [(w[:-1] * _B + w[1:]) * _A, (s[:-1] * _A + s[1:]) * _C]
        if len(words) > 2:
            streams.append(((s[:-2] * _A + s[1:-1]) * _B + s[2:]) * _A)
        at, n = np.unique((np.concatenate(streams) >> self.shift).astype(np.int64), return_counts=True)
        value = np.log1p(n)
        return at, value / np.sqrt(value @ value)


def fit(rows: Iterable[tuple[str, int]], bits: int = BITS, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.2, passes: int = PASSES) -> np.ndarray:
    """Weights, the last of them the bias."""
    features, rows = Features(bits), list(rows)
    size = (1 << bits) + 1
    z, n, w = np.zeros(size), np.zeros(size), np.zeros(size)
    vectors = [(np.append(at, size - 1), np.append(value, 1.0), y) for (at, value), y in ((features(t), y) for t, y in rows)]
    for _ in range(passes):
        for at, x, y in vectors:
            zi, ni = z[at], n[at]
            wi = np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))
            p = 1 / (1 + np.exp(-np.clip(wi @ x, -30, 30)))
            g = (p - y) * x
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[at] = zi + g - sigma * wi
            n[at] = ni + g * g
    w = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))
    return w.astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, parts: int = 4, held: int = 2) -> np.ndarray:
    """Fit on labelled documents whose crc32(doc_id) mod ``parts`` isn't ``held``, at most ``sample``
    of them.  Null labels and labels without a document are passed over; null texts count as empty."""
    usable = labels.select("doc_id", "quality").where(F.col("quality").isin(0, 1) & (fold_of(F.col("doc_id"), parts) != held)).distinct()
    picked = {r.doc_id: r.quality for r in bounded_sample(usable, "doc_id", sample)}
    if not picked:
        return np.zeros((1 << BITS) + 1, np.float32)
    ids = docs.sparkSession.createDataFrame([(i,) for i in picked], "doc_id long")
    rows = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi").collect()  # ``sample`` ids at most
    ordered = sorted(((xxhash.xxh64_intdigest(str(r.doc_id)), r.text or "", r.doc_id) for r in rows))
    return fit((t, picked[i]) for _, t, i in ordered)


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row; a null or empty text has the score of the bias and one reserved
    feature."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2 ** BITS floats: 1 MB

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, features = shared.value, Features(int(np.log2(len(shared.value) - 1)))
        bias = float(w[-1])
        for batch in small_batches(batches):
            out = []
            for text in batch.column(1).to_pylist():
                at, x = features(text)
                out.append(1 / (1 + np.exp(-np.clip(w[at] @ x + bias, -30, 30))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64())], [id_col, "score"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {dict(docs.dtypes)[id_col]}, score double")
