"""Toxicity by compression distance.

One Zstandard dictionary is trained on the windows of ordinary texts (a few words each, with
overlap), one on those of toxic texts, and every window of a text is compressed with both: the mean
saving of a window by the toxic one takes in all of its text.  A toxic document is mostly ordinary
text, though, so a third dictionary, the ordinary one with the word beginnings and endings that recur
in toxic documents and hardly ever in ordinary ones, finds single windows: a document's largest
savings by it are taken.  A calibrated logistic curve makes the score of both.

Training runs on the driver, on at most ``sample`` labelled rows of each kind (those whose ids hash
smallest), so its cost doesn't grow with the corpus.  In the curve's fit a sampled row counts for the
labelled rows of its kind that it stands for, so scores have the labels' class ratio whatever part of
a kind was read.  Scoring is one narrow pass over whole texts:
no shuffle, memory bounded by one document.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import DataFrame, functions as F

from siftwell.llm.common import bounded_sample, fold_of, small_batches, unload

#: Words in a window, words from one window to the next, most bytes in a window.
WORDS, HOP, MOST = 6, 5, 192
#: Bytes of either trained dictionary, lengths of the segments that are weighed, rounds of choosing.
TRAINED_BYTES, LENGTHS, ROUNDS = 24576, (6, 7, 8, 9, 10), 4
#: Share of toxic documents in which a segment must recur, and that it must add to those reached.
RECURS, GAIN = 0.03, 0.03
#: Parts of the sample; a part's mean savings, for the curve, are by dictionaries of the other parts.
FOLDS = 5
#: Labelled rows of each kind that training reads at most.
SAMPLE = 1500
_space = re.compile(r"\s+")


def _prepared(text: str | None) -> bytes:
    return _space.sub(" ", (text or "").lower()).strip().encode("utf-8", "replace")


def windows(data: bytes) -> np.ndarray:
    """(start, length) of the windows; together they cover every byte."""
    if not data:
        return np.zeros((0, 2), np.uint64)
    spaces = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    starts, ends = np.concatenate([[0], spaces]), np.concatenate([spaces + 1, [len(data)]])
    first = np.arange(0, max(1, len(starts) - WORDS + HOP), HOP)
    last = np.minimum(first + WORDS - 1, len(starts) - 1)
    at, size = starts[first], ends[last] - starts[first]
    if size.max() > MOST:  # long words are cut, with overlap
        step = MOST - 32
        parts = np.maximum(1, -(-(size - 32) // step))
        k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        at, size = np.repeat(at, parts) + k * step, np.repeat(size, parts) - k * step
        size = np.minimum(size, MOST)
    return np.stack([at, size], 1).astype(np.uint64)


def _compressor(raw: bytes) -> zs.ZstdCompressor:
    how = zs.ZstdCompressionParameters(strategy=zs.STRATEGY_GREEDY, min_match=6, window_log=17, hash_log=16, chain_log=16, search_log=4, target_length=64, format=zs.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0)
    return zs.ZstdCompressor(dict_data=zs.ZstdCompressionDict(raw), compression_params=how)


def _trained(samples: list[bytes], size: int) -> bytes:
    try:
        return zs.train_dictionary(size, samples, k=32, d=8).as_bytes()
    except zs.ZstdError:  # too few samples to train on: their bytes are the dictionary
        return b" ".join(samples)[-size:] or b" the "


def _dictionary(texts: list[bytes]) -> bytes:
    return _trained([d[int(a) : int(a + n)] for d in texts for a, n in windows(d)], TRAINED_BYTES)


def _lengths(data: bytes, w: np.ndarray, compressors: list[zs.ZstdCompressor]) -> list[np.ndarray]:
    """The compressed lengths of the windows by each compressor."""
    held = zs.BufferWithSegments(data, w.tobytes())
    packed = [c.multi_compress_to_buffer(held, threads=1) for c in compressors]
    return [np.fromiter((len(p[i]) for i in range(len(w))), np.int64, len(w)) for p in packed]


def _segments(data: bytes) -> set[bytes]:
    out = set()
    for word in set(data.split(b" ")):
        framed = b" " + word[:64] + b" "
        for n in LENGTHS:  # at the word's start and at its end
            if len(framed) >= n:
                out.add(framed[:n])
                out.add(framed[-n:])
    return out


def _toxic_segments(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Segments that recur in toxic documents and not in ordinary ones, chosen so that together
    they reach as many toxic documents as possible; several rounds, each without what overlaps."""
    in_toxic: Counter = Counter()
    for d in toxic:
        in_toxic.update(_segments(d))
    least, nt, no = max(3, RECURS * len(toxic)), max(1, len(toxic)), max(1, len(ordinary))
    usual = {s for s, n in in_toxic.items() if n >= least}
    in_toxic = Counter({s: in_toxic[s] for s in usual})
    sets = [_segments(d) & usual for d in toxic]
    in_ordinary = Counter(s for d in ordinary for s in _segments(d) & usual)
    left = {s for s in usual if in_toxic[s] / nt >= 6 * (in_ordinary[s] + 1) / no}
    chosen: list[bytes] = []
    for _ in range(ROUNDS):
        rest, found = [x & left for x in sets], []
        while True:
            counts = Counter(s for x in rest for s in x)
            gain, _, best = max(((n - 3 * nt * in_ordinary[s] / no, len(s), s) for s, n in counts.items()), default=(0, 0, b""))
            if gain < max(3, GAIN * nt):
                break
            found.append(best)
            rest = [x for x in rest if best not in x]
        chosen += found
        left = {s for s in left if not any(s in c or c in s for c in found)}
    return chosen


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    marked: bytes
    weights: np.ndarray

    def open(self) -> "Scorer":
        return Scorer(self)


class Scorer:
    def __init__(self, model: Model):
        self.compressors = [_compressor(raw) for raw in (model.ordinary, model.toxic, model.marked)]
        self.weights = model.weights

    def features(self, text: str | None) -> np.ndarray:
        data = _prepared(text)
        w = windows(data)
        top, mean = np.zeros(4), 0.0
        if len(w):
            ordinary, toxic, marked = _lengths(data, w, self.compressors)
            most = np.sort(np.clip(ordinary - marked, 0, 8))[-4:][::-1]
            top[: len(most)] = most
            mean = (ordinary - toxic).mean()
        return np.array([1.0, top[0], top[0] + top[1], top.sum(), mean, np.log1p(len(w))])

    def score(self, text: str | None) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.features(text) @ self.weights, -30, 30))))


def _logistic(x: np.ndarray, y: np.ndarray, counts: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """``counts`` says how many rows each row counts for."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (counts * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (counts * (y - p)) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(toxic_texts: list[str], ordinary_texts: list[str], behind: tuple[float, float] = (1.0, 1.0)) -> Model:
    """Train the dictionaries and the curve.  Texts that repeat count once in the dictionaries.
    ``behind`` is the number of labelled rows that a toxic and an ordinary text stand for.  With no
    toxic text the score is about the share of toxic ones for every document."""
    toxic = [_prepared(t) for t in dict.fromkeys(toxic_texts)]
    ordinary = [_prepared(t) for t in dict.fromkeys(ordinary_texts)]
    base, other = _dictionary(ordinary), _dictionary(toxic)
    chosen = _toxic_segments(toxic, ordinary)
    more = b" " + b" ".join(reversed(chosen)) + b" " if chosen else b""
    model = Model(base, other, base + more, np.zeros(6))
    scorer = model.open()
    x = np.array([scorer.features(t) for t in [*toxic_texts, *ordinary_texts]] or [[1.0, 0, 0, 0, 0, 0]])
    y = np.array([1.0] * len(toxic_texts) + [0.0] * len(ordinary_texts) or [0.0])
    data = [_prepared(t) for t in [*toxic_texts, *ordinary_texts]]
    part = lambda d: zlib.crc32(d) % FOLDS
    for k in range(FOLDS):  # a dictionary saves more on texts that it was trained on than on others
        rest = [_compressor(_dictionary([d for d in texts if part(d) != k])) for texts in (ordinary, toxic)]
        for row, d in enumerate(data):
            if part(d) == k and len(w := windows(d)):
                without, by_toxic = _lengths(d, w, rest)
                x[row, 4] = (without - by_toxic).mean()
    counts = np.where(y == 1, *behind)
    model.weights = _logistic(x, y, counts * len(y) / counts.sum())
    return model


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, parts: int = 3, held: int = 1) -> Model:
    """Fit on labelled documents whose crc32(doc_id) mod ``parts`` isn't ``held``; at most ``sample``
    of either kind, weighted by the number of all of that kind.  Null labels, labels without a document and empty texts are passed over."""
    usable = labels.select("doc_id", "toxic").where(F.col("toxic").isin(0, 1) & (fold_of(F.col("doc_id"), parts) != held)).distinct()
    rows = {kind: bounded_sample(usable.where(F.col("toxic") == kind), "doc_id", sample) for kind in (1, 0)}
    picked = {r.doc_id: kind for kind in (1, 0) for r in rows[kind]}
    if not picked:
        return fit([], [])
    total = {r["toxic"]: r["count"] for r in usable.groupBy("toxic").count().collect()}
    behind = tuple(total[kind] / len(rows[kind]) if rows[kind] else 1.0 for kind in (1, 0))
    ids = docs.sparkSession.createDataFrame([(i,) for i in picked], "doc_id long")
    found = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi").collect()  # 2 * sample ids at most
    texts = sorted(((r.doc_id, r.text) for r in found if r.text), key=lambda r: (r[0], r[1]))
    return fit([t for i, t in texts if picked[i] == 1], [t for i, t in texts if picked[i] == 0], behind)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row; a null or empty text has the score of a text without windows."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # three dictionaries of about 25 kB

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unload()
        scorer = shared.value.open()
        for batch in small_batches(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([scorer.score(t) for t in batch.column(1).to_pylist()], pa.float64())], [id_col, "score"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {dict(docs.dtypes)[id_col]}, score double")


def keep_clean(docs: DataFrame, model: Model, limit: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose score is under ``limit``, all columns as they were, whatever their names."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unload()
        scorer = shared.value.open()
        for batch in small_batches(batches):
            yield batch.filter(pa.array([scorer.score(t) < limit for t in batch.column(at).to_pylist()], pa.bool_()))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
