"""Token counts of fields and sections by offset mapping.

A document is encoded once, whole; tokens are intervals of its text, and so are its sections.  Both
lists are sorted and sections follow one another, so joining them is a merge: each token is looked up
among the sections' starts.  A token that lies in several sections is allocated by a rule:

``start``    to the section that holds its first byte (the default; counts add up to the total)
``end``      to the section that holds its last byte
``largest``  to the section that holds most of its bytes, the first of equals
``share``    to all of them, in proportion to the bytes in each (counts are fractions)

Encoding sections one by one would give other tokens at their borders and cost more.  One narrow
pass, without a shuffle; memory is bounded by one document.  Null or empty texts have no tokens and
no sections; rows that repeat are counted each time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siftwell.llm.bpe import ByteBpe, loaded
from siftwell.llm.common import held, small_batches

RULES = ("start", "end", "largest", "share")


def lines(data: bytes) -> np.ndarray:
    """Starts of a text's lines; a line keeps its line end."""
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    return np.concatenate([[0], ends[ends < len(data)]]) if data else np.zeros(0, np.int64)


def paragraphs(data: bytes) -> np.ndarray:
    """Starts of the lines that follow an empty line, and of the first."""
    at = lines(data)
    return at[[k == 0 or data[x - 2 : x] == b"\n\n" for k, x in enumerate(at)]] if len(at) else at


class Spans:
    """texts -> (start, end) of their tokens, in bytes."""

    def __init__(self, bpe: ByteBpe):
        size = bpe.fst.sizes.astype(np.uint8 if bpe.fst.sizes.max() < 256 else np.uint32)
        self.kind = size.dtype
        self.parts = bpe.form(lambda ids, cut: [size[ids[a:b]].tobytes() for a, b in cut], b"")

    def __call__(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for parts in self.parts(texts):
            size = np.frombuffer(b"".join(parts), self.kind)
            end = np.cumsum(size, dtype=np.int64)
            yield end - size, end


def _spans(ranks_path: str) -> Spans:
    return held(("spans", ranks_path), lambda: Spans(loaded(ranks_path)))


def characters(data: bytes, at: np.ndarray) -> np.ndarray:
    """Byte offsets as code points: how many characters begin before each."""
    begins = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    return np.concatenate([[0], np.cumsum(begins)])[at]


def allocate(start: np.ndarray, end: np.ndarray, sections: np.ndarray, size: int, rule: str = "start") -> tuple[np.ndarray, int]:
    """(tokens of each section, tokens that lie in several)."""
    n = len(sections)
    if not n:
        return np.zeros(0), 0
    first = np.searchsorted(sections, start, "right") - 1
    last = np.searchsorted(sections, end - 1, "right") - 1
    crossing = np.flatnonzero(first != last)
    if rule == "end":
        return np.bincount(last, minlength=n).astype(float), len(crossing)
    count = np.bincount(first, minlength=n).astype(float)
    if rule != "start":
        bounds = np.append(sections, size)
        for t in crossing:
            over = np.array([min(end[t], bounds[s + 1]) - max(start[t], bounds[s]) for s in range(first[t], last[t] + 1)], float)
            count[first[t]] -= 1
            if rule == "largest":
                count[first[t] + int(over.argmax())] += 1
            else:
                count[first[t] : last[t] + 1] += over / over.sum()
    return count, len(crossing)


def count(docs: DataFrame, ranks_path: str, cut: Callable[[bytes], np.ndarray] = lines, rule: str = "start", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_sections, n_crossing, section_tokens) of every row."""
    if rule not in RULES:
        raise ValueError(f"rule: one of {RULES}")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = _spans(ranks_path)
        for batch in small_batches(batches):
            total, n_sections, crossing, each = [], [], [], []
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for text, (start, end) in zip(texts, spans(texts)):
                data = text.encode("utf-8", "replace")
                sections = cut(data)
                tokens, n = allocate(start, end, sections, len(data), rule)
                total.append(len(start))
                n_sections.append(len(sections))
                crossing.append(n)
                each.append(tokens)
            names = [id_col, "n_tokens", "n_sections", "n_crossing", "section_tokens"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (total, n_sections, crossing)), pa.array(each, pa.list_(pa.float64()))], names)

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, n_sections long, n_crossing long, section_tokens array<double>")


def fields(docs: DataFrame, ranks_path: str, columns: list[str], joint: str = "\n", rule: str = "start", id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, one count for each column): the columns' texts joined by ``joint`` are encoded
    as one document; the joint belongs to the field before it.  Null fields are empty."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans = _spans(ranks_path)
        for batch in small_batches(batches):
            rows = zip(*(batch.column(k + 1).to_pylist() for k in range(len(columns))))
            split = [[(x or "") + (joint if k < len(row) - 1 else "") for k, x in enumerate(row)] for row in rows]
            total, each = [], []
            for parts, (start, end) in zip(split, spans(["".join(x) for x in split])):
                at = np.cumsum([0] + [len(p.encode("utf-8", "replace")) for p in parts])
                tokens, _ = allocate(start, end, at[:-1], int(at[-1]), rule)
                total.append(len(start))
                each.append(tokens)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), *(pa.array([float(x[k]) for x in each], pa.float64()) for k in range(len(columns)))], [id_col, "n_tokens", *(f"{c}_tokens" for c in columns)])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, *columns).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, " + ", ".join(f"`{c}_tokens` double" for c in columns))
