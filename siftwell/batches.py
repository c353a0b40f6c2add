"""Arrow batches of bounded size, for functions that take rows to Python."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa


def bounded(batches: Iterable[pa.RecordBatch], rows: int = 256, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in order, at most ``rows`` at once, and fewer where they take over ``size`` bytes;
    a larger row comes alone."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            n = min(rows, batch.num_rows - at)
            while n > 1 and batch.slice(at, n).nbytes > size:
                n //= 2
            yield batch.slice(at, n)
            at += n
