"""Structured Streaming forms of the incremental steps.  Where a stream starts and ends is the
caller's; checkpoints give resumption, so there is no progress file."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from siftwell.operators import records
from siftwell.shared import written
from siftwell.sources.versioned import VersionedTable


def new_by_key(stream: DataFrame, key: str, time: str | None = None, late: str = "1 day") -> DataFrame:
    """Rows whose key wasn't seen before; with a time column, remembered for ``late`` only."""
    present = stream.where(F.coalesce(F.col(key), F.lit("")) != "")
    return present.withWatermark(time, late).dropDuplicatesWithinWatermark([key]) if time else present.dropDuplicates([key])


def upsert_into(stream: DataFrame, read: Callable[[], DataFrame], write: Callable[[DataFrame], None], key: str, order: str, checkpoint: str) -> DataStreamWriter:
    """Each micro-batch replaces rows of a table by key; running one twice gives the same table."""

    def merge(batch: DataFrame, _: int) -> None:
        write(records.upsert(read(), batch, key, order))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)


def windowed_counts(stream: DataFrame, time: str, by: str, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    return stream.withWatermark(time, late).groupBy(F.window(time, size), by).agg(F.count("*").alias("n"))


def append_to(stream: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """A history that only grows: what is new is added as Parquet, each row once, also after a restart."""
    return stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)


def upsert_versions(stream: DataFrame, table: VersionedTable, key: str, order: str, checkpoint: str, name: str = "stream") -> DataStreamWriter:
    """Each micro-batch is one version of a table.  A batch that comes again after a failure is made
    again if its version isn't there, and does nothing if it is."""

    def merge(batch: DataFrame, number: int) -> None:
        table.upsert(batch, key, order, batch=(name, number))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)


def with_retries(stream: DataFrame, work: Callable[[DataFrame], DataFrame], done: VersionedTable, failed: VersionedTable, key: str, checkpoint: str, most: int = 3, name: str = "stream") -> DataStreamWriter:
    """Work through a stream of rows; rows whose work failed come again with the next batch.

    ``work`` gives its rows with ``ok`` (boolean) and the columns of ``done``; ``failed`` has the stream's
    columns and ``attempts``, and rows leave it when they succeed or have failed ``most`` times.  Of rows
    with one key the new one counts.
    """

    def step(batch: DataFrame, number: int) -> None:
        columns = [f"`{c}`" for c in batch.columns]
        # a batch that is repeated sees the failures as they were before it
        again = failed.read(failed.before(name, number)).where(F.col("attempts") < most)
        new = batch.select(*columns).dropDuplicates([key])
        todo = new.withColumn("attempts", F.lit(0)).unionByName(again.join(new.select(key), key, "left_anti").select(*columns, "attempts"))
        outcome = written(work(todo), "outcome")
        done.upsert(outcome.where("ok"), key, "attempts", batch=(name, number))
        left = outcome.where(~F.coalesce("ok", F.lit(False))).select(*columns, (F.col("attempts") + 1).alias("attempts"))
        failed.change(lambda old: old.join(todo.select(key), key, "left_anti").unionByName(left), batch=(name, number))

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)


CACHE_STATE = "value string, stored timestamp"


def answered(requests: DataFrame, ttl_seconds: int = 86_400) -> DataFrame:
    """requests(key, ts, value) -> (key, ts, value, is_hit): a stateful cache with a time to live.

    A row with a value stores it under its key; one without asks for it, and gets what was stored less than
    ``ttl_seconds`` before, or null.  Time is the rows' own (``ts``), within a batch rows come by it; a key
    whose entry has expired by the watermark loses its state.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        value, stored = state.get if state.exists else (None, None)
        rows = pd.concat(list(batches)).sort_values("ts", kind="stable")
        out = []
        for ts, given in zip(rows["ts"], rows["value"]):
            if given is not None:
                value, stored = given, ts.to_pydatetime()
            fresh = stored is not None and (ts - pd.Timestamp(stored)).total_seconds() < ttl_seconds
            out.append((key[0], ts, value if fresh else None, fresh and given is None))
        if stored is not None:
            state.update((value, stored))
            ends = int(pd.Timestamp(stored).timestamp() * 1000) + ttl_seconds * 1000
            if ends > state.getCurrentWatermarkMs():
                state.setTimeoutTimestamp(ends)
            else:
                state.remove()
        yield pd.DataFrame(out, columns=["key", "ts", "value", "is_hit"])

    schema = "key string, ts timestamp, value string, is_hit boolean"
    return requests.where("key is not null and ts is not null").select("key", "ts", "value").groupBy("key").applyInPandasWithState(step, schema, CACHE_STATE, "append", GroupStateTimeout.EventTimeTimeout)
