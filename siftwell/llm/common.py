"""Helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see, as ``spark.checkpoint.dir`` names it.

    Only where that is unset (single-machine sessions, tests) a temporary folder is made and set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="siftwell-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage is cut, and a lost
    executor costs nothing that was written."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for file in df.inputFiles()[:1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(key: Column, parts: int) -> Column:
    """crc32 of the key's text, modulo ``parts``."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(parts)


def bounded_sample(df: DataFrame, key: str, limit: int) -> list:
    """At most ``limit`` rows, the same ones whatever the partitioning: those with the smallest
    hash of ``key``.  For fitting a model only; a TakeOrdered, so ``limit`` bounds the driver."""
    return df.orderBy(F.xxhash64(F.col(key)), F.col(key)).limit(limit).collect()


#: ASCII white space, as the word patterns of this package take it.
SPACE = " \t\n\x0b\f\r"


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` names it: lambda variables
    are bound to values, while columns may be inlined into each place."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    """The runs of characters other than ASCII white space; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


_held: dict = {}


def _trim() -> None:
    """Give memory that is free, but still this process's, back to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # only glibc has it
        pass


def held(key, make: Callable):
    """What a Python worker keeps from one batch to the next; made once."""
    if key not in _held:
        _trim()  # what earlier stages left in this process
        _held[key] = make()
        gc.collect()
        gc.freeze()  # large and lasting: the collector needn't walk it again
    return _held[key]


def unload() -> None:
    """Forget what this process holds.  A Python worker serves later stages too, and those that hold
    nothing need the memory."""
    if _held:
        _held.clear()
        gc.unfreeze()
        _trim()


def small_batches(batches: Iterable[pa.RecordBatch], rows: int = 512, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, and of ``size`` bytes or one row."""
    for batch in batches:
        todo = [batch.slice(at, rows) for at in range(0, batch.num_rows, rows)][::-1]
        while todo:
            part = todo.pop()
            if part.num_rows > 1 and part.nbytes > size:
                half = part.num_rows // 2
                todo += [part.slice(half), part.slice(0, half)]
            else:
                yield part
