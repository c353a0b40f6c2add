"""Tables written to the folder that the driver and all executors share, to cut lineage; rows dealt over the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """What ``spark.checkpoint.dir`` names.  Only a session on one machine that names none gets a
    temporary folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    spark.conf.set("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="siftwell-"))
    return folder(spark)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df``, written as Parquet and read again."""
    path = f"{folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over all cores.  A table of few bytes comes as one file with one row group, so that one
    task would read it and do all that is computed from its rows; call it while rows are still narrow."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism))
