"""A pipeline over ``documents``: toxicity, near duplicates, benchmark passages, secrets, tokens.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from siftwell.llm import bpe, decontam, ngram_join, secrets, toxicity
from siftwell.llm.common import shared_dir, table
from siftwell.llm.queries import LIMIT, ranks_path
from siftwell.session import ship


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under the limit."""
    model = toxicity.train(table(ship(spark), sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model, LIMIT)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each component of the n-gram Jaccard join."""
    ship(spark)
    return ngram_join.keep_one(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.keep_clean(docs, table(ship(spark), sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked."""
    ship(spark)
    return secrets.redact(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of all documents."""
    ship(spark)
    return bpe.digests(docs, ranks_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("secret_scans", mask_secrets),
    ("byte_level_bpe", tokenize),
]

#: SQL can't express the trained stage and the encoder; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    at = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.option("compression", "zstd").parquet(f"{at}/{k}-{name}")
        docs = spark.read.schema(out.schema).parquet(f"{at}/{k}-{name}")
    return docs
