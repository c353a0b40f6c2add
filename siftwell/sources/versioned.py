"""Tables of which every change is a new version, and a pointer that names the current one.

A change writes its rows to a folder of its own and then creates the next pointer, a file that no other
may have made: what is read is never overwritten, readers see a version whole or not at all, and of two
writers that began from one version the second fails and may try again.  A pointer also holds the last
batch of each stream that wrote, so a batch that comes again after a restart does nothing.

Folders that a writer left behind before it made its pointer are never read.  ``expire`` deletes old
versions.  Pointers are small files; everything else is Spark's.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from siftwell.operators import records

# The tables that articles are kept in.
COMPANIES = "id long, name string, website string, domain string, created_at timestamp"
ARTICLES = "id long, company_id long, title string, url string, source string, published string, language string, author string, excerpt string, body string, article_type string, relevance double, created_at timestamp"


class Conflict(RuntimeError):
    """Another writer made the version that this one was about to make."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def versions(self) -> list[int]:
        """The versions that there are, oldest first."""
        fs, at = self._fs(f"{self.path}/_versions")
        names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
        return sorted(int(m[1]) for n in names if (m := re.fullmatch(r"(\d+)\.json", n)))

    def pointer(self, version: int | None = None) -> dict:
        """(version, folder, batches) of a version, by default the current one; version 0 is empty."""
        known = self.versions()
        version = (known[-1] if known else 0) if version is None else version
        if not version:
            return {"version": 0, "folder": None, "batches": {}}
        if version not in known:
            raise ValueError(f"{self.path} has no version {version}")
        return json.loads(self.spark.read.text(f"{self.path}/_versions/{version}.json", wholetext=True).first()[0])

    def before(self, stream: str, number: int) -> int:
        """The last version that doesn't hold batch ``number`` of a stream; 0 if all do."""
        return next((v for v in reversed(self.versions()) if self.pointer(v)["batches"].get(stream, -1) < number), 0)

    def read(self, version: int | None = None) -> DataFrame:
        folder = self.pointer(version)["folder"]
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{folder}") if folder else self.spark.createDataFrame([], self.schema)

    def change(self, make: Callable[[DataFrame], DataFrame], batch: tuple[str, int] | None = None) -> int:
        """The rows that ``make`` gives for the current ones become the next version; its number.

        ``batch`` (stream, number) names the batch that this is of: if that or a later one of the stream is
        already in, nothing happens.
        """
        now = self.pointer()
        if batch and now["batches"].get(batch[0], -1) >= batch[1]:
            return now["version"]
        before = self.read(now["version"]) if now["version"] else self.spark.createDataFrame([], self.schema)
        folder = f"data/{uuid.uuid4().hex}"
        columns = [f"`{f.name}`" for f in before.schema.fields]
        make(before).select(*columns).write.parquet(f"{self.path}/{folder}")
        self._point({"version": now["version"] + 1, "folder": folder, "batches": now["batches"] | ({batch[0]: batch[1]} if batch else {})})
        return now["version"] + 1

    def _point(self, pointer: dict) -> None:
        """Create the pointer under another name and give it its own: whole or not at all."""
        fs, at = self._fs(f"{self.path}/_versions/{pointer['version']}.json")
        _, draft = self._fs(f"{self.path}/_drafts/{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(pointer).encode()))
        out.close()
        fs.mkdirs(at.getParent())
        if fs.exists(at) or not fs.rename(draft, at):
            fs.delete(draft, False)
            raise Conflict(f"version {pointer['version']} of {self.path} is there already")

    def upsert(self, new: DataFrame, key: str, order: str, keep: tuple[str, ...] = (), batch: tuple[str, int] | None = None) -> int:
        """Rows of ``new`` (the last by ``order`` for each key) replace those of their key."""
        return self.change(lambda old: records.upsert(old, new, key, order, keep), batch)

    def delete(self, keys: DataFrame, key: str) -> int:
        return self.change(lambda old: old.join(keys.select(key).distinct(), key, "left_anti"))

    def expire(self, keep: int = 2) -> None:
        """Delete all versions but the last ``keep``, their pointers first."""
        for version in self.versions()[: -max(1, keep)]:
            folder = self.pointer(version)["folder"]
            for gone in (f"_versions/{version}.json", folder):
                fs, at = self._fs(f"{self.path}/{gone}")
                fs.delete(at, True)


def delete_companies(companies: VersionedTable, articles: VersionedTable, gone: DataFrame) -> None:
    """Delete companies (id) with their articles; articles first, so none is left without its company."""
    articles.delete(gone.select(F.col("id").alias("company_id")), "company_id")
    companies.delete(gone, "id")


def articles_of(companies: VersionedTable, articles: VersionedTable, name: str) -> DataFrame:
    """The articles of a company by its name, the latest added first."""
    known = companies.read().where(F.col("name") == name).select(F.col("id").alias("company_id"), F.col("name").alias("company_name"), "domain")
    return articles.read().join(known, "company_id").orderBy(F.desc("created_at"), F.desc("id"))
