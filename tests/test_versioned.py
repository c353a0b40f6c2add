"""Versioned tables and the streams that write them: failures midway, repeats, retries, expiry."""

import pytest
from pyspark.sql import functions as F

from siftwell.sources import versioned
from siftwell.sources.versioned import VersionedTable
from siftwell.streaming import incremental


def rows(table, version=None):
    return sorted(map(tuple, table.read(version).collect()))


def test_versions(spark, tmp_path):
    t = VersionedTable(spark, f"{tmp_path}/t", "k string, v int")
    assert (rows(t), t.versions()) == ([], [])
    new = lambda *r: spark.createDataFrame(r, "k string, v int")
    assert t.upsert(new(("a", 1), ("b", 2)), "k", "v", batch=("s", 0)) == 1
    assert t.upsert(new(("a", 3), ("a", 2), ("c", 1)), "k", "v", batch=("s", 1)) == 2
    assert t.upsert(new(("a", 9)), "k", "v", batch=("s", 1)) == 2  # that batch is in
    assert t.upsert(new(("d", 9)), "k", "v", batch=("other", 0)) == 3
    assert rows(t) == [("a", 3), ("b", 2), ("c", 1), ("d", 9)] and rows(t, 1) == [("a", 1), ("b", 2)]
    assert t.delete(new(("a", 0)), "k") == 4 and rows(t, 3)[0] == ("a", 3)
    assert (t.before("s", 1), t.before("s", 0), t.before("nobody", 0)) == (1, 0, 4)
    reading = t.read()
    t.expire(keep=2)
    assert t.versions() == [3, 4] and reading.count() == 3
    with pytest.raises(ValueError):
        t.read(1)


def test_two_writers(spark, tmp_path):
    a, b = (VersionedTable(spark, f"{tmp_path}/t", "k string, v int") for _ in range(2))

    def late(old):
        b.change(lambda _: spark.createDataFrame([("b", 1)], "k string, v int"))
        return spark.createDataFrame([("a", 1)], "k string, v int")

    with pytest.raises(versioned.Conflict):
        a.change(late)
    assert rows(a) == [("b", 1)] and a.versions() == [1]


def test_articles_and_companies(spark, tmp_path):
    companies, articles = VersionedTable(spark, f"{tmp_path}/c", versioned.COMPANIES), VersionedTable(spark, f"{tmp_path}/a", versioned.ARTICLES)
    at = F.to_timestamp(F.lit("2024-01-01")) + F.make_interval(days=F.col("id"))
    full = lambda df, schema: spark.createDataFrame([], schema).unionByName(df, allowMissingColumns=True)
    companies.change(lambda _: full(spark.sql("select id, concat('c', id) as name from range(3)").withColumn("created_at", at), versioned.COMPANIES))
    found = spark.sql("select id, id % 3 as company_id, concat('u', id) as url from range(7)").withColumn("created_at", at)
    articles.upsert(full(found, versioned.ARTICLES), "url", "created_at", keep=("created_at", "id"))
    assert [r.url for r in versioned.articles_of(companies, articles, "c0").collect()] == ["u6", "u3", "u0"]
    versioned.delete_companies(companies, articles, spark.createDataFrame([(0,), (5,)], "id long"))
    assert [r.name for r in companies.read().orderBy("id").collect()] == ["c1", "c2"] and sorted(r.url for r in articles.read().collect()) == ["u1", "u2", "u4", "u5"]


def land(spark, tmp_path, *r):
    spark.createDataFrame(r, "k string, v int, ts string").coalesce(1).write.mode("append").json(f"{tmp_path}/in")


def stream(spark, tmp_path):
    return spark.readStream.schema("k string, v int, ts timestamp").option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in")


def run(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def test_a_batch_that_dies_midway_comes_again(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, f"{tmp_path}/t", "k string, v int")
    go = lambda: run(incremental.upsert_versions(stream(spark, tmp_path).select("k", "v"), table, "k", "v", f"{tmp_path}/cp"))
    land(spark, tmp_path, ("a", 1, None), ("b", 1, None))
    go()
    land(spark, tmp_path, ("a", 2, None), ("c", 1, None))
    point = VersionedTable._point

    def dies(self, pointer):
        raise OSError("lost before the pointer")

    monkeypatch.setattr(VersionedTable, "_point", dies)
    with pytest.raises(Exception, match="lost before the pointer"):
        go()
    assert rows(table) == [("a", 1), ("b", 1)]  # its rows are written, yet no version

    def dies_after(self, pointer):
        point(self, pointer)
        raise OSError("lost after the pointer")

    monkeypatch.setattr(VersionedTable, "_point", dies_after)
    with pytest.raises(Exception, match="lost after the pointer"):
        go()
    monkeypatch.setattr(VersionedTable, "_point", point)
    go()  # the stream never heard that this batch was done
    assert rows(table) == [("a", 2), ("b", 1), ("c", 1)] and table.versions() == [1, 2]


def test_failed_rows_come_again(spark, tmp_path):
    done, failed = VersionedTable(spark, f"{tmp_path}/d", "k string, v int, attempts int"), VersionedTable(spark, f"{tmp_path}/f", "k string, v int, attempts int")
    work = lambda df: df.withColumn("ok", (F.col("k") != "never") & ((F.col("k") != "later") | (F.col("attempts") >= 1)))
    go = lambda: run(incremental.with_retries(stream(spark, tmp_path).select("k", "v"), work, done, failed, "k", f"{tmp_path}/cp", most=2))
    land(spark, tmp_path, ("good", 1, None), ("later", 2, None), ("never", 3, None), ("good", 1, None))
    go()
    assert [r[0] for r in rows(done)] == ["good"] and rows(failed) == [("later", 2, 1), ("never", 3, 1)]
    land(spark, tmp_path, ("more", 4, None))
    go()
    assert [r[0] for r in rows(done)] == ["good", "later", "more"] and rows(failed) == [("never", 3, 2)]
    land(spark, tmp_path, ("last", 5, None))
    go()
    assert rows(failed) == [("never", 3, 2)] and len(rows(done)) == 4  # tried as often as it may be


def test_cache_entries_expire(spark, tmp_path):
    schema = "key string, ts timestamp, value string"
    asked = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in").withWatermark("ts", "1 minute")

    def batch(*r):
        spark.createDataFrame([(k, f"2024-01-01T{t}", v) for k, t, v in r], "key string, ts string, value string").coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        run(incremental.answered(asked(), ttl_seconds=3600).writeStream.format("parquet").outputMode("append").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp"))

    batch(("a", "00:00:00", None), ("a", "00:10:00", "first"), ("a", "00:20:00", None), ("b", "00:15:00", "other"), (None, "00:00:00", "x"))
    batch(("a", "01:09:59", None), ("b", "01:15:00", None))
    batch(("a", "02:30:00", None), ("a", "02:31:00", "second"))
    batch(("a", "02:40:00", None), ("b", "02:41:00", None))
    got = {(r.key, r.ts.strftime("%H:%M:%S")): (r.value, r.is_hit) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {
        ("a", "00:00:00"): (None, False), ("a", "00:10:00"): ("first", False), ("a", "00:20:00"): ("first", True), ("b", "00:15:00"): ("other", False), ("a", "01:09:59"): ("first", True),
        ("b", "01:15:00"): (None, False), ("a", "02:30:00"): (None, False), ("a", "02:31:00"): ("second", False), ("a", "02:40:00"): ("second", True), ("b", "02:41:00"): (None, False),
    }
