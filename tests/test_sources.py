"""Sources, sinks and stream forms on written files."""

import json

from pyspark.sql import functions as F

from siftwell.sources import landed
from siftwell.streaming import incremental


def test_text_and_json_sources(spark, tmp_path):
    (tmp_path / "a.md").write_text("# A\nb")
    assert [tuple(r) for r in landed.markdown_files(spark, f"{tmp_path}/a.md").collect()] == [("a.md", "# A\nb")]
    (tmp_path / "one.json").write_text('{"k": 1,\n"v": ["x", "y"]}')
    (tmp_path / "two.json").write_text('[{"k": 2}, {"k": 3}]')
    rows = landed.json_records(spark, f"{tmp_path}/*.json", "k int, v array<string>")
    assert sorted(r.k for r in rows.collect()) == [1, 2, 3]
    landed.save_csv(rows, f"{tmp_path}/csv")
    assert {tuple(r) for r in spark.read.option("header", True).csv(f"{tmp_path}/csv").collect()} == {("1", "x | y"), ("2", None), ("3", None)}
    landed.save_json(rows, f"{tmp_path}/json", by="k")
    assert spark.read.json(f"{tmp_path}/json").count() == 3


def test_cache_and_snapshots(spark, tmp_path):
    cache = spark.createDataFrame([("a", "2024-01-01 10:00:00", 1), ("a", "2024-01-01 11:00:00", 2), ("b", "2023-12-01 00:00:00", 3)], "key string, ts string, v int").withColumn("ts", F.to_timestamp("ts"))
    assert [(r.key, r.v) for r in landed.fresh(cache, "2024-01-01 12:00:00").collect()] == [("a", 2)]
    assert spark.createDataFrame([("Ab",)], "k string").select(landed.cache_key(F.col("k"))).first()[0] == "187ef4436122d1cc2f40dc2b92f0eba0"
    for version in ("1", "2", "2"):
        landed.snapshot(cache.withColumn("html", F.lit("x")).transform(landed.final), f"{tmp_path}/snap", version)
    assert {(r.version, r.n) for r in spark.read.parquet(f"{tmp_path}/snap").groupBy("version").agg(F.count("*").alias("n")).collect()} == {(1, 3), (2, 3)}


def test_landed_tables(spark):
    pages = spark.createDataFrame([("https://a.org/x", 1), ("https://b.org/", 2), (None, 3)], "url string, p int")
    hosts = spark.createDataFrame([("a.org",), ("a.org",)], "host string")
    assert [r.p for r in landed.with_known_host(pages, hosts).collect()] == [1]
    items = spark.createDataFrame([(" T ", "u", None, "s", None, 1), ("later", "u", None, "s", None, 2), ("none", " ", None, None, None, 3)], "title string, url string, published string, source string, description string, position int")
    assert [tuple(r) for r in landed.news(items).collect()] == [("u", "T", "", "s", "")]
    entries = spark.createDataFrame([("r", "sitemap", "r/blog.xml"), ("r", "sitemap", "r/shop.xml"), ("r", "url", "p0"), ("r/blog.xml", "url", "p1"), ("r/blog.xml", "sitemap", "r/news.xml"), ("r/news.xml", "url", "p2"), ("r/shop.xml", "url", "p3")], "parent string, kind string, url string")
    assert sorted(r.url for r in landed.sitemap_pages(entries, ["r"], ["blog", "news"]).collect()) == ["p0", "p1", "p2"]
    answers = spark.createDataFrame([("https://x/api/company/1", '{"siren": 1, "photos": [1], "deep": {"a": [2]}}'), ("https://x/api/company/2", '{"other": 1}'), ("https://x/ads", '{"siren": 1}'), ("https://x/api/company/3", "[1]"), ("https://x/api/company/4", "no")], "url string, json string")
    got = landed.useful_answers(answers, ["/company/"], ["siren"], ["photos"]).collect()
    assert [(r.name, json.loads(r.json)) for r in got] == [("https://x/api/company/1", {"siren": 1, "deep": {"a": [2]}})]


def test_markdown_of_pages(spark):
    html = "<html><head><title>t</title></head><body><h2>A  <b>bold</b> title</h2><p>Some <a href='/x'>link</a> &amp; <img src=i.png alt=pic></p><ul><li>one<li>two</ul><script>var x</script><p>a<br>b</p></body>"
    rows = spark.createDataFrame([(1, html), (2, None)], "i int, h string").select("i", landed.html_to_markdown(F.col("h")).alias("m")).orderBy("i").collect()
    assert rows[0].m == "## A **bold** title\n\nSome [link](/x) & ![pic](i.png)\n\n* one\n* two\n\na\nb" and rows[1].m == ""


def test_streams(spark, tmp_path):
    def land(name, rows):
        spark.createDataFrame(rows, "k string, v int, ts string").coalesce(1).write.mode("append").json(f"{tmp_path}/in")

    def stream():
        return spark.readStream.schema("k string, v int, ts timestamp").json(f"{tmp_path}/in")

    def run(writer):
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()

    def write(df):
        df.write.mode("overwrite").parquet(f"{tmp_path}/new")
        spark.read.parquet(f"{tmp_path}/new").write.mode("overwrite").parquet(f"{tmp_path}/table")

    spark.createDataFrame([("a", 0, None)], "k string, v int, ts timestamp").write.parquet(f"{tmp_path}/table")
    land("1", [("a", 1, "2024-01-01T00:10:00"), ("b", 2, "2024-01-01T00:20:00")])
    upsert = lambda: incremental.upsert_into(stream(), lambda: spark.read.parquet(f"{tmp_path}/table"), write, "k", "v", f"{tmp_path}/c1")
    history = lambda: incremental.append_to(stream(), f"{tmp_path}/history", f"{tmp_path}/c2")
    run(upsert())
    run(history())
    land("2", [("a", 5, "2024-01-01T01:10:00")])
    run(upsert())
    run(history())
    run(history())  # nothing new
    assert sorted((r.k, r.v) for r in spark.read.parquet(f"{tmp_path}/table").collect()) == [("a", 5), ("b", 2)]
    assert sorted(r.v for r in spark.read.parquet(f"{tmp_path}/history").collect()) == [1, 2, 5]
    query = incremental.windowed_counts(stream(), "ts", "k").writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r.k, r.n) for r in spark.table("counts").collect()) == [("a", 1), ("a", 1), ("b", 1)]


def test_markdown_of_tables_quotes_and_code(spark):
    cases = [
        ("<ol><li>one<li>two<ul><li>in</ul><li>three</ol>", "1. one\n2. two\n\n* in\n\n3. three"),
        ("<table><tr><th>A</th><th>B | C</th></tr><tr><td>1 <b>2</b></td></tr></table>after", "| A | B \\| C |\n| --- | --- |\n| 1 **2** | |\n\nafter"),
        ("<table><tr><td>a<td>b<tr><td>c<p>d", "| a | b |\n| --- | --- |\n| c d | |"),
        ("x<blockquote><p>said  this</p><p>and <i>that</i></p></blockquote>y", "x\n\n> said this\n>\n> and *that*\n\ny"),
        ("use <code>a  b</code><pre><code>if x:\n    y = 1\n</code></pre>end", "use `a b`\n\n```\nif x:\n    y = 1\n\n```\n\nend"),
        ("<table></table><blockquote></blockquote>z", ">\n\nz"),
    ]
    rows = spark.createDataFrame([(k, h) for k, (h, _) in enumerate(cases)], "i int, h string").select("i", landed.html_to_markdown(F.col("h")).alias("m")).orderBy("i").collect()
    assert [r.m for r in rows] == [want for _, want in cases]
