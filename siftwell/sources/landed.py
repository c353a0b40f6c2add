"""Landed content as DataFrames, and the sinks."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType

from siftwell.operators import records


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """URLs of a text file: no byte-order mark, blank lines or lines that start with #."""
    line = F.trim(F.regexp_replace("value", "^\ufeff", ""))
    return spark.read.text(path).select(line.alias("url")).where((F.col("url") != "") & ~F.col("url").startswith("#"))


def markdown_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("source_file"), F.col("value").alias("raw_markdown"))


def json_records(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Files that hold an object or a list of objects."""
    return spark.read.schema(schema).json(path, multiLine=True)


def sitemap_urls(spark: SparkSession, path: str) -> DataFrame:
    """The locations of sitemap files, with their kind (sitemap or url)."""
    whole = spark.read.text(path, wholetext=True)
    pattern = r"(?is)<(sitemap|url)>.*?<loc>\s*([^<]*?)\s*</loc>"
    pairs = F.arrays_zip(F.regexp_extract_all("value", F.lit(pattern), F.lit(1)).alias("kind"), F.regexp_extract_all("value", F.lit(pattern), F.lit(2)).alias("url"))
    return whole.select(F.inline(pairs))


def flat(df: DataFrame, joint: str = " | ") -> DataFrame:
    """Lists joined, structs and maps as JSON, nulls as the empty string: ready for CSV."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, ArrayType) and not isinstance(f.dataType.elementType, StructType | MapType | ArrayType):
            c = F.array_join(c.cast("array<string>"), joint)
        elif isinstance(f.dataType, StructType | MapType | ArrayType):
            c = F.to_json(c)
        out.append(F.coalesce(c.cast("string"), F.lit("")).alias(f.name))
    return df.select(*out)


def save_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    flat(df).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def save_companies(df: DataFrame, path: str, everything: str, by: str) -> None:
    """The rows of each company in a folder of its own, which replaces what was there of that company, and
    all of them added to the global ones."""
    rows = flat(df)
    kept = rows.withColumn("_folder", F.regexp_replace(F.trim(F.regexp_replace(by, r"(?U)[^\w\s-]", "")), r"(?U)\s", "_"))
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", True).option("escape", '"').partitionBy("_folder").csv(path)
    rows.write.mode("append").option("header", True).option("escape", '"').csv(everything)


def newest_file(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, modified): the file that was changed last, of equals the last by name."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select("path", F.col("modificationTime").alias("modified"))
    return files.groupBy().agg(F.max(F.struct("modified", "path")).alias("f")).where("f is not null").select("f.path", "f.modified")


def save_json(df: DataFrame, path: str, mode: str = "overwrite", by: str | None = None) -> None:
    w = df.write.mode(mode)
    (w.partitionBy(by) if by else w).json(path)


def fresh(cache: DataFrame, now: str, ttl_seconds: int = 86_400, key: str = "key", time: str = "ts") -> DataFrame:
    """The latest entry of each key that is younger than the time to live."""
    young = cache.where(F.col(time) > F.to_timestamp(F.lit(now)) - F.make_interval(secs=F.lit(ttl_seconds)))
    return young.groupBy(key).agg(F.max_by(F.struct(*[c for c in cache.columns if c != key]), time).alias("r")).select(key, "r.*")


def cache_key(identifier: Column) -> Column:
    """The key under which an identifier's answer is kept, whatever its case."""
    return F.md5(F.lower(identifier).cast("binary"))


def snapshot(df: DataFrame, path: str, version: str) -> None:
    """One version of a dataset beside the others; writing it again replaces it alone."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/version={version}")


def final(df: DataFrame, bulky: list[str] = ["raw_markdown", "html"]) -> DataFrame:
    """Without the columns that only earlier steps need."""
    return df.drop(*bulky)


def with_known_host(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """Pages whose host is in the landed table of resolved ``hosts`` (host)."""
    host = F.regexp_extract("url", r"^[^/]*//([^/?#]*)", 1)
    return pages.withColumn("_host", host).join(hosts.select(F.col("host").alias("_host")).distinct(), "_host", "left_semi").drop("_host")


def news(items: DataFrame, order: str = "position") -> DataFrame:
    """items(title, url, published, source, description, position) of news searches in the columns of
    articles; of each URL the first item counts, items without a URL are left out."""
    text = lambda c: F.coalesce(F.trim(c), F.lit(""))
    rows = items.where(text(F.col("url")) != "").select(F.col("url"), text(F.col("title")).alias("rss_title"), text(F.col("published")).alias("rss_date"), text(F.col("source")).alias("source"), text(F.col("description")).alias("excerpt"), order)
    return records.keep_first(rows, ["url"], [order]).drop(order)


def sitemap_pages(entries: DataFrame, roots: list[str], keywords: list[str], depth: int = 3) -> DataFrame:
    """(url): the pages that the sitemaps under ``roots`` list.  entries(parent, kind, url) are landed
    sitemaps; from the roots on, only sitemaps whose URL holds one of ``keywords`` are followed."""
    named = F.col("url").rlike("(?i)" + "|".join(rf"\Q{k}\E" for k in keywords))
    level = entries.where(F.col("parent").isin(roots))
    found = level.where("kind = 'url'")
    for _ in range(depth):
        below = level.where((F.col("kind") == "sitemap") & named).select(F.col("url").alias("parent")).distinct()
        level = entries.join(below, "parent")
        found = found.unionByName(level.where("kind = 'url'").select(*found.columns))
    return found.select("url").distinct()


def useful_answers(answers: DataFrame, paths: list[str], useful: list[str], bulky: list[str]) -> DataFrame:
    """answers(url, json) of a page's requests -> (name, json): those on ``paths`` that are objects with one of
    the ``useful`` keys, without the ``bulky`` ones, named by the last 80 characters of their URL."""
    wanted = F.col("url").rlike("(?i)" + "|".join(rf"\Q{p}\E" for p in paths))
    rows = answers.where(wanted).withColumn("m", F.from_json("json", "map<string,variant>")).where(F.arrays_overlap(F.map_keys("m"), F.array(*[F.lit(k) for k in useful])))
    kept = F.map_filter("m", lambda k, _: ~k.isin(bulky))
    return rows.select(F.right("url", F.lit(80)).alias("name"), F.to_json(kept).alias("json"))


class _Markdown(HTMLParser):
    """Headings, paragraphs, lists, emphasis, links, images, tables, quotations and code of a page as markdown."""

    BLOCKS = frozenset("p div section article main header footer nav aside ul ol form figure body html".split())
    SKIPPED = frozenset("script style noscript template svg head".split())
    #: Stand for the spaces and line ends of code, which stay as they are.
    KEPT = {" ": "\ue000", "\n": "\ue001", "\t": "\ue002"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.skipped = self.code = 0
        self.links: list[str] = []
        self.lists: list[int | None] = []  # the last number of an ordered one
        self.quotes: list[int] = []  # where in ``out`` they begin
        self.tables: list[dict] = []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag in self.SKIPPED:
            self.skipped += 1
        elif re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag in ("ul", "ol"):
            self.lists.append(0 if tag == "ol" else None)
            self.out.append("\n\n")
        elif tag in self.BLOCKS:
            self.out.append("\n\n")
        elif tag == "li":
            if self.lists and self.lists[-1] is not None:
                self.lists[-1] += 1
                self.out.append(f"\n{self.lists[-1]}. ")
            else:
                self.out.append("\n* ")
        elif tag == "br":
            self.out.append("  \n")
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("i", "em"):
            self.out.append("*")
        elif tag == "a":
            self.links.append(a.get("href") or "")
            self.out.append("[")
        elif tag == "img":
            self.out.append(f"![{a.get('alt') or ''}]({a.get('src') or ''})")
        elif tag == "pre":
            self.code += 1
            self.out.append("\n\n```\n")
        elif tag == "code" and not self.code:
            self.out.append("`")
        elif tag == "blockquote":
            self.out.append("\n\n")
            self.quotes.append(len(self.out))
        elif tag == "table":
            self.out.append("\n\n")
            self.tables.append({"rows": [], "cell": None})
        elif tag == "tr" and self.tables:
            self._end_cell()
            self.tables[-1]["rows"].append([])
        elif tag in ("td", "th") and self.tables:
            self._end_cell()
            self.tables[-1]["cell"] = len(self.out)

    def handle_endtag(self, tag):
        if tag in self.SKIPPED:
            self.skipped = max(0, self.skipped - 1)
        elif tag in self.BLOCKS or re.fullmatch("h[1-6]", tag):
            if tag in ("ul", "ol") and self.lists:
                self.lists.pop()
            self.out.append("\n\n")
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("i", "em"):
            self.out.append("*")
        elif tag == "a" and self.links:
            self.out.append(f"]({self.links.pop()})")
        elif tag == "pre" and self.code:
            self.code -= 1
            self.out.append("\n```\n\n")
        elif tag == "code" and not self.code:
            self.out.append("`")
        elif tag == "blockquote" and self.quotes:
            said = self._taken(self.quotes.pop())
            self.out.append("\n".join(f"> {line}" if line else ">" for line in self.plain(said).split("\n")) + "\n\n")
        elif tag in ("td", "th", "tr") and self.tables:
            self._end_cell()
        elif tag == "table" and self.tables:
            self._end_cell()
            self._end_table()

    def handle_data(self, data):
        if self.skipped:
            return
        if self.code:
            for c, stands in self.KEPT.items():
                data = data.replace(c, stands)
            self.out.append(data)
        else:
            self.out.append(re.sub(r"\s+", " ", data))

    def _taken(self, at: int) -> str:
        """What was written from a place on, which is taken back."""
        said = "".join(self.out[at:])
        del self.out[at:]
        return said

    def _end_cell(self) -> None:
        table = self.tables[-1]
        if table["cell"] is not None:
            if not table["rows"]:
                table["rows"].append([])
            table["rows"][-1].append(" ".join(self._taken(table["cell"]).split()).replace("|", "\\|"))
            table["cell"] = None

    def _end_table(self) -> None:
        rows = [r for r in self.tables.pop()["rows"] if r]
        width = max(map(len, rows), default=0)
        lines = ["| " + " | ".join(r + [""] * (width - len(r))) + " |" for r in rows]
        if lines:
            lines.insert(1, "|" + " --- |" * width)
        self.out.append("\n".join(lines) + "\n\n")

    @staticmethod
    def plain(said: str) -> str:
        lines = [re.sub(r"[ \t]+", " ", x).strip(" \t\r\f\v") for x in said.split("\n")]
        return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()

    def text(self) -> str:
        while self.tables:  # what nothing closes ends with the page
            self._end_cell()
            self._end_table()
        out = self.plain("".join(self.out))
        for c, stands in self.KEPT.items():
            out = out.replace(stands, c)
        return out


@F.pandas_udf(StringType())
def html_to_markdown(html: pd.Series) -> pd.Series:
    """A page as markdown; null gives the empty text."""

    def one(page: str | None) -> str:
        parser = _Markdown()
        parser.feed(page or "")
        parser.close()
        return parser.text()

    return html.map(one)
