"""A company's pages as one text: which were fetched, in what order, after their navigation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from siftwell.functions.text import blank, let, page_status

RULE = "-" * 50
TRUNCATED = "[...]"


def after_navigation(markdown: Column) -> Column:
    """What follows the last line of a page's navigation, if it is 200 characters or more; else all."""
    lines = F.split(blank(markdown), "\n")
    marked = F.transform(lines, lambda x: F.lower(x).contains("go to **") | F.lower(x).contains("header persistent"))
    back = F.array_position(F.reverse(marked), F.lit(True)).cast("int")  # from the end; 0 if there is none
    at = F.when(back > 0, F.size(lines) - back + 1).otherwise(1)  # so many lines go; the first one always
    rest = F.trim(F.array_join(F.slice(lines, at + 1, F.size(lines)), "\n"), F.lit(" \n\t\r"))
    return F.when(F.char_length(rest) >= 200, rest).otherwise(markdown)


def prepared(markdown: Column) -> Column:
    """struct (action, status, confidence, content): how ``text.page_status`` judges a page, and what of it is
    used: all of a valid page, what follows its navigation of one that is mostly that, else nothing."""
    return let(page_status(markdown), lambda s: F.struct(s["action"].alias("action"), s["status"].alias("status"), s["confidence"].alias("confidence"), F.when(s["status"] == "valid", markdown).when(s["status"] == "nav_dump", after_navigation(markdown)).alias("content")))


def fetched(links: DataFrame, attempts: DataFrame, ranks: list[str]) -> DataFrame:
    """links(company_id, category, position, url) with the first good attempt(url, method, content, status) of
    each, methods in the order of ``ranks``; ``failed`` where there is none."""
    order = F.array_position(F.array(*[F.lit(m) for m in ranks]), F.col("method"))
    good = attempts.where((F.col("status") == "valid") & (order > 0)).groupBy("url").agg(F.min_by(F.struct("content", "method"), order).alias("a"))
    out = links.join(good, "url", "left")
    return out.select("company_id", "category", "position", "url", F.coalesce("a.content", F.lit("failed")).alias("content"), F.coalesce("a.method", F.lit("failed")).alias("method"))


def bundled(pages: DataFrame) -> DataFrame:
    """(company_id, raw_markdown, n_pages, n_failed): the fetched pages under headings, in order.  A
    company has a bounded number of pages (``navigation.pick_links``)."""
    text = F.concat(F.lit("## "), F.upper("category"), F.lit("\n\n"), F.col("content"))
    ok = F.col("content") != "failed"
    parts = F.transform(F.sort_array(F.collect_list(F.when(ok, F.struct("position", text.alias("text"))))), lambda p: p["text"])
    return pages.groupBy("company_id").agg(F.array_join(parts, f"\n\n{RULE}\n\n").alias("raw_markdown"), F.count_if(ok).alias("n_pages"), F.count_if(~ok).alias("n_failed"))


def context(pages: DataFrame, first: str = "welcome", most: int = 16_000) -> DataFrame:
    """(company_id, context): the fetched pages with headings, ``first`` before the others, cut at ``most``
    characters with a mark."""
    order = F.struct((F.col("category") != first).cast("int").alias("late"), "position", F.concat(F.lit("=== "), F.upper("category"), F.lit(" ===\n"), F.col("content")).alias("text"))
    usable = ~F.col("content").isin("failed", "")
    parts = F.transform(F.sort_array(F.collect_list(F.when(usable, order))), lambda p: p["text"])
    joined = pages.groupBy("company_id").agg(F.array_join(parts, "\n\n").alias("c"))
    return joined.select("company_id", F.when(F.char_length("c") > most, F.concat(F.left("c", F.lit(most)), F.lit(f"\n{TRUNCATED}"))).otherwise(F.col("c")).alias("context"))
