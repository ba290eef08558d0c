"""Link harvesting: scan, filter, count, and what is new."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def hrefs(pages: DataFrame, exclude_images: bool = True) -> DataFrame:
    """``page_id, pos, url``: every anchor's target in document order, duplicates kept, resolved.

    Covers absolute and root-relative targets in quotes; for anything else use ``sources.html``.
    """
    found = F.posexplode(F.regexp_extract_all("html", F.lit(r'(?is)<a\s[^>]*?href="([^"]*)"'), 1)).alias("pos", "href")
    links = pages.select("page_id", F.col("url").alias("base"), found).select("page_id", "pos", T.resolved(F.col("base"), F.col("href")).alias("url"))
    return links.where(~T.is_image(F.col("url"))) if exclude_images else links


def matching(links: DataFrame, condition: Column | None = None) -> DataFrame:
    """Links that satisfy the condition; all without one."""
    return links if condition is None else links.where(condition)


def articles_per_journal(links: DataFrame) -> DataFrame:
    """Links per journal, duplicates and links without a year counted (journals of one name add up)."""
    return links.groupBy("journal").agg(F.count(F.lit(1)).alias("articles"))


def articles_per_year(links: DataFrame) -> DataFrame:
    year = T.year(F.col("url"))
    return links.withColumn("year", year).where(F.col("year").isNotNull()).groupBy("journal", "year").agg(F.count(F.lit(1)).alias("articles"))


def in_years(counts: DataFrame, first: int, last: int, least: int) -> DataFrame:
    return counts.where(F.col("year").between(first, last) & (F.col("articles") >= least))


def sorted_values(counts: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column, in order."""
    return counts.select(column).distinct().orderBy(column)


def bounds(counts: DataFrame) -> DataFrame:
    return counts.agg(*[f(c).alias(f"{n}_{c}") for c in ("year", "articles") for n, f in (("min", F.min), ("max", F.max))])


def new_links(scraped: DataFrame, existing: DataFrame) -> DataFrame:
    """Scraped links that aren't there yet; repeats within the scrape stay."""
    return scraped.join(existing.select("url").distinct(), "url", "left_anti")


def to_download(links: DataFrame, present: DataFrame, fmt: str) -> DataFrame:
    """Links whose file isn't in the folder yet, with the file's name."""
    return links.withColumn("file", T.download_name(F.col("url"), fmt)).join(present.select("file").distinct(), "file", "left_anti")


def first_then_distinct(links: DataFrame, n: int, order: str) -> DataFrame:
    """The first ``n`` lines, then their distinct URLs (in that order of steps)."""
    return links.orderBy(order).limit(n).select("url").distinct()
