"""Walks over linked pages, level by level: fetch, scan, and go on to what hasn't been seen.

A walk is a folder with a table per level: each page of that level with its tries, error and links in document
order.  The levels together are the set of pages seen, so a page is fetched once however often it is linked, and a walk that
was broken off goes on after its last whole level.  The links of a level, filtered and without what has been seen, are the next
level's pages.  Nothing of a level is gathered at the driver but whether there is one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources import files, markup
from . import fetch
from .providers import PageFetcher

WALKED = "url string, attempts int, error string, links array<string>"

#: Fetches ``url`` rows: the same rows with ``html`` (null: not had), ``attempts`` and ``error``.
Fetch = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Level:
    """Which links of a level's pages are followed, and the address they are fetched at."""

    follows: Callable[[Column], Column] = lambda url: F.lit(True)
    address: Callable[[Column], Column] = lambda url: url


def by_network(fetcher: PageFetcher, **settings) -> Fetch:
    """Pages by a fetcher, tried as ``fetch.fetched`` does."""
    return lambda urls: fetch.fetched(urls, fetcher, **settings)


def from_table(pages: DataFrame) -> Fetch:
    """Pages that are there already (``url, html``, one row each)."""
    known = pages.select("url", "html")
    return lambda urls: urls.join(known, "url", "left").withColumns({"attempts": F.lit(1), "error": F.when(F.col("html").isNull(), F.lit("no such page"))})


def scanned(pages: DataFrame) -> DataFrame:
    """Fetched pages as ``WALKED``: the absolute targets of their anchors instead of the text; images are no links."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [markup.anchors(h, u) for h, u in zip(pdf["html"], pdf["url"])]
            yield pdf[["url", "attempts", "error"]].assign(links=found)

    return pages.select("url", "html", F.col("attempts").cast("int").alias("attempts"), "error").mapInPandas(run, WALKED)


def level(spark: SparkSession, folder: str, number: int) -> DataFrame:
    """The pages of one level of a walk."""
    return spark.read.schema(WALKED).parquet(f"{folder.rstrip('/')}/level={number}")


def seen(spark: SparkSession, folder: str, upto: int) -> DataFrame:
    """``level, url, attempts, error, links`` of the first ``upto`` levels."""
    return reduce(DataFrame.unionByName, [level(spark, folder, i).select(F.lit(i).alias("level"), "*") for i in range(upto)])


def walked(roots: DataFrame, get: Fetch, levels: Sequence[Level], folder: str) -> int:
    """Walk from ``roots`` (``url``) into ``folder``; the number of levels that have pages.

    ``levels`` has one entry for each step from a level to the next, so the walk has one level more, or fewer where nothing
    new is linked.  Null links and roots are passed over.
    """
    spark, folder = roots.sparkSession, folder.rstrip("/")
    frontier = roots.select("url").where("url is not null").distinct()
    for i in range(len(levels) + 1):
        path = f"{folder}/level={i}"
        if not files.exists(spark, f"{path}/_SUCCESS"):
            scanned(get(frontier)).write.mode("overwrite").parquet(path)
        now = level(spark, folder, i)
        if now.isEmpty():
            return i
        if i < len(levels):
            link = F.col("link")
            step = levels[i]
            linked = now.select(F.explode("links").alias("link")).where(step.follows(link)).select(step.address(link).alias("url")).where("url is not null").distinct()
            frontier = linked.join(seen(spark, folder, i + 1).select("url"), "url", "left_anti")
    return len(levels) + 1


def journal_levels(domain: str) -> list[Level]:
    """From a publisher's front page to journals, to issues, to articles."""
    issue = Level(T.is_issue)
    return [Level(lambda u: T.is_journal(u, domain), T.crawl_url), issue]


def article_links(spark: SparkSession, folder: str, roots: DataFrame, domain: str) -> DataFrame:
    """``journal, issue, pos, url`` of a walk by ``journal_levels``: every article link by the way it was reached.

    Pages were fetched once, but a page that is linked twice gives its links twice, as following every link would.
    """
    follow = journal_levels(domain)
    own = [level(spark, folder, i).select(F.col("url").alias("page"), F.posexplode("links").alias("pos", "link")) for i in range(3)]
    first = roots.select(F.col("url").alias("page")).join(own[0], "page").where(follow[0].follows(F.col("link")))
    journals = first.select(T.journal_name(F.col("link")).alias("journal"), follow[0].address(F.col("link")).alias("page"))
    issues = journals.join(own[1], "page").where(follow[1].follows(F.col("link"))).select("journal", F.col("link").alias("page"))
    found = issues.join(own[2], "page").where(T.is_article(F.col("link")) & ~T.is_void(F.col("link")))
    return found.select("journal", F.col("page").alias("issue"), "pos", F.col("link").alias("url"))
