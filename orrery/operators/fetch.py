"""Pages and files over the network: tries, back-off, and what could not be had."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StringType, StructField, StructType

from ..functions import text as T
from .providers import FileFetcher, PageFetcher

#: Attempts at a page, and the seconds waited between two, drawn uniformly.
TRIES, WAIT = 6, (1.0, 3.0)


def in_threads(items: Sequence[Any], call: Callable[[Any], Any], width: int) -> list[Any]:
    """``call`` of every item in order, ``width`` at a time."""
    if width <= 1 or len(items) <= 1:
        return [call(x) for x in items]
    with ThreadPoolExecutor(width) as pool:
        return list(pool.map(call, items))


def attempted(call: Callable[[], Any], tries: int, wait: tuple[float, float]) -> tuple[Any, int, str | None]:
    """What ``call`` gives, the attempts it took and the last error; None once the tries are used up."""
    error = None
    for i in range(1, tries + 1):
        try:
            return call(), i, None
        except Exception as e:  # a fetcher's own errors are unknown here
            error = f"{type(e).__name__}: {e}"
        if i < tries and wait[1] > 0:
            time.sleep(random.uniform(*wait))
    return None, tries, error


def _fetched(df: DataFrame, get: Callable[[str], Any], to: StructField, tries: int, wait: tuple[float, float], width: int) -> DataFrame:
    df = df.drop(to.name, "attempts", "error")  # those of an earlier try

    def one(url: str | None) -> tuple[Any, int, str | None]:
        return (None, 0, "no url") if url is None else attempted(lambda: get(url), tries, wait)

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = in_threads(pdf["url"].tolist(), one, width)
            yield pdf.assign(**{to.name: [x for x, _, _ in found], "attempts": [n for _, n, _ in found], "error": [e for _, _, e in found]})

    return df.mapInPandas(run, StructType([*df.schema.fields, to, StructField("attempts", IntegerType()), StructField("error", StringType())]))


def fetched(urls: DataFrame, fetcher: PageFetcher, tries: int = TRIES, wait: tuple[float, float] = WAIT, width: int = 8) -> DataFrame:
    """``urls`` (``url, ...``) with ``html`` (null when the tries are used up), ``attempts`` and ``error``; no row is dropped."""
    return _fetched(urls, fetcher.fetch, StructField("html", StringType()), tries, wait, width)


def downloaded(links: DataFrame, fetcher: FileFetcher, fmt: str, tries: int = 1, wait: tuple[float, float] = WAIT, width: int = 8) -> DataFrame:
    """``links`` (``url, ...``) with the ``file`` name and its ``content`` (null: skipped), ``attempts`` and ``error``."""
    named = links.withColumn("file", T.download_name(F.col("url"), fmt))
    return _fetched(named, lambda url: fetcher.content(url), StructField("content", BinaryType()), tries, wait, width)


def download_counts(files: DataFrame) -> DataFrame:
    """``total, skipped, managed``: managed are those with content."""
    return files.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("content").isNull()).alias("skipped"), F.count_if(F.col("content").isNotNull()).alias("managed"))
