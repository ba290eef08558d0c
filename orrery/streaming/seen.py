"""What is new in a stream of pages: the links, and the files to download, that no earlier increment had.

Each link (and each file name) is a key of the query's state, which Spark keeps in partitions by the key and takes from the
checkpoint after a failure.  An increment's rows of one key are added up before the shuffle, so a link on every page is a row a task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import text as T
from ..operators import links

PAGES = "page_id long, url string, html string"
#: ``new``: occurrences in the increment that had the key first; ``skipped``: occurrences in this increment of a key that was there already.
SEEN = "kind string, key string, new long, skipped long"


def pages(spark: SparkSession, folder: str, files_at_once: int | None = None) -> DataFrame:
    """A stream of the pages in the Parquet files of a folder, as they arrive."""
    read = spark.readStream.schema(PAGES)
    return (read.option("maxFilesPerTrigger", files_at_once) if files_at_once else read).parquet(folder)


def _counted(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pdf.groupby(["kind", "key"], as_index=False).size().rename(columns={"size": "n"})


def _told(key: tuple[str, str], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    n = sum(int(p["n"].sum()) for p in parts)
    new = not state.exists
    state.update((True,))
    yield pd.DataFrame({"kind": [key[0]], "key": [key[1]], "new": [n if new else 0], "skipped": [0 if new else n]})


def seen(stream: DataFrame, fmt: str = "pdf") -> DataFrame:
    """``SEEN`` rows of every increment of a stream of pages: its links, and the files that its article links name."""
    found = links.hrefs(stream)
    url = F.col("url")
    file = F.when(T.is_article(url) & ~T.is_void(url), T.download_name(url, fmt))
    both = found.select(F.inline(F.array(F.struct(F.lit("link").alias("kind"), url.alias("key")), F.struct(F.lit("file").alias("kind"), file.alias("key"))))).where("key is not null")
    counted = both.mapInPandas(_counted, "kind string, key string, n long")
    return counted.groupBy("kind", "key").applyInPandasWithState(_told, SEEN, "seen boolean", "append", GroupStateTimeout.NoTimeout)


def counters(rows: DataFrame) -> DataFrame:
    """``kind, keys, new, skipped``: how many keys came up first, and the occurrences on either side."""
    return rows.groupBy("kind").agg(F.count_if(F.col("new") > 0).alias("keys"), F.sum("new").alias("new"), F.sum("skipped").alias("skipped"))
