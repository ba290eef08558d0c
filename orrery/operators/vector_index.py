"""An index for exact nearest neighbours: vectors by their nearest centroid, with the bounds that let whole cells be skipped.

Centroids are fitted on a bounded sample (how good they are decides how much is skipped, never what is found).
Every vector is stored in its nearest centroid's cell, a folder of its own, with its distance to the centroid; a small table has each
cell's centroid and the smallest and largest of these distances.  For a query ``q`` and a vector ``x`` of a cell with centroid ``c``
the triangle inequality gives ``|d(q, c) - d(x, c)| <= d(q, x)``.  A first pass over the cells nearest to each query
finds an upper bound of its ``k``-th distance; the second reads only cells, and of those only vectors, that the bound allows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.shared import discarded, written
from .retrieve import nearest_pairs

#: Vectors that the centroids are fitted on at most, and the rounds of that; pairs of queries and rows held at once.
SAMPLE, ROUNDS, CELLS = 20_000, 8, 1 << 22
#: Cells that a query looks into first; distances are compared with this much room for rounding.
FIRST, ROOM = 2, 1e-9
#: Vectors of a cell that meet its queries in one task; tasks that write a cell.
BLOCK, WRITERS = 1 << 16, 8

_CELL = "cell int, centroid array<double>, near double, far double, n long"
_FOUND = "query_id long, id long, distance double"


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows to all centroids, a block of rows at a time by differences, so equal ones are 0."""
    out = np.empty((len(x), len(c)))
    width = max(1, CELLS // max(1, c.size))
    for a in range(0, len(x), width):
        out[a : a + width] = np.sqrt(((x[a : a + width, None, :] - c[None]) ** 2).sum(axis=2))
    return out


def fitted(vectors: DataFrame, cells: int, sample: int = SAMPLE, rounds: int = ROUNDS) -> np.ndarray:
    """At most ``cells`` centroids by Lloyd's rounds over the ``sample`` rows whose ids' hashes are smallest."""
    rows = vectors.select("id", "embedding").orderBy(F.xxhash64("id"), "id").limit(sample)  # each task keeps its own first rows
    x = np.array([r["embedding"] for r in rows.collect()], float)
    if not len(x):
        return np.zeros((0, 0))
    x = np.unique(x, axis=0)
    rng = np.random.default_rng(0)
    c = x[rng.choice(len(x), min(cells, len(x)), replace=False)]
    for _ in range(rounds):
        own = _distances(x, c).argmin(axis=1)
        sums, counts = np.zeros_like(c), np.bincount(own, minlength=len(c))
        np.add.at(sums, own, x)
        c = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], c)
    return c


def build(vectors: DataFrame, path: str, cells: int | None = None) -> None:
    """Write the index of ``vectors`` (``id, embedding, ...``; nulls left out) to a new folder; about the square root of their number is the usual ``cells``."""
    spark, path = vectors.sparkSession, path.rstrip("/")
    vectors = vectors.where("id is not null and embedding is not null")
    cells = cells or max(1, min(4096, int(vectors.count() ** 0.5)))
    held = spark.sparkContext.broadcast(fitted(vectors, cells))

    def placed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            d = _distances(np.array(pdf["embedding"].tolist(), float), held.value)
            own = d.argmin(axis=1)
            yield pd.DataFrame({"id": pdf["id"], "embedding": pdf["embedding"], "away": d[np.arange(len(d)), own], "cell": own.astype(np.int32)})

    found = vectors.select(F.col("id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInPandas(placed, "id long, embedding array<double>, away double, cell int")
    # a cell may hold any share of the rows: its rows go to many tasks and files
    found.repartition("cell", F.pmod(F.xxhash64("id"), F.lit(WRITERS))).write.mode("errorifexists").partitionBy("cell").parquet(f"{path}/vectors")
    stored = spark.read.schema("id long, embedding array<double>, away double, cell int").parquet(f"{path}/vectors")
    centroids = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(held.value)], "cell int, centroid array<double>")
    bounds = stored.groupBy("cell").agg(F.min("away").alias("near"), F.max("away").alias("far"), F.count(F.lit(1)).alias("n"))
    centroids.join(bounds, "cell").select("cell", "centroid", "near", "far", "n").coalesce(1).write.parquet(f"{path}/cells")


def cells_of(spark: SparkSession, path: str) -> DataFrame:
    """``cell, centroid, near, far, n``: a row for each cell that has vectors."""
    return spark.read.schema(_CELL).parquet(f"{path.rstrip('/')}/cells")


def vectors_of(spark: SparkSession, path: str) -> DataFrame:
    """``id, embedding, away, cell`` of all vectors; a filter on ``cell`` reads only those folders."""
    return spark.read.schema("id long, embedding array<double>, away double, cell int").parquet(f"{path.rstrip('/')}/vectors")


def _asked(queries: DataFrame, cells: pd.DataFrame) -> DataFrame:
    """``query_id, query, cell, apart, least``: each query with each cell, its distance to the centroid and to anything in the cell at least."""
    held = queries.sparkSession.sparkContext.broadcast((np.array(cells["centroid"].tolist(), float), cells["near"].to_numpy(), cells["far"].to_numpy(), cells["cell"].to_numpy(np.int32)))

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c, near, far, number = held.value
        for pdf in batches:
            for a in range(0, len(pdf), 64):
                part = pdf.iloc[a : a + 64]
                d = _distances(np.array(part["query"].tolist(), float), c)
                least = np.maximum(0, np.maximum(d - far, near - d))
                order = np.argsort(np.argsort(np.where(least > 0, least, d - far), axis=1, kind="stable"), axis=1)
                yield pd.DataFrame({
                    "query_id": np.repeat(part["query_id"].to_numpy(), len(c)), "query": [q for q in part["query"] for _ in range(len(c))],
                    "cell": np.tile(number, len(part)), "apart": d.ravel(), "least": least.ravel(), "turn": order.ravel(),
                })

    return queries.mapInPandas(run, "query_id long, query array<double>, cell int, apart double, least double, turn int")


def _met(vectors: DataFrame, asked: DataFrame, sizes: DataFrame, k: int) -> DataFrame:
    """``query_id, id, distance``: the ``k`` nearest of the vectors of the cells that each query asks, cell by cell and in blocks of each.

    ``asked`` has ``query_id, query, cell, apart, bound``: vectors that the bound rules out aren't compared.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    queries = asked.join(sizes, "cell").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).drop("n")
    rows = vectors.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int")).drop("n")

    def run(base: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if len(base) and len(own):
            ids, x, away = base["id"].to_numpy(np.int64), np.array(base["embedding"].tolist(), float), base["away"].to_numpy()
            bound, apart = np.sqrt(own["bound"].to_numpy()), own["apart"].to_numpy()
            room = ROOM * (1 + apart)
            parts = []
            for i, (q, name) in enumerate(zip(own["query"], own["query_id"])):
                at = np.flatnonzero(np.abs(away - apart[i]) <= bound[i] + room[i])
                if len(at):
                    parts.append(nearest_pairs(ids[at], x[at], np.array([name]), np.array([q], float), k))
            if parts:
                found = [np.concatenate(p) for p in zip(*parts)]
        return pd.DataFrame(dict(zip(("query_id", "id", "distance"), found)))

    return rows.groupBy("cell", "block").cogroup(queries.groupBy("cell", "block")).applyInPandas(run, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def search(spark: SparkSession, path: str, queries: DataFrame, k: int = 6) -> DataFrame:
    """``query_id, rank, id, distance``: the exact ``k`` nearest vectors of the index (squared L2, ties by id) of ``queries`` (``query_id, embedding``).

    A null query has no neighbours.  The centroids (at most some thousand) are broadcast; a cell's vectors and the queries that
    ask it meet in blocks.
    """
    cells = cells_of(spark, path).toPandas()
    asked = queries.where("query_id is not null and embedding is not null").select(F.col("query_id").cast("long").alias("query_id"), F.col("embedding").cast("array<double>").alias("query"))
    if not len(cells):
        return spark.createDataFrame([], "query_id long, rank int, id long, distance double")
    pairs = written(_asked(asked, cells), "asked")
    sizes = F.broadcast(spark.createDataFrame(cells[["cell", "n"]], "cell int, n long"))  # a row for each centroid
    # the first cells in turn that together hold k vectors, and two at least
    before = F.sum("n").over(Window.partitionBy("query_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1))
    first = pairs.join(sizes, "cell").withColumn("before", F.coalesce(before, F.lit(0))).where((F.col("turn") < FIRST) | (F.col("before") < k))
    unbound = F.lit(float("inf"))
    near = written(_met(_read(spark, path, first), first.select("query_id", "query", "cell", "apart", unbound.alias("bound")), sizes, k), "near")
    bounds = _best(near, k).groupBy("query_id").agg(F.when(F.count(F.lit(1)) == k, F.max("distance")).otherwise(unbound).alias("bound"))
    seen = first.select("query_id", "cell")
    rest = pairs.join(seen, ["query_id", "cell"], "left_anti").join(bounds, "query_id").where(F.col("least") <= F.sqrt("bound") * (1 + ROOM) + ROOM * (1 + F.col("apart")))
    rest = written(rest.select("query_id", "query", "cell", "apart", "bound"), "rest")
    found = written(_best(near.unionByName(_met(_read(spark, path, rest), rest, sizes, k)), k).select("query_id", "rank", "id", "distance"), "found")
    discarded(pairs, near, rest)
    return found


def _read(spark: SparkSession, path: str, asked: DataFrame) -> DataFrame:
    """The vectors of the cells that some query asks; the other folders aren't opened."""
    wanted = [r["cell"] for r in asked.select("cell").distinct().collect()]  # as many as there are cells at most
    return vectors_of(spark, path).where(F.col("cell").isin(wanted) if wanted else F.lit(False))


def share_read(spark: SparkSession, path: str, queries: DataFrame, k: int = 6) -> float:
    """The share of all pairs of a query and a cell that ``search`` looks into, to tell how well the cells fit."""
    cells = cells_of(spark, path).toPandas()
    asked = queries.select(F.col("query_id").cast("long").alias("query_id"), F.col("embedding").cast("array<double>").alias("query"))
    found = search(spark, path, queries, k).groupBy("query_id").agg(F.when(F.count(F.lit(1)) == k, F.max("distance")).otherwise(F.lit(float("inf"))).alias("bound"))
    pairs = _asked(asked, cells).join(found, "query_id")
    r = pairs.agg(F.count_if((F.col("turn") < FIRST) | (F.col("least") <= F.sqrt("bound"))).alias("read"), F.count(F.lit(1)).alias("all")).first()
    return r["read"] / r["all"] if r["all"] else 0.0
