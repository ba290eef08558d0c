"""Exact quantiles by distributed selection.

A quantile lies between two ranks of its group.  Ranges that hold more than ``RANGE`` values are cut at values from a
mergeable sketch, the values of each part are counted (a cut's own value is a part of its own), and only parts
that hold a wanted rank go on to the next round.  Ranges that are small enough are ranked, equal values counted first.  So no
task orders more than one range, whatever the number of rows or how many of them are equal.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import discarded, written

#: Values that one task ranks; cuts of a larger range (one less than a power of two), and the sketch's accuracy.
RANGE, CUTS, ACCURACY = 1 << 15, 255, 2560


def _part(cuts: Column, v: Column) -> Column:
    """``2 i`` for values between the cuts ``i - 1`` and ``i``, ``2 i + 1`` for cut ``i`` itself; by bisection."""
    steps = [1 << b for b in reversed(range(CUTS.bit_length()))]
    below = lambda i, s: F.get(cuts, i + s - 1) < v  # noqa: E731  null past the end: false
    i = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda i, s: i + F.when(below(i, s), s).otherwise(0))
    return F.get(F.transform(F.array(i), lambda i: 2 * i + F.when(F.get(cuts, i) == v, 1).otherwise(0)), F.lit(0))


def _within(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """The rows inside the open ranges of their group."""
    inside = (F.col("low").isNull() | (F.col("v") > F.col("low"))) & (F.col("high").isNull() | (F.col("v") < F.col("high")))
    return rows.join(ranges, "g").where(inside)


def _ranked(rows: DataFrame, ranges: DataFrame, wanted: DataFrame) -> DataFrame:
    """``g, rank, v`` of the wanted ranks in ranges that one task can rank."""
    key = ["g", "low", "high", "before"]
    counted = _within(rows, ranges).groupBy(*key, "v").agg(F.count(F.lit(1)).alias("k"))
    upto = F.col("before") + F.sum("k").over(Window.partitionBy(*key).orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    return counted.select("g", "v", (upto - F.col("k")).alias("from"), upto.alias("to")).join(wanted, "g").where("rank >= from and rank < to").select("g", "rank", "v")


def _parts(rows: DataFrame, ranges: DataFrame, wanted: DataFrame) -> DataFrame:
    """``g, low, high, before, n, point`` of the parts of the ranges that hold a wanted rank; ``point`` is a cut's own value."""
    key = ["g", "low", "high", "before"]
    inside = _within(rows, ranges.drop("n"))
    shares = F.array(*[F.lit(i / (CUTS + 1)) for i in range(1, CUTS + 1)])
    cuts = written(inside.groupBy(*key).agg(F.sort_array(F.array_distinct(F.percentile_approx("v", shares, ACCURACY))).alias("cuts")), "cuts")
    c, part = F.col("cuts"), F.col("part")
    counted = _within(rows, cuts).withColumn("part", _part(c, F.col("v"))).groupBy(*key, "part").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, 0))  # 2 CUTS + 1 rows
    placed = counted.withColumn("from", F.col("before") + upto - F.col("n")).join(cuts.select("g", F.col("before"), "cuts"), ["g", "before"])
    i = F.floor(part / 2).cast("int")
    point = F.when(part % 2 == 1, F.get(c, i))
    low, high = F.when(i > 0, F.get(c, F.greatest(i - 1, F.lit(0)))), F.get(c, i)
    parts = placed.select("g", F.coalesce(low, "low").alias("low"), F.coalesce(high, "high").alias("high"), F.col("from").alias("before"), "n", point.alias("point"))
    held = parts.join(wanted, "g").where("rank >= before and rank < before + n").select(parts.columns).distinct()
    out = written(held, "ranges")
    discarded(cuts)
    return out


def selected(rows: DataFrame, wanted: DataFrame, counts: DataFrame, most: int = RANGE) -> DataFrame:
    """``g, rank, v``: the values of ``rows`` (``g, v``) at the wanted ranks (``g, rank``, from 0); ``counts`` has ``g, n``."""
    none = F.lit(None).cast("double")
    ranges = written(counts.select("g", none.alias("low"), none.alias("high"), F.lit(0).cast("long").alias("before"), "n"), "ranges")
    found, tables = [], [ranges]
    while True:
        found.append(_ranked(rows, ranges.where(F.col("n") <= most).drop("n"), wanted))
        large = ranges.where(F.col("n") > most)
        if large.isEmpty():
            break
        parts = _parts(rows, large, wanted)
        points = parts.where("point is not null").join(wanted, "g").where("rank >= before and rank < before + n")
        found.append(points.select("g", "rank", F.col("point").alias("v")))
        tables.append(parts)
        ranges = parts.where("point is null").drop("point")
    out = written(reduce(DataFrame.union, found), "found")
    discarded(*tables)
    return out


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, shares: Sequence[float], to: str = "quantiles", most: int = RANGE) -> DataFrame:
    """``by`` and an array of the value's quantiles in each group, linearly interpolated between ranks; nulls don't count.

    Groups with nulls only have none.  NaN is larger than all numbers.
    """
    g = F.struct(*by) if by else F.lit(0)
    rows = df.where(F.col(value).isNotNull()).select(g.alias("g"), F.col(value).cast("double").alias("v"))
    counts = written(rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")), "counts")
    each = counts.select("g", F.posexplode(F.array(*map(F.lit, shares))).alias("i", "share"), "n").withColumn("at", F.col("share").cast("double") * (F.col("n") - 1))
    wanted = written(each.select("g", "i", "at", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))).alias("rank")), "wanted")
    values = selected(rows, wanted.select("g", "rank").distinct(), counts, most)
    both = wanted.join(values, ["g", "rank"]).groupBy("g", "i", "at").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    between = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise((F.ceil("at") - F.col("at")) * F.col("low") + (F.col("at") - F.floor("at")) * F.col("high"))
    whole = both.groupBy("g").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", between.alias("q")))), lambda x: x["q"]).alias(to))  # one value a share
    return whole.select(*[F.col("g")[b].alias(b) for b in by], to)
