"""Exact quantiles over ranges against Spark's own aggregate."""

import random

import pytest
from pyspark.sql import functions as F

from orrery.operators import report
from orrery.operators.quantiles import CUTS, _part, exact_quantiles

SHARES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(1)
    made = [(None if i % 3 == 0 else f"g{i % 3}", rng.choice([0.0, 1.0, rng.gauss(0, 1e3), rng.random(), 1e300, -0.0])) for i in range(3000)]
    made += [("hot", 5.0)] * 900 + [("hot", 7.0)] * 2 + [("two", float(i % 2)) for i in range(800)] + [("few", 3.0), ("none", None), ("nan", float("nan")), ("nan", 1.0)]
    return spark.createDataFrame(made, "k string, x double").repartition(4).cache()


@pytest.mark.parametrize("most", [10, 300, 1 << 20])
def test_equal_to_the_aggregate(rows, most):
    want = {r.k: r.q for r in rows.where("x is not null").groupBy("k").agg(F.percentile("x", SHARES).alias("q")).collect()}
    found = exact_quantiles(rows, ["k"], "x", SHARES, most=most).collect()
    plain = lambda q: str([x + 0.0 for x in q])  # noqa: E731  -0.0 is 0.0
    assert len(found) == len(want) and all(plain(r.quantiles) == plain(want[r.k]) for r in found)


def test_without_groups_and_without_rows(spark, rows):
    (r,) = exact_quantiles(rows, [], "x", [0.5], most=50).collect()
    assert r.quantiles == rows.agg(F.percentile("x", [0.5]).alias("q")).first().q
    assert exact_quantiles(rows.where("false"), ["k"], "x", [0.5]).collect() == []
    (d,) = report.described(rows.where("false"), ["x"]).collect()
    assert d.n == 0 and d.q50 is None and d.mean is None


def test_parts_by_bisection(spark):
    cuts = sorted({float(i * i) for i in range(CUTS)})
    df = spark.range(300).select((F.col("id") * 1.0).alias("v"), F.lit(cuts).alias("cuts")).select("v", _part(F.col("cuts"), F.col("v")).alias("p"), _part(F.lit([9.0, 20.0]), F.col("v")).alias("q"))
    for r in df.collect():
        assert r.p == 2 * sum(c < r.v for c in cuts) + (r.v in cuts)
        assert r.q == 2 * sum(c < r.v for c in (9, 20)) + (r.v in (9, 20))
