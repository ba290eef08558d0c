"""The vector index against brute force, and how much of it a search leaves out."""

import numpy as np
import pytest

from orrery.operators import vector_index as V


def brute(rows, queries, k):
    out = []
    for name, q in queries:
        near = sorted((float(((np.array(v) - np.array(q)) ** 2).sum()), i) for i, v in rows)[:k]
        out += [(name, rank + 1, i, d) for rank, (d, i) in enumerate(near)]
    return sorted(out)


def both(spark, path, rows, queries, k):
    V.build(spark.createDataFrame(rows + [(10**6, None), (None, [0.0] * len(rows[0][1]))], "id long, embedding array<double>"), path, 8)
    asked = spark.createDataFrame(queries, "query_id long, embedding array<double>")
    found = sorted((r.query_id, r["rank"], r.id, r.distance) for r in V.search(spark, path, asked, k).collect())
    want = brute(rows, queries, k)
    assert [f[:3] for f in found] == [w[:3] for w in want] and [f[3] for f in found] == pytest.approx([w[3] for w in want])
    return asked


def test_clusters_are_skipped(spark, tmp_path):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 6)) * 50
    rows = [(i, (centres[i % 8] + rng.normal(size=6)).tolist()) for i in range(240)]
    queries = [(i, rows[i][1]) for i in range(0, 240, 20)]
    asked = both(spark, f"{tmp_path}/i", rows, queries, 5)
    assert V.share_read(spark, f"{tmp_path}/i", asked, 5) < 0.5
    cells = V.cells_of(spark, f"{tmp_path}/i")
    assert cells.count() <= 8 and {r.cell for r in cells.collect()} == {r.cell for r in V.vectors_of(spark, f"{tmp_path}/i").select("cell").distinct().collect()}


@pytest.mark.parametrize("k", [1, 6, 500])
def test_ties_repeats_and_large_k(spark, tmp_path, monkeypatch, k):
    monkeypatch.setattr(V, "BLOCK", 16)
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(0, 3, 3).astype(float).tolist()) for i in range(100)] + [(1000 + i, [1.0, 1.0, 1.0]) for i in range(40)]
    queries = [(0, [1.0, 1.0, 1.0]), (1, [9.0, 0.0, 0.0]), (2, rows[5][1]), (3, [0.5, 0.5, 0.5])]
    both(spark, f"{tmp_path}/i", rows, queries, k)


def test_nothing_indexed_or_asked(spark, tmp_path):
    empty = spark.createDataFrame([], "id long, embedding array<double>")
    V.build(empty, f"{tmp_path}/i")
    asked = spark.createDataFrame([(1, [0.0])], "query_id long, embedding array<double>")
    assert V.search(spark, f"{tmp_path}/i", asked).collect() == []
    V.build(spark.createDataFrame([(1, [0.0])], "id long, embedding array<double>"), f"{tmp_path}/j")
    assert V.search(spark, f"{tmp_path}/j", asked.where("false")).collect() == []
    assert [tuple(r) for r in V.search(spark, f"{tmp_path}/j", asked).collect()] == [(1, 1, 1, 0.0)]
