"""Every query with SQL returns the same rows as DuckDB on the small tables; the others return rows."""

import math

import duckdb
import pytest

from orrery.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    return v


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    rows = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    if name not in catalog.ORACLES:
        assert rows
        return
    found = duck.execute(catalog.ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert rows == sorted((tuple(_plain(r[i]) for i in at) for r in found.fetchall()), key=repr)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
