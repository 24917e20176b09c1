"""Registered queries against their SQL in DuckDB on the smallest tables."""

import math
import os

import pytest

from statuta.plans import registry

DIR = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return str(v) if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for f in os.listdir(DIR):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DIR}/{f}'").fetchall()
    return c


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    ours = sorted(repr(tuple(plain(v) for v in r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    relation = duck.sql(registry.SQL[name])
    assert sorted(relation.columns) == columns
    order = [relation.columns.index(c) for c in columns]
    theirs = sorted(repr(tuple(plain(r[i]) for i in order)) for r in relation.fetchall())
    assert ours == theirs


def test_flagship(spark):
    assert registry.flagship(spark, DIR).count() == 1500
    assert len(registry.QUERIES["gazette_export"](spark, DIR).columns) == 34
