"""Every registered query against its DuckDB oracle on the small tables."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from playback_qos.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["events"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))  # those of other subpackages have tests of their own
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    rel = con.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    want = canon(rel.columns, rel.fetchall())
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "max_quality" in df.columns
