"""The operators' queries against their DuckDB SQL, where SQL can express them."""

import duckdb
import pytest

from playback_qos.llm.queries import LLM_ORACLE_SQL, LLM_QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(LLM_ORACLE_SQL))
def test_query_matches_sql(spark, con, name):
    df, rel = LLM_QUERIES[name](spark, SF), con.sql(LLM_ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(columns).collect()), key=repr)
    assert got == sorted(rel.select(*columns).fetchall(), key=repr)


def test_all_operators_are_registered():
    from __spark_entry__ import queries

    names = {x.split("_")[0] for x in LLM_QUERIES}
    assert names == {f"op{n}" for n in range(1, 14)} and {*LLM_QUERIES, "pipeline"} <= set(queries())
