"""Every registered query against its DuckDB oracle on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from scripts.oracle_check import TABLES, digest
from tidemark.plans.oracles import ORACLES
from tidemark.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(oracle_sql()[name])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    assert len(s_rows) == len(o_rows)
    assert digest(df.columns, s_rows)[0] == digest(o_cols, o_rows)[0]


_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_column_types_match_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    spark_types = {f.name: _DUCK.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
                   for f in df.schema}
    rel = con.sql(oracle_sql()[name])
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["window_start", "window_end", "rank", "category_code", "event_count"]
    assert df.count() > 0
