"""The registered queries: against DuckDB where SQL can express them, else their shape over whole tables."""

import duckdb
import pytest

from scripts.oracle_check import TABLES, digest
from tidemark.llm.common import table
from tidemark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
LOOKS_AT = {"op3": "documents", "op5": "documents", "op6": "documents", "op7": "documents", "op8": "documents", "op10": "embeddings",
            "op13": "documents"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(df.columns)
    assert digest(df.columns, rows)[0] == digest(columns, res.fetchall())[0]


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.split("_")[0] in LOOKS_AT))
def test_one_row_for_each_input_row(spark, name):
    source = table(spark, SF, LOOKS_AT[name.split("_")[0]])
    key = "vec_id" if "vec_id" in source.columns else "doc_id"
    got = QUERIES[name](spark, SF)
    assert sorted(r[0] for r in got.select(key).collect()) == sorted(r[0] for r in source.select(key).collect())


def test_entry_registers_all(spark):
    import __spark_entry__

    assert {f"op{i}" for i in range(1, 14)} <= {n.split("_")[0] for n in __spark_entry__.queries()}
    assert "pipeline" in __spark_entry__.queries()
