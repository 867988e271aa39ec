"""Queries of the operators against their SQL on the driver's smallest tables."""

import os

import duckdb
import pytest

from threadloom.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_rows_agree(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}{'/*.parquet' if os.path.isdir(f'{SF}/{f}') else ''}'")
    cur = con.execute(queries.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    df = queries.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(cols)
    assert sorted(repr(tuple(r[c] for c in cols)) for r in df.collect()) == sorted(map(repr, cur.fetchall()))
