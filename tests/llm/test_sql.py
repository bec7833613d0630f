"""The queries that SQL can express, against DuckDB on the smallest tables."""

import duckdb
import pytest

from plover.llm import oracle, queries
from scripts.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.Q))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(oracle.Q[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols) and rows_of(df.columns, got) == rows_of(cols, cur.fetchall())
