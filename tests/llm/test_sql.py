"""Queries that SQL can express, against DuckDB on the small tables."""

import duckdb
import pandas as pd
import pytest

from touchline.llm.queries import QUERIES, SQL

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DIR}/{t}.parquet')")
    got, want = QUERIES[name](spark, DIR).toPandas(), con.execute(SQL[name]).df()
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    order = lambda d: d[cols].sort_values(cols).reset_index(drop=True)
    pd.testing.assert_frame_equal(order(got), order(want), check_dtype=False)
