"""Queries that SQL can express, against DuckDB."""

import duckdb

from cytoframe.llm import queries


def test_oracle(spark, small):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.sql(f"create view {table} as from '{small}/{table}.parquet'")
    for name, sql in queries.oracle_sql().items():
        want = con.sql(sql)
        got = queries.queries()[name](spark, small)
        cols = sorted(got.columns)
        assert sorted(want.columns) == cols
        assert sorted(map(repr, (tuple(r[c] for c in cols) for r in got.collect()))) == sorted(map(repr, want.select(", ".join(cols)).fetchall()))
