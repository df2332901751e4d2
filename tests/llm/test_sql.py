"""The training-data queries that SQL can express, against DuckDB on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from quillwork.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in "documents embeddings pages benchmark".split():
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    found = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    df = queries.queries()[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(columns).collect()), key=repr) == sorted(found.fetchall(), key=repr)
