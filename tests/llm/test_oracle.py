"""The queries that SQL can express, against DuckDB at the smallest scale."""

import duckdb
import pytest

from placerank.llm.catalog import ORACLE, QUERIES

from .conftest import SF


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    rel = con.sql(ORACLE[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in got.columns]
    assert sorted(map(tuple, got.collect())) == sorted(tuple(r[i] for i in order) for r in rel.fetchall())
