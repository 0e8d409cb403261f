"""The training-data queries that SQL can express, against DuckDB on the sf0.001 tables."""

import duckdb
import pytest

from pricelake.llm.queries import ORACLES, QUERIES

from .messy import by_row

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    out = QUERIES[name](spark, SF)
    assert sorted(out.columns) == sorted(columns)
    assert by_row(map(tuple, out.select(columns).collect())) == by_row(result.fetchall())
