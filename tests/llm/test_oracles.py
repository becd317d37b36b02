"""Operators that SQL can express, against DuckDB over whole tables."""

import duckdb
import pandas as pd
import pytest

from roadpulse.llm.queries import llm_oracles, llm_queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(llm_oracles()))
def test_against_sql(spark, name):
    engine = duckdb.connect()
    for table in ("documents", "labels"):
        engine.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = engine.execute(llm_oracles()[name]).df()
    got = llm_queries()[name](spark, SF).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    got, want = (df[columns].sort_values(columns).reset_index(drop=True).convert_dtypes() for df in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False)
