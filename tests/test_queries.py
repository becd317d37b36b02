"""Every named query against its SQL, on the smallest tables."""

import os
import sys

import duckdb
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from roadpulse.plans.oracles import all_oracles
from roadpulse.plans.queries import all_queries

QUERIES = all_queries()
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    connection.execute("CREATE VIEW events AS SELECT * FROM '/root/testdata/sf0.001/events.parquet'")
    return connection


def _ordered(df):
    df = df[sorted(df.columns)].copy()
    for name in df.columns:
        if str(df[name].dtype).startswith("datetime"):
            df[name] = df[name].astype("datetime64[us]")
        elif df[name].dtype.kind not in "iuf":
            df[name] = df[name].astype(object).where(df[name].notna(), None)
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def test_contract_names_them_all():
    import __spark_entry__ as contract

    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, engine, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = engine.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(want) > 0
    pd.testing.assert_frame_equal(_ordered(got), _ordered(want), check_dtype=False, check_exact=True)


def test_entry(spark):
    import __spark_entry__ as contract

    rows = contract.entry(spark).collect()
    assert {r["table_name"]: r["n_rows"] for r in rows} == {
        t: 1000
        for t in ("vehicle_data", "gps_data", "traffic_data", "weather_data", "emergency_data")
    }
