"""Registered queries against their DuckDB oracle SQL on sf0.001 (the driver's gate, in small)."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
NAMES = ["region_filter", "region_profile", "profile_by_entity", "entity_pairing", "time_align_join",
         "skewed_align", "asof_forward", "weather_wide", "csv_scan_headers", "merged_rows", "pa_fit_entity",
         "model_compare", "stream_profile"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]
