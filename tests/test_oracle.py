"""Tier 2: every registered query against its DuckDB oracle on the smallest data."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from scripts.compare_oracle import TABLES, canon

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(entry.oracle_sql()[name])
    want = canon([d[0] for d in res.description], res.fetchall())
    assert got[1] == want[1]
    assert got[0] == want[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "season_pts_rank" in df.columns
