"""Every query of the library against its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from stratus.plans import catalogue

DATA = os.environ.get("STRATUS_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(p).split('.')[0]} as select * from read_parquet('{p}')")
    return con


def rows_of(frame):
    cols = sorted(frame.columns)
    return cols, sorted((tuple(None if pd.isna(v) else v for v in r) for r in frame[cols].astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(name, spark, duck):
    got = catalogue.queries()[name](spark, DATA)
    cols, rows = rows_of(got.toPandas())
    if name not in catalogue.oracle_sql():
        assert rows
        return
    want_cols, want = rows_of(duck.execute(catalogue.oracle_sql()[name]).df())
    assert cols == want_cols
    assert len(rows) == len(want)
    for a, b in zip(rows, want, strict=True):
        assert [x if not isinstance(x, float) else pytest.approx(x, abs=2e-6, rel=1e-9) for x in b] == list(a)
