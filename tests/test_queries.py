"""Every registered query against its SQL, on the small tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from lingualake.plans import registry

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def rows(df: pd.DataFrame):
    df = df[sorted(df.columns)]
    return sorted(tuple("" if v is None or v != v else str(pd.Timestamp(v)) if "date" in str(t) else str(v) for v, t in zip(r, df.dtypes)) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", list(registry.ENTRIES))
def test_query(spark, duck, name):
    run, sql = registry.ENTRIES[name]
    got = run(spark, DIR).toPandas()
    if sql:
        want = duck.execute(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)
    assert len(got)
