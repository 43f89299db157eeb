"""Every query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import numpy as np
import pytest

from roadglass.plans import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def canon(frame):
    frame = frame[sorted(frame.columns)].copy()
    for c in frame:
        numbers = frame[c].dtype.kind in "fiub"
        frame[c] = frame[c].astype(float).round(9) if numbers else frame[c].map(lambda v: "null" if v is None or v != v else str(v))
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLE_SQL:
        assert len(got)
        return
    want = duck.sql(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    a, b = canon(got), canon(want)
    for c in a:
        assert np.array_equal(a[c].to_numpy(), b[c].to_numpy(), equal_nan=a[c].dtype.kind == "f"), c
