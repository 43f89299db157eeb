"""Queries over events whose values reach farther than those of the given tables, against DuckDB."""

import datetime

import duckdb
import pytest
from test_queries import canon

from roadglass.plans import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    """Values up to 850, an even and an odd ``k`` for each, and series of two that span 299.99, 300 or 300.01."""
    rows = [(v / 100, 2 * i + k, k, i % 7) for i, v in enumerate(range(0, 85_000, 211)) for k in (0, 1)]
    rows += [(v / 100, 10_000 + 2 * i + j, 1, 100 + i) for i, low in enumerate((*range(0, 20_000, 617), *[0] * 3)) for j, v in enumerate((low, low + 29_999 + i % 3))]
    start = datetime.datetime(2024, 1, 1)
    events = [(i, start + datetime.timedelta(seconds=i), series, "click", v, f'{{"k": {k}}}') for v, i, k, series in rows]
    top = str(tmp_path_factory.mktemp("wide"))
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{top}/events.parquet")
    duck = duckdb.connect()
    duck.sql(f"create view events as select * from '{top}/events.parquet/*.parquet'")
    return top, duck


@pytest.mark.parametrize("name", ["read_imu", "rpy_quat_roundtrip", "time_unit", "unprojection"])
def test_wide_values(spark, wide, name):
    top, duck = wide
    got, want = canon(QUERIES[name](spark, top).toPandas()), canon(duck.sql(ORACLE_SQL[name]).df())
    assert len(got) and got.equals(want)
