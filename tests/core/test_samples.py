"""Samples by group against all hashes in order; nearest points of far clouds against all pairs."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadglass.operators import camera, series, spatial


@pytest.mark.parametrize("n", [0, 1, 37, 100_000])
@pytest.mark.parametrize("by", [(), ("g",), ("g", "h")])
def test_a_sample_has_the_smallest_hashes_of_its_group(spark, n, by):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"), (F.col("id") % 2 == 0).alias("h")).repartition(5)
    got = series.sample(rows, ["id"], n, 5, by)
    assert got.columns == rows.columns
    all_ = {}
    for r in rows.withColumn("x", F.xxhash64("id", F.lit(5))).collect():
        all_.setdefault(tuple(r[c] for c in by), []).append((r["x"], r["id"]))
    want = sorted(i for part in all_.values() for _, i in sorted(part)[:n])
    assert sorted(r["id"] for r in got.collect()) == want


def test_rows_that_repeat_a_key_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, "a")] * 30 + [(2, "a")] * 30, "id long, g string")
    assert series.sample(rows, ["id"], 40, 0, ["g"]).count() == 40
    assert series.sample(rows.where("false"), ["id"], 4, 0, ["g"]).count() == 0 and series.sample(rows.where("false"), ["id"], 4).count() == 0


def test_a_crop_keeps_so_many_of_each_scan(spark):
    points = spark.range(4000).select("id", (F.col("id") % 4).alias("scan"), (F.col("id") % 50 / 100.0).alias("x"), F.lit(0.1).alias("y"), F.lit(2.0).alias("z"))
    got = camera.frustum_crop(points, [100, 100, 50, 50], 100, 100, cap=25, key=["id"], by=["scan"])
    assert {r["scan"]: r["count"] for r in got.groupBy("scan").count().collect()} == {i: 25 for i in range(4)}


def cloud(spark, p, first=0):
    return spark.createDataFrame([(first + i, *map(float, x)) for i, x in enumerate(p)], "id long, x double, y double, z double")


def brute(a, b):
    d = np.sqrt(((a[:, None] - b[None]) ** 2).sum(-1))
    return d.argmin(1), d.min(1)


@pytest.fixture
def checkpoints(spark, tmp_path):
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path))


@pytest.mark.parametrize("shift, n", [(0.0, 300), (7.0, 700), (100.0, 1500)])
def test_nearest_of_far_clouds(spark, checkpoints, shift, n):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(n // 2, 3)), rng.normal(size=(n, 3)) * [1, 3, 0.1] + shift
    b[: n // 10] = b[0]  # copies of one place
    got = {r["left_id"]: (r["right_id"], r["d"]) for r in spatial.nearest_any(cloud(spark, a), cloud(spark, b), 0.3, "id", "id").collect()}
    at, d = brute(a, b)
    assert len(got) == len(a)
    assert all(got[i] == (j, pytest.approx(x, rel=1e-12)) for i, (j, x) in enumerate(zip(at.tolist(), d.tolist())))


def test_two_rows_and_points_that_are_not_finite(spark, checkpoints):
    left = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (2, 1e6, 0.0, 0.0), (3, None, 0.0, 0.0), (4, float("nan"), 0.0, 0.0)], "id long, x double, y double, z double")
    right = spark.createDataFrame([(8, 1e6, 1.0, 0.0), (7, 1e6, 1.0, 0.0), (9, float("inf"), 0.0, 0.0)], "id long, x double, y double, z double")
    began = time.time()
    got = {r["left_id"]: (r["right_id"], r["d"]) for r in spatial.nearest_any(left, right, 0.01, "id", "id").collect()}
    assert got == {1: (7, (1e12 + 1) ** 0.5), 2: (7, 1.0)} and time.time() - began < 60
    assert spatial.nearest_any(left, right.where("false"), 0.01, "id", "id").count() == 0


def test_large_clouds_far_apart(spark, checkpoints):
    rng = np.random.default_rng(4)
    a, b = rng.uniform(size=(20_000, 3)) * 10, rng.uniform(size=(20_000, 3)) * 10 + [100, 0, 0]
    began = time.time()
    got = spatial.nearest_any(cloud(spark, a).repartition(4), cloud(spark, b).repartition(4), 0.5, "id", "id").toPandas().set_index("left_id").sort_index()
    took = time.time() - began
    at, d = brute(a[:500], b)
    assert len(got) == 20_000 and (got["right_id"].to_numpy()[:500] == at).all() and np.allclose(got["d"].to_numpy()[:500], d, rtol=1e-12)
    assert took < 120, took
    print("seconds", took)
