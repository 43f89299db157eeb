"""Operators on long series, far points, odd input: results and time."""

import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadglass.functions import geo, text
from roadglass.operators import maneuvers, relational, reports, series, spatial
from roadglass.plans.relations import _checkpoints


def test_as_of_over_one_long_series_in_linear_time(spark):
    n = 200_000
    rows = spark.range(n, numPartitions=4)
    left = rows.select(F.lit(1).alias("s"), (F.col("id") * 10).alias("t"), "id")
    right = rows.select(F.lit(1).alias("s"), (F.col("id") * 15 + 3).alias("t"), F.col("id").alias("v"), (F.col("id") * 1.5).alias("x"))
    began = time.time()
    got = series.asof(left, right, ["s"], ["v"], direction="nearest").agg(F.sum("ref_t"), F.count("v")).first()
    times = np.arange(n) * 15 + 3
    at = np.arange(n) * 10
    k = np.clip(np.searchsorted(times, at, "right") - 1, 0, n - 1)
    after = np.clip(np.searchsorted(times, at, "left"), 0, n - 1)
    near = np.where((times[k] <= at) & (at - times[k] <= np.abs(times[after] - at)), times[k], times[after])
    assert got[0] == near.sum() and got[1] == n
    x = series.interpolate(left, right, ["s"], ["x"]).agg(F.sum("x")).first()[0]
    assert math.isclose(x, np.interp(at, times, np.arange(n) * 1.5).sum(), rel_tol=1e-9)
    assert time.time() - began < 20


def test_right_rows_at_the_same_time_and_clamps(spark):
    left = spark.createDataFrame([(t,) for t in (0, 5, 7, 20)], "t long").withColumn("s", F.lit(1))
    right = spark.createDataFrame([(5, "a"), (9, "b")], "t long, v string").withColumn("s", F.lit(1))
    by = lambda **k: [r["v"] for r in series.asof(left, right, ["s"], ["v"], **k).orderBy("t").collect()]
    assert by() == [None, "a", "a", "b"] and by(clamp=True) == ["a", "a", "a", "b"]
    assert by(direction="forward") == ["a", "a", "b", None] and by(direction="forward", clamp=True) == ["a", "a", "b", "b"]
    assert by(direction="nearest") == ["a", "a", "a", "b"] and by(direction="nearest", tolerance=3) == [None, "a", "a", None]


def plain_merge(events, gap):
    out = []
    for start, peak_t, end, peak in sorted(events):
        if out and start - out[-1][2] <= gap and (out[-1][3] > 0) != (peak > 0):
            a = out.pop()
            out.append((a[0], peak_t if abs(peak) > abs(a[3]) else a[1], end, peak if abs(peak) > abs(a[3]) else a[3]))
        else:
            out.append((start, peak_t, end, peak))
    return out


def test_merge_of_many_events_in_linear_time(spark):
    rng = random.Random(3)
    rows = [(s, t, t + 1, t + rng.randint(2, 6), rng.choice((-1.0, 1.0)) * rng.random()) for s in (1, 2) for t in range(0, 400_000, 8)]
    df = spark.createDataFrame(rows + [(None, 0, 1, 2, 1.0)], "series int, t_start long, t_peak long, t_end long, peak double").repartition(3)
    began = time.time()
    got = series.merge_opposite(df, ["series"], 4).collect()
    assert time.time() - began < 20
    for s in (1, 2):
        assert sorted(tuple(r)[1:] for r in got if r["series"] == s) == plain_merge([r[1:] for r in rows if r[0] == s], 4)
    assert series.merge_opposite(df.where("false"), ["series"], 4).count() == 0


def test_a_long_stop_has_its_middle_row(spark):
    n = 100_000
    df = spark.range(n).select(F.lit(1).alias("s"), (F.col("id") * 10).alias("t"), F.when(F.col("id") < n - 1, 0.0).otherwise(1e9).alias("x"), F.lit(0.0).alias("y"))
    got = series.stops(df, ["s"], "x", "y", 0.5, 0.0, 1).collect()
    assert [tuple(r) for r in got] == [(1, 0, (n - 2 + 1) // 2 * 10, (n - 2) * 10, float((n - 2) * 10))]


@pytest.mark.parametrize("n", [1, 2, 3, 6, 30])
def test_acceleration_as_numpy_has_it(spark, n):
    rng = np.random.default_rng(n)
    t = np.cumsum(rng.integers(0, 3, n)) * 1_000_000_000
    e, h = rng.normal(size=n).cumsum(), rng.normal(size=n).cumsum()
    want = np.zeros(n)
    if n >= 3:
        dt = np.gradient(t.astype(float)) / 1e9
        dt[dt == 0] = np.nan
        with np.errstate(all="ignore"):
            want = np.nan_to_num(np.gradient(np.hypot(np.gradient(e), np.gradient(h)) / dt) / dt, nan=0.0, posinf=0.0, neginf=0.0)
    df = spark.createDataFrame([(1, i, int(t[i]), float(e[i]), float(h[i])) for i in range(n)], "s int, i int, t long, e double, h double")
    got = [r["acceleration"] for r in series.acceleration(df, ["s"], "e", "h", 10**9, "t", "i").orderBy("i").collect()]
    assert np.allclose(got, want, atol=1e-9)


def test_nearest_any_reaches_far_points(spark):
    _checkpoints(spark)
    left = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (2, 1e9, 0.0, 0.0), (3, None, 0.0, 0.0), (4, float("nan"), 0.0, 0.0)], "id int, x double, y double, z double")
    right = spark.createDataFrame([(7, 1e-6, 0.0, 0.0), (8, -5.0, 0.0, 0.0)], "id int, x double, y double, z double")
    assert {(r["left_id"], r["right_id"]) for r in spatial.nearest_any(left, right, 0.5, "id", "id").collect()} == {(1, 7), (2, 7)}
    assert spatial.nearest_any(left, right.where("false"), 1e-4, "id", "id").count() == 0


def test_exact_percentiles_as_numpy_has_them(spark):
    rng = np.random.default_rng(4)
    groups = {"a": rng.lognormal(0, 3, 5000), "b": np.repeat([1.0, 2.0, 1e9], 50), "c": np.array([3.5]), None: rng.normal(size=300)}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("a", None), ("d", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    got = {r["g"]: r for r in reports.exact_percentiles(df, ["g"], "v", [0, 0.1, 0.5, 0.975, 1], pieces=16).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert np.allclose(list(got[g])[1:], np.percentile(vs, [0, 10, 50, 97.5, 100]))
    whole = reports.exact_percentiles(df, [], "v", [0.5]).first()[0]
    assert math.isclose(whole, np.median([v for vs in groups.values() for v in vs]))


def test_round_robin_over_blocks_of_blocks(spark):
    keys = random.Random(5).sample(range(-500, 100_000), 3000)
    got = {r["k"]: r["endpoint"] for r in relational.round_robin(spark.createDataFrame([(k,) for k in keys], "k long").repartition(3), "k", 7, block=16).collect()}
    assert got == {k: i % 7 for i, k in enumerate(sorted(keys))}


@pytest.mark.parametrize(
    "chain, want",
    [
        ("flicker_whole_red_deg15_ph03", [("flicker", None), ("whole", "red:15"), ("ph", "03")]), ("whole_red_15", [("whole", "red:15")]), ("whole__", [("whole", ":")]),
        ("whole_red", [("unknown", "whole"), ("unknown", "red")]), ("", [("unknown", "")]), ("rcn1__lr22", [("unknown", "rcn1"), ("unknown", ""), ("lr", "22")]), ("whole_whole_degx_whole", [("whole", "whole:x"), ("unknown", "whole")]),
    ],
)
def test_tags(spark, chain, want):
    got = spark.range(1).select(text.tags(F.lit(chain)).alias("t")).first()["t"]
    assert [(x["kind"], x["value"]) for x in got] == want


@pytest.mark.parametrize(
    "answer, want",
    [
        ('x {"a": {"b": "}"}} y}', '{"a": {"b": "}"}}'), ('{"a": "\\"}"} {', '{"a": "\\"}"}'), ('" {"a": 1}', '{"a": 1}'), ('{"a": "cut off }', None), ('{"a": "cut \\', None), ("{{}", None), ("none", None), (None, None),
        ('{"a\n": "\n}"}', '{"a\n": "\n}"}'), ("} {}", "{}"),
    ],
)
def test_first_balanced_object(answer, want):
    assert text._balanced(answer) == want


def test_quaternions_of_any_length(spark):
    rng = np.random.default_rng(6)
    p, q = rng.normal(size=(2, 4)) * 3
    cols = lambda v: [F.lit(float(x)) for x in v]
    unit = lambda v: v / np.linalg.norm(v)
    value = lambda cs: np.array(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cs)]).first(), dtype=float)
    assert np.allclose(value(geo.rotation_of_quaternion(cols(p))), value(geo.rotation_of_quaternion(cols(unit(p)))))
    assert np.allclose(value(geo.slerp(cols(p), cols(q), F.lit(0.3))), value(geo.slerp(cols(unit(p)), cols(unit(q)), F.lit(0.3))))
    r = value(geo.rotation_of_quaternion(cols(p))) * 1.001
    assert math.isclose(np.linalg.norm(value(geo.quaternion_of_rotation(cols(r)))), 1.0)
    assert all(x is None for x in spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(geo.normalise([F.lit(0.0)] * 4))]).first())


def test_events_of_a_series_without_fixes_are_not_placed(spark):
    events = spark.createDataFrame([(1, 0, 5, 9, 1.0, "stop"), (2, 0, 5, 9, -1.0, "stop")], "vehicle int, t_start long, t_peak long, t_end long, magnitude double, kind string")
    fixes = spark.createDataFrame([(1, 4, 10.0, 20.0), (1, 7, 11.0, 21.0)], "vehicle int, t long, lat double, lon double")
    assert [tuple(r) for r in maneuvers.placed(events, fixes, ["vehicle"]).collect()] == [(1, 5, 10.0, 20.0, "stop", 1.0)]
