"""Scenarios: short drives whose events are known."""

import math

import pytest

from roadglass.operators import maneuvers as M
from roadglass.operators import series as S

NS = 10**9
METRE = math.degrees(1 / 6378137.0)


def imu(spark, rates, dt=0.1, accel=None):
    heading, rows = 0.0, []
    for i, r in enumerate(rates):
        heading += r * dt
        rows.append((1, int(i * dt * NS), r, heading, accel[i] if accel else 0.0))
    return spark.createDataFrame(rows, "v int, t long, yaw_rate double, heading double, accel_x double")


def pulse(n, *parts):
    out = [0.0] * n
    for start, length, value in parts:
        out[start : start + length] = [value] * length
    return out


@pytest.mark.parametrize(
    "rates,n",
    [
        (pulse(60, (20, 5, 0.1), (25, 5, -0.1)), 1),  # both halves of an S are one pulse in size
        (pulse(60, (15, 7, 0.1), (26, 7, -0.1)), 1),  # two pulses of opposite sign, joined
        ([0.3] * 50, 0),  # a turn that never ends
        (pulse(200, (20, 150, 0.3)), 0),  # too long
        (pulse(100, (20, 8, 0.1)), 0),  # the heading stays off
        (pulse(60, (20, 2, 0.1)), 0),  # too short
        ([0.0, 0.1], 0),
        ([], 0),
    ],
)
def test_lane_changes(spark, rates, n):
    assert M.lane_changes(imu(spark, rates), ["v"]).count() == n


@pytest.mark.parametrize("size,kind", [(5.0, "harsh_accel"), (-5.0, "harsh_decel"), (1.0, None)])
def test_harsh(spark, size, kind):
    got = M.harsh_events(imu(spark, [0.0] * 30, accel=pulse(30, (10, 5, size))), ["v"]).collect()
    assert [r["kind"] for r in got] == ([kind] if kind else [])
    assert all(r["magnitude"] == size and r["t_start"] == NS for r in got)


def track(spark, norths, dt=1.0):
    return spark.createDataFrame([(1, int(i * dt * NS), 35.0 + n * METRE, 139.0) for i, n in enumerate(norths)], "v int, t long, lat double, lon double")


@pytest.mark.parametrize("still,n", [(3, 1), (1, 0)])
def test_stops(spark, still, n):
    drive = [10.0 * i for i in range(6)]
    norths = drive + [drive[-1]] * still + [drive[-1] + 10.0 * (i + 1) for i in range(5)]
    got = M.stop_events(track(spark, norths), ["v"]).collect()
    assert len(got) == n and all(r["magnitude"] == still for r in got)


def test_a_teleport_is_one_jump_and_hard_braking_is_none(spark):
    norths = [10.0 * i for i in range(10)]
    norths[5] += 500_000
    jumps = [r["t"] // NS for r in M.flagged(track(spark, norths), ["v"]).where("jump").collect()]
    assert jumps == [5]
    assert M.flagged(track(spark, [0.0, 60.0, 61.0]), ["v"]).where("jump AND t = 1000000000").count() == 0


def test_zero_fixes(spark):
    rows = [(1, 0, 0.0, 0.0), (1, 1, 35.0, 139.0), (1, 2, 0.0, 0.0), (1, 3, float("nan"), 1.0)]
    got = M.flagged(spark.createDataFrame(rows, "v int, t long, lat double, lon double"), ["v"]).orderBy("t").collect()
    assert [r["zero"] for r in got] == [False, False, True, False] and [r["finite"] for r in got] == [True, True, True, False]


def test_ticks_every_thirty_seconds(spark):
    got = S.ticks(track(spark, [float(i) for i in range(100)]), ["v"], 30 * NS, ["lat"]).collect()
    assert sorted(r["ref_t"] // NS for r in got) == [30, 60, 90]
    odd = spark.createDataFrame([(1, s * NS, float(s)) for s in (0, 29, 31, 60)], "v int, t long, lat double")
    assert [r["ref_t"] // NS for r in S.ticks(odd, ["v"], 30 * NS, ["lat"]).orderBy("tick").collect()] == [31, 60]


def test_events_are_placed_at_the_nearest_fix(spark):
    fixes = spark.createDataFrame([(1, t, float(t), -float(t)) for t in (0, 10, 20, 30)], "v int, t long, lat double, lon double")
    events = spark.createDataFrame([(1, 8, p, 12, -2.0, "stop") for p in (11, 15, -5, 99)], "v int, t_start long, t_peak long, t_end long, magnitude double, kind string")
    got = {r["t_ns"]: r for r in M.placed(events, fixes, ["v"]).collect()}
    assert {k: r["lat"] for k, r in got.items()} == {11: 10.0, 15: 10.0, -5: 0.0, 99: 30.0} and got[11]["magnitude"] == 2.0
    assert M.placed(events, fixes.where("false"), ["v"]).count() == 0
