"""Series operators against plain loops."""

import bisect
import math
import random

import pytest
from pyspark.sql import functions as F

from roadglass.operators import series as S

UNIT = 1000


@pytest.fixture(scope="module")
def signal():
    rng = random.Random(7)
    rows, seq = [], 0
    for s in range(5):
        t = 0
        for _ in range((0, 1, 2, 60, 90)[s]):
            t += rng.choice((0, 100, 250, 400, 3000))
            seq += 1
            rows.append((s, t, seq, round(rng.gauss(0, 2), 3), round(rng.uniform(-3, 3), 3)))
    return rows


@pytest.fixture(scope="module")
def frame(spark, signal):
    return spark.createDataFrame(signal, "s int, t long, seq long, v double, w double").cache()


def by_series(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        out.setdefault(r[0], []).append(r)
    return out


def loop_pulses(rows, enter, leave):
    out = []
    for s, part in by_series(rows).items():
        start = peak = None
        for i, r in enumerate(part):
            if start is None:
                if abs(r[3]) >= enter:
                    start = peak = i
            else:
                if abs(r[3]) > abs(part[peak][3]):
                    peak = i
                if abs(r[3]) < leave:
                    out.append((s, part[start][1], part[peak][1], r[1], part[peak][3]))
                    start = None
    return sorted(out)


@pytest.mark.parametrize("enter,leave", [(2.5, 0.8), (1.5, 1.5), (3.5, 0.2)])
def test_pulses(frame, signal, enter, leave):
    found = S.pulses(frame, ["s"], "v", enter, leave, UNIT, "t", "seq")
    assert sorted(map(tuple, found.collect())) == loop_pulses(signal, enter, leave)


def test_pulses_need_an_order_of_thresholds(frame):
    with pytest.raises(ValueError):
        S.pulses(frame, ["s"], "v", 1.0, 2.0, UNIT)


def test_merge_opposite_is_a_fold(spark, signal):
    events = loop_pulses(signal, 1.5, 1.0)
    gap = 1500
    want = []
    for e in events:
        last = want[-1] if want and want[-1][0] == e[0] else None
        if last and e[1] - last[3] <= gap and (last[4] > 0) != (e[4] > 0):
            large = e if abs(e[4]) > abs(last[4]) else last
            want[-1] = (e[0], last[1], large[2], e[3], large[4])
        else:
            want.append(e)
    rows = spark.createDataFrame(events, "s int, t_start long, t_peak long, t_end long, peak double")
    assert sorted(map(tuple, S.merge_opposite(rows, ["s"], gap).collect())) == sorted(want)
    assert len(want) < len(events)


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
def test_asof(spark, signal, direction):
    rng = random.Random(3)
    right = sorted({(s, rng.randrange(0, 60000)) for s in range(1, 5) for _ in range(12)})
    lefts = [(r[0], r[1], r[2]) for r in signal]
    a = spark.createDataFrame(lefts, "s int, t long, seq long")
    b = spark.createDataFrame([(s, t, t * 2) for s, t in right], "s int, t long, x long")
    got = {r["seq"]: r["ref_t"] for r in S.asof(a, b, ["s"], ["x"], direction=direction).collect()}
    for s, t, seq in lefts:
        times = [u for v, u in right if v == s]
        past, ahead = [u for u in times if u <= t], [u for u in times if u >= t]
        p, n = (past[-1] if past else None), (ahead[0] if ahead else None)
        want = {"backward": p, "forward": n, "nearest": n if p is None else p if n is None or t - p <= n - t else n}[direction]
        assert got[seq] == want, (s, t)


def test_asof_clamp_and_tolerance(spark):
    a = spark.createDataFrame([(1, 5), (1, 50)], "s int, t long")
    b = spark.createDataFrame([(1, 10, "a"), (1, 20, "b")], "s int, t long, x string")
    assert [r["x"] for r in S.asof(a, b, ["s"], ["x"], clamp=True).orderBy("t").collect()] == ["a", "b"]
    assert [r["x"] for r in S.asof(a, b, ["s"], ["x"], direction="nearest", tolerance=5).orderBy("t").collect()] == ["a", None]


def test_stops_and_islands(frame, signal):
    got = sorted((r["s"], r["t_start"], r["t_mid"], r["t_end"]) for r in S.stops(frame, ["s"], "v", "w", 4.0, 0.3, UNIT, "t", "seq").collect())
    want = []
    for s, part in by_series(signal).items():
        slow = []
        for a, b in zip(part, part[1:]):
            dt = (b[1] - a[1]) / UNIT
            slow.append(dt > 0 and math.hypot(b[3] - a[3], b[4] - a[4]) / dt < 4.0)
        i = 0
        while i < len(slow):
            if slow[i]:
                j = i
                while j < len(slow) and slow[j]:
                    j += 1
                if (part[j][1] - part[i][1]) / UNIT >= 0.3:
                    want.append((s, part[i][1], part[(i + j) // 2][1], part[j][1]))
                i = j
            else:
                i += 1
    assert got == sorted(want) and want


def test_speed_jumps(frame, signal):
    got = {r["seq"]: r["jump"] for r in S.speed_jumps(frame, ["s"], "v", "w", 8.0, UNIT, "t", "seq").collect()}
    for part in by_series(signal).values():
        fast = [b[1] <= a[1] or math.hypot(b[3] - a[3], b[4] - a[4]) / ((b[1] - a[1]) / UNIT) > 8.0 for a, b in zip(part, part[1:])]
        for i, r in enumerate(part):
            want = False if not fast else fast[0] if i == 0 else fast[-1] if i == len(fast) else fast[i - 1] and fast[i]
            assert got[r[2]] == want


def test_evenly_and_stride(frame, signal):
    part = by_series(signal)[4]
    got = [r["seq"] for r in S.evenly(frame.where("s = 4"), ["s"], 7, "t", "seq").orderBy("t", "seq").collect()]
    assert got == [part[int(i * (len(part) - 1) / 6)][2] for i in range(7)]
    got = [r["seq"] for r in S.stride(frame.where("s = 4"), ["s"], 4, 5, "t", "seq").orderBy("t", "seq").collect()]
    assert got == [r[2] for r in part[::4][:5]]
    assert S.evenly(frame.where("s = 1"), ["s"], 7, "t", "seq").count() == 1


def test_ticks_take_the_first_row_at_or_after(frame, signal):
    part = by_series(signal)[4]
    times = [r[1] for r in part]
    got = {r["tick"]: r["ref_t"] for r in S.ticks(frame.where("s = 4"), ["s"], 5000, ["v"]).collect()}
    want = {}
    for k in range(1, (times[-1] - times[0]) // 5000 + 1):
        i = min(bisect.bisect_left(times, times[0] + k * 5000), len(times) - 1)
        want[k] = times[i]
    assert got == want


def test_interpolate_ends_and_middle(spark):
    a = spark.createDataFrame([(1, 0), (1, 15), (1, 20), (1, 99)], "s int, t long")
    b = spark.createDataFrame([(1, 10, 1.0), (1, 20, 3.0)], "s int, t long, x double")
    assert [r["x"] for r in S.interpolate(a, b, ["s"], ["x"]).orderBy("t").collect()] == [1.0, 2.0, 3.0, 3.0]


def test_empty_inputs(frame):
    none = frame.where("false")
    assert S.pulses(none, ["s"], "v", 2.0, 1.0, UNIT).count() == 0
    assert S.ticks(none, ["s"], 100, ["v"]).count() == 0
    assert S.asof(frame, none.select("s", "t", F.col("v").alias("x")), ["s"], ["x"]).where("x IS NULL").count() == frame.count()
