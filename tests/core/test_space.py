"""Geometry, spatial operators, the solver, point formats."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadglass.functions import geo
from roadglass.operators import camera, solve, spatial
from roadglass.sources import messages, pcd


def values(spark, **columns):
    row = spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()
    return [row[n] for n in columns]


@pytest.mark.parametrize("angles", [(0.1, -0.4, 2.0), (3.0, 1.2, -3.0), (-2.5, -1.5, 0.3), (0.0, 0.0, math.pi - 1e-3)])
def test_rotations_agree(spark, angles):
    a = [F.lit(x) for x in angles]
    q = geo.rpy_to_quaternion(*a)
    one = values(spark, **{f"r{i}": c for i, c in enumerate(geo.rotation_of_quaternion(q))})
    two = values(spark, **{f"r{i}": c for i, c in enumerate(geo.rotation_of_euler(*a))})
    assert np.allclose(one, two, atol=1e-12)
    back = values(spark, **{f"a{i}": c for i, c in enumerate(geo.euler_of_rotation([F.lit(float(x)) for x in two]))})
    assert np.allclose(back, angles, atol=1e-6)
    again = values(spark, **{f"q{i}": c for i, c in enumerate(geo.quaternion_of_rotation([F.lit(float(x)) for x in two]))})
    assert abs(abs(np.dot(again, values(spark, **{f"q{i}": c for i, c in enumerate(q)}))) - 1) < 1e-9


def test_wrap_and_slerp(spark):
    assert np.allclose(values(spark, a=geo.wrap_angle(F.lit(math.pi)), b=geo.wrap_angle(F.lit(-7.0))), [-math.pi, -7 + 2 * math.pi])
    p, q = geo.rpy_to_quaternion(F.lit(0.0), F.lit(0.0), F.lit(0.2)), geo.rpy_to_quaternion(F.lit(0.0), F.lit(0.0), F.lit(1.0))
    yaw = geo.yaw_of_quaternion(geo.slerp(p, [-c for c in q], F.lit(0.25)))
    assert math.isclose(values(spark, y=yaw)[0], 0.4, abs_tol=1e-9)


def test_zero_quaternion_is_identity(spark):
    assert values(spark, **{f"r{i}": c for i, c in enumerate(geo.rotation_of_wxyz([F.lit(0.0)] * 4))}) == [1, 0, 0, 0, 1, 0, 0, 0, 1]


def test_nearest_against_all_pairs(spark):
    rng = random.Random(5)
    a = [(i, *(rng.uniform(-1, 1) for _ in range(3))) for i in range(80)]
    b = [(i, *(rng.uniform(-1, 1) for _ in range(3))) for i in range(120)]
    left, right = (spark.createDataFrame(x, "id int, x double, y double, z double") for x in (a, b))
    want = {p[0]: min((math.dist(p[1:], q[1:]), q[0]) for q in b) for p in a}
    got = {r["left_id"]: (r["d"], r["right_id"]) for r in spatial.nearest(left, right, 0.3, "id", "id").collect()}
    assert {k: v[1] for k, v in want.items() if v[0] < 0.3} == {k: v[1] for k, v in got.items()}


def test_searches_for_the_nearest_form_no_pairs(spark, monkeypatch):
    """Clustered, gridded and copied points, all inside the gate of most others: the k nearest, by a number of rows that follows the points."""
    rng = np.random.default_rng(3)
    grid = np.stack(np.meshgrid(*[np.arange(6) * 0.05] * 3), axis=-1).reshape(-1, 3)
    cloud = np.concatenate([rng.normal(0, 0.05, (700, 3)), grid, np.tile(grid[5], (400, 1)), rng.normal(0, 1e-4, (300, 3)) + 3, [[500.0, 0, 0]]])
    rows = [(i, *map(float, p)) for i, p in enumerate(cloud[rng.permutation(len(cloud))])]
    points = spark.createDataFrame([*rows, (len(rows), None, 0.0, 0.0), (len(rows) + 1, float("nan"), 0.0, 0.0)], "id long, x double, y double, z double")
    monkeypatch.setattr(spatial, "BLOCK", 32)
    p = np.array([r[1:] for r in rows])
    x, y, z = (p[:, None, c] - p[None, :, c] for c in range(3))
    d = np.sqrt(((0.0 + x * x) + y * y) + z * z)
    want = {(i, int(j), n + 1, d[i, j]) for i in range(len(p)) for n, j in enumerate(np.argsort(d[i], kind="stable")[:4]) if d[i, j] < 0.3}
    assert {tuple(r[c] for c in ("left_id", "right_id", "k", "d")) for r in spatial.nearest_k(points, points, 0.3, 4, "id", "id").collect()} == want
    assert spatial._candidates(points, points, 0.3, 4, "id", "id").count() < 12 * len(rows)  # pairs inside the gate: over 500 a point
    left, right = points.where("id % 40 = 0"), points.where("id % 40 <> 0")
    d[:, ::40] = np.inf
    best = {(i, int(d[i].argmin()), d[i].min()) for i in range(0, len(p), 40) if d[i].min() < 0.3}
    assert {tuple(r[c] for c in ("left_id", "right_id", "d")) for r in spatial.nearest(left, right, 0.3, "id", "id").collect()} == best
    assert spatial.nearest(left.limit(0), right, 0.3, "id", "id").count() == spatial.nearest(left, right.limit(0), 0.3, "id", "id").count() == 0


def test_align_finds_a_small_motion(spark):
    rng = np.random.default_rng(1)
    grid = [(x, y) for x in np.linspace(-2, 2, 9) for y in np.linspace(-2, 2, 9)]
    planes = [((x, y, 0.0), (0, 0, 1)) for x, y in grid] + [((x, 3.0, y), (0, 1, 0)) for x, y in grid] + [((4.0, x, y), (1, 0, 0)) for x, y in grid]
    target = spark.createDataFrame([(i, *map(float, p), *map(float, n)) for i, (p, n) in enumerate(planes)], "target int, x double, y double, z double, nx double, ny double, nz double")
    motion = solve.se3_exp(np.array([0.01, -0.02, 0.015, 0.05, -0.04, 0.03]))
    moved = [np.linalg.inv(motion) @ np.append(np.array(p) + 0 * rng.normal(size=3), 1) for p, _ in planes]
    points = spark.createDataFrame([(i, *map(float, p[:3])) for i, p in enumerate(moved)], "point int, x double, y double, z double")
    pose, rms, n = solve.align(points, target, np.eye(4), [0.4], steps=6)
    assert n == len(planes) and rms < 1e-3
    assert np.allclose(pose, motion, atol=2e-3)


def test_weak_directions_are_taken_out():
    h = np.diag([1.0, 1.0, 1.0, 1.0, 1.0, 1e-9])
    assert np.allclose(solve.without_weak(np.ones(6), h, 1e-6), [1, 1, 1, 1, 1, 0])


def test_pcd_round_trip(spark, tmp_path):
    rows = [("a", i, float(i), 0.5, -1.0, 7.0) for i in range(5)]
    files = pcd.encode(spark.createDataFrame(rows, "scan string, point long, x double, y double, z double, intensity double"), "scan").collect()
    (tmp_path / "a.pcd").write_bytes(files[0]["content"])
    got = pcd.read(spark, str(tmp_path)).orderBy("point").collect()
    assert [r["x"] for r in got] == [0, 1, 2, 3, 4] and got[0]["intensity"] == 7.0


def test_points_from_packed_bytes(spark):
    kind = np.dtype({"names": ["x", "y", "z", "t_us"], "formats": ["<f4", "<f4", "<f4", "<u4"], "offsets": [0, 4, 8, 12], "itemsize": 20})
    cloud = np.zeros(3, kind)
    cloud["x"], cloud["t_us"] = [1, np.nan, 3], [10, 20, 30]
    layout = [("x", 0, 7), ("y", 4, 7), ("z", 8, 7), ("t_us", 12, 6), ("odd", 16, 99)]
    df = spark.createDataFrame([(1, cloud.tobytes(), 20, layout), (2, None, 20, layout)], "scan int, data binary, point_step int, fields array<struct<name:string,offset:int,datatype:int>>")
    got = [(r["scan"], r["point"], r["x"], r["intensity"], r["time"]) for r in messages.points(df, ["scan"]).orderBy("point").collect()]
    assert got == [(1, 0, 1.0, 0.0, 10.0), (1, 2, 3.0, 0.0, 30.0)]


def test_small_scans_are_decoded_together(spark, monkeypatch):
    """Many scans of a few layouts take a few calls, in bounded pieces; broken ends and scans without bytes are left out."""
    frame = np.frombuffer
    calls = []
    layouts = [[("x", 0, 7), ("y", 4, 2), ("z", 5, 2), *more] for more in ([], [("intensity", 6, 2)], [("t_us", 6, 4), ("odd", 7, 99)])]
    rows = [(i, b"".join(np.float32(j).tobytes() + bytes([i % 200, j, 7, 1]) for j in range(i % 4)) + b"?" * (i % 3), 8, layouts[i % 3]) for i in range(300)]
    rows += [(300, None, 8, layouts[0]), (301, rows[3][1], 0, layouts[0]), (302, rows[3][1], None, layouts[0]), (303, rows[3][1], 8, None)]
    kind = "scan int, data binary, point_step int, fields array<struct<name:string,offset:int,datatype:int>>"
    want = {(i, j, float(j), float(i % 200), float(j), 7.0 if i % 3 == 1 else 0.0, 7.0 + 256 if i % 3 == 2 else None) for i in range(300) for j in range(i % 4)}
    df = spark.createDataFrame(rows, kind).coalesce(1)
    got = {tuple(r[c] for c in ("scan", "point", "x", "y", "z", "intensity", "time")) for r in messages.points(df, ["scan"]).collect()}
    assert got == want
    assert messages.points(df, ["scan"]).select(F.spark_partition_id()).count() == len(want)
    # the function of the tasks, called here on one batch
    run = {}
    scans = df.select("scan", "data", "point_step", "fields")
    monkeypatch.setattr(type(scans), "mapInArrow", lambda self, f, schema: run.update(f=f, rows=self.toArrow()))
    messages.points(scans, ["scan"])
    batches = run["rows"].combine_chunks().to_batches()
    monkeypatch.setattr(np, "frombuffer", lambda *a, **k: calls.append(1) or frame(*a, **k))
    assert sum(b.num_rows for b in run["f"](iter(batches))) == len(want) and len(calls) < 10


def encode_rle(runs):
    import base64

    out = bytearray()
    for i, n in enumerate(runs):
        x, more = n - (runs[i - 2] if i > 2 else 0), True
        while more:
            c = x & 0x1F
            x >>= 5
            more = x != (-1 if c & 0x10 else 0)
            out.append((c | (0x20 if more else 0)) + 48)
    return base64.b64encode(bytes(out)).decode()


def test_rle_mask(spark):
    height, width = 6, 9
    mask = np.zeros((height, width), int)
    mask[1:4, 2:7] = 1
    flat, runs, value = mask.T.ravel(), [], 0
    for bit in flat:
        if bit != value:
            value = bit
            runs.append(0)
        if not runs:
            runs.append(0)
        runs[-1] += 1
    rows = spark.createDataFrame([(1, ([height, width], encode_rle(runs))), (2, None)], "k int, rle struct<size:array<int>,counts:string>")
    got = [r["pixel"] for r in camera.mask_pixels(rows, ["k"], "rle").collect()]
    assert sorted(got) == np.flatnonzero(mask.ravel()).tolist()


def test_unproject_undoes_project(spark):
    k, d = (500.0, 510.0, 320.0, 240.0), (0.05, -0.02, 0.001, -0.001, 0.003)
    points = spark.createDataFrame([(0.1, 0.2), (-0.4, 0.3), (0.0, 0.0)], "p double, q double")
    u, v, _ = geo.project([F.col("p"), F.col("q"), F.lit(1.0)], k, d)
    for r in camera.unproject_table(points.withColumns({"u": u, "v": v}), k, d).collect():
        assert math.isclose(r["a"], r["p"], abs_tol=1e-9) and math.isclose(r["b"], r["q"], abs_tol=1e-9)


def test_tracks_round_trip(spark):
    flat = spark.createDataFrame([(1, 0, 5, 1.0, 2.0), (1, 1, 6, 3.0, 4.0), (2, 0, 7, 0.0, 0.0)], "track int, seq int, t_ns long, u double, v double")
    back = camera.observations(camera.tracks(flat, "track", "seq", ["t_ns", "u", "v"]), "track", "points")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, flat.collect()))
