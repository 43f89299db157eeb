"""Angles, rotations, map and camera projections as Column expressions.

Quaternions are four Columns. Two conventions exist: ``xyzw`` for poses and
transforms, ``wxyz`` for annotation data; names say which. Rotations are lists
of nine Columns in row order. All stays inside generated code.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: equatorial radius in metres of the sphere behind both map projections.
EARTH_RADIUS_M = 6378137.0
Columns = Sequence[Column]


def wrap_angle(a: Column) -> Column:
    """To [-pi, pi)."""
    return F.pmod(a + F.lit(pi), F.lit(2 * pi)) - F.lit(pi)


def same_turn(a: Column, near: Column) -> Column:
    """The angle and as many whole turns as bring it nearest to another."""
    return a + F.lit(2 * pi) * F.rint((near - a) / F.lit(2 * pi))


def yaw_of_quaternion(q: Columns) -> Column:
    x, y, z, w = q
    return F.atan2(2 * (w * z + x * y), 1 - 2 * (y * y + z * z))


def enu(lat: Column, lon: Column, lat0: Column, lon0: Column) -> tuple[Column, Column]:
    """East and north in metres of an origin, equirectangular."""
    return F.radians(lon - lon0) * EARTH_RADIUS_M * F.cos(F.radians(lat0)), F.radians(lat - lat0) * EARTH_RADIUS_M


def from_enu(east: Column, north: Column, lat0: Column, lon0: Column) -> tuple[Column, Column]:
    """Latitude and longitude in degrees."""
    return lat0 + F.degrees(north / EARTH_RADIUS_M), lon0 + F.degrees(east / (EARTH_RADIUS_M * F.cos(F.radians(lat0))))


def mercator(lat: Column, lon: Column) -> tuple[Column, Column]:
    return F.radians(lon) * EARTH_RADIUS_M, F.log(F.tan(F.lit(pi / 4) + F.radians(lat) / 2)) * EARTH_RADIUS_M


def rpy_to_quaternion(roll: Column, pitch: Column, yaw: Column) -> Columns:
    """xyzw."""
    (cr, sr), (cp, sp), (cy, sy) = ((F.cos(a / 2), F.sin(a / 2)) for a in (roll, pitch, yaw))
    return [sr * cp * cy - cr * sp * sy, cr * sp * cy + sr * cp * sy, cr * cp * sy - sr * sp * cy, cr * cp * cy + sr * sp * sy]


def quaternion_to_rpy(q: Columns) -> Columns:
    x, y, z, w = q
    sine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), 2 * (w * y - z * x)))
    return [F.atan2(2 * (w * x + y * z), 1 - 2 * (x * x + y * y)), F.asin(sine), yaw_of_quaternion(q)]


def same_rpy(rows: DataFrame, angles: Columns, near: Columns, names: Sequence[str]) -> DataFrame:
    """Adds, of all roll, pitch, yaw that make the same rotation as ``angles``, those nearest to the given ones.

    A rotation tells its angles up to whole turns, and up to turning all three about
    (roll and yaw by half a turn, the pitch mirrored); what is known of them tells which.
    """
    roll, pitch, yaw = (F.col(f"_a{i}") for i in range(3))
    rows = rows.withColumns({f"_a{i}": a for i, a in enumerate(angles)} | {f"_n{i}": n for i, n in enumerate(near)})
    ways = {"s": (roll, pitch, yaw), "o": (roll + F.lit(pi), F.lit(pi) - pitch, yaw + F.lit(pi))}
    rows = rows.withColumns({f"_{w}{i}": same_turn(a, F.col(f"_n{i}")) for w, way in ways.items() for i, a in enumerate(way)})
    far = lambda w: sum((F.pow(F.col(f"_{w}{i}") - F.col(f"_n{i}"), 2) for i in range(1, 3)), F.pow(F.col(f"_{w}0") - F.col("_n0"), 2))
    rows = rows.withColumn("_other", far("o") < far("s"))
    rows = rows.withColumns({n: F.when(F.col("_other"), F.col(f"_o{i}")).otherwise(F.col(f"_s{i}")) for i, n in enumerate(names)})
    return rows.drop("_other", *[f"_{m}{i}" for m in "anso" for i in range(3)])


def normalise(q: Columns) -> Columns:
    """Of length one; nulls for a quaternion without length."""
    norm = F.sqrt(sum((c * c for c in q[1:]), q[0] * q[0]))
    return [F.try_divide(c, norm) for c in q]


def multiply(p: Columns, q: Columns) -> Columns:
    """Hamilton product, xyzw."""
    (a, b, c, d), (x, y, z, w) = p, q
    return [d * x + a * w + b * z - c * y, d * y - a * z + b * w + c * x, d * z + a * y - b * x + c * w, d * w - a * x - b * y - c * z]


def conjugate(q: Columns) -> Columns:
    x, y, z, w = q
    return [-x, -y, -z, w]


def slerp(p: Columns, q: Columns, fraction: Column) -> Columns:
    """Along the shorter arc; nearly equal rotations are mixed linearly. xyzw of any length in, normalised xyzw out.

    For many rows with_slerp makes the smaller plan.
    """
    p, q = normalise(p), normalise(q)
    plain = sum((a * b for a, b in zip(p[1:], q[1:])), p[0] * q[0])
    angle = F.acos(F.least(F.lit(1.0), F.abs(plain)))
    near = F.abs(plain) > 0.9995
    first = F.when(near, 1 - fraction).otherwise(F.try_divide(F.sin((1 - fraction) * angle), F.sin(angle)))
    second = F.when(near, fraction).otherwise(F.try_divide(F.sin(fraction * angle), F.sin(angle))) * F.when(plain < 0, -1.0).otherwise(1.0)
    return normalise([first * a + second * b for a, b in zip(p, q)])


def with_slerp(rows: DataFrame, p: Columns, q: Columns, fraction: Column, names: Sequence[str]) -> DataFrame:
    """Adds slerp as columns, step by step: each step is a projection whose columns the next one uses many times, where one expression would repeat them."""
    step = lambda mark, columns: {f"_{mark}{i}": c for i, c in enumerate(columns)}
    own = lambda mark: [F.col(f"_{mark}{i}") for i in range(4)]
    rows = rows.withColumns(step("sp", normalise(p)) | step("sq", normalise(q)) | {"_sf": fraction})
    rows = rows.withColumn("_sd", sum((a * b for a, b in zip(own("sp")[1:], own("sq")[1:])), F.col("_sp0") * F.col("_sq0")))
    rows = rows.withColumn("_sa", F.acos(F.least(F.lit(1.0), F.abs("_sd"))))
    near, sine, f = F.abs("_sd") > 0.9995, F.sin("_sa"), F.col("_sf")
    first = F.when(near, 1 - f).otherwise(F.try_divide(F.sin((1 - f) * F.col("_sa")), sine))
    second = F.when(near, f).otherwise(F.try_divide(F.sin(f * F.col("_sa")), sine)) * F.when(F.col("_sd") < 0, -1.0).otherwise(1.0)
    rows = rows.withColumns({"_s1": first, "_s2": second})
    rows = rows.withColumns(step("sm", [F.col("_s1") * a + F.col("_s2") * b for a, b in zip(own("sp"), own("sq"))]))
    rows = rows.withColumns(dict(zip(names, normalise(own("sm")))))
    return rows.drop(*[f"_{m}{i}" for m in ("sp", "sq", "sm") for i in range(4)], "_sf", "_sd", "_sa", "_s1", "_s2")


def rotation_of_quaternion(q: Columns) -> Columns:
    """xyzw of any length to a rotation."""
    return rotation_of_unit(normalise(q))


def rotation_of_unit(q: Columns) -> Columns:
    """xyzw of length one to a rotation."""
    x, y, z, w = q
    return [
        1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w),
        2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w),
        2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y),
    ]


def rotation_of_wxyz(q: Columns) -> Columns:
    """wxyz of any length to a rotation; zero length gives the identity."""
    norm = F.sqrt(sum((c * c for c in q[1:]), q[0] * q[0]))
    w, x, y, z = (F.when(norm == 0, F.lit(float(i == 0))).otherwise(c / F.when(norm == 0, 1.0).otherwise(norm)) for i, c in enumerate(q))
    return rotation_of_unit([x, y, z, w])


def rotation_of_euler(roll: Column, pitch: Column, yaw: Column) -> Columns:
    """Rz(yaw) Ry(pitch) Rx(roll)."""
    (cr, sr), (cp, sp), (cy, sy) = ((F.cos(a), F.sin(a)) for a in (roll, pitch, yaw))
    return [cy * cp, cy * sp * sr - sy * cr, cy * sp * cr + sy * sr, sy * cp, sy * sp * sr + cy * cr, sy * sp * cr - cy * sr, -sp, cp * sr, cp * cr]


def euler_of_rotation(r: Columns) -> Columns:
    """Roll, pitch, yaw; where the pitch is straight up or down all turn is given to the roll."""
    lock = F.abs(r[6]) >= 0.99999
    pitch = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), -r[6])))
    return [F.when(lock, F.atan2(-r[5], r[4])).otherwise(F.atan2(r[7], r[8])), pitch, F.when(lock, F.lit(0.0)).otherwise(F.atan2(r[3], r[0]))]


def quaternion_of_rotation(r: Columns) -> Columns:
    """xyzw of length one, by the largest of the four squared components."""
    trace = r[0] + r[4] + r[8]
    branches = []
    for i in range(4):
        squared = (trace, r[0] - r[4] - r[8], r[4] - r[0] - r[8], r[8] - r[0] - r[4])[i] + 1
        s = F.sqrt(F.greatest(squared, F.lit(1e-300))) * 2
        wx, wy, wz = (r[7] - r[5]) / s, (r[2] - r[6]) / s, (r[3] - r[1]) / s
        xy, xz, yz = (r[1] + r[3]) / s, (r[2] + r[6]) / s, (r[5] + r[7]) / s
        branches.append(([wx, wy, wz, s / 4], [s / 4, xy, xz, wx], [xy, s / 4, yz, wy], [xz, yz, s / 4, wz])[i])
    first = trace > 0
    second = (r[0] > r[4]) & (r[0] > r[8])
    third = r[4] > r[8]
    return normalise([F.when(first, b[0]).when(second, b[1]).when(third, b[2]).otherwise(b[3]) for b in zip(*branches)])


def rotate(r: Columns, p: Columns) -> Columns:
    return [r[3 * i] * p[0] + r[3 * i + 1] * p[1] + r[3 * i + 2] * p[2] for i in range(3)]


def transpose(r: Columns) -> Columns:
    return [r[3 * j + i] for i in range(3) for j in range(3)]


def apply_transform(r: Columns, t: Columns, p: Columns) -> Columns:
    """R p + t."""
    return [a + b for a, b in zip(rotate(r, p), t)]


def apply_inverse(r: Columns, t: Columns, p: Columns) -> Columns:
    """R' (p - t)."""
    return rotate(transpose(r), [a - b for a, b in zip(p, t)])


def box_corners(centre: Columns, size_wlh: Columns, r: Columns) -> list[Columns]:
    """Eight corners of a box with length along x, width along y, height along z; signs run --- to +++."""
    w, l, h = size_wlh
    signs = [(x, y, z) for x in (-0.5, 0.5) for y in (-0.5, 0.5) for z in (-0.5, 0.5)]
    return [apply_transform(r, centre, [l * F.lit(x), w * F.lit(y), h * F.lit(z)]) for x, y, z in signs]


def project(p: Columns, k: Sequence[float], distortion: Sequence[float] = (), nearest: float = 0.1) -> Columns:
    """Pixel u, v and validity of a point in the camera frame; ``k``: fx, fy, cx, cy.

    Four distortion coefficients mean a fisheye lens, five the plumb-bob model,
    eight the rational model. Points nearer than ``nearest`` are not valid.
    """
    fx, fy, cx, cy = k
    x, y, z = p
    valid = z > nearest
    depth = F.when(valid, z).otherwise(F.lit(1.0))
    a, b = x / depth, y / depth
    r2 = a * a + b * b
    d = list(distortion)
    if len(d) == 4:
        r = F.sqrt(r2)
        theta = F.atan(r)
        t2 = theta * theta
        bent = theta * (1 + t2 * (d[0] + t2 * (d[1] + t2 * (d[2] + t2 * d[3]))))
        scale = F.when(r > 1e-8, bent / F.when(r > 1e-8, r).otherwise(1.0)).otherwise(F.lit(1.0))
        a, b = a * scale, b * scale
    elif d:
        k1, k2, p1, p2, k3, k4, k5, k6 = (d + [0.0] * 8)[:8]
        radial = (1 + r2 * (k1 + r2 * (k2 + r2 * k3))) / (1 + r2 * (k4 + r2 * (k5 + r2 * k6)))
        a, b = a * radial + 2 * p1 * a * b + p2 * (r2 + 2 * a * a), b * radial + p1 * (r2 + 2 * b * b) + 2 * p2 * a * b
    return [a * fx + cx, b * fy + cy, valid]


def huber_weight(r: Column, delta: float) -> Column:
    return F.when(F.abs(r) <= delta, F.lit(1.0)).otherwise(F.lit(delta) / F.abs(r))


def pack(parts: Columns, bits: int) -> Column:
    """Integers, each moved up by half its range, side by side in one 64-bit key."""
    key = None
    for part in parts:
        moved = part.cast("long") + (1 << (bits - 1))
        key = moved if key is None else F.shiftleft(key, bits).bitwiseOR(moved)
    return key


def voxel_key(x: Column, y: Column, z: Column, size: float) -> Column:
    """21 bits an axis."""
    return pack([F.floor(c / size) for c in (x, y, z)], 21)


def arc_key(azimuth: Column, elevation: Column, r: Column, footprint: float) -> Column:
    """26 bits each for the arc lengths across and up, in footprints."""
    return pack([F.floor(azimuth * r / footprint), F.floor(elevation * r / footprint)], 26)


def rolling_shutter_time(t_ns: Column, row: Column, height: Column, line_s: Column) -> Column:
    """Time at which a row was exposed; unchanged without a line time."""
    return F.coalesce(t_ns + F.bround((row - height / 2) * line_s * 1e9).cast("long"), t_ns)


def time_unit_ns(values: Column, most: float = 1_000_000) -> Column:
    """Aggregate: 1000 if a scan's time field spans at most ``most`` (1e6 microseconds), else 1."""
    return F.when(F.max(values) - F.min(values) <= most, F.lit(1000)).otherwise(F.lit(1))


def frame_kind(x: Column, y: Column, z: Column) -> Column:
    """Aggregate: ECEF if positions are farther than 100 km from the origin on average, else LOCAL."""
    return F.when(F.avg(F.sqrt(x * x + y * y + z * z)) > 1e5, F.lit("ECEF")).otherwise(F.lit("LOCAL"))
