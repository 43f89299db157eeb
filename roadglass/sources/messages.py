"""The contract of message logs, and typed series read from it.

A log is a DataFrame (topic, schema_name, log_time_ns, file_seq, msg_seq, data),
whatever stores it: Parquet or JSON written by a converter, or the optional
``mcap`` source. Order is file_seq, log_time_ns, msg_seq. Decoded payloads are
columns of structs; the functions below take them as they are named in ROS.
"""

from __future__ import annotations

import json
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, text
from ..operators import relational, series

SCHEMA = "topic string, schema_name string, log_time_ns long, file_seq int, msg_seq long, data binary"
ORDER = ("file_seq", "log_time_ns", "msg_seq")
#: PointField datatypes 1 to 8.
POINT_TYPES = {1: np.int8, 2: np.uint8, 3: np.int16, 4: np.uint16, 5: np.int32, 6: np.uint32, 7: np.float32, 8: np.float64}
#: Fixed value: names that a per-point time can have, by priority.
TIME_FIELDS = ("time_stamp", "t_us", "timestamp")
#: Bytes of points that are decoded at once, unless one scan has more.
DECODED = 8_000_000


def bag_files(path: str, suffix: str = ".mcap") -> list[str]:
    """A file as it is, or the files of a folder in order of name; none is an error."""
    p = Path(path)
    if p.is_file():
        return [str(p)]
    found = sorted(str(x) for x in p.glob(f"*{suffix}")) if p.is_dir() else []
    if not found:
        raise FileNotFoundError(path)
    return found


def read(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(SCHEMA).load(path)


def scan(messages: DataFrame, topics: list[str] | None = None, start_s: float | None = None, end_s: float | None = None) -> DataFrame:
    """Filters that reach the scan. Rows are in no order: what needs one sorts by ORDER, or its own key, without the payloads that it doesn't read."""
    out = messages
    if topics is not None:
        out = out.where(F.col("topic").isin(topics))
    if start_s is not None:
        out = out.where(F.col("log_time_ns") >= int(start_s * 1e9))
    if end_s is not None:
        out = out.where(F.col("log_time_ns") <= int(end_s * 1e9))
    return out


def topics_by_schema(messages: DataFrame, schema_name: str) -> DataFrame:
    return messages.where(F.col("schema_name") == schema_name).select("topic").distinct().orderBy("topic")


def camera_topics(messages: DataFrame) -> DataFrame:
    """(topic, camera) in numeric order of cameras."""
    found = messages.select("topic").distinct().withColumn("camera", text.camera_of(F.col("topic"))).where("camera IS NOT NULL")
    return found.orderBy(F.regexp_extract("camera", r"(\d+)", 1).cast("int"))


def fixes(messages: DataFrame, msg: str = "msg") -> DataFrame:
    """(t, lat, lon, alt, spread, status) of decoded NavSatFix messages; no spread without a covariance type."""
    m = F.col(msg)
    cov = m["position_covariance"]
    spread = F.when(m["position_covariance_type"] == 0, F.lit(0.0)).otherwise(F.sqrt(F.greatest((F.get(cov, 0) + F.get(cov, 4)) / 2, F.lit(0.0))))
    return messages.select(F.col("log_time_ns").alias("t"), "file_seq", "msg_seq", m["latitude"].alias("lat"), m["longitude"].alias("lon"), m["altitude"].alias("alt"), spread.alias("spread"), m["status"]["status"].alias("status"))


def imu(messages: DataFrame, msg: str = "msg", turns: bool = False) -> DataFrame:
    """(t, yaw_rate, heading, accel_x), one pass.

    The heading lies between -pi and pi; with ``turns`` between -2 pi and 2 pi, as
    a quaternion and its negative, one rotation, are told apart by a turn.
    """
    q = F.col(msg)["orientation"]
    heading = geo.yaw_of_quaternion([q[c] for c in "xyzw"])
    if turns:
        heading = geo.same_turn(heading, 2 * F.atan2(q["z"], q["w"]))
    return messages.select(
        F.col("log_time_ns").alias("t"), "file_seq", "msg_seq", F.col(msg)["angular_velocity"]["z"].alias("yaw_rate"),
        heading.alias("heading"), F.col(msg)["linear_acceleration"]["x"].alias("accel_x"),
    )


def header_ns(msg: str = "msg"):
    stamp = F.col(msg)["header"]["stamp"]
    return stamp["sec"].cast("long") * 1_000_000_000 + stamp["nanosec"].cast("long")


def odometry(messages: DataFrame, msg: str = "msg") -> DataFrame:
    """(t, x, y, z, qx, qy, qz, qw, var_x, var_y, var_z) by header time."""
    pose = F.col(msg)["pose"]["pose"]
    cov = F.col(msg)["pose"]["covariance"]
    return messages.select(header_ns(msg).alias("t"), "file_seq", "msg_seq", *[pose["position"][c].alias(c) for c in "xyz"], *[pose["orientation"][c].alias(f"q{c}") for c in "xyzw"], *[F.get(cov, i).alias(f"var_{c}") for i, c in ((0, "x"), (7, "y"), (14, "z"))])


def trajectory(odo: DataFrame, by: list[str], t: str = "t", seq: str = "msg_seq") -> DataFrame:
    """Positions relative to the first of their series, in order of time."""
    w = series.order(by, t, seq)
    return odo.withColumns({c: F.col(c) - F.first(c).over(w) for c in "xyz"})


def static_transforms(messages: DataFrame, msg: str = "msg") -> DataFrame:
    """(parent, child, x, y, z, qx, qy, qz, qw); of repeated pairs the last in log order."""
    each = messages.select(*ORDER, F.posexplode(F.col(msg)["transforms"]).alias("at", "tf"))
    t = F.col("tf")["transform"]
    rows = each.select(
        *ORDER, "at", F.col("tf")["header"]["frame_id"].alias("parent"), F.col("tf")["child_frame_id"].alias("child"),
        *[t["translation"][c].alias(c) for c in "xyz"], *[t["rotation"][c].alias(f"q{c}") for c in "xyzw"],
    )
    return relational.last_wins(rows, ["parent", "child"], [*ORDER, "at"]).drop(*ORDER, "at")


def first_messages(messages: DataFrame, key: str = "topic") -> DataFrame:
    return relational.first_wins(messages, [key], list(ORDER))


def source_sizes(infos: DataFrame, images: DataFrame | None = None, camera: str = "camera") -> DataFrame:
    """(camera, width, height) by the first camera_info of each camera, else by its first image that has a size."""
    size = F.struct("width", "height")
    first = lambda rows, name: rows.where("width IS NOT NULL AND height IS NOT NULL").groupBy(camera).agg(F.min_by(size, F.struct(*ORDER)).alias(name))
    found = first(infos, "_info")
    if images is None:
        return found.select(camera, "_info.*")
    both = found.join(first(images, "_image"), camera, "full")
    return both.select(camera, F.coalesce("_info", "_image").alias("_size")).select(camera, "_size.*")


def position_modes(messages: DataFrame, data: str = "data") -> DataFrame:
    """Adds ``mode`` for 72-byte packets whose status channel is 0 and whose mode is valid (below 31)."""
    byte = lambda i: F.conv(F.hex(F.substring(data, i + 1, 1)), 16, 10).cast("int")
    mode = byte(68).bitwiseAND(F.lit(0x7F))
    return messages.where((F.length(data) > 68) & (byte(62) == 0) & (byte(68).bitwiseAND(F.lit(0x80)) == 0)).withColumn("mode", mode).where(F.col("mode") < 31)


def points(scans: DataFrame, keep: list[str], data: str = "data", step: str = "point_step", fields: str = "fields") -> DataFrame:
    """Explode point clouds: the ``keep`` columns and point, x, y, z, intensity, time.

    ``fields`` is an array of (name, offset, datatype). Rows with a value that is
    not finite are dropped; a missing intensity is 0, a missing time null;
    fields of unknown type are skipped. Scans of one layout are decoded together,
    column by column from the packed bytes.
    """
    kinds = {c: scans.schema[c].dataType.simpleString() for c in keep}
    schema = ", ".join(f"`{c}` {k}" for c, k in kinds.items()) + ", point long, x double, y double, z double, intensity double, time double"

    def explode(batches):
        for batch in batches:
            layouts = batch.column("_layout").dictionary_encode()
            codes = np.stack([layouts.indices.fill_null(-1).to_numpy(), batch.column(step).fill_null(0).to_numpy()], axis=1)
            for code in np.unique(codes, axis=0):
                layout, width = json.loads(layouts.dictionary[int(code[0])].as_py()) if code[0] >= 0 else [], int(code[1])
                known = {f["name"]: f for f in layout if f and f.get("datatype") in POINT_TYPES}
                if not all(c in known for c in "xyz") or not width:
                    continue
                kind = np.dtype({"names": list(known), "formats": [np.dtype(POINT_TYPES[f["datatype"]]) for f in known.values()], "offsets": [f["offset"] for f in known.values()], "itemsize": width})
                rows = np.flatnonzero((codes == code).all(axis=1))
                size = pc.binary_length(batch.column(data)).fill_null(0).to_numpy()[rows]
                piece = size.cumsum() // DECODED
                for part in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(piece)) + 1):
                    yield decode(batch, rows[part], size[part], kind, known)

    def decode(batch, rows, size, kind, known):
        """Points of scans of one layout."""
        raw = batch.column(data).take(pa.array(rows))
        n = size // kind.itemsize
        cloud = np.frombuffer(b"".join(r.as_buffer()[: k * kind.itemsize] for r, k in zip(raw, n) if k), kind)
        out = {c: cloud[c].astype(np.float64) for c in "xyz"}
        out["intensity"] = cloud["intensity"].astype(np.float64) if "intensity" in known else np.zeros(len(cloud))
        good = np.flatnonzero(np.logical_and.reduce([np.isfinite(v) for v in out.values()]))
        time = next((f for f in TIME_FIELDS if f in known), None)
        scan, point = np.repeat(rows, n), np.arange(len(cloud)) - np.repeat(n.cumsum() - n, n)
        arrays = [*(batch.column(c).take(pa.array(scan[good])) for c in keep), pa.array(point[good]), *(pa.array(v[good]) for v in out.values())]
        arrays.append(pa.array(cloud[time].astype(np.float64)[good]) if time else pa.nulls(len(good), pa.float64()))
        return pa.RecordBatch.from_arrays(arrays, names=[*keep, "point", "x", "y", "z", "intensity", "time"])

    return scans.select(*keep, data, F.col(step).cast("long").alias(step), F.to_json(fields).alias("_layout")).mapInArrow(explode, schema)


def deskew(points_: DataFrame, poses: DataFrame, by: list[str], t: str = "t", start: str = "t0") -> DataFrame:
    """Points moved from where the sensor was at their time to where it was at the scan's start.

    ``poses``: by, t, x, y, z, qx, qy, qz, qw. Adds dx, dy, dz and ``moved``.
    """
    q, p = ["qx", "qy", "qz", "qw"], ["x", "y", "z"]
    named = poses.select(*by, F.col("t"), *[F.col(c).alias(f"p_{c}") for c in (*p, *q)])

    def at(rows: DataFrame, time: str, mark: str) -> DataFrame:
        out = series.interpolate(rows.withColumn("_t", F.col(time)), named.withColumnRenamed("t", "_t"), by, [f"p_{c}" for c in p], "_t", [f"p_{c}" for c in q])
        return out.drop("_t").withColumnsRenamed({f"p_{c}": f"{mark}_{c}" for c in (*p, *q)})

    # one pose for each scan, not for each of its points; both are by series and start
    starts = at(points_.select(*by, start).distinct(), start, "then")
    rows = at(points_, t, "now").join(starts, [*by, start])
    pose = {m: (geo.rotation_of_unit([F.col(f"{m}_{c}") for c in q]), [F.col(f"{m}_{c}") for c in p]) for m in ("now", "then")}
    world = geo.apply_transform(*pose["now"], [F.col(c) for c in p])
    rows = rows.withColumns({f"w{c}": v for c, v in zip(p, world)})
    back = geo.apply_inverse(*pose["then"], [F.col(f"w{c}") for c in p])
    rows = rows.withColumns({f"d{c}": v for c, v in zip(p, back)})
    moved = F.sqrt(sum(((F.col(f"d{c}") - F.col(c)) * (F.col(f"d{c}") - F.col(c)) for c in p), F.lit(0.0)))
    return rows.withColumn("moved", moved).drop(*[f"{m}_{c}" for m in ("now", "then") for c in (*p, *q)], *[f"w{c}" for c in p])
