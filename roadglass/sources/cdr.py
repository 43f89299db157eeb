"""Messages between bytes and structs: definitions compiled to programs that run on whole Arrow arrays.

A definition is the text that a container keeps with a schema: fields line by
line, then the types it uses, each after a line of equals signs and ``MSG: name``.
It becomes a tree of steps. Decoding runs the steps for all messages of a batch at
once: each message has a cursor, a step aligns the cursors, gathers the bytes that
lie there and moves on; elements of a sequence of structs go in lockstep. Bytes are
in the common data representation: a header of four bytes with the byte order,
then values aligned to their size, counted from behind the header.

Results by case: a null message gives a null struct, and so does one that ends too
early or names a length that it can't have; what follows the last field is ignored;
unsigned 64-bit values above the signed range wrap; arrays of single bytes become
binary; text that isn't UTF-8 has replacement characters.
"""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Primitive types, their layout, and the signed type that holds them in Spark.
PRIMITIVES = {
    "bool": ("?", "boolean"), "byte": ("B", "smallint"), "char": ("B", "smallint"), "int8": ("b", "tinyint"), "uint8": ("B", "smallint"), "int16": ("h", "smallint"), "uint16": ("H", "int"),
    "int32": ("i", "int"), "uint32": ("I", "bigint"), "int64": ("q", "bigint"), "uint64": ("Q", "bigint"), "float32": ("f", "float"), "float64": ("d", "double"),
}
ARROW = {"boolean": pa.bool_(), "tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64(), "float": pa.float32(), "double": pa.float64()}
SINGLE = ("byte", "char", "uint8")
_HEADER = "builtin_interfaces/Time stamp\nstring frame_id"
_TIME = "int32 sec\nuint32 nanosec"
_VECTOR, _QUATERNION = "float64 x\nfloat64 y\nfloat64 z", "float64 x\nfloat64 y\nfloat64 z\nfloat64 w"
_RULE = "\n" + "=" * 80 + "\nMSG: "
_COMMON = {"std_msgs/Header": _HEADER, "builtin_interfaces/Time": _TIME, "geometry_msgs/Vector3": _VECTOR, "geometry_msgs/Point": _VECTOR, "geometry_msgs/Quaternion": _QUATERNION}


def _with(text: str, **types: str) -> str:
    return text + "".join(f"{_RULE}{name}\n{body}" for name, body in (_COMMON | {k.replace("__", "/"): v for k, v in types.items()}).items())


#: The public definitions of the messages that the library reads.
DEFINITIONS = {
    "sensor_msgs/msg/NavSatFix": _with("std_msgs/Header header\nsensor_msgs/NavSatStatus status\nfloat64 latitude\nfloat64 longitude\nfloat64 altitude\nfloat64[9] position_covariance\nuint8 position_covariance_type", sensor_msgs__NavSatStatus="int8 STATUS_NO_FIX=-1\nint8 status -2\nuint16 service"),
    "sensor_msgs/msg/Imu": _with("std_msgs/Header header\ngeometry_msgs/Quaternion orientation\nfloat64[9] orientation_covariance\ngeometry_msgs/Vector3 angular_velocity\nfloat64[9] angular_velocity_covariance\ngeometry_msgs/Vector3 linear_acceleration\nfloat64[9] linear_acceleration_covariance"),
    "nav_msgs/msg/Odometry": _with("std_msgs/Header header\nstring child_frame_id\ngeometry_msgs/PoseWithCovariance pose\ngeometry_msgs/TwistWithCovariance twist", geometry_msgs__PoseWithCovariance="Pose pose\nfloat64[36] covariance", geometry_msgs__Pose="Point position\nQuaternion orientation", geometry_msgs__TwistWithCovariance="Twist twist\nfloat64[36] covariance", geometry_msgs__Twist="Vector3 linear\nVector3 angular"),
    "tf2_msgs/msg/TFMessage": _with("geometry_msgs/TransformStamped[] transforms", geometry_msgs__TransformStamped="std_msgs/Header header\nstring child_frame_id\nTransform transform", geometry_msgs__Transform="Vector3 translation\nQuaternion rotation"),
    "sensor_msgs/msg/CameraInfo": _with("std_msgs/Header header\nuint32 height\nuint32 width\nstring distortion_model\nfloat64[] d\nfloat64[9] k\nfloat64[9] r\nfloat64[12] p\nuint32 binning_x\nuint32 binning_y\nRegionOfInterest roi", sensor_msgs__RegionOfInterest="uint32 x_offset\nuint32 y_offset\nuint32 height\nuint32 width\nbool do_rectify"),
    "sensor_msgs/msg/PointCloud2": _with("std_msgs/Header header\nuint32 height\nuint32 width\nPointField[] fields\nbool is_bigendian\nuint32 point_step\nuint32 row_step\nuint8[] data\nbool is_dense", sensor_msgs__PointField="uint8 INT8=1\nuint8 FLOAT32=7\nstring name\nuint32 offset\nuint8 datatype\nuint32 count"),
    "sensor_msgs/msg/CompressedImage": _with("std_msgs/Header header\nstring format\nuint8[] data"),
    "std_msgs/msg/String": "string data",
}


@dataclass
class Step:
    """A field's type: primitive, string or struct (``fields``), alone (count None), in an array of ``count`` or in a sequence (-1)."""

    kind: str
    count: int | None = None
    fields: list[tuple[str, Step]] = field(default_factory=list)

    @property
    def ddl(self) -> str:
        if self.count is not None and self.kind in SINGLE:
            return "binary"
        one = "struct<" + ",".join(f"`{n}`:{s.ddl}" for n, s in self.fields) + ">" if self.kind == "struct" else "string" if self.kind == "string" else PRIMITIVES[self.kind][1]
        return one if self.count is None else f"array<{one}>"

    @property
    def arrow(self) -> pa.DataType:
        if self.count is not None and self.kind in SINGLE:
            return pa.binary()
        one = pa.struct([(n, s.arrow) for n, s in self.fields]) if self.kind == "struct" else pa.string() if self.kind == "string" else ARROW[PRIMITIVES[self.kind][1]]
        return one if self.count is None else pa.list_(one)


_FIELD = re.compile(r"^(?P<type>[\w/]+)(?:<=\d+)?(?P<array>\[(?:<=)?(?P<count>\d*)\])?\s+(?P<name>\w+)(?P<rest>\s*=|\s|$)")


def compiled(definition: str) -> Step:
    """The program of a definition."""
    parts = re.split(r"^=+\s*\nMSG:\s*(\S+)\s*$", definition, flags=re.MULTILINE)
    bodies = {"": parts[0]} | {name.replace("/msg/", "/"): body for name, body in zip(parts[1::2], parts[2::2])}

    def build(name: str, inside: tuple[str, ...]) -> list[tuple[str, Step]]:
        if name in inside:
            raise ValueError(f"{name} holds itself")
        out = []
        for line in bodies[name].splitlines():
            line = line.split("#")[0].strip()
            m = _FIELD.match(line)
            if not line or (m and m["rest"].strip() == "="):
                continue
            if not m:
                raise ValueError(f"not a field: {line}")
            # an array of at most n is a sequence like any other
            count = None if not m["array"] else int(m["count"]) if m["count"] and "<=" not in m["array"] else -1
            kind = m["type"].replace("/msg/", "/")
            if kind in PRIMITIVES or kind == "string":
                out.append((m["name"], Step(kind, count)))
                continue
            # a bare name is of the same package, or the header
            known = next((k for k in (kind, f"{name.split('/')[0]}/{kind}", "std_msgs/Header" if kind == "Header" else kind) if k in bodies), None) or next((k for k in bodies if k.split("/")[-1] == kind), None)
            if known is None:
                raise ValueError(f"{kind} is not defined")
            out.append((m["name"], Step("struct", count, build(known, (*inside, name)))))
        return out or [("structure_needs_at_least_one_member", Step("uint8"))]

    return Step("struct", None, build("", ()))


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start .. start + size of each, one after the other."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


class Cursors:
    """Where each message of a batch is being read; ``at`` counts from behind its header."""

    def __init__(self, raw: np.ndarray, base: np.ndarray, size: np.ndarray, swap: bool):
        self.raw, self.base, self.size, self.swap = raw, base, size, swap
        self.at = np.zeros(len(base), dtype=np.int64)
        self.bad = size < 0

    def some(self, which: np.ndarray) -> Cursors:
        out = Cursors(self.raw, self.base[which], self.size[which], self.swap)
        out.at, out.bad = self.at[which], self.bad[which]
        return out

    def back(self, which: np.ndarray, part: Cursors) -> None:
        self.at[which], self.bad[which] = part.at, part.bad

    def align(self, size: int, which: np.ndarray | slice = slice(None)) -> None:
        self.at[which] += -self.at[which] % size

    def _move(self, size: np.ndarray) -> np.ndarray:
        """Sizes that can be read; the others are bad and read nothing more."""
        self.bad |= (size < 0) | (self.at + size > self.size)
        return np.where(self.bad, 0, size)

    def numbers(self, kind: str, count: int = 1) -> np.ndarray:
        kind = np.dtype(PRIMITIVES[kind][0])
        self.align(kind.itemsize)
        n = kind.itemsize * count
        self._move(np.full(len(self.at), n))
        place = np.where(self.bad, 0, self.base + self.at)
        if len(self.raw) < n:
            return np.zeros((len(place), count), kind)
        # bad ones read some place that is there
        place = np.minimum(place, len(self.raw) - n)
        got = self.raw[place[:, None] + np.arange(n)].view(kind.newbyteorder(">") if self.swap else kind)
        self.at += np.where(self.bad, 0, n)
        return got

    def bytes(self, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all bytes, how many of each)"""
        size = self._move(size)
        out = self.raw[_spread(self.base + self.at, size)]
        self.at += size
        return out, size


def _offsets(size: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(size)]).astype(np.int32)


def _plain(kind: str, values: np.ndarray) -> pa.Array:
    to = ARROW[PRIMITIVES[kind][1]]
    if kind == "bool":
        return pa.array(values.astype(np.uint8) != 0)
    if kind == "uint64":
        values = values.astype(np.uint64).view(np.int64)
    return pa.array(values.astype(values.dtype.newbyteorder("=")).astype(to.to_pandas_dtype()), to)


def _run(step: Step, c: Cursors) -> pa.Array:
    n = len(c.at)
    if step.count is None:
        if step.kind == "struct":
            parts = [_run(s, c) for _, s in step.fields]
            return pa.StructArray.from_arrays(parts, names=[name for name, _ in step.fields])
        if step.kind == "string":
            # the length counts a zero at the end
            size = c.numbers("uint32").astype(np.int64).reshape(-1)
            data, size = c.bytes(size)
            ends = np.cumsum(size)
            keep = np.ones(len(data), dtype=bool)
            keep[ends[size > 0] - 1] = data[ends[size > 0] - 1] != 0
            size = np.diff(np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], ends])])
            data = data[keep].tobytes()
            out = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(_offsets(size)), pa.py_buffer(data)])
            try:
                data.decode()
                return out.cast(pa.string())
            except (UnicodeDecodeError, pa.ArrowInvalid):
                return pa.array([x.decode("utf-8", "replace") for x in out.to_pylist()], pa.string())
        return _plain(step.kind, c.numbers(step.kind).reshape(-1))
    if step.count >= 0:
        count = np.full(n, step.count, dtype=np.int64)
    else:
        count = c.numbers("uint32").astype(np.int64).reshape(-1)
        count[c.bad] = 0
    if step.kind not in ("struct", "string"):
        size = np.dtype(PRIMITIVES[step.kind][0]).itemsize
        c.align(size, count > 0)
        data, got = c.bytes(count * size)
        if step.kind in SINGLE:
            return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(_offsets(got)), pa.py_buffer(data.tobytes())])
        kind = np.dtype(PRIMITIVES[step.kind][0])
        values = data.view(kind.newbyteorder(">") if c.swap else kind)
        return pa.ListArray.from_arrays(pa.array(_offsets(got // size)), _plain(step.kind, values))
    # an element takes one byte at least
    c.bad |= count > np.maximum(c.size - c.at, 0)
    count[c.bad] = 0
    one, parts, owners = Step(step.kind, None, step.fields), [], []
    for k in range(int(count.max()) if n else 0):
        which = np.flatnonzero((count > k) & ~c.bad)
        some = c.some(which)
        parts.append(_run(one, some))
        owners.append(which)
        c.back(which, some)
    if not parts:
        return pa.ListArray.from_arrays(pa.array(np.zeros(n + 1, dtype=np.int32)), pa.array([], one.arrow))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return pa.ListArray.from_arrays(pa.array(_offsets(np.bincount(owner, minlength=n))), pa.concat_arrays(parts).take(pa.array(order)))


def decode_array(step: Step, data: pa.Array) -> pa.StructArray:
    """A struct for each message."""
    data = data.cast(pa.binary()) if not pa.types.is_binary(data.type) else data
    n = len(data)
    buffers = data.buffers()
    at = np.frombuffer(buffers[1], np.int32, n + 1 + data.offset)[data.offset :].astype(np.int64) if n else np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(buffers[2], np.uint8) if n and buffers[2] is not None else np.zeros(0, dtype=np.uint8)
    start, size = at[:-1], np.diff(at)
    there = ~data.is_null().to_numpy(zero_copy_only=False) & (size >= 4)
    little = np.zeros(n, dtype=bool)
    little[there] = raw[start[there] + 1] & 1 == 1
    parts, owners = [], []
    for swap in (False, True):
        which = np.flatnonzero(there & (little != swap))
        if len(which):
            c = Cursors(raw, start[which] + 4, size[which] - 4, swap)
            got = _run(step, c)
            parts.append(got.filter(pa.array(~c.bad)))
            owners.append(which[~c.bad])
    if not parts:
        return pa.nulls(n, step.arrow)
    place = np.full(n, -1, dtype=np.int64)
    owner = np.concatenate(owners)
    place[owner] = np.arange(len(owner))
    return pa.concat_arrays(parts).take(pa.array(place, mask=place < 0))


def decode(messages: DataFrame, definition: str, data: str = "data", out: str = "msg") -> DataFrame:
    """All other columns, and the decoded message in place of its bytes."""
    step = compiled(definition)
    keep = [c for c in messages.columns if c != data]
    schema = ", ".join([*(f"`{c}` {messages.schema[c].dataType.simpleString()}" for c in keep), f"`{out}` {step.ddl}"])

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), decode_array(step, batch.column(data))], names=[*keep, out])

    return messages.select(*keep, F.col(data)).mapInArrow(run, schema)


def _write(step: Step, value, out: bytearray) -> None:
    """Appends a value; ``out`` has no header, so its length is the place to align."""

    def number(kind: str, v) -> None:
        form = PRIMITIVES[kind][0]
        out.extend(b"\0" * (-len(out) % struct.calcsize(form)))
        out.extend(struct.pack("<" + form, v & 0xFFFFFFFFFFFFFFFF if kind == "uint64" else v))

    if step.count is None:
        if step.kind == "struct":
            for name, s in step.fields:
                _write(s, (value or {}).get(name), out)
        elif step.kind == "string":
            text = (value or "").encode() + b"\0"
            number("uint32", len(text))
            out.extend(text)
        else:
            number(step.kind, value or 0)
        return
    items = list(value or ())
    if step.count >= 0:
        if len(items) > step.count:
            raise ValueError(f"{len(items)} values for an array of {step.count}")
        items += [None] * (step.count - len(items))
    else:
        number("uint32", len(items))
    one = Step(step.kind, None, step.fields)
    for x in items:
        _write(one, x, out)


def encode_value(step: Step, value: dict) -> bytes:
    """The bytes of one message, little-endian; missing fields are zero or empty."""
    out = bytearray()
    _write(step, value, out)
    return b"\0\1\0\0" + bytes(out)


def encode(messages: DataFrame, definition: str, msg: str = "msg", out: str = "data") -> DataFrame:
    """All other columns, and the message's bytes in place of its struct; a null struct stays null."""
    step = compiled(definition)
    keep = [c for c in messages.columns if c != msg]
    schema = ", ".join([*(f"`{c}` {messages.schema[c].dataType.simpleString()}" for c in keep), f"`{out}` binary"])

    def run(batches):
        for batch in batches:
            for part in (batch.slice(i, 1024) for i in range(0, batch.num_rows, 1024)):
                data = [None if v is None else encode_value(step, v) for v in part.column(msg).to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(data, pa.binary())], names=[*keep, out])

    return messages.select(*keep, F.col(msg)).mapInArrow(run, schema)
