"""Message bytes against bytes written by hand, and there and back."""

import struct

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadglass.sources import cdr, messages


class Hand:
    """Writes values one by one, aligned from behind the header."""

    def __init__(self, order="<"):
        self.out, self.order = b"", order

    def put(self, form, *values):
        for v in values:
            self.out += b"\0" * (-len(self.out) % struct.calcsize(form)) + struct.pack(self.order + form, v)
        return self

    def text(self, s):
        self.put("I", len(s.encode()) + 1)
        self.out += s.encode() + b"\0"
        return self

    def header(self, sec, nanosec, frame):
        return self.put("i", sec).put("I", nanosec).text(frame)

    def done(self):
        return (b"\0\1\0\0" if self.order == "<" else b"\0\0\0\0") + self.out


def one(kind, data):
    return cdr.decode_array(cdr.compiled(cdr.DEFINITIONS[kind]), pa.array([data], pa.binary())).to_pylist()[0]


@pytest.mark.parametrize("order", ["<", ">"])
def test_fix_imu_and_odometry(order):
    cov = [float(i) for i in range(9)]
    fix = Hand(order).header(7, 8, "gps").put("b", -1).put("H", 3).put("d", 35.5, 139.25, 12.0, *cov).put("B", 2).done()
    got = one("sensor_msgs/msg/NavSatFix", fix)
    assert got["header"] == {"stamp": {"sec": 7, "nanosec": 8}, "frame_id": "gps"} and got["status"] == {"status": -1, "service": 3}
    assert (got["latitude"], got["longitude"], got["altitude"], got["position_covariance"], got["position_covariance_type"]) == (35.5, 139.25, 12.0, cov, 2)
    imu = Hand(order).header(1, 2, "imu_link").put("d", 0, 0, 0.6, 0.8, *cov, 1, 2, 3, *cov, 4, 5, 6, *cov).done()
    got = one("sensor_msgs/msg/Imu", imu)
    assert got["orientation"] == {"x": 0, "y": 0, "z": 0.6, "w": 0.8} and got["angular_velocity"]["z"] == 3 and got["linear_acceleration"]["x"] == 4
    odo = Hand(order).header(1, 2, "odom").text("base").put("d", 1, 2, 3, 0, 0, 0, 1, *range(36), 7, 8, 9, 10, 11, 12, *range(36)).done()
    got = one("nav_msgs/msg/Odometry", odo)
    assert got["child_frame_id"] == "base" and got["pose"]["pose"]["position"] == {"x": 1, "y": 2, "z": 3} and got["pose"]["covariance"][7] == 7 and got["twist"]["twist"]["angular"]["z"] == 12


@pytest.mark.parametrize("order", ["<", ">"])
def test_transforms_camera_and_points(order):
    tf = Hand(order).put("I", 2)
    for k, (parent, child) in enumerate([("base_link", "a"), ("a", "camera0/camera_link")]):
        tf.header(5, k, parent).text(child).put("d", k, 2, 3, 0, 0, 0, 1)
    got = one("tf2_msgs/msg/TFMessage", tf.done())["transforms"]
    assert [(t["header"]["frame_id"], t["child_frame_id"], t["transform"]["translation"]["x"]) for t in got] == [("base_link", "a", 0), ("a", "camera0/camera_link", 1)]
    info = Hand(order).header(0, 0, "cam").put("I", 480, 640).text("plumb_bob").put("I", 5).put("d", *range(5), *range(9), *range(9), *range(12)).put("I", 0, 0, 1, 2, 3, 4).put("?", True).done()
    got = one("sensor_msgs/msg/CameraInfo", info)
    assert (got["height"], got["width"], got["distortion_model"], got["d"]) == (480, 640, "plumb_bob", [0, 1, 2, 3, 4]) and got["p"][11] == 11 and got["roi"] == {"x_offset": 1, "y_offset": 2, "height": 3, "width": 4, "do_rectify": True}
    cloud = Hand(order).header(0, 0, "lidar").put("I", 1, 2, 2).text("x").put("I", 0).put("B", 7).put("I", 1).text("intensity").put("I", 4).put("B", 2).put("I", 1).put("?", False).put("I", 5, 10, 10)
    cloud.out += bytes(range(10))
    cloud.put("?", True)
    got = one("sensor_msgs/msg/PointCloud2", cloud.done())
    assert [(f["name"], f["offset"], f["datatype"]) for f in got["fields"]] == [("x", 0, 7), ("intensity", 4, 2)] and got["data"] == bytes(range(10)) and got["point_step"] == 5 and got["is_dense"] is True


def test_a_message_that_ends_early_or_lies_about_its_length_is_null():
    step = cdr.compiled(cdr.DEFINITIONS["tf2_msgs/msg/TFMessage"])
    whole = Hand().put("I", 1).header(1, 2, "p").text("c").put("d", 1, 2, 3, 0, 0, 0, 1).done()
    cut = [whole[:n] for n in range(len(whole))]
    lies = [b"\0\1\0\0" + struct.pack("<I", 0xFFFFFFFF), b"\0\1\0\0" + struct.pack("<I", 3) + whole[8:]]
    got = cdr.decode_array(step, pa.array([whole, *cut, *lies, None, b"", whole + b"more"], pa.binary())).to_pylist()
    assert got[0] == got[-1] and got[0]["transforms"][0]["child_frame_id"] == "c" and all(g is None for g in got[1:-1])


def test_definitions_with_all_kinds_of_fields():
    text = """# a comment
uint8 MODE_A=1
string NAME="x # y"
Header header
int64[<=3] few
string[] names  # names
string<=10 short
pkg/Inner[2] pair
bool[] flags
uint64 big 7
================================================================================
MSG: pkg/Inner
int8 a
Deep deep
===
MSG: pkg/Deep
float32 f
===
MSG: std_msgs/Header
string frame_id
"""
    step = cdr.compiled(text)
    assert step.ddl == "struct<`header`:struct<`frame_id`:string>,`few`:array<bigint>,`names`:array<string>,`short`:string,`pair`:array<struct<`a`:tinyint,`deep`:struct<`f`:float>>>,`flags`:array<boolean>,`big`:bigint>"
    value = {"header": {"frame_id": "f"}, "few": [1, -2], "names": ["", "é"], "short": "s", "pair": [{"a": 1, "deep": {"f": 0.5}}, {"a": -1, "deep": {"f": 1.5}}], "flags": [True, False], "big": -1}
    assert cdr.decode_array(step, pa.array([cdr.encode_value(step, value)] * 3, pa.binary())).to_pylist() == [value] * 3
    for bad in ("pkg/None x", "int32", "A a\n===\nMSG: A\nA a"):
        with pytest.raises(ValueError):
            cdr.compiled(bad)


MIXED = cdr.compiled("string s\nuint8[] raw\nfloat64[] d\nItem[] items\n===\nMSG: Item\nint16 k\nstring t\nint32[] n")
values = st.fixed_dictionaries({"s": st.text(max_size=4).filter(lambda t: "\0" not in t), "raw": st.binary(max_size=5), "d": st.lists(st.floats(allow_nan=False), max_size=3), "items": st.lists(st.fixed_dictionaries({"k": st.integers(-9, 9), "t": st.text("ab", max_size=3), "n": st.lists(st.integers(-9, 9), max_size=3)}), max_size=3)})


@settings(max_examples=300, deadline=None)
@given(st.lists(values, max_size=6))
def test_there_and_back(rows):
    got = cdr.decode_array(MIXED, pa.array([cdr.encode_value(MIXED, r) for r in rows], pa.binary()))
    assert got.to_pylist() == rows


def test_in_spark_up_to_typed_series(spark):
    fix = Hand().header(7, 8, "gps").put("b", 0).put("H", 1).put("d", 35.5, 139.25, 12.0, 4, 0, 0, 0, 12, 0, 0, 0, 1).put("B", 2).done()
    log = spark.createDataFrame([("/fix", "sensor_msgs/msg/NavSatFix", 5, 0, 0, bytearray(fix)), ("/fix", "sensor_msgs/msg/NavSatFix", 6, 0, 1, None)], messages.SCHEMA)
    got = messages.fixes(cdr.decode(log, cdr.DEFINITIONS["sensor_msgs/msg/NavSatFix"])).orderBy("t").collect()
    assert (got[0]["lat"], got[0]["lon"], got[0]["alt"], got[0]["status"]) == (35.5, 139.25, 12.0, 0) and round(got[0]["spread"], 9) == round(8**0.5, 9) and got[1]["lat"] is None
    back = cdr.encode(cdr.decode(log, cdr.DEFINITIONS["sensor_msgs/msg/NavSatFix"]), cdr.DEFINITIONS["sensor_msgs/msg/NavSatFix"]).orderBy("msg_seq").collect()
    assert bytes(back[0]["data"]) == fix and back[1]["data"] is None and cdr.decode(log.where("false"), cdr.DEFINITIONS["std_msgs/msg/String"]).count() == 0
