"""Containers: written and read in parts, pruned reads, and a recording with other calibration."""

import json
import os
import random
import struct
import zlib

import pytest
from fake_files import counting, read_bytes
from pyspark.sql import functions as F

from roadglass.sources import cdr, container, messages, rewrite

TEXTS = {"std_msgs/msg/String": cdr.DEFINITIONS["std_msgs/msg/String"], "sensor_msgs/msg/CameraInfo": cdr.DEFINITIONS["sensor_msgs/msg/CameraInfo"], "tf2_msgs/msg/TFMessage": cdr.DEFINITIONS["tf2_msgs/msg/TFMessage"]}


def log_of(spark, n=2000, topics=3):
    rng = random.Random(5)
    rows = [(f"/t{rng.randrange(topics)}", "std_msgs/msg/String", 1000 + 3 * i, 0, i, bytearray(rng.randbytes(rng.randint(0, 60)))) for i in range(n)]
    return rows, spark.createDataFrame(rows, messages.SCHEMA)


def content(rows):
    return sorted((r[0], r[1], r[2], bytes(r[5])) for r in rows)


@pytest.mark.parametrize("compression", ["", "zstd"])
def test_there_and_back_in_parts(spark, tmp_path, compression):
    rows, log = log_of(spark)
    container.write(log, str(tmp_path / "out"), TEXTS, compression=compression, parts=3, chunk_bytes=4000)
    assert sorted(os.listdir(tmp_path)) == ["out"] and sorted(os.listdir(tmp_path / "out")) == [f"bag_{i:06d}.mcap" for i in range(3)]
    got = container.read(spark, str(tmp_path / "out"), task_bytes=9000)
    assert content(got.collect()) == content(rows) and got.rdd.getNumPartitions() > 3
    ordered = got.orderBy(*messages.ORDER).collect()
    assert [r["log_time_ns"] for r in ordered] == sorted(r[2] for r in rows)
    index = container.chunks(spark, str(tmp_path / "out"), True)
    assert index.count() > 10 and index.select(F.sum(F.aggregate("channels", F.lit(0).cast("long"), lambda s, c: s + c["count"]))).first()[0] == len(rows)
    assert [r["definition"] for r in container.schemas(spark, str(tmp_path / "out")).collect()] == ["string data"]


def test_topics_and_times_read_the_chunks_that_hold_them_only(spark, tmp_path):
    # one topic in the first half, another in the second
    rows = [("/a" if i < 1000 else "/b", "std_msgs/msg/String", i, 0, i, bytearray(b"%050d" % i)) for i in range(2000)]
    path, note = str(tmp_path / "out"), str(tmp_path / "note")
    container.write(spark.createDataFrame(rows, messages.SCHEMA), path, parts=1, chunk_bytes=4000)
    whole = os.path.getsize(f"{path}/bag_000000.mcap")
    for topics, low, high, want in ((["/a"], None, None, 1000), (None, 1500, 1599, 100), (["/a"], 950, 1100, 50), (["/none"], None, None, 0), (None, 5000, None, 0)):
        got = container.read(spark, path, topics, low, high, open_file=counting(note))
        read_bytes(note)
        assert got.count() == want
        index = read_bytes(note)
        assert index < whole * (0.75 if want == 1000 else 0.35), (topics, low, high)
    assert container.read(spark, path, open_file=counting(note)).count() == 2000 and read_bytes(note) > whole * 0.8


@pytest.mark.parametrize("every, limit", [(1, 5), (7, None), (100, 3), (3, 10_000), (1, 0)])
def test_every_nth_message_of_a_topic(spark, tmp_path, every, limit):
    rows, log = log_of(spark, 1500)
    path, note = str(tmp_path / "out"), str(tmp_path / "note")
    container.write(log, path, parts=2, chunk_bytes=3000)
    got = container.read_sampled(spark, path, ["/t0", "/t2"], every, limit, open_file=counting(note)).collect()
    want = []
    for topic in ("/t0", "/t2"):
        mine = [r for r in rows if r[0] == topic][::every]
        want += mine if limit is None else mine[:limit]
    assert content(got) == content(want)
    if limit == 5:
        assert read_bytes(note) < 0.4 * sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path))


def test_chunks_that_overlap_are_numbered_by_their_messages(spark, tmp_path):
    path = tmp_path / "bag.mcap"
    times = [5, 1, 9, 3, 2, 8, 7, 4, 6, 0]
    with open(path, "wb") as f:
        out = container.ContainerFile(f, {}, "", 1)  # a chunk for each message
        for t in times:
            out.add("/x", "s", t, b"%d" % t)
        out.close()
    got = container.read_sampled(spark, str(path), ["/x"], 4).collect()
    assert sorted(r["log_time_ns"] for r in got) == [0, 4, 8]


def test_files_without_a_summary_or_cut_off(spark, tmp_path):
    head = container.MAGIC + container._record(1, container._string("") + container._string(""))
    body = container._record(3, struct.pack("<H", 1) + container._string("s") + container._string("") + container._string("")) + container._record(4, struct.pack("<HH", 0, 1) + container._string("/x") + container._string("cdr") + container._string(b""))
    body += b"".join(container._record(5, struct.pack("<HIQQ", 0, i, i, i) + b"d%d" % i) for i in range(20))
    (tmp_path / "a.mcap").write_bytes(head + body + container._record(15, bytes(4)) + container._record(2, bytes(20)) + container.MAGIC)
    (tmp_path / "b.mcap").write_bytes(head + body[:-3])
    packed = struct.pack("<QQQI", 0, 19, len(body), zlib.crc32(body)) + container._string("") + struct.pack("<Q", len(body)) + body
    (tmp_path / "c.mcap").write_bytes(head + container._record(6, packed))
    (tmp_path / "d.mcap").write_bytes(head)
    got = container.read(spark, str(tmp_path)).groupBy("file_seq").count().collect()
    assert sorted(map(tuple, got)) == [(0, 20), (1, 19), (2, 20)]
    assert container.read_sampled(spark, str(tmp_path / "c.mcap"), ["/x"], 6).count() == 4
    (tmp_path / "e.mcap").write_bytes(head + container._record(6, packed[:-1] + b"!"))
    with pytest.raises(Exception, match="checksum"):
        container.read(spark, str(tmp_path / "e.mcap")).collect()


def test_an_existing_result_stays_without_force_and_a_failure_leaves_nothing(spark, tmp_path):
    rows, log = log_of(spark, 50)
    path = str(tmp_path / "out")
    container.write(log, path)
    with pytest.raises(Exception, match="exists"):
        container.write(log.limit(5), path)
    assert container.read(spark, path).count() == 50
    with pytest.raises(Exception, match="needs a topic"):
        container.write(log.withColumn("data", F.when(F.col("msg_seq") != 30, F.col("data"))), path, force=True)
    assert container.read(spark, path).count() == 50 and os.listdir(tmp_path) == ["out"]
    container.write(log.limit(5), path, force=True)
    assert container.read(spark, path).count() == 5
    container.write(log.where("false"), str(tmp_path / "empty"))
    assert container.read(spark, str(tmp_path / "empty")).count() == 0


# ---- calibration -----------------------------------------------------------------------


def info(frame, k):
    step = cdr.compiled(TEXTS["sensor_msgs/msg/CameraInfo"])
    return cdr.encode_value(step, {"header": {"stamp": {"sec": 3, "nanosec": 4}, "frame_id": frame}, "width": 100, "height": 100, "distortion_model": "plumb_bob", "k": [k] * 9, "d": [0.0] * 5, "p": [k] * 12, "r": [1.0] * 9})


@pytest.fixture
def params(tmp_path):
    top = tmp_path / "params"
    tf = {"base_link": {"child_a": {"x": 1.0, "y": 2.0, "z": 3.0}, "camera1/camera_link": {"x": 5, "yaw": 0.5}}, "parent_b": {"child_b": {"x": 4.0, "roll": 0.1, "pitch": 0.2, "yaw": 0.3}, "note": "no transform"}, "text": "none"}
    for i in range(3):
        (top / f"camera{i}").mkdir(parents=True)
        data = {"image_width": 640, "image_height": 480, "distortion_model": "rational", "camera_matrix": {"data": [10.0 * (i + 1)] * 9}, "distortion_coefficients": {"data": [0.5] * 8}, "projection_matrix": {"data": [7.0] * 12}, "rectification_matrix": {"data": [1, 0, 0, 0, 1, 0, 0, 0, 1]}}
        (top / f"camera{i}" / "camera_info.json").write_text(json.dumps(data))
    (top / "multi_tf_static.json").write_text(json.dumps(tf))
    return str(top)


@pytest.fixture
def bag(spark, tmp_path):
    old = cdr.encode_value(cdr.compiled(TEXTS["tf2_msgs/msg/TFMessage"]), {"transforms": [{"child_frame_id": "old_child"}]})
    text = cdr.encode_value(cdr.compiled("string data"), {"data": "passes"})
    at = lambda n: f"/sensing/camera/camera{n}/camera_info"
    rows = [("/tf_static", "tf2_msgs/msg/TFMessage", 1_000_000_005, old), (at(0), "sensor_msgs/msg/CameraInfo", 1_100_000_000, info("optical0", 999.0)), (at(9), "sensor_msgs/msg/CameraInfo", 1_200_000_000, info("optical9", 999.0)), ("/imu/data", "std_msgs/msg/String", 1_300_000_000, text), ("/tf_static", "tf2_msgs/msg/TFMessage", 2_000_000_000, old)]
    log = spark.createDataFrame([(t, s, n, 0, i, bytearray(d)) for i, (t, s, n, d) in enumerate(rows)], messages.SCHEMA)
    container.write(log, str(tmp_path / "in"), TEXTS)
    return str(tmp_path / "in"), {(t, n): d for t, _, n, d in rows}


def test_calibration_is_replaced_and_all_else_stays(spark, tmp_path, params, bag):
    source, old = bag
    target = str(tmp_path / "out")
    told = rewrite.rewrite(spark, source, target, params).collect()
    assert [(r["note"], r["subject"], r["messages"]) for r in told] == [("no document for camera", "camera9", 1)]
    got = {(r["topic"], r["log_time_ns"]): r for r in container.read(spark, target).collect()}
    assert got.keys() == old.keys()
    for key in old:
        if key[0] == "/imu/data" or "camera9" in key[0]:
            assert bytes(got[key]["data"]) == old[key]
    tf = container.read(spark, target, ["/tf_static"])
    for r in cdr.decode(tf, TEXTS["tf2_msgs/msg/TFMessage"]).collect():
        by = {t["child_frame_id"]: t for t in r["msg"]["transforms"]}
        assert set(by) == {"child_a", "child_b", "camera1/camera_link", "camera1/camera_optical_link"}
        assert all(t["header"]["stamp"]["sec"] * 10**9 + t["header"]["stamp"]["nanosec"] == r["log_time_ns"] for t in by.values())
        assert (by["child_a"]["header"]["frame_id"], by["child_a"]["transform"]["translation"]["y"], by["child_a"]["transform"]["rotation"]["w"]) == ("base_link", 2, 1)
        optical = by["camera1/camera_optical_link"]
        assert optical["header"]["frame_id"] == "camera1/camera_link" and optical["transform"]["translation"]["x"] == 0
        assert [optical["transform"]["rotation"][c] for c in "xyzw"] == [-0.5, 0.5, -0.5, 0.5]
    camera = container.read(spark, target, ["/sensing/camera/camera0/camera_info"])
    (r,) = cdr.decode(camera, TEXTS["sensor_msgs/msg/CameraInfo"]).collect()
    assert r["msg"]["header"]["frame_id"] == "optical0" and r["msg"]["header"]["stamp"]["sec"] == 3
    assert (r["msg"]["width"], r["msg"]["height"], r["msg"]["k"][0], len(r["msg"]["d"]), r["msg"]["distortion_model"]) == (640, 480, 10.0, 8, "rational")
    assert {r["schema_name"]: r["definition"] for r in container.schemas(spark, target).collect()} == TEXTS


def test_refusal_force_and_no_static_transforms(spark, tmp_path, params, bag):
    source, _ = bag
    target = str(tmp_path / "out")
    rewrite.rewrite(spark, source, target, params)
    with pytest.raises(Exception, match="exists"):
        rewrite.rewrite(spark, source, target, params)
    rewrite.rewrite(spark, source, target, params, force=True, compress=True)
    assert container.read(spark, target).count() == 5
    some = str(tmp_path / "some")
    container.write(container.read(spark, source, ["/imu/data"]), some)
    told = rewrite.rewrite(spark, some, str(tmp_path / "some_out"), params).collect()
    assert [r["note"] for r in told] == ["no static transforms"] and container.read(spark, str(tmp_path / "some_out")).count() == 1
    with pytest.raises(ValueError):
        rewrite.transforms_of(spark, {"a": "b"})
