"""Relational operators, texts, datasets, sinks, streams."""

import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F

from roadglass.functions import text
from roadglass.operators import relational as R
from roadglass.operators import reports
from roadglass.sources import dataset, mcap, messages, pcd, sinks
from roadglass.streaming import pulses


@pytest.fixture(autouse=True, scope="module")
def checkpoints(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(tmp_path_factory.mktemp("checkpoints").as_uri())


def test_required_join_stops_on_a_missing_key(spark):
    left, right = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(Exception, match="sensor without a row"):
        R.required_join(left, right, ["k"], "sensor").collect()
    assert R.required_join(left.where("k = 1"), right, ["k"], "sensor").count() == 1


@pytest.mark.parametrize("links,want", [({"a": "b", "b": "c", "c": ""}, [0, 1, 2]), ({"a": "b", "b": "a", "c": ""}, None), ({"a": "c", "b": "c", "c": ""}, None), ({"c": ""}, [0])])
def test_chain(spark, links, want):
    rows = spark.createDataFrame([("g", k, v) for k, v in links.items()], "g string, token string, next string")
    got = {r["token"]: r["position"] for r in R.chain(rows, ["g"], "token", "next").collect()}
    assert [got[k] for k in sorted(links)] == (want or [None] * len(links))


def test_longest_prefix(spark):
    rows = spark.createDataFrame([("a_b_c",), ("a_x",), ("z",), ("ab_c",)], "s string")
    bases = spark.createDataFrame([("a",), ("a_b",), ("a_b_c",)], "base string")
    assert sorted(map(tuple, R.longest_prefix(rows, "s", bases, "base").collect())) == [("a_b_c", "a_b"), ("a_x", "a")]


def test_review_summary(spark):
    rows = spark.createDataFrame([(True, [("blur", "high"), (None, None)]), (None, []), (False, [])], "ok boolean, issues array<struct<category:string,severity:string>>")
    got = {(r["metric"], r["item"]): r["value"] for r in reports.review_summary(rows, "ok", "issues").collect()}
    assert got == {("n_total", ""): 3, ("n_evaluated", ""): 2, ("ok_ratio", ""): 0.5, ("category", "blur"): 1, ("category", "other"): 1, ("severity", "high"): 1, ("severity", "low"): 1}
    none = {r["metric"]: r["value"] for r in reports.review_summary(rows.where("ok IS NULL"), "ok", "issues").collect()}
    assert none["ok_ratio"] is None


@pytest.mark.parametrize("answer,want", [('{"a": 1}', '{"a":1}'), ('<think>{"b": 2}</think>```json\n{"a": 1}\n```', '{"a":1}'), ('so {"a": "}\\"{"} and {"c": 1}', '{"a":"}\\"{"}'), ("nothing", None), ('{"a": 1', None), (None, None)])
def test_parse_answer(spark, answer, want):
    df = spark.createDataFrame([(answer,)], "a string").select(F.to_json(text.parse_answer(F.col("a"))).alias("j"))
    assert df.first()["j"] == want


def test_tags(spark):
    df = spark.createDataFrame([("flicker_whole_red_deg30_rcw05_whole_red",)], "c string").select(text.tags(F.col("c")).alias("t"))
    assert [tuple(x) for x in df.first()["t"]] == [("flicker", None), ("whole", "red:30"), ("rcw", "05"), ("unknown", "whole"), ("unknown", "red")]


def test_tar_offsets():
    archive, places = dataset.pack_tar([("a.json", b"{}"), ("b.bin", b"x" * 1000)])
    for name, (start, size) in places.items():
        assert archive[start : start + size] == tarfile.open(fileobj=io.BytesIO(archive)).extractfile(name).read()


def test_shards(spark):
    rows = spark.createDataFrame([("c1", "2", b"two"), ("c1", "1", b"one"), ("c2", "1", b"x")], "clip string, name string, body binary")
    got = {r["clip"]: (r["archive"], json.loads(r["index"])) for r in dataset.shards(rows, "clip", "name", "body").collect()}
    start, size = got["c1"][1]["2"]
    assert bytes(got["c1"][0][start : start + size]) == b"two" and list(got["c1"][1]) == ["1", "2"]


def test_frames(spark):
    make = spark.createDataFrame
    got = dataset.frames(
        make([("s1", "s2", "sc"), ("s2", "", "sc")], "token string, next string, scene_token string"),
        make([("s1", "c", "p1", "f1"), ("s2", "c", "none", "f2")], "sample_token string, calibrated_sensor_token string, ego_pose_token string, filename string"),
        make([("x", "CAM", "camera")], "token string, channel string, modality string"),
        make([("c", "x")], "token string, sensor_token string"),
        make([("p1", [1.0], [1.0])], "token string, translation array<double>, rotation array<double>"),
        make([("s1", "i1"), ("s1", "i2")], "sample_token string, instance_token string"),
        make([("i1", "k1")], "token string, category_token string"),
        make([("k1", "car")], "token string, name string"),
    )
    rows = {r["token"]: r for r in got.collect()}
    assert rows["s1"]["frame_key"] == "00000" and rows["s2"]["frame_key"] == "00001"
    assert rows["s1"]["num_boxes"] == 2 and rows["s1"]["categories"] == ["car"] and rows["s2"]["categories"] == []
    assert rows["s2"]["views"][0]["ego_translation"] is None


def test_events_csv_has_a_header_without_rows(spark, tmp_path):
    none = spark.createDataFrame([], "t_ns long, lat double, lon double, maneuver_type string, magnitude double")
    sinks.write_events(none, str(tmp_path / "e"))
    assert next((tmp_path / "e").glob("*.csv")).read_text().strip() == "t_ns,lat,lon,maneuver_type,magnitude"


def asks(folder):
    return sorted(p.read_text() for p in folder.glob("*.asked"))


def test_review_asks_each_frame_once_or_twice(spark, tmp_path):
    """A client that answers at random: no frame is lost or repeated, and none is asked more than twice."""
    note = tmp_path / "asked"
    note.mkdir()

    def ask(prompt: str) -> str:
        import random
        import uuid

        (note / f"{uuid.uuid4().hex}.asked").write_text(prompt.split("\n")[0])
        return '{"frame_ok": true, "n": %f}' % random.random() if random.random() < 0.5 else "no { idea"

    frames = spark.createDataFrame([(i, f"frame {i}") for i in range(200)], "id long, prompt string").repartition(7)
    out = sinks.review(frames, ask, ["id"], str(tmp_path / "answers"))
    got, again = out.collect(), out.collect()
    assert sorted(r["id"] for r in got) == list(range(200)) and sorted(map(str, got)) == sorted(map(str, again))
    calls = {f"frame {r['id']}": r["calls"] for r in got}
    asked = asks(note)
    assert {a: asked.count(a) for a in set(asked)} == calls and set(calls.values()) == {1, 2}
    failed = [r for r in got if not r["parse_ok"]]
    assert failed and all(r["calls"] == 2 for r in failed)
    for r in failed:
        told = json.loads(r["parsed"])
        assert told["frame_ok"] is None and told["raw_response"] == r["answer"] == "no { idea" and told["overall_notes"] == ""
        assert [(x["category"], x["severity"], x["region"]) for x in told["issues"]] == [("other", "high", None)]
    # with the same folder nothing is asked again, and more frames are
    sinks.review(frames, ask, ["id"], str(tmp_path / "answers")).collect()
    assert asks(note) == asked
    more = frames.unionByName(spark.createDataFrame([(200, "frame 200")], "id long, prompt string"))
    assert sinks.review(more, ask, ["id"], str(tmp_path / "answers")).count() == 201
    assert set(asks(note)) - set(asked) == {"frame 200"}
    with pytest.raises(ValueError):
        sinks.review(frames.unionByName(frames), ask, ["id"], str(tmp_path / "other"))


def test_review_retries_with_a_reminder(spark, tmp_path):
    def ask(prompt: str) -> str:
        return '{"ok": true}' if "JSON" in prompt or prompt == "good" else "well"

    rows = spark.createDataFrame([("good", "x"), ("bad", None), ("", "y")], "prompt string, answered string")
    got = {r["prompt"]: (r["parse_ok"], r["calls"], r["answered"]) for r in sinks.review(rows, ask, ["prompt"], str(tmp_path)).collect()}
    assert got == {"good": (True, 1, "x"), "bad": (True, 2, None), "": (True, 2, "y")}


def test_bag_files(tmp_path):
    with pytest.raises(FileNotFoundError):
        messages.bag_files(str(tmp_path))
    for n in ("b.mcap", "a.mcap", "c.txt"):
        (tmp_path / n).touch()
    assert [p[-6:] for p in messages.bag_files(str(tmp_path))] == ["a.mcap", "b.mcap"]


def test_mcap_needs_its_library(spark):
    try:
        import mcap as library  # noqa: F401
    except ImportError:
        with pytest.raises(ImportError, match="mcap"):
            mcap.register(spark)


def test_position_modes(spark):
    packet = bytearray(72)
    packet[68] = 5
    late, other, high = bytearray(packet), bytearray(packet), bytearray(packet)
    late[68], other[62], high[68] = 0x85, 1, 40
    df = spark.createDataFrame([(i, bytes(p)) for i, p in enumerate((packet, late, other, high, packet[:60]))], "i int, data binary")
    assert [(r["i"], r["mode"]) for r in messages.position_modes(df).collect()] == [(0, 5)]


def test_static_transforms_last_wins(spark):
    schema = "file_seq int, log_time_ns long, msg_seq long, msg struct<transforms:array<struct<header:struct<frame_id:string>,child_frame_id:string,transform:struct<translation:struct<x:double,y:double,z:double>,rotation:struct<x:double,y:double,z:double,w:double>>>>>"
    tf = lambda x: (("base",), "cam", ((x, 0.0, 0.0), (0.0, 0.0, 0.0, 1.0)))
    df = spark.createDataFrame([(0, 1, 0, ([tf(1.0)],)), (0, 2, 1, ([tf(2.0), tf(3.0)],))], schema)
    assert [(r["parent"], r["child"], r["x"]) for r in messages.static_transforms(df).collect()] == [("base", "cam", 3.0)]


def test_stream_pulses(spark, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    schema = "series long, t long, v double"
    for i, rows in enumerate(([(1, 1, 0.0), (1, 2, 3.0), (2, 2, 5.0)], [(1, 3, -4.0), (1, 4, 0.1), (2, 3, 5.5)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run = pulses.stream_pulses(stream, 2.0, 0.5).writeStream.format("memory").queryName("pulses").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    assert [tuple(r) for r in spark.table("pulses").collect()] == [(1, 2, 3, 4, -4.0)]
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_point_files_are_written_by_tasks(spark, tmp_path):
    rows = [(f"s{i % 3}", i, float(i), 2.0, 3.0, None if i == 4 else 0.5) for i in range(50)] + [(None, 99, 1.0, 1.0, 1.0, 1.0)]
    points = spark.createDataFrame(rows, "scan string, point long, x double, y double, z double, intensity double").repartition(4)
    told = {r["scan"]: r["points"] for r in pcd.write(points, str(tmp_path), "scan").collect()}
    assert told == {"s0": 17, "s1": 17, "s2": 16} and sorted(p.name for p in tmp_path.glob("*.pcd")) == ["s0.pcd", "s1.pcd", "s2.pcd"]
    back = pcd.read(spark, str(tmp_path)).orderBy("path", "point").collect()
    assert [(r["path"].split("/")[-1][:2], r["x"]) for r in back] == [(f"s{k}", float(i)) for k in range(3) for i in range(k, 50, 3)]
    again = {r["scan"]: r["points"] for r in pcd.write(points.where("point < 10"), str(tmp_path), "scan").collect()}
    assert again == {"s0": 4, "s1": 3, "s2": 3} and not list(tmp_path.glob(".*.part"))
