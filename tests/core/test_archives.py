"""Archives written in a stream, and members read by their ranges."""

import hashlib
import os
import random
import tarfile

import pytest
from fake_files import counting, read_bytes
from pyspark.sql import functions as F

from roadglass.plans import logs
from roadglass.sources import archives


@pytest.fixture
def members(spark):
    rng = random.Random(6)
    rows = [(f"clip_{i % 5}", f"{i:05d}.cam.bin", bytearray(rng.randbytes(rng.choice((0, 1, 511, 512, 513, 3000))))) for i in range(300)]
    return {(s, m): bytes(b) for s, m, b in rows}, spark.createDataFrame(rows, archives.MEMBERS).repartition(6)


def test_archives_hold_all_members_where_the_index_says(spark, tmp_path, members):
    want, frame = members
    top = str(tmp_path / "out")
    index = archives.write(frame, top, parts=3)
    assert sorted(os.listdir(top)) == [*(f"clip_{i}.tar" for i in range(5)), "index"] and os.listdir(tmp_path) == ["out"]
    got = {}
    for i in range(5):
        with tarfile.open(f"{top}/clip_{i}.tar") as tar:
            names = tar.getnames()
            assert names == sorted(names)
            got |= {(f"clip_{i}", m.name): (tar.extractfile(m).read(), m.offset_data, m.size) for m in tar.getmembers()}
    assert {k: v[0] for k, v in got.items()} == want
    assert {(r["shard"], r["member"]): (want[r["shard"], r["member"]], r["offset"], r["size"]) for r in index.collect()} == got


def test_ranges_are_read_once_and_merged(spark, tmp_path, members):
    want, frame = members
    top, note = str(tmp_path / "out"), str(tmp_path / "note")
    index = archives.write(frame, top).withColumn("path", F.concat(F.lit(top + "/"), "shard", F.lit(".tar")))
    some = index.where("member LIKE '%7.cam.bin'").union(index.limit(0))
    got = archives.bodies(some, open_file=counting(note))
    assert {(r["shard"], r["member"]): bytes(r["body"]) for r in got.collect()} == {k: v for k, v in want.items() if k[1].endswith("7.cam.bin")}
    read_bytes(note)
    assert archives.bodies(index, task_bytes=50_000, open_file=counting(note)).count() == 300
    assert len(open(note).readlines()) < 30  # few reads for 300 members
    none = index.limit(3).withColumn("offset", F.lit(None).cast("long"))
    assert [r["body"] for r in archives.bodies(none).collect()] == [None] * 3
    with pytest.raises(Exception, match="ends before"):
        archives.bodies(index.limit(1).withColumn("size", F.lit(10_000_000).cast("long"))).collect()


def test_parts_of_frames(spark, tmp_path):
    top = str(tmp_path / "out")
    rows = [("sensor", f"{i:05d}.{p}", bytearray(f"{p}{i}".encode())) for i in range(20) for p in ("meta.json", "cam.jpg")] + [("anno", f"{i:05d}.ann3d.json", bytearray(b"[%d]" % i)) for i in range(20)]
    index = archives.write(spark.createDataFrame(rows, archives.MEMBERS), top)
    at = {r["member"]: (r["offset"], r["size"]) for r in index.collect()}
    frames = [(i, "sensor.tar", "anno.tar", *at[f"{i:05d}.meta.json"], *(map(float, at[f"{i:05d}.cam.jpg"]) if i % 4 else (None, None)), *at[f"{i:05d}.ann3d.json"]) for i in range(20)]
    frame = spark.createDataFrame(frames, "frame_index int, sensor_shard string, anno_shard string, meta_offset long, meta_size long, cam_offset double, cam_size double, ann3d_offset long, ann3d_size long")
    got = archives.parts(frame.where("frame_index % 2 = 0"), top, {"meta": "sensor_shard", "cam": "sensor_shard", "ann3d": "anno_shard"}, ["frame_index"]).collect()
    want = {(i, p): b for i in range(0, 20, 2) for p, b in (("meta", f"meta.json{i}"), ("cam", f"cam.jpg{i}"), ("ann3d", f"[{i}]")) if p != "cam" or i % 4}
    assert {(r["frame_index"], r["part"]): bytes(r["body"]).decode() for r in got} == want


def test_errors_leave_what_was_there(spark, tmp_path, members):
    _, frame = members
    top = str(tmp_path / "out")
    archives.write(frame, top)
    with pytest.raises(Exception, match="exists"):
        archives.write(frame, top)
    for bad in (frame.withColumn("body", F.when(F.col("member") > "00001", F.col("body"))), frame.withColumn("member", F.lit("same")), frame.withColumn("member", F.repeat("member", F.lit(40)))):
        with pytest.raises(Exception):
            archives.write(bad, top, force=True)
    assert archives.index(spark, top).count() == 300 and os.listdir(tmp_path) == ["out"]
    archives.write(frame.limit(4), top, force=True)
    assert archives.index(spark, top).count() == 4
    archives.write(frame.where("false"), str(tmp_path / "empty"))
    assert archives.index(spark, str(tmp_path / "empty")).count() == 0


def test_short_lines_share_members(spark, tmp_path):
    """Archives of many short lines stay near the lines' size, and lose none."""
    rows = spark.range(20_000).select((F.col("id") % 3).cast("string").alias("shard"), (F.col("id") % 4).cast("string").alias("kind"), F.to_json(F.struct("id")).alias("line")).repartition(3)
    top = str(tmp_path / "out")
    index = archives.write(archives.bundles(rows, held=5000), top)
    assert index.count() == index.distinct().count() < 200
    assert sum(os.path.getsize(f"{top}/{f}") for f in os.listdir(top) if f.endswith(".tar")) < 20_000 * 15
    read = archives.bodies(index.where("split(member, '[.]')[1] = '2'").withColumn("path", F.concat(F.lit(top + "/"), "shard", F.lit(".tar"))))
    assert sorted(r["line"] for r in archives.lines(read).collect()) == sorted(f'{{"id":{i}}}' for i in range(2, 20_000, 4))


def test_archives_of_sources_keep_repeated_ids_and_odd_names(spark, tmp_path, monkeypatch):
    """Sources of any name, divided when large; a row for every document."""
    monkeypatch.setattr(logs, "SHARD_BYTES", 20_000)
    rows = [(i // 2, f"text {i}" * (i % 50), ("a/b c", "a.example-1", "", "ü", None)[i % 5]) for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r["source"], r["name"], r["md5"]) for r in logs.shard_members(spark, str(tmp_path)).collect())
    assert got == sorted((s, f"{i}.txt", hashlib.md5(t.encode()).hexdigest()) for i, t, s in rows if s is not None)
