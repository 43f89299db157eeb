"""Annotation datasets: linked JSON tables to a frame index, shards with byte offsets, and their manifests."""

from __future__ import annotations

import io
import json
import tarfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import relational as R


def clip_dirs(top: str) -> list[str]:
    """Folders that have both annotation and data below them, sorted."""
    return sorted({str(p.parent) for p in Path(top).rglob("annotation") if p.is_dir() and (p.parent / "data").is_dir()})


def json_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.json(f"{folder}/{name}.json", multiLine=True)


def frames(sample: DataFrame, data: DataFrame, sensors: DataFrame, calibrated: DataFrame, poses: DataFrame, boxes: DataFrame, instances: DataFrame, categories: DataFrame) -> DataFrame:
    """One row a frame: position, key, channels with their files and poses, boxes with category names, counts and category list.

    Foreign keys of sensors must exist; poses, instances and categories may be missing.
    """
    channels = R.required_join(calibrated.select(F.col("token").alias("calibrated_sensor_token"), "sensor_token"), sensors.select(F.col("token").alias("sensor_token"), "channel", "modality"), ["sensor_token"], "calibrated_sensor")
    shots = R.required_join(data, channels, ["calibrated_sensor_token"], "sample_data").join(
        poses.select(F.col("token").alias("ego_pose_token"), F.col("translation").alias("ego_translation"), F.col("rotation").alias("ego_rotation")), "ego_pose_token", "left"
    )
    views = R.grouped(shots.withColumnRenamed("sample_token", "_s"), ["_s"], ["channel"], ["channel", "modality", "filename", "ego_translation", "ego_rotation"], "views")
    named = boxes.join(instances.select(F.col("token").alias("instance_token"), "category_token"), "instance_token", "left").join(categories.select(F.col("token").alias("category_token"), F.col("name").alias("category")), "category_token", "left")
    listed = named.groupBy(F.col("sample_token").alias("_s")).agg(F.count(F.lit(1)).alias("num_boxes"), R.sorted_set("category").alias("categories"))
    ordered = R.chain(sample, ["scene_token"], "token", "next")
    rows = ordered.join(views, ordered["token"] == views["_s"], "left").drop("_s").join(listed, ordered["token"] == listed["_s"], "left").drop("_s")
    n = F.max("position").over(_scene()) + 1
    return rows.withColumn("frame_key", R.frame_key(F.col("position"), n)).withColumns({"num_boxes": F.coalesce("num_boxes", F.lit(0)), "categories": F.coalesce("categories", F.array().cast("array<string>"))})


def _scene():
    from pyspark.sql import Window

    return Window.partitionBy("scene_token")


def index_scan(index: DataFrame, clip: str, order: str, lists: list[str], categories: list[str] | None, every: int = 1) -> DataFrame:
    """Every n-th frame of a clip, and of these the ones with a wanted category: the stride comes first."""
    from ..operators import series as S

    rows = S.stride(index, [clip], every, None, order)
    return rows if not categories else R.with_any(rows, lists, categories)


def pack_tar(members: list[tuple[str, bytes]], mtime: int = 0) -> tuple[bytes, dict[str, tuple[int, int]]]:
    """A tar archive in memory, and the offset and size of each member's bytes."""
    buffer, places = io.BytesIO(), {}
    with tarfile.open(fileobj=buffer, mode="w", format=tarfile.USTAR_FORMAT) as tar:
        for name, body in members:
            info = tarfile.TarInfo(name)
            info.size, info.mtime = len(body), mtime
            start = buffer.tell() + 512
            tar.addfile(info, io.BytesIO(body))
            places[name] = (start, len(body))
    return buffer.getvalue(), places


def shards(rows: DataFrame, key: str, name: str, body: str) -> DataFrame:
    """(key, archive, index) for each key: its members in order of name, and where each lies; a key fits in one task, as a clip does."""
    kind = rows.schema[key].dataType.simpleString()

    def build(pdf):
        pdf = pdf.sort_values(name)
        archive, places = pack_tar([(n, bytes(b)) for n, b in zip(pdf[name], pdf[body])])
        return pdf[[key]].iloc[:1].assign(archive=archive, index=json.dumps({n: list(p) for n, p in places.items()}))

    return rows.select(key, name, body).groupBy(key).applyInPandas(build, f"`{key}` {kind}, archive binary, index string")


def shard_list(manifests: DataFrame, url: str = "url", frames_: str = "n_frames") -> DataFrame:
    """(url, nsamples): frames and one clip record each; manifests without a frame count are broken and skipped."""
    return manifests.where(F.col(frames_).isNotNull()).select(F.col(url).alias("url"), (F.col(frames_) + 1).alias("nsamples")).orderBy("url")


def unconverted(clips: DataFrame, done: DataFrame) -> DataFrame:
    """Clips (clip, n_frames) without a finished manifest of the same number of frames."""
    return clips.join(done.where("has_shards AND has_index").select("clip", "n_frames"), ["clip", "n_frames"], "left_anti")


def crops(files: DataFrame, path: str = "path") -> DataFrame:
    """(clip, channel, name, path) of cropped images by their names."""
    name = text.stem(F.col(path))
    clip = text.before_camera(name)
    rest = F.expr("substring(name, length(clip) + 2)")
    return files.select(path, name.alias("name"), clip.alias("clip")).where("clip IS NOT NULL").withColumn("channel", text.channel_of(rest))
