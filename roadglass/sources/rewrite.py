"""A recording with other calibration: static transforms and camera infos replaced, all else as it is.

The calibration is a handful of documents and travels with the tasks; the log is
one pass, in which a batch without such messages leaves as it came. Every static
transform message becomes the one of the configuration, stamped with its log time;
a camera info with a configured camera takes its sizes and matrices and keeps its
header; cameras without one pass through, and no message is added.

Results by case: a camera info that can't be decoded gets an empty header; a log
without static transforms stays without; ``notes`` tells both that and cameras
that no document describes; a configuration without transforms is an error.
"""

from __future__ import annotations

import json
import re
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import transforms
from . import cdr, container

TF_TOPIC = "/tf_static"
#: Fixed value: where a camera's infos are, and its number.
CAMERA_INFO = r"^/sensing/camera/(camera\d+)/camera_info$"
#: Fields of a camera document, and those of a message.
CAMERA_FIELDS = {"width": ("image_width",), "height": ("image_height",), "distortion_model": ("distortion_model",), "k": ("camera_matrix", "data"), "d": ("distortion_coefficients", "data"), "p": ("projection_matrix", "data"), "r": ("rectification_matrix", "data")}
_TF = cdr.compiled(cdr.DEFINITIONS["tf2_msgs/msg/TFMessage"])
_INFO = cdr.compiled(cdr.DEFINITIONS["sensor_msgs/msg/CameraInfo"])


def document(path: Path):
    """A YAML or JSON document."""
    if path.suffix == ".json":
        return json.loads(path.read_text())
    try:
        import yaml
    except ImportError as e:
        raise ImportError("the yaml package is needed to read YAML documents; JSON is read without it") from e
    return yaml.safe_load(path.read_text())


def transforms_of(spark: SparkSession, tree: dict) -> list[dict]:
    """Transforms of a document parent, child, values: as quaternions, with the optical frames of cameras."""
    values = ("x", "y", "z", "roll", "pitch", "yaw")
    rows = [(parent, child, *(float(v.get(c, 0.0)) for c in values)) for parent, children in (tree or {}).items() if isinstance(children, dict) for child, v in children.items() if isinstance(v, dict)]
    if not rows:
        raise ValueError("the document has no transforms")
    frame = spark.createDataFrame(rows, "parent string, child string, " + ", ".join(f"{c} double" for c in values))
    found = [r.asDict() for r in transforms.expand(frame).collect()]
    place = {(r[0], r[1]): i for i, r in enumerate(rows)}
    return sorted(found, key=lambda r: place.get((r["parent"], r["child"]), len(place)))


def camera_of(tree: dict) -> dict:
    """Fields of a camera info from a camera's document."""
    out = {}
    for name, way in CAMERA_FIELDS.items():
        value = tree
        for step in way:
            value = value[step]
        out[name] = [float(v) for v in value] if isinstance(value, list) else str(value) if name == "distortion_model" else int(value)
    return out


def load(spark: SparkSession, folder: str) -> tuple[list[dict], dict[str, dict]]:
    """Transforms and cameras of a folder of documents: multi_tf_static, and camera*/camera_info."""
    top = Path(folder)
    tf = next(p for p in (top / "multi_tf_static.yaml", top / "multi_tf_static.json") if p.exists())
    infos = sorted(p for kind in ("yaml", "json") for p in top.glob(f"camera*/camera_info.{kind}"))
    return transforms_of(spark, document(tf)), {p.parent.name: camera_of(document(p)) for p in infos}


def tf_value(rows: list[dict], time_ns: int) -> dict:
    stamp = {"sec": time_ns // 1_000_000_000, "nanosec": time_ns % 1_000_000_000}
    return {"transforms": [{"header": {"stamp": stamp, "frame_id": r["parent"]}, "child_frame_id": r["child"], "transform": {"translation": {c: r[c] for c in "xyz"}, "rotation": {c: r[f"q{c}"] for c in "xyzw"}}} for r in rows]}


def replace(log: DataFrame, tf: list[dict], cameras: dict[str, dict]) -> DataFrame:
    """The log with the messages of the configuration in place of its own."""
    if not tf:
        raise ValueError("no transforms")
    topics, schema = {}, log.schema

    def run(batches):
        for batch in batches:
            data, times = batch.column("data"), batch.column("log_time_ns")
            places, made = [], []
            for topic in pc.unique(batch.column("topic")).to_pylist():
                if topic not in topics:
                    m = re.match(CAMERA_INFO, topic or "")
                    topics[topic] = TF_TOPIC if topic == TF_TOPIC else m[1] if m and m[1] in cameras else None
                if topics[topic] is None:
                    continue
                at = pc.indices_nonzero(pc.equal(batch.column("topic"), topic))
                if topics[topic] == TF_TOPIC:
                    made += [cdr.encode_value(_TF, tf_value(tf, t)) for t in times.take(at).to_pylist()]
                else:
                    old = cdr.decode_array(_INFO, data.take(at)).to_pylist()
                    made += [cdr.encode_value(_INFO, {"header": (o or {}).get("header")} | cameras[topics[topic]]) for o in old]
                places += at.to_pylist()
            if places:
                mask = [False] * batch.num_rows
                for p in places:
                    mask[p] = True
                by_place = [d for _, d in sorted(zip(places, made))]
                batch = batch.set_column(batch.schema.get_field_index("data"), "data", pc.replace_with_mask(data, pa.array(mask), pa.array(by_place, data.type)))
            yield batch

    return log.mapInArrow(run, schema)


def notes(log: DataFrame, cameras: dict[str, dict]) -> DataFrame:
    """(note, subject, messages): camera topics without a document, and whether there are no static transforms."""
    counts = log.groupBy("topic").agg(F.count("*").alias("messages"))
    camera = F.regexp_extract("topic", CAMERA_INFO, 1)
    unknown = counts.where((camera != "") & ~camera.isin(*cameras)).select(F.lit("no document for camera").alias("note"), camera.alias("subject"), "messages")
    static = counts.agg(F.coalesce(F.sum(F.when(F.col("topic") == TF_TOPIC, F.col("messages"))), F.lit(0)).alias("messages"))
    return unknown.unionByName(static.where("messages = 0").select(F.lit("no static transforms").alias("note"), F.lit(TF_TOPIC).alias("subject"), "messages"))


def rewrite(spark: SparkSession, source: str, target: str, folder: str, force: bool = False, compress: bool = False) -> DataFrame:
    """Rewrites a container, or a folder of them, with the calibration of a folder; returns the notes."""
    tf, cameras = load(spark, folder)
    log = container.read(spark, source)
    texts = {r["schema_name"]: r["definition"] for r in container.schemas(spark, source).collect()}
    container.write(replace(log, tf, cameras), target, texts, Path(target).stem, "zstd" if compress else "", force)
    return notes(log, cameras)
