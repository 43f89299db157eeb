"""Binary PCD files (v0.7, float32 x y z and intensity) as tables."""

from __future__ import annotations

import os
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "path string, point long, x float, y float, z float, intensity float"


def header(n: int | str, intensity: bool = True) -> bytes:
    fields = ["x", "y", "z"] + ["intensity"] * intensity
    lines = [
        "# .PCD v0.7 - Point Cloud Data file format", "VERSION 0.7", "FIELDS " + " ".join(fields), "SIZE" + " 4" * len(fields), "TYPE" + " F" * len(fields),
        "COUNT" + " 1" * len(fields), f"WIDTH {n}", "HEIGHT 1", "VIEWPOINT 0 0 0 1 0 0 0", f"POINTS {n}", "DATA binary",
    ]
    return ("\n".join(lines) + "\n").encode()


def parse(content: bytes) -> dict[str, np.ndarray]:
    """Float columns of a binary file by name."""
    head, _, body = content.partition(b"DATA binary\n")
    facts = {k: v for k, *v in (line.split() for line in head.decode("ascii", "replace").splitlines() if line and line[0] != "#")}
    kinds = {"F4": "<f4", "F8": "<f8", "U1": "u1", "U2": "<u2", "U4": "<u4", "I1": "i1", "I2": "<i2", "I4": "<i4"}
    kind = np.dtype([(name, kinds[t + s]) for name, t, s in zip(facts["FIELDS"], facts["TYPE"], facts["SIZE"])])
    rows = np.frombuffer(body, kind, count=int(facts["POINTS"][0]))
    return {name: rows[name].astype(np.float32) for name in kind.names}


def read(spark: SparkSession, path: str) -> DataFrame:
    def explode(batches):
        for batch in batches:
            for name, content in zip(batch["path"].to_pylist(), batch["content"].to_pylist()):
                c = parse(content)
                n = len(c["x"])
                yield pa.RecordBatch.from_arrays([pa.array([name] * n, pa.string()), pa.array(np.arange(n)), *[pa.array(c.get(k, np.zeros(n, np.float32))) for k in ("x", "y", "z", "intensity")]], names=["path", "point", "x", "y", "z", "intensity"])

    return spark.read.format("binaryFile").option("pathGlobFilter", "*.pcd").load(path).select("path", "content").mapInArrow(explode, SCHEMA)


def encode(points: DataFrame, key: str, order: str = "point") -> DataFrame:
    """(key, content): one file's bytes for each key; a key's points must fit in one task, as one scan does."""
    kind = points.schema[key].dataType.simpleString()

    def build(pdf):
        pdf = pdf.sort_values(order)
        body = pdf[["x", "y", "z", "intensity"]].to_numpy("<f4")
        return pdf[[key]].iloc[:1].assign(content=header(len(body)) + body.tobytes())

    return points.select(key, order, "x", "y", "z", "intensity").groupBy(F.col(key)).applyInPandas(build, f"`{key}` {kind}, content binary")


def write(points: DataFrame, folder: str, key: str, order: str = "point") -> DataFrame:
    """A file ``{key}.pcd`` for each key, written by the task that has its points, as they come; returns (key, path, points).

    A file is written under another name, its header last, and renamed when it is
    whole, so a task that is lost or repeated leaves no half of one. The folder has
    to be open to all machines. Keys with a null coordinate keep the point, as NaN.
    """
    kind = points.schema[key].dataType.simpleString()
    place = re.sub("^file:/*", "/", folder.rstrip("/"))
    columns = ("x", "y", "z", "intensity")

    def save(batches):
        os.makedirs(place, exist_ok=True)
        now, stream, n, hidden = None, None, 0, ""

        def close():
            stream.seek(0)
            stream.write(header(f"{n:012d}"))
            stream.close()
            os.replace(hidden, f"{place}/{now}.pcd")
            return pa.RecordBatch.from_arrays([pa.array([now], out.field(0).type), pa.array([f"{place}/{now}.pcd"]), pa.array([n], pa.int64())], schema=out)

        for batch in batches:
            keys = batch.column(key)
            body = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype("<f4") for c in columns], axis=1) if batch.num_rows else np.zeros((0, 4))
            marks = keys.to_pylist()
            starts = [i for i in range(len(marks)) if i == 0 or marks[i] != marks[i - 1]]
            out = pa.schema([(key, keys.type), ("path", pa.string()), ("points", pa.int64())])
            for a, b in zip(starts, [*starts[1:], len(marks)]):
                if stream is None or marks[a] != now:
                    if stream is not None:
                        yield close()
                    now, n, hidden = marks[a], 0, f"{place}/.{uuid.uuid4().hex}.part"
                    stream = open(hidden, "wb")
                    stream.write(header("0" * 12))
                stream.write(body[a:b].tobytes())
                n += b - a
        if stream is not None:
            yield close()

    rows = points.where(F.col(key).isNotNull()).select(key, order, *columns).repartition(key).sortWithinPartitions(key, order)
    rows.mapInArrow(save, f"`{key}` {kind}, path string, points long").write.mode("overwrite").parquet(f"file://{place}/manifest")
    return points.sparkSession.read.parquet(f"file://{place}/manifest")
