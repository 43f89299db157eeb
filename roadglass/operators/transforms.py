"""Static transforms as rows: from Euler angles to quaternions, with the optical frames of cameras."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo, text

#: Fixed value: rotation from a camera's link to its optical frame, xyzw.
OPTICAL = (-0.5, 0.5, -0.5, 0.5)
COLUMNS = ("parent", "child", "x", "y", "z", "qx", "qy", "qz", "qw")


def expand(rows: DataFrame) -> DataFrame:
    """(parent, child, x, y, z, qx, qy, qz, qw) of rows with roll, pitch, yaw; missing numbers are 0.

    Each camera link gets an optical frame below it, at a fixed rotation.
    """
    number = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    turned = geo.rpy_to_quaternion(*(number(c) for c in ("roll", "pitch", "yaw")))
    links = rows.select("parent", "child", *[number(c).alias(c) for c in "xyz"], *[q.alias(f"q{c}") for q, c in zip(turned, "xyzw")])
    below = F.concat(F.regexp_extract("child", r"^(camera\d+)/", 1), F.lit("/camera_optical_link"))
    optical = links.where(F.col("child").rlike(text.CAMERA_LINK)).select(
        F.col("child").alias("parent"), below.alias("child"), *[F.lit(0.0).alias(c) for c in "xyz"], *[F.lit(v).alias(f"q{c}") for v, c in zip(OPTICAL, "xyzw")]
    )
    return links.unionByName(optical)
