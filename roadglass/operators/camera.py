"""Points against images as tables: crops, sampling, costs, sweeps, masks.

An image is a table (v, u, value); pixels are joined, not looped over.
"""

from __future__ import annotations

import base64
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo
from . import series


def frustum_crop(points: DataFrame, k: Sequence[float], width: int, height: int, margin: float = 0.0, nearest: float = 0.2, cap: int | None = None, seed: int = 0, key: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """Points in front of the camera whose pixel (added as u, v) lies in the image and its margin; ``cap`` keeps that many of each group (a scan) by a hash of the key."""
    u, v, valid = geo.project([F.col(c) for c in "xyz"], k, nearest=nearest)
    out = points.where(valid).withColumns({"u": u, "v": v}).where(F.col("u").between(-margin, width + margin) & F.col("v").between(-margin, height + margin))
    return out if cap is None else series.sample(out, key, cap, seed, by)


def unproject_table(pixels: DataFrame, k: Sequence[float], distortion: Sequence[float], rounds: int = 20) -> DataFrame:
    """Adds a, b, the undistorted direction of (u, v): fixed-point iteration in numpy, a fixed number of rounds.

    Far from the centre the iteration may run off or be too slow. Directions that
    the lens doesn't bend onto their pixel are sought anew by Newton's method from
    the centre, with steps halved until they come nearer; where that finds none
    either, the pixel lies outside of what the lens shows, the iteration's stay.
    """
    fx, fy, cx, cy = k
    k1, k2, p1, p2, k3, k4, k5, k6 = (list(distortion) + [0.0] * 8)[:8]

    def run(batches):
        for pdf in batches:
            x0, y0 = (pdf["u"] - cx) / fx, (pdf["v"] - cy) / fy
            x, y = x0.copy(), y0.copy()
            for _ in range(rounds):
                r2 = x * x + y * y
                radial = (1 + r2 * (k4 + r2 * (k5 + r2 * k6))) / (1 + r2 * (k1 + r2 * (k2 + r2 * k3)))
                x, y = (x0 - 2 * p1 * x * y - p2 * (r2 + 2 * x * x)) * radial, (y0 - p1 * (r2 + 2 * y * y) - 2 * p2 * x * y) * radial
            x0, y0, x, y = (v.to_numpy(float) for v in (x0, y0, x, y))
            near = 1e-12 * (1 + np.hypot(x0, y0))
            with np.errstate(all="ignore"):
                u, v = bend(x, y)[:2]
                off = np.flatnonzero(~(np.hypot(u - x0, v - y0) <= near) & np.isfinite(near))
                if len(off):
                    p, q, gap = newton(x0[off], y0[off])
                    found = gap <= near[off]
                    x[off[found]], y[off[found]] = p[found], q[found]
            yield pdf.assign(a=x, b=y)

    def bend(x, y):
        """Where the lens puts a direction, and the three different derivatives of that."""
        r2 = x * x + y * y
        over, under = 1 + r2 * (k1 + r2 * (k2 + r2 * k3)), 1 + r2 * (k4 + r2 * (k5 + r2 * k6))
        radial = over / under
        slope = ((k1 + r2 * (2 * k2 + r2 * 3 * k3)) - radial * (k4 + r2 * (2 * k5 + r2 * 3 * k6))) / under
        u, v = x * radial + 2 * p1 * x * y + p2 * (r2 + 2 * x * x), y * radial + p1 * (r2 + 2 * y * y) + 2 * p2 * x * y
        cross = 2 * x * y * slope + 2 * p1 * x + 2 * p2 * y
        return u, v, radial + 2 * x * x * slope + 2 * p1 * y + 6 * p2 * x, cross, radial + 2 * y * y * slope + 6 * p1 * y + 2 * p2 * x

    def newton(x0, y0):
        x, y = np.zeros_like(x0), np.zeros_like(y0)
        gap = np.hypot(x0, y0)
        for _ in range(50):
            u, v, xx, xy, yy = bend(x, y)
            e, f, det = x0 - u, y0 - v, xx * yy - xy * xy
            dx, dy = (yy * e - xy * f) / det, (xx * f - xy * e) / det
            moved = np.zeros(len(x), dtype=bool)
            for half in range(30):
                p, q = x + dx / (1 << half), y + dy / (1 << half)
                u, v = bend(p, q)[:2]
                less = np.hypot(u - x0, v - y0)
                better = ~moved & (less < gap)
                x[better], y[better], gap[better] = p[better], q[better], less[better]
                moved |= better
                if moved.all() or not np.isfinite(dx[~moved]).any() or (gap[~moved] <= 1e-15 * (1 + np.hypot(x0, y0)[~moved])).all():
                    break
            if not moved.any():
                break
        return x, y, gap

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pixels.schema)
    return pixels.mapInPandas(run, schema + ", a double, b double")


def bilinear(points: DataFrame, image: DataFrame, width: int, height: int, key: Sequence[str]) -> DataFrame:
    """(key, sampled): value at (u, v) from the four pixels around, clamped to the image; one join on the pixel, four rows a point."""
    u, v = F.greatest(F.lit(0.0), F.least(F.col("u"), F.lit(width - 1.0))), F.greatest(F.lit(0.0), F.least(F.col("v"), F.lit(height - 1.0)))
    u0, v0 = F.least(F.floor(u), F.lit(max(0, width - 2))).cast("int"), F.least(F.floor(v), F.lit(max(0, height - 2))).cast("int")
    fu, fv = u - u0, v - v0
    corner = lambda i, j: F.struct(F.least(u0 + i, F.lit(width - 1)).alias("u"), F.least(v0 + j, F.lit(height - 1)).alias("v"), ((fu if i else 1 - fu) * (fv if j else 1 - fv)).alias("w"))
    four = points.select(*key, F.explode(F.array(*[corner(i, j) for i in (0, 1) for j in (0, 1)])).alias("_c")).select(*key, "_c.*")
    return four.join(image.select("u", "v", "value"), ["u", "v"]).groupBy(*key).agg(F.sum(F.col("w") * F.col("value")).alias("sampled"))


def capped_mean(value: Column, most: float) -> Column:
    """Aggregate: mean over all rows, a missing value counting as ``most``."""
    return F.sum(F.coalesce(value, F.lit(most))) / F.count(F.lit(1))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Aggregate over all weights, also those whose value is missing."""
    return F.try_divide(F.sum(F.coalesce(value, F.lit(0.0)) * weight), F.sum(weight))


def median_or_inf(value: Column) -> Column:
    return F.coalesce(F.median(value), F.lit(float("inf")))


def normalised(value: str, by: Sequence[str]) -> Column:
    """Share of the largest in its group; 0 where that is not positive."""
    largest = F.max(value).over(Window.partitionBy(*by))
    return F.when(largest > 0, F.col(value) / largest).otherwise(F.lit(0.0))


def clipped(rows: DataFrame, value: str, by: Sequence[str], low: float = 0.05, high: float = 0.95, name: str = "score") -> DataFrame:
    """Adds the value scaled to 0..1 between two percentiles of its group."""
    ends = rows.groupBy(*by).agg(F.percentile(value, F.lit(low)).alias("_lo"), F.percentile(value, F.lit(high)).alias("_hi"))
    scaled = F.coalesce(F.try_divide(F.col(value) - F.col("_lo"), F.col("_hi") - F.col("_lo")), F.lit(0.0))
    return rows.join(ends, list(by)).withColumn(name, F.greatest(F.lit(0.0), F.least(F.lit(1.0), scaled))).drop("_lo", "_hi")


def top_share(rows: DataFrame, score: str, by: Sequence[str], share: float) -> DataFrame:
    """Rows at or above the (1 - share) quantile of their group."""
    ends = rows.groupBy(*by).agg(F.percentile(score, F.lit(1 - share)).alias("_at"))
    return rows.join(ends, list(by)).where(F.col(score) >= F.col("_at")).drop("_at")


def sweep_grid(spark, axes: int, span: float, steps: int) -> DataFrame:
    """(axis, step, offset): evenly spaced offsets of each axis from -span to span."""
    return spark.range(axes).select(F.col("id").cast("int").alias("axis"), F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("step")).withColumn("offset", -span + F.col("step") * (2 * span / (steps - 1)))


def reprojection(observed: DataFrame, k: Sequence[float], behind: float = 50.0, nearest: float = 0.2) -> DataFrame:
    """Adds du, dv: projected less observed pixel; ``behind`` where the point isn't in front."""
    pu, pv, valid = geo.project([F.col(c) for c in "xyz"], k, nearest=nearest)
    return observed.withColumns({"du": F.when(valid, pu - F.col("u")).otherwise(F.lit(behind)), "dv": F.when(valid, pv - F.col("v")).otherwise(F.lit(behind))})


def observations(tracks: DataFrame, track: str, points: str) -> DataFrame:
    """(track, seq, t_ns, u, v) of an array of (t_ns, u, v)."""
    return tracks.select(track, F.posexplode(points).alias("seq", "_o")).select(track, "seq", "_o.*")


def tracks(flat: DataFrame, track: str, seq: str, fields: Sequence[str]) -> DataFrame:
    """Observations as an ordered array a track."""
    from .relational import grouped

    return grouped(flat, [track], [seq], fields, "points")


def rle_mask(counts: str, height: int, width: int) -> list[int]:
    """Indices (row * width + column) of a mask from base64 of the compressed run lengths of COCO.

    Runs alternate between 0 and 1 down the columns; each number has five bits a
    character and a sign, and from the third on is a difference to the one two before.
    """
    data, runs, at = base64.b64decode(counts), [], 0
    while at < len(data):
        value = shift = 0
        while True:
            c = data[at] - 48
            at += 1
            value |= (c & 0x1F) << shift
            shift += 5
            if not c & 0x20:
                if c & 0x10:
                    value |= -1 << shift
                break
        runs.append(value + runs[-2] if len(runs) > 2 else value)
    out, place = [], 0
    for i, n in enumerate(runs):
        if i % 2:
            out += [(p % height) * width + p // height for p in range(place, place + n)]
        place += n
    return sorted(out)


def mask_pixels(masks: DataFrame, key: Sequence[str], rle: str) -> DataFrame:
    """(key, pixel) of masks given as (size [height, width], counts)."""
    cells = F.udf(lambda r: rle_mask(r["counts"], *r["size"]) if r else [], "array<int>", useArrow=True)
    return masks.select(*key, F.explode(cells(F.col(rle))).alias("pixel"))
