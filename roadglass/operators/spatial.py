"""Spatial operators over point tables: voxel maps, range images, visibility votes, neighbours.

All pairs inside a gate are an equi-join on the keys of cells as wide as the gate.
Searches for the nearest form no such pairs: they divide space into blocks of a
bounded number of points, so that the work follows the number of points, however
many of them lie inside the gate.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import pi

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo

XYZ = ("x", "y", "z")


def voxel_map(points: DataFrame, size: float, scan: str = "scan", intensity: str = "intensity") -> DataFrame:
    """For each voxel: points, distinct scans, centroid, mean intensity and spread (root of the summed variances).

    First by scan and voxel, then by voxel: both aggregates combine before they shuffle.
    """
    sums = [F.sum(c).alias(f"s{c}") for c in XYZ] + [F.sum(F.col(c) * F.col(c)).alias(f"q{c}") for c in XYZ]
    one = points.groupBy(F.col(scan).alias("_scan"), geo.voxel_key(*(F.col(c) for c in XYZ), size).alias("voxel")).agg(F.count(F.lit(1)).alias("n"), F.sum(intensity).alias("si"), *sums)
    out = one.groupBy("voxel").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("scans"), F.sum("si").alias("si"), *[F.sum(f"{k}{c}").alias(f"{k}{c}") for c in XYZ for k in "sq"])
    n = F.col("n")
    spread = sum((F.greatest(F.col(f"q{c}") / n - (F.col(f"s{c}") / n) * (F.col(f"s{c}") / n), F.lit(0.0)) for c in XYZ), F.lit(0.0))
    return out.select("voxel", "n", "scans", *[(F.col(f"s{c}") / n).alias(c) for c in XYZ], (F.col("si") / n).alias("intensity"), F.sqrt(spread).alias("spread"))


def spherical(x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """Azimuth, elevation, range."""
    r = F.sqrt(x * x + y * y + z * z)
    return F.atan2(y, x), F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.coalesce(F.try_divide(z, r), F.lit(0.0))))), r


def range_image(points: DataFrame, footprint: float, scan: str = "scan", point: str = "vec_id") -> DataFrame:
    """Nearest return of each scan and arc-length cell: (scan, cell, r, point), ties to the smaller point."""
    az, el, r = spherical(*(F.col(c) for c in XYZ))
    cells = points.select(F.col(scan).alias("scan"), geo.arc_key(az, el, r, footprint).alias("cell"), r.alias("_r"), F.col(point).alias("_p"))
    return cells.groupBy("scan", "cell").agg(F.min("_r").alias("r"), F.min_by("_p", F.struct("_r", "_p")).alias("point"))


def angle_image(points: DataFrame, step: float, scan: str = "scan", point: str = "vec_id") -> DataFrame:
    """Nearest return by scan and angular cell: (scan, u, v, r, point)."""
    az, el, r = spherical(*(F.col(c) for c in XYZ))
    cells = points.select(F.col(scan).alias("scan"), F.floor((az + F.lit(pi)) / step).alias("u"), F.floor((el + F.lit(pi / 2)) / step).alias("v"), r.alias("_r"), F.col(point).alias("_p"))
    return cells.groupBy("scan", "u", "v").agg(F.min("_r").alias("r"), F.min_by("_p", F.struct("_r", "_p")).alias("point"))


def range_edges(image: DataFrame, jump: float) -> DataFrame:
    """Points in front of a jump in range to the next cell along u or v, each with its largest jump: (scan, point, weight)."""
    def along(a: str, b: str) -> DataFrame:
        w = Window.partitionBy("scan", b).orderBy(a)
        near = F.lead(a).over(w) == F.col(a) + 1
        gap = F.when(near, F.lead("r").over(w) - F.col("r"))
        front = image.withColumn("_g", gap).withColumn("_o", F.lead("point").over(w)).where(F.abs("_g") > jump)
        return front.select("scan", F.when(F.col("_g") > 0, F.col("point")).otherwise(F.col("_o")).alias("point"), F.abs("_g").alias("weight"))

    return along("u", "v").unionByName(along("v", "u")).groupBy("scan", "point").agg(F.max("weight").alias("weight"))


def visibility_votes(voxels: DataFrame, sensors: DataFrame, image: DataFrame, footprint: float, nearest: float, farthest: float, half_width: float, half_height: float, slack: float) -> DataFrame:
    """How many sensors could have seen each voxel: (voxel, visible).

    ``sensors``: scan, ox, oy, oz, yaw. Voxels and sensors meet in coarse cells as
    wide as the farthest range, an equi-join; then exact range and field of view;
    then the range image by (scan, cell). A voxel is visible where something was
    measured at or beyond it, less ``slack``; a cell without a return says nothing.
    """
    def coarse(*names: str) -> list[Column]:
        return [F.floor(F.col(c) / farthest).cast("long") for c in names]

    reach = F.explode(F.array(*[F.struct(*[F.lit(d).alias(n) for d, n in zip((i, j, k), "ijk")]) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]))
    near = sensors.withColumn("_d", reach).select("scan", "ox", "oy", "oz", "yaw", *[(c + F.col(f"_d.{n}")).alias(f"_c{n}") for c, n in zip(coarse("ox", "oy", "oz"), "ijk")])
    cells = voxels.select("voxel", *XYZ, *[c.alias(f"_c{n}") for c, n in zip(coarse(*XYZ), "ijk")])
    pairs = cells.join(near, ["_ci", "_cj", "_ck"])
    dx, dy, dz = F.col("x") - F.col("ox"), F.col("y") - F.col("oy"), F.col("z") - F.col("oz")
    cos, sin = F.cos("yaw"), F.sin("yaw")
    az, el, r = spherical(cos * dx + sin * dy, cos * dy - sin * dx, dz)
    seen = pairs.select("voxel", "scan", az.alias("_az"), el.alias("_el"), r.alias("_r")).where(F.col("_r").between(nearest, farthest) & (F.abs("_az") <= half_width) & (F.abs("_el") <= half_height))
    seen = seen.withColumn("cell", geo.arc_key(F.col("_az"), F.col("_el"), F.col("_r"), footprint))
    return seen.join(image.select("scan", "cell", "r"), ["scan", "cell"]).where(F.col("r") >= F.col("_r") - slack).groupBy("voxel").agg(F.count(F.lit(1)).alias("visible"))


def vote(voxels: DataFrame, visible: DataFrame, least: float) -> DataFrame:
    """Voxels with ``ratio`` = scans that hit over scans that could see (hits at least), where it reaches ``least``."""
    out = voxels.join(visible, "voxel", "left")
    return out.withColumn("ratio", F.col("scans") / F.greatest(F.coalesce("visible", F.lit(0)), F.col("scans"))).where(F.col("ratio") >= least).drop("visible")


def within(left: DataFrame, right: DataFrame, gate: float, left_id: str, right_id: str) -> DataFrame:
    """All pairs nearer than the gate: (left_id, right_id, d). Both sides have x, y, z; ids get the suffixes _l and _r if equal.

    Cells are as wide as the gate, so partners are in the 27 cells around; the right side is repeated into them.
    """
    cell = [F.floor(F.col(c) / gate).cast("long") for c in XYZ]
    around = F.explode(F.array(*[F.struct(*[(c + d).alias(f"_{n}") for c, d, n in zip(cell, (i, j, k), "ijk")]) for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)]))
    a = left.select(F.col(left_id).alias("left_id"), *[F.col(c).alias(f"l{c}") for c in XYZ], *[c.alias(f"_{n}") for c, n in zip(cell, "ijk")])
    b = right.select(F.col(right_id).alias("right_id"), *[F.col(c).alias(f"r{c}") for c in XYZ], around.alias("_c")).select("right_id", *[f"r{c}" for c in XYZ], "_c.*")
    d = F.sqrt(sum(((F.col(f"l{c}") - F.col(f"r{c}")) * (F.col(f"l{c}") - F.col(f"r{c}")) for c in XYZ), F.lit(0.0)))
    return a.join(b, ["_i", "_j", "_k"]).withColumn("d", d).where(F.col("d") < gate)


#: Points that a block has on average, of both sides together, and blocks at most; sampled points by which each is cut.
BLOCK, BLOCKS, CUT_BY = 512, 1 << 15, 16
#: Distances that are held at once.
HELD = 1 << 21


def _cuts(points: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Axis and place of the cut of each inner node of a balanced tree: node n has the children 2n and 2n + 1, the second from the place on."""
    axis, place = np.zeros(1 << depth, dtype=np.int64), np.zeros(1 << depth)
    groups = [points]
    for level in range(depth):
        halves = []
        for i, p in enumerate(groups):
            node = (1 << level) + i
            if len(p):
                axis[node] = np.ptp(p, axis=0).argmax()
                place[node] = np.median(p[:, axis[node]])
            after = p[:, axis[node]] >= place[node]
            halves += [p[~after], p[after]]
        groups = halves
    return axis, place


def _blocked(rows: DataFrame, axis: np.ndarray, place: np.ndarray, depth: int) -> DataFrame:
    """Rows (id, x, y, z) with the number of their block."""
    def number(batches):
        for batch in batches:
            p = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in XYZ])
            node = np.ones(batch.num_rows, dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + (p[axis[node], np.arange(len(node))] >= place[node])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(node)], names=[*batch.schema.names, "block"])

    return rows.mapInArrow(number, f"id {rows.schema['id'].dataType.simpleString()}, x double, y double, z double, block long")


def _candidates(left: DataFrame, right: DataFrame, gate: float, k: int, left_id: str, right_id: str) -> DataFrame:
    """(left_id, right_id, d): of each left point the k nearest right ones inside the gate, ties to the smaller id, and some more.

    A balanced tree of cuts, made on the driver from a sample, divides both sides
    into blocks; another sample changes the cost and not the result. The k-th
    distance in a left point's own block bounds its search, as do the boxes around
    the other blocks' points; it goes only to blocks that are as near as that, and
    brings from each no more than k points. At one place only the k smallest ids of
    the right side can count, so that copies are not compared with copies.
    """
    spark = left.sparkSession
    finite = " AND ".join(f"abs({c}) < double('infinity')" for c in XYZ)
    a, b = (f.select(F.col(i).alias("id"), *[F.col(c).cast("double").alias(c) for c in XYZ]).where(finite) for f, i in ((left, left_id), (right, right_id)))
    if k == 1:
        b = b.groupBy(*XYZ).agg(F.min("id").alias("id")).select("id", *XYZ)
    else:
        b = b.withColumn("_n", F.row_number().over(Window.partitionBy(*XYZ).orderBy("id"))).where(F.col("_n") <= k).drop("_n")
    both = a.select(*XYZ).unionByName(b.select(*XYZ))
    n = both.count()
    depth = int(np.ceil(np.log2(min(BLOCKS, max(1.0, n / BLOCK)))))
    share = min(1.0, CUT_BY * (1 << depth) / max(n, 1))
    some = (both.sample(share, seed=7) if share < 1 else both).toArrow() if depth else None
    axis, place = _cuts(np.stack([some.column(c).to_numpy() for c in XYZ], axis=1) if depth else np.empty((0, 3)), depth)
    a, b = _blocked(a, axis, place, depth), _blocked(b, axis, place, depth)
    boxes = b.groupBy("block").agg(F.count(F.lit(1)).alias("n"), *[g(c).alias(f"{m}{c}") for m, g in (("a", F.min), ("b", F.max)) for c in XYZ]).toArrow()
    number, count = boxes.column("block").to_numpy(), boxes.column("n").to_numpy()
    low, high = (np.stack([boxes.column(f"{m}{c}").to_numpy() for c in XYZ]) for m in "ab")
    shared = spark.sparkContext.broadcast((number, count, low, high))

    def xyz(table: pa.Table) -> np.ndarray:
        return np.stack([table.column(c).to_numpy() for c in XYZ]) if table.num_rows else np.empty((3, 0))

    def distances(p: np.ndarray, q: np.ndarray):
        """Row by row, in pieces: (from, to, distances)."""
        step = max(1, HELD // max(1, q.shape[1]))
        for i in range(0, p.shape[1], step):
            x, y, z = (p[c, i : i + step, None] - q[c, None, :] for c in range(3))
            yield i, min(i + step, p.shape[1]), np.sqrt(((0.0 + x * x) + y * y) + z * z)

    def length(d: np.ndarray) -> np.ndarray:
        return np.sqrt((d * d).sum(axis=0))

    def route(here: pa.Table, there: pa.Table) -> pa.Table:
        """Points of a block with each block that may hold some of their nearest, and how far these can be."""
        number, count, low, high = shared.value
        p, q = xyz(here), xyz(there)
        bound = np.full(p.shape[1], float(gate))
        if q.shape[1] >= k:
            for i, j, d in distances(p, q):
                bound[i:j] = np.minimum(bound[i:j], np.partition(d, k - 1, axis=1)[:, k - 1])
        at, to = [], []
        if p.shape[1]:
            a, b = p.min(axis=1)[:, None], p.max(axis=1)[:, None]
            most = length(np.maximum(np.abs(high - a), np.abs(b - low)))
            order = most.argsort()
            enough = np.searchsorted(count[order].cumsum(), k)
            if enough < len(order):
                bound = np.minimum(bound, most[order[enough]])
            bound = bound * (1 + 1e-9)  # for what rounding takes off
            near = np.flatnonzero(length(np.maximum(0.0, np.maximum(low - b, a - high))) <= bound.max())
            step = max(1, HELD // max(1, len(near)))
            for i in range(0, p.shape[1], step):
                off = p[:, i : i + step, None]
                gap = length(np.maximum(0.0, np.maximum(low[:, None, near] - off, off - high[:, None, near])))
                r, c = np.nonzero(gap <= bound[i : i + step, None])
                at.append(i + r)
                to.append(near[c])
        at, to = (np.concatenate(x) if x else np.empty(0, dtype=np.int64) for x in (at, to))
        rows = here.select(["id", *XYZ]).take(pa.array(at))
        return rows.append_column("bound", pa.array(bound[at])).append_column("block", pa.array(number[to]))

    def search(here: pa.Table, there: pa.Table) -> pa.Table:
        there = there.sort_by("id")
        p, q, bound = xyz(here), xyz(there), here.column("bound").to_numpy()
        found = [(np.empty(0, dtype=np.int64),) * 2 + (np.empty(0),)]
        for i, j, d in distances(p, q):
            r, c = np.nonzero((d < gate) & (d <= bound[i:j, None]))
            d = d[r, c]
            order = np.lexsort((c, d, r))
            r, c, d = r[order], c[order], d[order]
            first = np.arange(len(r)) - np.searchsorted(r, r) < k
            found.append((i + r[first], c[first], d[first]))
        r, c, d = map(np.concatenate, zip(*found))
        return pa.table({"left_id": here.column("id").take(pa.array(r)), "right_id": there.column("id").take(pa.array(c)), "d": d})

    kinds = [f.schema["id"].dataType.simpleString() for f in (a, b)]
    routes = a.groupBy("block").cogroup(b.groupBy("block")).applyInArrow(route, f"id {kinds[0]}, x double, y double, z double, bound double, block long")
    return routes.groupBy("block").cogroup(b.groupBy("block")).applyInArrow(search, f"left_id {kinds[0]}, right_id {kinds[1]}, d double")


def nearest(left: DataFrame, right: DataFrame, gate: float, left_id: str, right_id: str) -> DataFrame:
    """(left_id, right_id, d): the nearest right point inside the gate, ties to the smaller id; rows without one are left out."""
    return _candidates(left, right, gate, 1, left_id, right_id).groupBy("left_id").agg(F.min(F.struct("d", "right_id")).alias("m")).select("left_id", F.col("m.right_id").alias("right_id"), F.col("m.d").alias("d"))


def nearest_k(left: DataFrame, right: DataFrame, gate: float, k: int, left_id: str, right_id: str) -> DataFrame:
    """The k nearest inside the gate, numbered from 1; a point joined with its own table finds itself first."""
    order = Window.partitionBy("left_id").orderBy("d", "right_id")
    return _candidates(left, right, gate, k, left_id, right_id).withColumn("k", F.row_number().over(order)).where(F.col("k") <= k).select("left_id", "right_id", "d", "k")


#: Points that a leaf of a tree of cells has on average, and at most in one row.
LEAF, LEAF_ROW = 32, 64


def _tree(points: DataFrame, point_id: str, ends: dict, depth: int) -> tuple[list[DataFrame], DataFrame]:
    """Boxes (cell, up, box) of the occupied cells of each level, from the whole to the leaves, and the leaves' points (cell, points) in rows of bounded length.

    A cell is its level's place along each axis in a number; ``up`` is the cell it lies in, with half as many places a side.
    """
    side = 1 << depth
    place = {c: F.least(F.lit(side - 1), F.floor((F.col(c) - ends[f"a_{c}"]) / max((ends[f"b_{c}"] - ends[f"a_{c}"]) / side, 1e-300))).cast("long") for c in XYZ}
    packed = lambda i, j, k: (i * (1 << 20) + j) * (1 << 20) + k
    rows = points.select(F.col(point_id).alias("id"), *XYZ, *[place[c].alias(f"p{c}") for c in XYZ])
    leaf = rows.groupBy("px", "py", "pz").agg(F.count(F.lit(1)).alias("n"), *[g(c).alias(f"{m}{c}") for c in XYZ for m, g in (("a", F.min), ("b", F.max))]).checkpoint()
    levels, level = [], leaf
    for _ in range(depth + 1):
        half = [F.call_function("shiftright", F.col(f"p{c}"), F.lit(1)) for c in XYZ]
        levels.append(level.select(packed(*(F.col(f"p{c}") for c in XYZ)).alias("cell"), packed(*half).alias("up"), F.struct(*[f"{m}{c}" for c in XYZ for m in "ab"]).alias("box")))
        level = level.groupBy(*[h.alias(f"p{c}") for h, c in zip(half, XYZ)]).agg(*[g(f"{m}{c}").alias(f"{m}{c}") for c in XYZ for m, g in (("a", F.min), ("b", F.max))])
    sizes = leaf.select("px", "py", "pz", F.ceil(F.col("n") / LEAF_ROW).alias("parts"))
    # a full leaf, copies of one place for instance, gets several rows
    dealt = rows.join(sizes, ["px", "py", "pz"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    held = dealt.groupBy(packed(*(F.col(f"p{c}") for c in XYZ)).alias("cell"), "part").agg(F.array_sort(F.collect_list(F.struct("id", *XYZ))).alias("points"))
    return levels[::-1], held


def _far(left: DataFrame, right: DataFrame, left_id: str, right_id: str, ends: Sequence[dict]) -> DataFrame:
    """(left_id, right_id, d): the nearest right point of each left one, however far, by a descent through trees of cells over both sides.

    From level to level a pair of cells becomes the pairs of the cells in them; of
    a left cell's pairs those go that are farther, box from box, than another one
    is at most. What is left of the leaves is compared point by point.
    """
    counts = [left.count(), right.count()]
    depth = max(1, min(20, int(np.log2(max(1.0, max(counts) / LEAF)) / 3)))
    (l_levels, l_points), (r_levels, r_points) = (_tree(f, i, e, depth) for f, i, e in ((left, left_id, ends[0]), (right, right_id, ends[1])))
    pairs = left.sparkSession.createDataFrame([(0, 0)], "l long, r long")
    for ls, rs in zip(l_levels[1:], r_levels[1:]):
        a = ls.select(F.col("cell").alias("l_cell"), F.col("up").alias("l"), F.col("box").alias("l_box"))
        b = rs.select(F.col("cell").alias("r_cell"), F.col("up").alias("r"), F.col("box").alias("r_box"))
        each = pairs.join(a, "l").join(b, "r")
        gap = lambda c: F.greatest(F.lit(0.0), F.col(f"r_box.a{c}") - F.col(f"l_box.b{c}"), F.col(f"l_box.a{c}") - F.col(f"r_box.b{c}"))
        most = lambda c: F.greatest(F.abs(F.col(f"r_box.b{c}") - F.col(f"l_box.a{c}")), F.abs(F.col(f"l_box.b{c}") - F.col(f"r_box.a{c}")))
        each = each.select("l_cell", "r_cell", sum((gap(c) * gap(c) for c in XYZ), F.lit(0.0)).alias("low"), sum((most(c) * most(c) for c in XYZ), F.lit(0.0)).alias("high"))
        best = each.groupBy("l_cell").agg(F.min("high").alias("best"))
        # a little more than the bound, for what rounding takes off
        pairs = each.join(best, "l_cell").where(F.col("low") <= F.col("best") * (1 + 1e-9)).select(F.col("l_cell").alias("l"), F.col("r_cell").alias("r")).checkpoint()
    kinds = [f.schema[i].dataType.simpleString() for f, i in ((left, left_id), (right, right_id))]
    joined = pairs.join(l_points.select(F.col("cell").alias("l"), F.col("points").alias("here")), "l").join(r_points.select(F.col("cell").alias("r"), F.col("points").alias("there")), "r").select("here", "there")

    def compare(batches):
        for batch in batches:
            sides = []
            for c in ("here", "there"):
                lists = batch.column(c)
                flat, ends = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
                sides.append((flat.field("id"), np.stack([flat.field(x).to_numpy(zero_copy_only=False) for x in XYZ]), ends))
            (left_ids, p, a), (right_ids, q, b) = sides
            at, least = np.empty(p.shape[1], dtype=np.int64), np.empty(p.shape[1])
            for k in range(batch.num_rows):
                x, y, z = (p[c, a[k] : a[k + 1], None] - q[c, None, b[k] : b[k + 1]] for c in range(3))
                d = np.sqrt(((0.0 + x * x) + y * y) + z * z)
                near = d.argmin(axis=1)  # the first of equals has the smaller id
                at[a[k] : a[k + 1]] = b[k] + near
                least[a[k] : a[k + 1]] = d[np.arange(len(near)), near]
            yield pa.RecordBatch.from_arrays([left_ids, right_ids.take(pa.array(at)), pa.array(least)], names=["left_id", "right_id", "d"])

    found = joined.mapInArrow(compare, f"left_id {kinds[0]}, right_id {kinds[1]}, d double")
    return found.groupBy("left_id").agg(F.min(F.struct("d", "right_id")).alias("m")).select("left_id", F.col("m.right_id").alias("right_id"), F.col("m.d").alias("d"))


def nearest_any(left: DataFrame, right: DataFrame, gate: float, left_id: str, right_id: str) -> DataFrame:
    """The nearest right point however far: inside the gate by its cells, for the rows without one by a descent through cells of all sizes (``_far``).

    Rows and points with a coordinate that is null or not finite find none and are
    none. Needs a checkpoint folder.
    """
    finite = " AND ".join(f"abs({c}) < double('infinity')" for c in XYZ)
    rest, right = left.where(finite), right.where(finite)
    near = nearest(rest, right, gate, left_id, right_id).checkpoint()
    rest = rest.join(near.select(F.col("left_id").alias(left_id)), left_id, "left_anti").checkpoint()
    ends = [f.agg(*[g(c).alias(f"{n}_{c}") for c in XYZ for n, g in (("a", F.min), ("b", F.max))]).first().asDict() for f in (rest, right)]
    if any(e["a_x"] is None for e in ends):
        return near
    return near.unionByName(_far(rest, right, left_id, right_id, ends))


def plane_snap(points: DataFrame, target: DataFrame, gate: float, point_id: str, target_id: str) -> DataFrame:
    """Points moved along the normal onto the plane of their nearest target (x, y, z, nx, ny, nz); those farther than the gate are dropped."""
    near = nearest(points, target, gate, point_id, target_id)
    t = target.select(F.col(target_id).alias("right_id"), *[F.col(c).alias(f"t{c}") for c in XYZ], "nx", "ny", "nz")
    joined = near.join(points.select(F.col(point_id).alias("left_id"), *XYZ), "left_id").join(t, "right_id")
    off = sum(((F.col(c) - F.col(f"t{c}")) * F.col(f"n{c}") for c in XYZ), F.lit(0.0))
    return joined.select("left_id", "right_id", *[(F.col(c) - off * F.col(f"n{c}")).alias(c) for c in XYZ])


def covariance(pairs: DataFrame, points: DataFrame, left_id: str = "left_id", right_id: str = "right_id", point_id: str = "vec_id") -> DataFrame:
    """(left_id, n, cxx, cxy, cxz, cyy, cyz, czz): population covariance of each point's neighbours."""
    p = points.select(F.col(point_id).alias(right_id), *XYZ)
    return pairs.join(p, right_id).groupBy(left_id).agg(F.count(F.lit(1)).alias("n"), *[F.covar_pop(a, b).alias(f"c{a}{b}") for i, a in enumerate(XYZ) for b in XYZ[i:]])


def normals(cov: DataFrame, left_id: str = "left_id") -> DataFrame:
    """(left_id, nx, ny, nz): eigenvector of the smallest eigenvalue, its largest component positive."""
    kind = cov.schema[left_id].dataType.simpleString()

    def solve(batches):
        for pdf in batches:
            c = {k: pdf[k].to_numpy(float) for k in ("cxx", "cxy", "cxz", "cyy", "cyz", "czz")}
            m = np.stack([c["cxx"], c["cxy"], c["cxz"], c["cxy"], c["cyy"], c["cyz"], c["cxz"], c["cyz"], c["czz"]], axis=1).reshape(-1, 3, 3)
            v = np.linalg.eigh(m)[1][:, :, 0] if len(m) else np.empty((0, 3))
            largest = np.take_along_axis(v, np.abs(v).argmax(axis=1)[:, None], axis=1) if len(v) else v[:, :1]
            v = v * np.where(largest < 0, -1.0, 1.0)
            yield pdf[[left_id]].assign(nx=v[:, 0], ny=v[:, 1], nz=v[:, 2])

    return cov.mapInPandas(solve, f"`{left_id}` {kind}, nx double, ny double, nz double")


def triangulate(rays: DataFrame, track: str) -> DataFrame:
    """(track, x, y, z): the point nearest to all rays of a track; rays are ox, oy, oz and unit dx, dy, dz.

    Six and three sums a track, then Cramer's rule; parallel rays give nulls.
    """
    d = [F.col(f"d{c}") for c in XYZ]
    o = [F.col(f"o{c}") for c in XYZ]
    m = [[(1.0 if i == j else 0.0) - d[i] * d[j] for j in range(3)] for i in range(3)]
    sums = [F.sum(m[i][j]).alias(f"a{i}{j}") for i in range(3) for j in range(i, 3)] + [F.sum(sum((m[i][j] * o[j] for j in range(3)), F.lit(0.0))).alias(f"b{i}") for i in range(3)]
    s = rays.groupBy(track).agg(*sums)
    a = [[F.col(f"a{min(i, j)}{max(i, j)}") for j in range(3)] for i in range(3)]
    b = [F.col(f"b{i}") for i in range(3)]

    def det(q: Sequence[Sequence[Column]]) -> Column:
        return q[0][0] * (q[1][1] * q[2][2] - q[1][2] * q[2][1]) - q[0][1] * (q[1][0] * q[2][2] - q[1][2] * q[2][0]) + q[0][2] * (q[1][0] * q[2][1] - q[1][1] * q[2][0])

    whole = det(a)
    safe = F.when(F.abs(whole) > 1e-12, whole)
    return s.select(track, *[(det([[b[i] if j == k else a[i][j] for j in range(3)] for i in range(3)]) / safe).alias(c) for k, c in enumerate(XYZ)])
