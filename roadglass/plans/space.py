"""Spatial and geometric queries over the embeddings table read as points."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo
from ..operators import camera, solve, spatial
from ..sources import messages
from .base import EMB, SIG, emb, query, sig
from .relations import _checkpoints

XYZ = spatial.XYZ
VOXEL = 0.1
KEY = "((CAST(floor(x / 0.1) AS BIGINT) + 1048576) << 42) | ((CAST(floor(y / 0.1) AS BIGINT) + 1048576) << 21) | (CAST(floor(z / 0.1) AS BIGINT) + 1048576)"
MAP = f"""vm AS (SELECT {KEY} AS voxel, count(*) AS n, count(DISTINCT scan) AS scans, avg(x) AS x, avg(y) AS y, avg(z) AS z, avg(intensity) AS intensity,
 sqrt(greatest(avg(x*x)-avg(x)*avg(x),0) + greatest(avg(y*y)-avg(y)*avg(y),0) + greatest(avg(z*z)-avg(z)*avg(z),0)) AS spread FROM emb GROUP BY 1)"""


def _arc(az: str, el: str, r: str, footprint: float) -> str:
    return f"((CAST(floor({az} * {r} / {footprint}) AS BIGINT) + 33554432) << 26) | (CAST(floor({el} * {r} / {footprint}) AS BIGINT) + 33554432)"


SPH = f"""sp AS (SELECT vec_id, scan, atan2(y, x) AS az, asin(greatest(-1, least(1, z / sqrt(x*x+y*y+z*z)))) AS el, sqrt(x*x+y*y+z*z) AS r FROM emb),
ri AS (SELECT scan, {_arc('az', 'el', 'r', 0.05)} AS cell, min(r) AS r, first(vec_id ORDER BY r, vec_id) AS point FROM sp GROUP BY 1, 2)"""


@query("voxel_map", f"WITH {EMB}, {MAP} SELECT voxel, n, scans, round(x, 6) + 0.0 AS x, round(y, 6) + 0.0 AS y, round(z, 6) + 0.0 AS z, round(intensity, 6) + 0.0 AS intensity, round(spread, 5) AS spread FROM vm")
def voxel_map(spark, sf_dir):
    out = spatial.voxel_map(emb(spark, sf_dir), VOXEL)
    return out.select("voxel", "n", "scans", *[(F.round(c, 6) + 0.0).alias(c) for c in (*XYZ, "intensity")], F.round("spread", 5).alias("spread"))


@query("range_image", f"WITH {EMB}, {SPH} SELECT scan, cell, round(r, 6) AS r, point FROM ri")
def range_image(spark, sf_dir):
    return spatial.range_image(emb(spark, sf_dir), 0.05).withColumn("r", F.round("r", 6))


@query("voxel_vote", f"""WITH {EMB}, {MAP}, {SPH}, se AS (SELECT scan, 0.01 * scan AS ox, -0.01 * scan AS oy, 0.0 AS oz, 0.3 * scan AS yaw FROM (SELECT DISTINCT scan FROM emb)),
d AS (SELECT voxel, scan, cos(yaw)*(x-ox) + sin(yaw)*(y-oy) AS a, cos(yaw)*(y-oy) - sin(yaw)*(x-ox) AS b, z - oz AS c FROM vm, se),
q AS (SELECT voxel, scan, atan2(b, a) AS az, asin(greatest(-1, least(1, c / sqrt(a*a+b*b+c*c)))) AS el, sqrt(a*a+b*b+c*c) AS r FROM d),
v AS (SELECT q.voxel, count(*) AS visible FROM q JOIN ri ON ri.scan = q.scan AND ri.cell = {_arc('q.az', 'q.el', 'q.r', 0.05)} AND ri.r >= q.r - 0.02 WHERE q.r BETWEEN 0.02 AND 1.0 AND abs(q.az) <= 1.5 AND abs(q.el) <= 1.2 GROUP BY 1)
SELECT voxel, scans, round(scans / greatest(coalesce(visible, 0), scans), 6) AS ratio FROM vm LEFT JOIN v USING (voxel) WHERE scans / greatest(coalesce(visible, 0), scans) >= 0.6""")
def voxel_vote(spark, sf_dir):
    points = emb(spark, sf_dir)
    sensors = points.select("scan").distinct().select("scan", (0.01 * F.col("scan")).alias("ox"), (-0.01 * F.col("scan")).alias("oy"), F.lit(0.0).alias("oz"), (0.3 * F.col("scan")).alias("yaw"))
    voxels = spatial.voxel_map(points, VOXEL)
    seen = spatial.visibility_votes(voxels, sensors, spatial.range_image(points, 0.05), 0.05, 0.02, 1.0, 1.5, 1.2, 0.02)
    return spatial.vote(voxels, seen, 0.6).select("voxel", "scans", F.round("ratio", 6).alias("ratio"))


@query("range_edges", f"""WITH {EMB}, {SPH}, im AS (SELECT scan, CAST(floor((az + pi()) / 0.1) AS BIGINT) AS u, CAST(floor((el + pi() / 2) / 0.1) AS BIGINT) AS v, min(r) AS r, first(vec_id ORDER BY r, vec_id) AS point FROM sp GROUP BY 1, 2, 3),
e AS (SELECT scan, point, lead(u) OVER w = u + 1 AS near, lead(r) OVER w - r AS g, lead(point) OVER w AS o FROM im WINDOW w AS (PARTITION BY scan, v ORDER BY u)
 UNION ALL SELECT scan, point, lead(v) OVER w = v + 1, lead(r) OVER w - r, lead(point) OVER w FROM im WINDOW w AS (PARTITION BY scan, u ORDER BY v))
SELECT scan, CASE WHEN g > 0 THEN point ELSE o END AS point, round(max(abs(g)), 6) AS weight FROM e WHERE near AND abs(g) > 0.05 GROUP BY 1, 2""")
def range_edges(spark, sf_dir):
    return spatial.range_edges(spatial.angle_image(emb(spark, sf_dir), 0.1), 0.05).withColumn("weight", F.round("weight", 6))


DIST = "sqrt((a.x-b.x)*(a.x-b.x) + (a.y-b.y)*(a.y-b.y) + (a.z-b.z)*(a.z-b.z))"


def _sides(spark, sf_dir):
    e = emb(spark, sf_dir)
    return e.where("vec_id % 3 = 0"), e.where("vec_id % 3 <> 0")


@query("spatial_nn", f"""WITH {EMB} SELECT a.vec_id AS left_id, first(b.vec_id ORDER BY {DIST}, b.vec_id) AS right_id, round(min({DIST}), 6) AS d FROM emb a, emb b WHERE a.vec_id % 3 = 0 AND b.vec_id % 3 <> 0 AND {DIST} < 0.08 GROUP BY 1""")
def spatial_nn(spark, sf_dir):
    return spatial.nearest(*_sides(spark, sf_dir), 0.08, "vec_id", "vec_id").withColumn("d", F.round("d", 6))


@query("spatial_nn_any", f"""WITH {EMB} SELECT a.vec_id AS left_id, first(b.vec_id ORDER BY {DIST}, b.vec_id) AS right_id, round(min({DIST}), 6) AS d FROM emb a, emb b WHERE a.vec_id % 3 = 0 AND b.vec_id % 3 <> 0 GROUP BY 1""")
def spatial_nn_any(spark, sf_dir):
    _checkpoints(spark)
    return spatial.nearest_any(*_sides(spark, sf_dir), 0.08, "vec_id", "vec_id").withColumn("d", F.round("d", 6))


@query("spatial_nn_far", f"""WITH {EMB}, a AS (SELECT vec_id, x + 100 AS x, y, z - 20 AS z FROM emb WHERE vec_id % 3 = 0), b AS (SELECT * FROM emb WHERE vec_id % 3 <> 0)
SELECT a.vec_id AS left_id, round(min({DIST}), 6) AS d FROM a, b GROUP BY 1""")
def spatial_nn_far(spark, sf_dir):
    """Nearest points of a cloud that lies far outside of the gate."""
    _checkpoints(spark)
    left, right = _sides(spark, sf_dir)
    left = left.withColumns({"x": F.col("x") + 100, "z": F.col("z") - 20})
    return spatial.nearest_any(left, right, 0.08, "vec_id", "vec_id").select("left_id", F.round("d", 6).alias("d"))


@query("spatial_knn", f"""WITH {EMB}, j AS (SELECT a.vec_id AS left_id, b.vec_id AS right_id, {DIST} AS d FROM emb a, emb b WHERE {DIST} < 0.15)
SELECT left_id, right_id, round(d, 6) AS d, CAST(k AS INTEGER) AS k FROM (SELECT *, row_number() OVER (PARTITION BY left_id ORDER BY d, right_id) AS k FROM j) WHERE k <= 5""")
def spatial_knn(spark, sf_dir):
    e = emb(spark, sf_dir)
    return spatial.nearest_k(e, e, 0.15, 5, "vec_id", "vec_id").withColumn("d", F.round("d", 6))


NN = f"""nn AS (SELECT a.vec_id AS left_id, first(b.vec_id ORDER BY {DIST}, b.vec_id) AS right_id FROM emb a, emb b WHERE a.vec_id % 3 = 0 AND b.vec_id % 3 <> 0 AND {DIST} < 0.08 GROUP BY 1),
pr AS (SELECT nn.*, p.x, p.y, p.z, t.intensity / l AS nx, t.x / l AS ny, t.y / l AS nz, (p.x-t.x)*t.intensity/l + (p.y-t.y)*t.x/l + (p.z-t.z)*t.y/l AS o FROM nn JOIN emb p ON p.vec_id = left_id
 JOIN (SELECT *, sqrt(intensity*intensity + x*x + y*y) AS l FROM emb) t ON t.vec_id = right_id)"""


def _planes(spark, sf_dir):
    """Points, and others that carry a normal made of their coordinates."""
    a, b = _sides(spark, sf_dir)
    norm = F.sqrt(F.col("intensity") * F.col("intensity") + F.col("x") * F.col("x") + F.col("y") * F.col("y"))
    return a, b.select("vec_id", *XYZ, (F.col("intensity") / norm).alias("nx"), (F.col("x") / norm).alias("ny"), (F.col("y") / norm).alias("nz"))


@query("plane_snap", f"WITH {EMB}, {NN} SELECT left_id, right_id, round(x - o * nx, 6) + 0.0 AS x, round(y - o * ny, 6) + 0.0 AS y, round(z - o * nz, 6) + 0.0 AS z FROM pr")
def plane_snap(spark, sf_dir):
    out = spatial.plane_snap(*_planes(spark, sf_dir), 0.08, "vec_id", "vec_id")
    return out.select("left_id", "right_id", *[(F.round(c, 6) + 0.0).alias(c) for c in XYZ])


@query("huber_normal_eq", f"""WITH {EMB}, {NN}, w AS (SELECT *, CASE WHEN abs(o) <= 0.01 THEN 1.0 ELSE 0.01 / abs(o) END AS w, y*nz - z*ny AS j0, z*nx - x*nz AS j1 FROM pr)
SELECT count(*) AS n, round(sum(w*j0*j0), 6) AS h00, round(sum(w*j0*j1), 6) + 0.0 AS h01, round(sum(w*nx*nx), 5) AS h33, round(sum(w*j0*o), 6) + 0.0 AS g0, round(sum(w*nz*o), 6) + 0.0 AS g5,
 round(sum(CASE WHEN abs(o) <= 0.01 THEN 0.5*o*o ELSE 0.01*(abs(o) - 0.005) END), 6) AS cost, round(sum(o*o), 6) AS squares FROM w""")
def huber_normal_eq(spark, sf_dir):
    import numpy as np

    rows = solve.residuals(*_planes(spark, sf_dir), np.eye(4), 0.08, "vec_id", "vec_id")
    names = {"h00": 6, "h01": 6, "h33": 5, "g0": 6, "g5": 6, "cost": 6, "squares": 6}
    return solve.normal_sums(rows, 0.01).select("n", *[(F.round(c, d) + 0.0).alias(c) for c, d in names.items()])


@query("pca_normals")
def pca_normals(spark, sf_dir):
    e = emb(spark, sf_dir)
    return spatial.normals(spatial.covariance(spatial.nearest_k(e, e, 0.15, 8, "vec_id", "vec_id"), e))


@query("triangulate", f"""WITH {EMB}, u AS (SELECT scan, x AS ox, y AS oy, z AS oz, (intensity)/l AS dx, (x+1)/l AS dy, (y-1)/l AS dz FROM (SELECT *, sqrt(intensity*intensity + (x+1)*(x+1) + (y-1)*(y-1)) AS l FROM emb)),
s AS (SELECT scan, sum(1-dx*dx) a, sum(-dx*dy) b, sum(-dx*dz) c, sum(1-dy*dy) d, sum(-dy*dz) e, sum(1-dz*dz) f, sum((1-dx*dx)*ox - dx*dy*oy - dx*dz*oz) p, sum(-dx*dy*ox + (1-dy*dy)*oy - dy*dz*oz) q, sum(-dx*dz*ox - dy*dz*oy + (1-dz*dz)*oz) r FROM u GROUP BY scan),
t AS (SELECT *, a*(d*f-e*e) - b*(b*f-e*c) + c*(b*e-d*c) AS det FROM s)
SELECT scan, round((p*(d*f-e*e) - b*(q*f-e*r) + c*(q*e-d*r)) / det, 5) + 0.0 AS x, round((a*(q*f-e*r) - p*(b*f-e*c) + c*(b*r-q*c)) / det, 5) + 0.0 AS y, round((a*(d*r-q*e) - b*(b*r-q*c) + p*(b*e-d*c)) / det, 5) + 0.0 AS z FROM t""")
def triangulate(spark, sf_dir):
    d = [F.col("intensity"), F.col("x") + 1, F.col("y") - 1]
    norm = F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2])
    rays = emb(spark, sf_dir).select("scan", *[F.col(c).alias(f"o{c}") for c in XYZ], *[(v / norm).alias(f"d{c}") for c, v in zip(XYZ, d)])
    return spatial.triangulate(rays, "scan").select("scan", *[(F.round(c, 5) + 0.0).alias(c) for c in XYZ])


@query("box_corners", f"""WITH {EMB}, s AS (SELECT i, CASE WHEN i & 4 > 0 THEN 0.5 ELSE -0.5 END AS sx, CASE WHEN i & 2 > 0 THEN 0.5 ELSE -0.5 END AS sy, CASE WHEN i & 1 > 0 THEN 0.5 ELSE -0.5 END AS sz FROM (SELECT unnest(range(8)) AS i))
SELECT vec_id, CAST(i AS INTEGER) AS corner, round(x + cos(2*intensity)*4*sx - sin(2*intensity)*2*sy, 6) + 0.0 AS cx, round(y + sin(2*intensity)*4*sx + cos(2*intensity)*2*sy, 6) + 0.0 AS cy, round(z + 1.5*sz, 6) + 0.0 AS cz FROM emb, s""")
def box_corners(spark, sf_dir):
    zero = F.lit(0.0)
    r = geo.rotation_of_wxyz([F.cos("intensity"), zero, zero, F.sin("intensity")])
    corners = geo.box_corners([F.col(c) for c in XYZ], [F.lit(2.0), F.lit(4.0), F.lit(1.5)], r)
    rows = emb(spark, sf_dir).select("vec_id", F.posexplode(F.array(*[F.struct(*[v.alias(n) for v, n in zip(c, ("cx", "cy", "cz"))]) for c in corners])).alias("corner", "c"))
    return rows.select("vec_id", "corner", *[(F.round(f"c.{c}", 6) + 0.0).alias(c) for c in ("cx", "cy", "cz")])


@query("pinhole_project", f"""WITH {EMB}, n AS (SELECT vec_id, x / (z + 1) AS a, y / (z + 1) AS b FROM emb WHERE z + 1 > 0.1), r AS (SELECT *, a*a + b*b AS r2 FROM n),
d AS (SELECT *, 1 + r2 * (0.1 + r2 * (-0.05 + r2 * 0.01)) AS k FROM r)
SELECT vec_id, round((a*k + 2*0.001*a*b + 0.002*(r2 + 2*a*a)) * 800 + 640, 5) AS u, round((b*k + 0.001*(r2 + 2*b*b) + 2*0.002*a*b) * 810 + 360, 5) AS v FROM d""")
def pinhole_project(spark, sf_dir):
    u, v, valid = geo.project([F.col("x"), F.col("y"), F.col("z") + 1], (800.0, 810.0, 640.0, 360.0), (0.1, -0.05, 0.001, 0.002, 0.01))
    return emb(spark, sf_dir).where(valid).select("vec_id", F.round(u, 5).alias("u"), F.round(v, 5).alias("v"))


@query("fisheye_project", f"""WITH {EMB}, n AS (SELECT vec_id, x / (z + 1) AS a, y / (z + 1) AS b FROM emb WHERE z + 1 > 0.1), r AS (SELECT *, sqrt(a*a + b*b) AS r, atan(sqrt(a*a + b*b)) AS th FROM n),
d AS (SELECT *, CASE WHEN r > 1e-8 THEN th * (1 + th*th * (0.05 + th*th * (-0.01 + th*th * (0.002 + th*th * -0.0005)))) / r ELSE 1.0 END AS k FROM r)
SELECT vec_id, round(a*k*500 + 320, 5) AS u, round(b*k*500 + 240, 5) AS v FROM d""")
def fisheye_project(spark, sf_dir):
    u, v, valid = geo.project([F.col("x"), F.col("y"), F.col("z") + 1], (500.0, 500.0, 320.0, 240.0), (0.05, -0.01, 0.002, -0.0005))
    return emb(spark, sf_dir).where(valid).select("vec_id", F.round(u, 5).alias("u"), F.round(v, 5).alias("v"))


@query("deskew", f"""WITH {SIG}, {EMB}, ps AS (SELECT t, value / 10 AS px, sv / 10 AS py FROM sig WHERE series = 7), sp AS (SELECT min(t) AS t0 FROM ps),
q AS (SELECT vec_id, x, y, z, t0 + vec_id * 3000000000 AS t, t0 FROM emb, sp),
b AS (SELECT q.*, a.t AS ta, a.px AS xa, a.py AS ya FROM q ASOF LEFT JOIN ps a ON q.t >= a.t), n AS (SELECT b.*, c.t AS tb, c.px AS xb, c.py AS yb FROM b ASOF LEFT JOIN ps c ON b.t < c.t),
i AS (SELECT *, CASE WHEN tb IS NULL THEN 0.0 ELSE (t - ta) / (tb - ta) END AS f FROM n), o AS (SELECT px AS x0, py AS y0 FROM ps ORDER BY t LIMIT 1)
SELECT vec_id, round(x + xa + (coalesce(xb, xa) - xa) * f - x0, 5) + 0.0 AS dx, round(y + ya + (coalesce(yb, ya) - ya) * f - y0, 5) + 0.0 AS dy, round(z, 5) + 0.0 AS dz FROM i, o""")
def deskew(spark, sf_dir):
    zero = F.lit(0.0)
    poses = sig(spark, sf_dir).where("series = 7").select("series", "t", (F.col("value") / 10).alias("x"), (F.col("sv") / 10).alias("y"), zero.alias("z"), zero.alias("qx"), zero.alias("qy"), zero.alias("qz"), F.lit(1.0).alias("qw"))
    start = poses.groupBy("series").agg(F.min("t").alias("t0"))
    points = emb(spark, sf_dir).select("vec_id", *XYZ, F.lit(7).cast("long").alias("series")).join(start, "series").withColumn("t", F.col("t0") + F.col("vec_id") * 3_000_000_000)
    return messages.deskew(points, poses, ["series"]).select("vec_id", *[(F.round(c, 5) + 0.0).alias(c) for c in ("dx", "dy", "dz")])



PIX = "(vec_id % 37) * 0.61 - 1 AS u, (vec_id % 23) * 0.83 - 1 AS v"


@query("frustum_crop", f"""WITH {EMB}, p AS (SELECT vec_id, x / z * 300 + 320 AS u, y / z * 300 + 240 AS v FROM emb WHERE z > 0.02) SELECT vec_id, round(u, 5) AS u, round(v, 5) AS v FROM p WHERE u BETWEEN -20 AND 660 AND v BETWEEN -20 AND 500""")
def frustum_crop(spark, sf_dir):
    out = camera.frustum_crop(emb(spark, sf_dir), (300.0, 300.0, 320.0, 240.0), 640, 480, 20.0, 0.02)
    return out.select("vec_id", F.round("u", 5).alias("u"), F.round("v", 5).alias("v"))


@query("bilinear_sample", f"""WITH i AS (SELECT u, v, (u * 7 + v * 13) % 17 * 1.0 AS value FROM (SELECT unnest(range(20)) AS u), (SELECT unnest(range(16)) AS v)),
p AS (SELECT vec_id, greatest(0, least(u, 19)) AS u, greatest(0, least(v, 15)) AS v FROM (SELECT vec_id, {PIX} FROM embeddings)), c AS (SELECT *, CAST(least(floor(u), 18) AS INTEGER) AS u0, CAST(least(floor(v), 14) AS INTEGER) AS v0 FROM p)
SELECT vec_id, round(sum(i.value * (CASE WHEN i.u = u0 THEN 1 - (c.u - u0) ELSE c.u - u0 END) * (CASE WHEN i.v = v0 THEN 1 - (c.v - v0) ELSE c.v - v0 END)), 6) AS sampled FROM c JOIN i ON i.u IN (u0, u0 + 1) AND i.v IN (v0, v0 + 1) GROUP BY vec_id""")
def bilinear_sample(spark, sf_dir):
    image = spark.range(320).select((F.col("id") % 20).cast("int").alias("u"), F.floor(F.col("id") / 20).cast("int").alias("v")).withColumn("value", ((F.col("u") * 7 + F.col("v") * 13) % 17).cast("double"))
    points = emb(spark, sf_dir).select("vec_id", ((F.col("vec_id") % 37) * 0.61 - 1).alias("u"), ((F.col("vec_id") % 23) * 0.83 - 1).alias("v"))
    return camera.bilinear(points, image, 20, 16, ["vec_id"]).withColumn("sampled", F.round("sampled", 6))


@query("image_costs", f"""WITH {EMB} SELECT scan, round(sum(coalesce(CASE WHEN x > 0 THEN y END, 3.0)) / count(*), 6) + 0.0 AS capped, round(sum(coalesce(CASE WHEN x > 0 THEN y END, 0.0) * abs(z)) / sum(abs(z)), 6) + 0.0 AS weighted,
 round(coalesce(median(CASE WHEN x > 0 THEN y END), 'infinity'::DOUBLE), 6) + 0.0 AS middle FROM emb GROUP BY scan""")
def image_costs(spark, sf_dir):
    seen = F.when(F.col("x") > 0, F.col("y"))
    costs = {"capped": camera.capped_mean(seen, 3.0), "weighted": camera.weighted_mean(seen, F.abs("z")), "middle": camera.median_or_inf(seen)}
    return emb(spark, sf_dir).groupBy("scan").agg(*[(F.round(c, 6) + 0.0).alias(n) for n, c in costs.items()])


@query("edge_scores", f"""WITH {EMB}, e AS (SELECT scan, quantile_cont(x, 0.05) AS lo, quantile_cont(x, 0.95) AS hi FROM emb GROUP BY scan), s AS (SELECT vec_id, scan, greatest(0, least(1, (x - lo) / (hi - lo))) AS score FROM emb JOIN e USING (scan)),
t AS (SELECT scan, quantile_cont(score, 0.75) AS cut FROM s GROUP BY scan) SELECT vec_id, scan, round(score, 6) AS score FROM s JOIN t USING (scan) WHERE score >= cut""")
def edge_scores(spark, sf_dir):
    return camera.top_share(camera.clipped(emb(spark, sf_dir), "x", ["scan"]), "score", ["scan"], 0.25).select("vec_id", "scan", F.round("score", 6).alias("score"))


@query("sweep_grid", "SELECT CAST(a AS INTEGER) AS axis, CAST(i AS INTEGER) AS step, round(-0.5 + i * 0.1, 9) + 0.0 AS \"offset\" FROM (SELECT unnest(range(6)) AS a), (SELECT unnest(range(11)) AS i)")
def sweep_grid(spark, sf_dir):
    return camera.sweep_grid(spark, 6, 0.5, 11).select("axis", "step", (F.round("offset", 9) + 0.0).alias("offset"))


@query("reprojection", f"""WITH {EMB} SELECT vec_id, round(CASE WHEN z > 0.02 THEN x / z * 300 + 320 - vec_id ELSE 50.0 END, 5) AS du, round(CASE WHEN z > 0.02 THEN y / z * 300 + 240 - vec_id ELSE 50.0 END, 5) AS dv FROM emb""")
def reprojection(spark, sf_dir):
    seen = emb(spark, sf_dir).withColumns({"u": F.col("vec_id").cast("double"), "v": F.col("vec_id").cast("double")})
    return camera.reprojection(seen, (300.0, 300.0, 320.0, 240.0), nearest=0.02).select("vec_id", F.round("du", 5).alias("du"), F.round("dv", 5).alias("dv"))


@query("identifiability", f"""WITH {EMB}, s AS (SELECT a, i, -0.5 + i * 0.1 AS o FROM (SELECT unnest(range(4)) AS a), (SELECT unnest(range(11)) AS i)),
g AS (SELECT scan AS camera, CASE WHEN vec_id % 2 = 0 THEN 'occlusion' ELSE 'planar' END AS edge, a, i, o,
 round(avg(1 / (0.05 + pow(x + CASE WHEN a = 0 THEN o ELSE 0 END, 2) + pow(y - CASE WHEN a = 1 THEN o ELSE 0 END, 2) + CASE WHEN vec_id % 3 = 0 THEN pow(CASE WHEN a = 2 THEN o ELSE 0 END - 0.3, 2) ELSE pow(CASE WHEN a = 2 THEN o ELSE 0 END + 0.3, 2) END)), 9) AS score FROM emb, s GROUP BY ALL),
n AS (SELECT *, score > lag(score) OVER w AND score > lead(score) OVER w AS top, max(score) OVER (PARTITION BY camera, edge, a) AS best FROM g WINDOW w AS (PARTITION BY camera, edge, a ORDER BY i)),
h AS (SELECT camera, edge, a, arg_min(o, CASE WHEN score = best THEN i END) AS peak, count(*) FILTER (top) AS n_max, list_sort(list_distinct(list(score) FILTER (top OR score = best)), 'DESC') AS hs FROM n GROUP BY ALL)
SELECT camera, edge, CAST(a AS INTEGER) AS axis, round(peak, 6) + 0.0 AS peak_value, n_max AS n_local_maxima, CASE WHEN len(hs) > 1 THEN round(hs[1] / hs[2], 6) ELSE -1.0 END AS prominence,
 round(abs(peak), 6) <= 0.15 AND (len(hs) < 2 OR hs[1] / hs[2] >= 1.05) AS passes FROM h""")
def identifiability(spark, sf_dir):
    """Every setting of four parameters against every point, by camera and class of edges, in one pass."""
    from ..operators import sweeps

    e = emb(spark, sf_dir).withColumns({"camera": F.col("scan"), "edge": F.when(F.col("vec_id") % 2 == 0, "occlusion").otherwise("planar")})
    square = lambda c: c * c
    third = F.when(F.col("vec_id") % 3 == 0, -0.3).otherwise(0.3)
    rows = e.withColumn("third", third)
    zero = F.lit(0.0)
    score = lambda p: 1 / (0.05 + square(F.col("x") + p[0]) + square(F.col("y") - p[1]) + square(p[2] + F.col("third")))
    grid = sweeps.scores(rows, ["camera", "edge"], [zero] * 4, [0.5] * 4, 11, score)
    grid = grid.withColumns({"score": F.round("score", 9), "value": F.round("value", 6)})
    found = sweeps.peaks(grid, ["camera", "edge"], [0.15] * 4)
    return found.select("camera", "edge", F.col("axis").cast("int").alias("axis"), (F.col("peak_value") + 0.0).alias("peak_value"), "n_local_maxima", F.when(F.col("prominence") < float("inf"), F.round("prominence", 6)).otherwise(-1.0).alias("prominence"), "passes")
