"""Queries over messages, files and solvers: events as decoded messages, points as scans."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import functions as F

from ..functions import geo, text
from ..operators import camera, reports, series, solve
from ..operators import relational as R
from ..sources import archives, messages, pcd, sinks
from .base import EMB, SIG, emb, query, sig, table
from .relations import _checkpoints

US = 1_000_000
#: Bytes of an archive of a source, about.
SHARD_BYTES = 64_000_000


def _log(spark, sf_dir):
    """Events as a log: one file a series, numbered by event."""
    return sig(spark, sf_dir).withColumns({"log_time_ns": F.col("t") * 1000, "file_seq": (F.col("series") % 3).cast("int"), "msg_seq": F.col("event_id")})


def _shared(spark, name: str) -> str:
    """A new folder below the one that all machines share."""
    import uuid

    _checkpoints(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("bag_files", """SELECT unnest(['benchmark', 'conversations', 'customer', 'documents', 'embeddings', 'events', 'labels', 'lineitem', 'nation', 'orders', 'pages', 'part', 'region', 'supplier']) AS name, CAST(unnest(range(14)) AS BIGINT) AS position""")
def bag_files(spark, sf_dir):
    """The files of a folder in order of name."""
    found = messages.bag_files(sf_dir, ".parquet")
    rows = spark.createDataFrame([(p, i) for i, p in enumerate(found)], "path string, position long")
    return rows.select(text.stem(F.col("path")).alias("name"), "position")


@query("read_fixes", f"""WITH {SIG} SELECT event_id, t * 1000 AS t, 35 + value / 1000 AS lat, 139 + sv / 1000 AS lon, value AS alt, round(CASE WHEN k % 4 = 0 THEN 0.0 ELSE sqrt(greatest((value + sv) / 2, 0)) END, 9) AS spread, k % 3 - 1 AS status FROM sig""")
def read_fixes(spark, sf_dir):
    value, sv, k = F.col("value"), F.col("sv"), F.col("k")
    zero = F.lit(0.0)
    msg = F.struct(
        (35 + value / 1000).alias("latitude"), (139 + sv / 1000).alias("longitude"), value.alias("altitude"), F.array(value, zero, zero, zero, sv, zero, zero, zero, value).alias("position_covariance"),
        (k % 4).alias("position_covariance_type"), F.struct((k % 3 - 1).alias("status")).alias("status"),
    )
    out = messages.fixes(_log(spark, sf_dir).withColumn("msg", msg))
    return out.select(F.col("msg_seq").alias("event_id"), "t", "lat", "lon", "alt", F.round("spread", 9).alias("spread"), "status")


@query("read_imu", f"""WITH {SIG} SELECT event_id, t * 1000 AS t, sv / 100 AS yaw_rate, round(2 * atan2(sin(value / 400), cos(value / 400)), 9) AS heading, value AS accel_x FROM sig""")
def read_imu(spark, sf_dir):
    q = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.sin(F.col("value") / 400).alias("z"), F.cos(F.col("value") / 400).alias("w"))
    msg = F.struct(q.alias("orientation"), F.struct((F.col("sv") / 100).alias("z")).alias("angular_velocity"), F.struct(F.col("value").alias("x")).alias("linear_acceleration"))
    out = messages.imu(_log(spark, sf_dir).withColumn("msg", msg), turns=True)
    return out.select(F.col("msg_seq").alias("event_id"), "t", "yaw_rate", F.round("heading", 9).alias("heading"), "accel_x")


def _odometry(spark, sf_dir):
    value, sv, t = F.col("value"), F.col("sv"), F.col("t")
    stamp = F.struct(F.call_function("div", t, F.lit(US)).cast("int").alias("sec"), ((t % US) * 1000).cast("int").alias("nanosec"))
    pose = F.struct(F.struct(value.alias("x"), sv.alias("y"), (value + sv).alias("z")).alias("position"), F.struct(*[F.lit(v).alias(c) for c, v in zip("xyzw", (0.0, 0.0, 0.6, 0.8))]).alias("orientation"))
    cov = F.transform(F.sequence(F.lit(0), F.lit(35)), lambda i: i * value)
    msg = F.struct(F.struct(stamp.alias("stamp")).alias("header"), F.struct(pose.alias("pose"), cov.alias("covariance")).alias("pose"))
    return messages.odometry(_log(spark, sf_dir).withColumns({"msg": msg, "vehicle": F.col("series")}))


@query("read_odometry", f"""WITH {SIG} SELECT event_id, t * 1000 AS t, value AS x, sv AS y, value + sv AS z, 0.6 AS qz, 0.8 AS qw, 0 * value AS var_x, 7 * value AS var_y, 14 * value AS var_z FROM sig""")
def read_odometry(spark, sf_dir):
    return _odometry(spark, sf_dir).select(F.col("msg_seq").alias("event_id"), "t", "x", "y", "z", "qz", "qw", "var_x", "var_y", "var_z")


@query("trajectory", f"""WITH {SIG} SELECT event_id, t * 1000 AS t, value - first_value(value) OVER w AS x, sv - first_value(sv) OVER w AS y FROM sig WINDOW w AS (PARTITION BY event_id % 3 ORDER BY t, event_id)""")
def trajectory(spark, sf_dir):
    odo = _odometry(spark, sf_dir).withColumn("drive", F.col("msg_seq") % 3)
    return messages.trajectory(odo, ["drive"]).select(F.col("msg_seq").alias("event_id"), "t", "x", "y")


@query("header_times", f"WITH {SIG} SELECT event_id, t * 1000 AS header_ns, t * 1000 AS log_ns FROM sig WHERE event_type = 'click'")
def header_times(spark, sf_dir):
    """Only the stamps of one topic's messages."""
    stamp = F.struct(F.struct(F.call_function("div", F.col("t"), F.lit(US)).alias("sec"), ((F.col("t") % US) * 1000).alias("nanosec")).alias("stamp"))
    rows = _log(spark, sf_dir).withColumns({"topic": F.col("event_type"), "msg": F.struct(stamp.alias("header"))})
    return messages.scan(rows, ["click"]).select("event_id", messages.header_ns().alias("header_ns"), F.col("log_time_ns").alias("log_ns"))


@query("speed_profile", f"""WITH {SIG}, a AS (SELECT series, t, sv, value, lead(t) OVER w AS tn, lead(sv) OVER w AS sn, lead(value) OVER w AS vn FROM sig WINDOW w AS (PARTITION BY series ORDER BY t, event_id))
SELECT series, CAST(floor((t + tn) / 2) AS BIGINT) AS t_mid, round(sqrt((sn - sv) * (sn - sv) + (vn - value) * (vn - value)) / greatest((tn - t) / 1e6, 1e-6), 6) AS speed FROM a WHERE tn IS NOT NULL""")
def speed_profile(spark, sf_dir):
    return series.speed_profile(sig(spark, sf_dir), ["series"], "sv", "value", US, "t", "event_id").withColumn("speed", F.round("speed", 6))


FLOATS = {0: "00000000", 1: "0000803F", 2: "000000C0", 3: "0000C07F"}  # 0, 1, -2 and no number, as their bytes


@query("point_decode", f"""WITH {SIG}, p AS (SELECT event_id, unnest(range(3)) AS point, k FROM sig), v AS (SELECT event_id, point, k, (k + point) % 4 AS f FROM p)
SELECT event_id, point, CAST(CASE f WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE -2 END AS DOUBLE) AS x, CAST(k % 100 AS DOUBLE) AS y, CAST(point * 7 AS DOUBLE) AS z, CASE WHEN event_id % 2 = 0 THEN CAST(point + 1 AS DOUBLE) ELSE 0.0 END AS intensity,
 CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(point * 256 + 5 AS DOUBLE) END AS time FROM v WHERE f <> 3""")
def point_decode(spark, sf_dir):
    """Packed points of mixed types: x float32, y and z bytes, an optional intensity, a 16-bit time."""
    byte = lambda c: F.lpad(F.hex(c), 2, "0")
    place = lambda p: (F.col("k") + p) % 4
    floats = lambda p: F.when(place(p) == 0, FLOATS[0]).when(place(p) == 1, FLOATS[1]).when(place(p) == 2, FLOATS[2]).otherwise(FLOATS[3])
    packed = F.concat(*[F.concat(floats(p), byte(F.col("k") % 100), byte(F.lit(p * 7)), byte(F.lit(p + 1)), F.lit("05"), byte(F.lit(p))) for p in range(3)])
    field = lambda name, at, kind: F.struct(F.lit(name).alias("name"), F.lit(at).alias("offset"), F.lit(kind).alias("datatype"))
    known = [field("x", 0, 7), field("y", 4, 2), field("z", 5, 2), field("ring", 6, 99)]
    fields = F.concat(F.array(*known), F.when(F.col("event_id") % 2 == 0, F.array(field("intensity", 6, 2))).otherwise(F.array_repeat(field("intensity", 6, 2), 0)), F.when(F.col("event_id") % 3 == 0, F.array_repeat(field("t_us", 7, 4), 0)).otherwise(F.array(field("t_us", 7, 4))))
    scans = sig(spark, sf_dir).select("event_id", F.unhex(packed).alias("data"), F.lit(9).alias("point_step"), fields.alias("fields"))
    return messages.points(scans, ["event_id"])


@query("pcd_files", f"WITH {EMB} SELECT scan, count(*) AS n, round(sum(CAST(CAST(x AS FLOAT) AS DOUBLE)), 4) AS x, round(sum(CAST(CAST(intensity AS FLOAT) AS DOUBLE)), 4) AS intensity, min(CAST(0 AS BIGINT)) AS first FROM emb GROUP BY scan")
def pcd_files(spark, sf_dir):
    """A file for each scan, written by its task, and read back."""
    path = _shared(spark, "pcd")
    pcd.write(emb(spark, sf_dir).withColumns({"point": F.col("vec_id"), "name": F.concat(F.lit("scan_"), F.col("scan").cast("string"))}), path, "name")
    back = pcd.read(spark, path)
    scan = F.regexp_extract("path", r"scan_(-?\d+)\.pcd$", 1).cast(emb(spark, sf_dir).schema["scan"].dataType)
    return back.groupBy(scan.alias("scan")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("x").cast("double")), 4).alias("x"), F.round(F.sum(F.col("intensity").cast("double")), 4).alias("intensity"), F.min("point").alias("first"))


@query("shard_members", "SELECT source, doc_id || '.txt' AS name, md5(coalesce(text, '')) AS md5 FROM documents WHERE source IS NOT NULL")
def shard_members(spark, sf_dir):
    """Archives by source, written in a stream; every member is read again from the place that the index has.

    A source of more than SHARD_BYTES has several; names have a number, since ids may repeat.
    """
    docs = table(spark, sf_dir, "documents").where("source IS NOT NULL").select("source", "doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("body"))
    parts = docs.groupBy("source").agg(F.ceil(F.sum(F.octet_length("body") + 1024) / SHARD_BYTES).alias("parts"))
    member = F.concat(F.col("doc_id").cast("string"), F.lit("."), F.monotonically_increasing_id().cast("string"), F.lit(".txt"))
    rows = docs.withColumn("member", member).join(parts, "source")
    shard = F.concat_ws("-", F.url_encode("source"), F.pmod(F.xxhash64("member"), F.col("parts")).cast("string"))
    path = re.sub("^file:/*", "/", _shared(spark, "shards"))
    index = archives.write(rows.select(shard.alias("shard"), "member", "body"), path)
    read = archives.bodies(index.withColumn("path", F.concat(F.lit(path + "/"), "shard", F.lit(".tar"))))
    source = F.url_decode(F.regexp_replace("shard", "-[0-9]+$", ""))
    return read.select(source.alias("source"), F.regexp_replace("member", "[.][0-9]+[.]txt$", ".txt").alias("name"), F.md5("body").alias("md5"))


@query("event_csv", f"WITH {SIG} SELECT CAST(t * 1000 AS VARCHAR) AS t_ns, event_type AS maneuver_type, CAST(k AS VARCHAR) AS magnitude, count(*) AS n FROM sig WHERE event_type = 'purchase' GROUP BY ALL")
def event_csv(spark, sf_dir):
    """Events written as one CSV file and read back as text."""
    path = _shared(spark, "events")
    rows = sig(spark, sf_dir).where("event_type = 'purchase'").select((F.col("t") * 1000).alias("t_ns"), F.lit(1.5).alias("lat"), F.lit(2.5).alias("lon"), F.col("event_type").alias("maneuver_type"), F.col("k").alias("magnitude"))
    sinks.write_events(rows, path)
    return spark.read.csv(path, header=True).groupBy("t_ns", "maneuver_type", "magnitude").agg(F.count(F.lit(1)).alias("n"))


@query("track_arrays", f"WITH {SIG} SELECT series AS track, CAST(row_number() OVER (PARTITION BY series ORDER BY t, event_id) - 1 AS INTEGER) AS seq, t AS t_ns, value AS u, sv AS v FROM sig")
def track_arrays(spark, sf_dir):
    """Observations to an array for each track, and flat again."""
    flat = sig(spark, sf_dir).select(F.col("series").alias("track"), F.struct("t", "event_id").alias("at"), F.col("t").alias("t_ns"), F.col("value").alias("u"), F.col("sv").alias("v"))
    return camera.observations(camera.tracks(flat, "track", "at", ["t_ns", "u", "v"]), "track", "points")


@query("strided_arrays", "SELECT vec_id, len(range(3, len(embedding) + 1, 8)) AS n, array_to_string(list_transform(range(3, len(embedding) + 1, 8), lambda i: round(CAST(embedding[i] AS DOUBLE), 3) = 0), ',') AS zeros, round(list_sum(list_transform(range(3, len(embedding) + 1, 8), lambda i: CAST(embedding[i] AS DOUBLE))), 5) + 0.0 AS total FROM embeddings")
def strided_arrays(spark, sf_dir):
    """Every eighth element of an array, from its third on."""
    part = R.every_nth(F.col("embedding"), 8, 2)
    total = F.aggregate(part, F.lit(0.0), lambda a, x: a + x.cast("double"))
    zeros = F.array_join(F.transform(part, lambda x: (F.round(x.cast("double"), 3) == 0).cast("string")), ",")
    return table(spark, sf_dir, "embeddings").select("vec_id", F.size(part).cast("long").alias("n"), zeros.alias("zeros"), (F.round(total, 5) + 0.0).alias("total"))


@query("rle_masks", """WITH g AS (SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) % 5 AS a, 1 + event_id % 7 AS b FROM events), p AS (SELECT event_id, unnest(range(a, a + b)) AS p FROM g)
SELECT event_id, array_to_string(list_sort(list((p % 4) * 5 + p // 4)), ',') AS pixels FROM p GROUP BY event_id""")
def rle_masks(spark, sf_dir):
    """Masks of a picture of 4 x 5 from their compressed run lengths."""
    a, b = F.col("k") % 5, 1 + F.col("event_id") % 7
    number = lambda n: F.char((n + F.when(n < 0, 32).otherwise(0) + 48).cast("int"))  # noqa: E731  five bits with a sign hold -16 to 15
    last = 20 - a - b
    runs = F.concat(number(a), number(b), F.when(last <= 15, number(last)).otherwise(F.concat(F.char((F.lit(32 + 48) + last % 32).cast("int")), F.char(F.lit(48)))))
    counts = sig(spark, sf_dir).select("event_id", F.base64(runs.cast("binary")).alias("counts"))
    decode = F.udf(lambda c: ",".join(map(str, camera.rle_mask(c, 4, 5))), "string", useArrow=True)
    return counts.select("event_id", decode("counts").alias("pixels"))


@query("unprojection", f"""WITH {SIG} SELECT event_id, round(sv / 500, 6) + 0.0 AS a, round(value / 500, 6) + 0.0 AS b FROM sig""")
def unprojection(spark, sf_dir):
    """Directions bent by a lens and made straight again."""
    k, lens = (800.0, 810.0, 640.0, 360.0), (-0.1, 0.02, 0.001, -0.002, 0.003)
    u, v, _ = geo.project([F.col("sv") / 500, F.col("value") / 500, F.lit(1.0)], k, lens)
    pixels = sig(spark, sf_dir).select("event_id", u.alias("u"), v.alias("v"))
    return camera.unproject_table(pixels, k, lens, rounds=60).select("event_id", *[(F.round(c, 6) + 0.0).alias(c) for c in ("a", "b")])


@query("hash_sample", "SELECT least(100, count(*)) AS n, least(100, count(*)) AS ids, least(100, count(*)) AS again FROM events")
def hash_sample(spark, sf_dir):
    """A sample has as many rows as asked for, all different, and the same ones whatever the partitions."""
    rows = table(spark, sf_dir, "events").select("event_id")
    one, two = series.sample(rows, ["event_id"], 100, 7), series.sample(rows.repartition(5), ["event_id"], 100, 7)
    return one.join(two.withColumn("same", F.lit(True)), "event_id", "left").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("ids"), F.count("same").alias("again"))


@query("camera_order", "SELECT '/sensing/camera/camera' || n_nationkey || '/image_raw/compressed' AS topic, 'camera' || n_nationkey AS camera, CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS BIGINT) AS position FROM nation WHERE n_nationkey % 2 = 0")
def camera_order(spark, sf_dir):
    """Camera topics in numeric order; cameras are few, so the driver numbers them."""
    n = F.col("n_nationkey").cast("string")
    odd = F.concat(F.lit("/sensing/lidar/lidar"), n)
    topics = table(spark, sf_dir, "nation").select(F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("/sensing/camera/camera"), n, F.lit("/image_raw/compressed"))).otherwise(odd).alias("topic"))
    return spark.createDataFrame([(*r, i) for i, r in enumerate(messages.camera_topics(topics).collect())], "topic string, camera string, position long")


@query("camera_arguments", """SELECT n_nationkey, n_nationkey + (n_nationkey + 1) AS total, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey * 10 END AS width, CASE WHEN n_nationkey % 2 = 0 THEN 720 END AS height FROM nation""")
def camera_arguments(spark, sf_dir):
    k = F.col("n_nationkey")
    ids = text.camera_ids(F.concat(k.cast("string"), F.lit(", ,"), (k + 1).cast("string"), F.lit(",")))
    size = text.resolution(F.when(k % 2 == 0, F.concat((k * 10).cast("string"), F.lit("x720"))).otherwise(F.concat((k * 10).cast("string"), F.lit("x721"))))
    rows = table(spark, sf_dir, "nation").select("n_nationkey", F.aggregate(ids, F.lit(0), lambda a, x: a + x).cast("int").alias("total"), size.alias("s"))
    return rows.select("n_nationkey", "total", "s.width", "s.height")


@query("source_sizes", f"""WITH {SIG}, i AS (SELECT series AS camera, first(k * 2 ORDER BY t, event_id) AS width FROM sig WHERE event_type = 'click' GROUP BY 1), m AS (SELECT series AS camera, first(k * 4 ORDER BY t, event_id) AS width FROM sig WHERE event_type = 'view' AND k % 3 > 0 GROUP BY 1)
SELECT camera, coalesce(i.width, m.width) AS width, 8 AS height FROM i FULL JOIN m USING (camera)""")
def source_sizes(spark, sf_dir):
    """The first camera_info tells, else the first image with a size."""
    log = _log(spark, sf_dir).withColumns({"camera": F.col("series"), "file_seq": F.lit(0), "height": F.lit(8)})
    infos = log.where("event_type = 'click'").withColumn("width", F.col("k") * 2)
    images = log.where("event_type = 'view'").withColumn("width", F.when(F.col("k") % 3 > 0, F.col("k") * 4))
    return messages.source_sizes(infos, images)


@query("timing_summary", """SELECT o_orderpriority AS step, CAST(count(*) AS DOUBLE) AS seconds, CASE WHEN o_orderpriority = '5-LOW' THEN 'rc=2' ELSE 'ok' END AS status FROM orders GROUP BY 1, 3 UNION ALL SELECT 'total', count(*), NULL FROM orders""")
def timing_summary(spark, sf_dir):
    steps = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("step")).agg(F.count(F.lit(1)).alias("seconds"))
    return reports.timings(steps.withColumn("code", F.when(F.col("step") == "5-LOW", 2).otherwise(0)))


@query("model_review", """SELECT doc_id, doc_id % 5 <> 4 AS parse_ok, CASE WHEN doc_id % 5 = 4 THEN NULL ELSE doc_id % 7 END AS issues FROM documents""")
def model_review(spark, sf_dir):
    """Answers of a client that answers differently at each call: half of the first answers are no JSON, one frame in five never gets any."""

    def ask(question: str) -> str:
        import random

        n = int(question.split("\n")[0])
        good = "```json\n{\"issues\": " + str(n % 7) + ", \"noise\": " + str(random.random()) + "}\n```"
        return good if n % 5 != 4 and ("JSON" in question or random.random() < 0.5) else f"I can't say {{ {random.random()}"

    frames = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("prompt"))
    out = sinks.review(frames, ask, ["doc_id"], _shared(spark, "review"))
    return out.select("doc_id", "parse_ok", F.get_json_object("parsed", "$.issues").try_cast("long").alias("issues"))


@query("sample_by_group", """SELECT event_type, least(150, count(*)) AS n, least(150, count(*)) AS ids, least(150, count(*)) AS again FROM events GROUP BY 1""")
def sample_by_group(spark, sf_dir):
    """Of each kind of events as many as asked for, all different, and the same ones whatever the partitions."""
    rows = table(spark, sf_dir, "events").select("event_type", "event_id")
    one, two = (series.sample(r, ["event_id"], 150, 7, ["event_type"]) for r in (rows, rows.repartition(5)))
    both = one.join(two.select("event_id", F.lit(True).alias("same")), "event_id", "left")
    return both.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("ids"), F.count("same").alias("again"))


def _wall_scene(spark, sf_dir):
    """Three walls as target, and the same points seen from a known pose."""
    ids = table(spark, sf_dir, "embeddings").select("vec_id").orderBy("vec_id").limit(300)
    k = F.col("vec_id").cast("long")
    p, q = ((k * 37) % 41) / 10.0 - 2.0, ((k * 53) % 43) / 10.0 - 2.0
    wall = k % 3
    pick = lambda a, b, c: F.when(wall == 0, a).when(wall == 1, b).otherwise(c)
    zero, one = F.lit(0.0), F.lit(1.0)
    target = ids.select(k.alias("target"), pick(p, p, F.lit(4.0)).alias("x"), pick(q, F.lit(3.0), p).alias("y"), pick(zero, q, q).alias("z"), pick(zero, zero, one).alias("nx"), pick(zero, one, zero).alias("ny"), pick(one, zero, zero).alias("nz"))
    motion = solve.se3_exp(np.array([0.01, -0.02, 0.015, 0.05, -0.04, 0.03]))
    back = np.linalg.inv(motion)
    moved = geo.apply_transform([F.lit(float(v)) for v in back[:3, :3].ravel()], [F.lit(float(v)) for v in back[:3, 3]], [F.col(c) for c in "xyz"])
    return target.select(F.col("target").alias("point"), *[m.alias(c) for m, c in zip(moved, "xyz")]), target, motion


@query("rigid_alignment", "SELECT true AS converged, 0.0 AS turn_error, 0.0 AS shift_error, 0.0 AS rms")
def rigid_alignment(spark, sf_dir):
    """A known motion found again from coarse to fine, and scored at the finest gate."""
    points, target, motion = _wall_scene(spark, sf_dir)
    pose, rms, n = solve.align(points, target, np.eye(4), [0.5, 0.25], steps=8)
    scored = solve.evaluate(points, target, pose, 0.25, 0.1, "point", "target")
    off = np.linalg.inv(motion) @ pose
    turn = float(np.arccos(np.clip((np.trace(off[:3, :3]) - 1) / 2, -1, 1)))
    error = round(float(np.sqrt(scored.squares / max(1, scored.n))), 4) + 0.0
    return spark.createDataFrame([(bool(scored.n == n and n > 0), round(turn, 3) + 0.0, round(float(np.linalg.norm(off[:3, 3])), 3) + 0.0, error)], "converged boolean, turn_error double, shift_error double, rms double")


@query("bounded_fit", f"WITH {SIG} SELECT round(avg(value), 3) AS free, round(least(avg(sv), 0.0), 3) + 0.0 AS held FROM sig")
def bounded_fit(spark, sf_dir):
    """The least squares of two means, the second held below zero by its bound."""
    rows = sig(spark, sf_dir).select("value", "sv").cache()
    n = rows.count()
    cost = lambda p: ((F.col("value") - p[0]) * (F.col("value") - p[0]) + (F.col("sv") - p[1]) * (F.col("sv") - p[1])) / n
    (free, held), _ = solve.minimise(solve.costs_of(rows, cost, 2), [10.0, -50.0], [-1000.0, -1000.0], [1000.0, 0.0])
    rows.unpersist()
    return spark.createDataFrame([(round(float(free), 3), round(float(held), 3) + 0.0)], "free double, held double")


@query("sweep_verdict", f"""WITH {SIG}, g AS (SELECT event_type AS edge, k AS step, round(avg(value), 9) AS score FROM sig GROUP BY 1, 2), r AS (SELECT edge, arg_max(step, score) AS best, max(score) / min(score) AS ratio FROM g GROUP BY edge)
SELECT edge, round(ratio, 6) AS ratio, CASE WHEN ratio >= 1.5 THEN 'GO' ELSE 'NO' END AS verdict FROM r""")
def sweep_verdict(spark, sf_dir):
    """Whether each class of edges tells settings apart: the best score over the worst."""
    grid = sig(spark, sf_dir).groupBy(F.col("event_type").alias("edge"), "k").agg(F.round(F.avg("value"), 9).alias("score"))
    return reports.contrast(grid, ["edge"], "score", 1.5).withColumn("ratio", F.round("ratio", 6))


@query("bounded_fits", f"""WITH {SIG} SELECT event_type AS key, round(regr_slope(value / 100, k / 50), 3) + 0.0 AS slope, round(regr_intercept(value / 100, k / 50), 3) + 0.0 AS intercept FROM sig GROUP BY 1""")
def bounded_fits(spark, sf_dir):
    """A line through the values of each kind of event: all fits in step, each round one aggregate."""
    rows = sig(spark, sf_dir).select(F.col("event_type").alias("key"), (F.col("value") / 100).alias("y"), (F.col("k") / 50).alias("x"))
    n = {r["key"]: r["count"] for r in rows.groupBy("key").count().collect()}
    off = lambda p: p[0] * F.col("x") + p[1] - F.col("y")
    found = solve.minimise_many(lambda stage: solve.costs_by_key(rows, "key", lambda p: off(p) * off(p) / 1000, 2), {k: [0.0, 0.0] for k in n}, [-50, -50], [50, 50], rounds=60, tolerance=1e-13)
    return spark.createDataFrame([(k, *(round(float(v), 3) + 0.0 for v in x)) for k, (x, _) in sorted(found.items())], "key string, slope double, intercept double")
