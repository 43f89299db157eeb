"""Relational, report and message-log queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relational as R
from ..operators import reports, transforms
from ..sources import dataset, messages
from .base import SIG, query, sig, table


@query("topic_discovery", "SELECT DISTINCT event_type AS topic FROM events WHERE regexp_matches(event_type, '^(click|view|purchase)$')")
def topic_discovery(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(F.col("event_type").alias("topic"), F.when(F.col("event_type").rlike("^(click|view|purchase)$"), "sensor_msgs/msg/Imu").otherwise("other").alias("schema_name"))
    return messages.topics_by_schema(log, "sensor_msgs/msg/Imu")


@query("bag_topic_stats", f"""WITH {SIG} SELECT event_type AS topic, count(*) AS n, first('schema_' || k ORDER BY t DESC, event_id DESC) AS schema, min(t) AS t_start, max(t) AS t_end, (max(t) - min(t)) / 1e6 AS seconds,
 CASE WHEN max(t) > min(t) THEN count(*) / ((max(t) - min(t)) / 1e6) ELSE 10.0 END AS rate FROM sig GROUP BY event_type""")
def bag_topic_stats(spark, sf_dir):
    s = sig(spark, sf_dir).withColumn("schema", F.concat(F.lit("schema_"), F.col("k").cast("string")))
    return reports.topic_summary(s, "event_type", "schema", "t", "event_id")


@query("distribution_stats", """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.1), 6) AS p10, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50, round(quantile_cont(l_extendedprice, 0.95), 6) AS p95,
 max(l_extendedprice) AS largest FROM lineitem GROUP BY l_returnflag""")
def distribution_stats(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem")
    found = reports.exact_percentiles(items, ["l_returnflag"], "l_extendedprice", [0.1, 0.5, 0.95])
    largest = items.groupBy("l_returnflag").agg(F.max("l_extendedprice").alias("largest"))
    return found.join(largest, "l_returnflag").select("l_returnflag", *[F.round(c, 6).alias(c) for c in ("p10", "p50", "p95")], "largest")


@query("sequence_chain", """WITH n AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position, count(*) OVER (PARTITION BY conv_id) AS n FROM (SELECT DISTINCT conv_id, turn FROM conversations))
SELECT conv_id, turn, position, lpad(CAST(position AS VARCHAR), CAST(greatest(5, length(CAST(n - 1 AS VARCHAR))) AS INTEGER), '0') AS frame_key FROM n""")
def sequence_chain(spark, sf_dir):
    """Turns linked to the next by token, put in order again by following the links."""
    from pyspark.sql import Window

    from ..operators.relational import chain

    _checkpoints(spark)
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn").distinct()
    w = Window.partitionBy("conv_id").orderBy("turn")
    token = lambda c: F.concat_ws("/", F.col("conv_id").cast("string"), c.cast("string"))
    linked = turns.withColumns({"token": token(F.col("turn")), "next": F.when(F.lead("turn").over(w).isNotNull(), token(F.lead("turn").over(w))).otherwise("")})
    rows = chain(linked, ["conv_id"], "token", "next")
    n = F.count(F.lit(1)).over(Window.partitionBy("conv_id"))
    return rows.select("conv_id", "turn", "position", R.frame_key(F.col("position"), n).alias("frame_key"))


def _checkpoints(spark) -> None:
    """The shared folder of the cluster; with a local master, as in tests, one of this machine."""
    if spark.sparkContext.getCheckpointDir():
        return
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        import tempfile
        from pathlib import Path

        top = Path(tempfile.mkdtemp(prefix="roadglass-")).as_uri()
    spark.sparkContext.setCheckpointDir(top)


@query("frame_denormalise", """WITH s AS (SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)
SELECT o_orderkey, o_orderpriority, count(l_orderkey) AS n_views, array_to_string(list(l_linenumber || ':' || p_brand || ':' || n_name || ':' || r_name ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) FILTER (l_orderkey IS NOT NULL), '|') AS views
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN s ON s_suppkey = l_suppkey GROUP BY o_orderkey, o_orderpriority""")
def frame_denormalise(spark, sf_dir):
    """Orders as frames, their items as views: required and optional lookups, then one ordered list a frame."""
    t = lambda n: table(spark, sf_dir, n)
    place = R.required_join(t("supplier").withColumn("n_nationkey", F.col("s_nationkey")), t("nation"), ["n_nationkey"], "supplier").join(t("region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey", "left")
    items = t("lineitem").join(t("part").withColumnRenamed("p_partkey", "l_partkey"), "l_partkey", "left").join(place.withColumnRenamed("s_suppkey", "l_suppkey"), "l_suppkey", "left")
    views = R.grouped(items, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"], ["l_linenumber", "p_brand", "n_name", "r_name"], "views")
    joined = t("orders").join(views, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    line = F.transform("views", lambda v: F.concat_ws(":", v["l_linenumber"].cast("string"), v["p_brand"], v["n_name"], v["r_name"]))
    return joined.select("o_orderkey", "o_orderpriority", F.coalesce(F.size("views"), F.lit(0)).cast("long").alias("n_views"), F.array_join(line, "|").alias("views"))


@query("frame_rollup", """SELECT l_orderkey, count(*) AS num_boxes, array_to_string(list_sort(list(DISTINCT p_type) FILTER (p_type <> '')), ',') AS categories FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey""")
def frame_rollup(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"), "left")
    return items.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("num_boxes"), F.array_join(R.sorted_set("p_type"), ",").alias("categories"))


@query("index_category_filter", """WITH f AS (SELECT o.o_orderkey, o.o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS pos, c.a, c.b FROM orders o LEFT JOIN
 (SELECT l_orderkey, list(DISTINCT p_type) FILTER (l_quantity >= 25) AS a, list(DISTINCT p_type) FILTER (l_quantity < 25) AS b FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey) c ON c.l_orderkey = o.o_orderkey)
SELECT o_orderkey FROM f WHERE pos % 3 = 0 AND (list_contains(a, 'PROMO') OR list_contains(b, 'PROMO'))""")
def index_category_filter(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("p_partkey") == F.col("l_partkey"))
    lists = items.groupBy("l_orderkey").agg(F.collect_set(F.when(F.col("l_quantity") >= 25, F.col("p_type"))).alias("a"), F.collect_set(F.when(F.col("l_quantity") < 25, F.col("p_type"))).alias("b"))
    index = table(spark, sf_dir, "orders").join(lists, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return dataset.index_scan(index, "o_orderstatus", "o_orderkey", ["a", "b"], ["PROMO"], 3).select("o_orderkey")


@query("payload_replace", """SELECT c_custkey, coalesce(CASE WHEN c_nationkey % 4 = 0 THEN 'template_' || c_nationkey END, c_name) AS c_name, c_nationkey % 4 = 0 AS replaced FROM customer""")
def payload_replace(spark, sf_dir):
    templates = table(spark, sf_dir, "nation").where("n_nationkey % 4 = 0").select(F.col("n_nationkey").alias("c_nationkey"), F.concat(F.lit("template_"), F.col("n_nationkey").cast("string")).alias("c_name"))
    return R.replace_payload(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_name"), templates, ["c_nationkey"], "c_name").select("c_custkey", "c_name", "replaced")


@query("tf_expand", """WITH t AS (SELECT r_name AS parent, 'camera' || n_nationkey || '/camera_link' AS child, n_nationkey * 1.0 AS x, 0.0 AS y, coalesce(CASE WHEN n_nationkey % 3 > 0 THEN n_nationkey / 2 END, 0.0) AS z, n_nationkey / 10 AS r, n_nationkey / 20 AS p, -n_nationkey / 15 AS w
 FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT 'base', 'lidar_' || r_regionkey, 1.0, 2.0, 3.0, 0, 0, 0 FROM region),
q AS (SELECT parent, child, x, y, z, sin(r/2)*cos(p/2)*cos(w/2) - cos(r/2)*sin(p/2)*sin(w/2) AS qx, cos(r/2)*sin(p/2)*cos(w/2) + sin(r/2)*cos(p/2)*sin(w/2) AS qy, cos(r/2)*cos(p/2)*sin(w/2) - sin(r/2)*sin(p/2)*cos(w/2) AS qz, cos(r/2)*cos(p/2)*cos(w/2) + sin(r/2)*sin(p/2)*sin(w/2) AS qw FROM t)
SELECT parent, child, x, y, z, round(qx, 9) + 0.0 AS qx, round(qy, 9) + 0.0 AS qy, round(qz, 9) + 0.0 AS qz, round(qw, 9) + 0.0 AS qw FROM q
UNION ALL SELECT child, replace(child, 'camera_link', 'camera_optical_link'), 0.0, 0.0, 0.0, -0.5, 0.5, -0.5, 0.5 FROM t WHERE regexp_matches(child, '^camera[0-9]+/camera_link$')""")
def tf_expand(spark, sf_dir):
    """Transforms with Euler angles, and an optical frame added below each camera link."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    k = F.col("n_nationkey")
    cameras = n.select(
        F.col("r_name").alias("parent"), F.concat(F.lit("camera"), k.cast("string"), F.lit("/camera_link")).alias("child"), k.cast("double").alias("x"), F.lit(0.0).alias("y"),
        F.when(k % 3 > 0, k / 2).alias("z"), (k / 10).alias("roll"), (k / 20).alias("pitch"), (-k / 15).alias("yaw"),
    )
    none = F.lit(None).cast("double")
    lidars = table(spark, sf_dir, "region").select(F.lit("base").alias("parent"), F.concat(F.lit("lidar_"), F.col("r_regionkey").cast("string")).alias("child"), F.lit(1.0).alias("x"), F.lit(2.0).alias("y"), F.lit(3.0).alias("z"), none.alias("roll"), none.alias("pitch"), none.alias("yaw"))
    out = transforms.expand(cameras.unionByName(lidars))
    return out.select("parent", "child", "x", "y", "z", *[(F.round(q, 9) + 0.0).alias(q) for q in ("qx", "qy", "qz", "qw")])


@query("last_wins", f"WITH {SIG} SELECT series, event_type, event_id, t, value FROM sig QUALIFY row_number() OVER (PARTITION BY series, event_type ORDER BY t DESC, event_id DESC) = 1")
def last_wins(spark, sf_dir):
    return R.last_wins(sig(spark, sf_dir).select("series", "event_type", "event_id", "t", "value"), ["series", "event_type"], ["t", "event_id"])


@query("first_wins", f"WITH {SIG} SELECT event_type, event_id, t, value FROM sig QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY t, event_id) = 1")
def first_wins(spark, sf_dir):
    return R.first_wins(sig(spark, sf_dir).select("event_type", "event_id", "t", "value"), ["event_type"], ["t", "event_id"])


@query("anti_pairs", "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def anti_pairs(spark, sf_dir):
    done = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(done, "c_custkey", "left_anti")


@query("unconverted", """SELECT o_orderkey AS clip, o_custkey AS n_frames FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'A' AND l_linestatus = 'F')""")
def unconverted(spark, sf_dir):
    clips = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("clip"), F.col("o_custkey").alias("n_frames"))
    done = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("clip"), (F.col("l_returnflag") == "A").alias("has_shards"), (F.col("l_linestatus") == "F").alias("has_index")).join(clips, "clip")
    return dataset.unconverted(clips, done)


@query("required_topics", "SELECT t AS topic, 'FAIL' AS level FROM (SELECT unnest(['click', 'odometry', 'purchase', 'tf_static']) AS t) EXCEPT SELECT event_type, 'FAIL' FROM events")
def required_topics(spark, sf_dir):
    need = spark.createDataFrame([(t,) for t in ("click", "odometry", "purchase", "tf_static")], "topic string")
    return R.missing(need, table(spark, sf_dir, "events").withColumnRenamed("event_type", "topic"), ["topic"]).withColumn("level", F.lit("FAIL"))


@query("longest_prefix", """WITH p AS (SELECT DISTINCT source AS base FROM documents UNION SELECT DISTINCT source || '_' || lang FROM documents WHERE lang <> 'es'), d AS (SELECT doc_id, source || '_' || lang || '_aug' AS stem FROM documents)
SELECT doc_id, stem, base FROM d JOIN p ON starts_with(stem, base || '_') QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length(base) DESC) = 1""")
def longest_prefix(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    base = d.select(F.col("source").alias("base")).union(d.where("lang <> 'es'").select(F.concat_ws("_", "source", "lang"))).distinct()
    return R.longest_prefix(d.select("doc_id", F.concat_ws("_", "source", "lang", F.lit("aug")).alias("stem")), "stem", base, "base")


@query("precedence_lookup", """SELECT s_suppkey, coalesce(CASE WHEN s_suppkey % 5 = 0 THEN 'override' END, CASE WHEN s_nationkey % 3 = 0 THEN 'result' END, n_name) AS source FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey""")
def precedence_lookup(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    third = s.join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey")).select("s_suppkey", F.col("n_name").alias("source"))
    one = s.where("s_suppkey % 5 = 0").select("s_suppkey", F.lit("override").alias("source"))
    two = s.where("s_nationkey % 3 = 0").select("s_suppkey", F.lit("result").alias("source"))
    return R.first_of(["s_suppkey"], s, "source", one, two, third).select("s_suppkey", "source")


@query("report_summary", """WITH r AS (SELECT d.doc_id, CASE WHEN l.quality IS NULL THEN NULL ELSE l.quality = 1 END AS ok, lang AS category, CASE WHEN toxic = 1 THEN 'high' END AS severity FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT 'n_total' AS metric, '' AS item, CAST(count(*) AS DOUBLE) AS value FROM r UNION ALL SELECT 'n_evaluated', '', count(ok) FROM r UNION ALL SELECT 'ok_ratio', '', count(*) FILTER (ok) / count(ok) FROM r
UNION ALL SELECT 'category', coalesce(CASE WHEN category <> 'es' THEN category END, 'other'), count(*) FROM r GROUP BY ALL UNION ALL SELECT 'severity', coalesce(severity, 'low'), count(*) FROM r GROUP BY ALL""")
def report_summary(spark, sf_dir):
    r = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    issue = F.struct(F.when(F.col("lang") != "es", F.col("lang")).alias("category"), F.when(F.col("toxic") == 1, F.lit("high")).alias("severity"))
    return reports.review_summary(r.select((F.col("quality") == 1).alias("ok"), F.array(issue).alias("issues")), "ok", "issues")


@query("mutual_information", """WITH b AS (SELECT min(l_quantity) AS a0, max(l_quantity) AS a1, min(l_extendedprice) AS b0, max(l_extendedprice) AS b1 FROM lineitem),
c AS (SELECT least(15, floor((l_quantity - a0) * 16 / (a1 - a0))) AS i, least(15, floor((l_extendedprice - b0) * 16 / (b1 - b0))) AS j, count(*) AS n FROM lineitem, b GROUP BY ALL),
m AS (SELECT n, sum(n) OVER (PARTITION BY i) AS r, sum(n) OVER (PARTITION BY j) AS c, sum(n) OVER () AS t FROM c)
SELECT round(sum(n / t * ln(n * t / (r * c))), 6) AS mutual_information FROM m""")
def mutual_information(spark, sf_dir):
    out = reports.mutual_information(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice")
    return out.select(F.round("mutual_information", 6).alias("mutual_information"))


@query("histogram", "SELECT CAST(least(floor((l_quantity - 1) / (49 / 10.0)), 9) AS INTEGER) AS bin, count(*) AS n FROM lineitem WHERE l_quantity BETWEEN 1 AND 50 GROUP BY 1")
def histogram(spark, sf_dir):
    return reports.histogram(table(spark, sf_dir, "lineitem"), "l_quantity", 1, 50, 10)


@query("shardlist", "SELECT 'shard-' || o_orderkey AS url, o_custkey + 1 AS nsamples FROM orders WHERE o_orderstatus <> 'P'")
def shardlist(spark, sf_dir):
    m = table(spark, sf_dir, "orders").select(F.concat(F.lit("shard-"), F.col("o_orderkey").cast("string")).alias("url"), F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("n_frames"))
    return dataset.shard_list(m)


@query("round_robin", "SELECT doc_id, CAST((row_number() OVER (ORDER BY doc_id) - 1) % 3 AS INTEGER) AS endpoint FROM documents")
def round_robin(spark, sf_dir):
    return R.round_robin(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 3)


@query("attribute_names", """WITH a AS (SELECT l_orderkey, list(l_suppkey ORDER BY l_linenumber, l_suppkey) AS tokens FROM lineitem GROUP BY l_orderkey), e AS (SELECT l_orderkey, unnest(tokens) AS s, generate_subscripts(tokens, 1) AS i FROM a)
SELECT l_orderkey, coalesce(array_to_string(list(s_name ORDER BY i) FILTER (s_name IS NOT NULL), ','), '') AS names FROM e LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 2 = 0) ON s = s_suppkey GROUP BY l_orderkey""")
def attribute_names(spark, sf_dir):
    tokens = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey"))), lambda x: x["l_suppkey"]).alias("tokens"))
    known = table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0").select("s_suppkey", "s_name")
    return R.names_of(tokens, "tokens", known, "s_suppkey", "s_name", ["l_orderkey"]).select("l_orderkey", F.array_join("names", ",").alias("names"))


@query("time_unit", f"""WITH {SIG} SELECT series, CASE WHEN max(value) - min(value) <= 300 THEN 1000 ELSE 1 END AS unit FROM sig GROUP BY series""")
def time_unit(spark, sf_dir):
    from ..functions import geo

    return sig(spark, sf_dir).groupBy("series").agg(geo.time_unit_ns(F.col("value"), 300).alias("unit"))



@query("settings_overlay", """SELECT s_suppkey, CASE WHEN s_suppkey % 5 = 0 THEN 'own' WHEN s_nationkey % 3 = 0 THEN 'nation ' || s_nationkey ELSE 'default' END AS origin, CASE WHEN s_nationkey % 3 = 0 THEN s_nationkey ELSE 100 END AS most, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE 5 END AS least FROM supplier""")
def settings_overlay(spark, sf_dir):
    """Nested settings of each supplier: defaults, its nation's document over them, its own over both; an own value ends a whole object."""
    from ..operators import settings

    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    key, nation = F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    every = s.select("s_suppkey", F.lit("defaults").alias("document"), F.lit(0).alias("rank"), F.lit('{"origin": "default", "limits": {"most": 100, "range": {"least": 5}}}').alias("text"))
    nations = s.where("s_nationkey % 3 = 0").select("s_suppkey", text("nation ", nation).alias("document"), F.lit(1).alias("rank"), text('{"origin": "nation ', nation, '", "limits": {"most": ', nation, "}}").alias("text"))
    own = s.where("s_suppkey % 5 = 0").select("s_suppkey", text("own ", key).alias("document"), F.lit(2).alias("rank"), F.lit('{"origin": "own"}').alias("text"))
    ended = s.where("s_suppkey % 7 = 0").select("s_suppkey", text("range ", key).alias("document"), F.lit(3).alias("rank"), F.lit('{"limits": {"range": "none"}}').alias("text"))
    docs = every.unionByName(nations).unionByName(own).unionByName(ended).withColumn("body", F.try_parse_json("text"))
    values = settings.overlaid(settings.leaves(docs, ["s_suppkey"], 3), ["s_suppkey"])
    return settings.looked_up(s.select("s_suppkey"), values, ["s_suppkey"], {"origin": (["origin"], "string", None), "most": (["limits", "most"], "int", None), "least": (["limits", "range", "least"], "int", None)})
