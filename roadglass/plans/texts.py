"""Queries over names, tags, model answers and arrays."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from .base import SIG, query, sig, table


@query("tag_parse", """WITH RECURSIVE b AS (SELECT doc_id, string_split('flicker_whole_' || lang || '_deg' || (doc_id % 180) || '_ph' || lpad(CAST(doc_id % 100 AS VARCHAR), 2, '0') || '__whole_red_' || (doc_id % 7) || '_lr1_whole_' || source, '_') AS p FROM documents),
r AS (SELECT doc_id, p, 1 AS i, 0 AS pos, NULL::VARCHAR AS kind, NULL::VARCHAR AS value FROM b UNION ALL
 SELECT doc_id, p, i + CASE WHEN p[i] = 'whole' AND i + 2 <= len(p) THEN 3 ELSE 1 END, pos + 1,
  CASE WHEN p[i] = 'flicker' THEN 'flicker' WHEN p[i] = 'whole' AND i + 2 <= len(p) THEN 'whole' WHEN regexp_matches(p[i], '^(ph|rcn|rcw|lr)[0-9]{2}$') THEN regexp_extract(p[i], '^([a-z]+)', 1) ELSE 'unknown' END,
  CASE WHEN p[i] = 'flicker' THEN NULL WHEN p[i] = 'whole' AND i + 2 <= len(p) THEN p[i+1] || ':' || CASE WHEN starts_with(p[i+2], 'deg') THEN substr(p[i+2], 4) ELSE p[i+2] END WHEN regexp_matches(p[i], '^(ph|rcn|rcw|lr)[0-9]{2}$') THEN right(p[i], 2) ELSE p[i] END
 FROM r WHERE i <= len(p))
SELECT doc_id, CAST(pos - 1 AS INTEGER) AS pos, kind, value FROM r WHERE pos > 0""")
def tag_parse(spark, sf_dir):
    number = lambda n: (F.col("doc_id") % n).cast("string")
    chain = F.concat(F.lit("flicker_whole_"), F.col("lang"), F.lit("_deg"), number(180), F.lit("_ph"), F.lpad(number(100), 2, "0"), F.lit("__whole_red_"), number(7), F.lit("_lr1_whole_"), F.col("source"))
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(text.tags(chain)).alias("pos", "tag")).select("doc_id", "pos", "tag.kind", "tag.value")


@query("fence_strip", r"""SELECT conv_id, turn, trim(regexp_replace(regexp_replace('<think>' || text || '</think>' || chr(10) || '```json' || chr(10) || '{"turn": ' || turn || '}' || chr(10) || '```', '<think>.*?</think>', '', 'gis'), '(?m)^```(json)?[ \t]*$', '', 'g'), chr(32) || chr(9) || chr(10) || chr(13)) AS clean FROM conversations""")
def fence_strip(spark, sf_dir):
    answer = F.concat(F.lit("<think>"), F.col("text"), F.lit("</think>\n```json\n{\"turn\": "), F.col("turn").cast("string"), F.lit("}\n```"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.strip_fences(answer).alias("clean"))


@query("fence_json_extract", """SELECT conv_id, turn, CASE WHEN turn % 3 = 2 THEN NULL ELSE turn END AS answer, turn % 3 <> 2 AS parse_ok FROM conversations""")
def fence_json_extract(spark, sf_dir):
    """Whole answers, objects inside chatter, and answers cut off."""
    turn = F.col("turn").cast("string")
    answer = (
        F.when(F.col("turn") % 3 == 0, F.concat(F.lit("```json\n{\"turn\": "), turn, F.lit(", \"s\": \"a}b\\\"{\"}\n```")))
        .when(F.col("turn") % 3 == 1, F.concat(F.lit("Sure: {\"turn\": "), turn, F.lit(", \"in\": {\"s\": \"}\"}} and more {")))
        .otherwise(F.concat(F.lit("{\"turn\": "), turn))
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", text.parse_answer(answer).alias("v"))
    return rows.select("conv_id", "turn", F.try_variant_get("v", "$.turn", "bigint").alias("answer"), F.col("v").isNotNull().alias("parse_ok"))


@query("stamp_names", f"WITH {SIG} SELECT event_id, CAST(((t * 1000 + event_id) // 1000000000) AS VARCHAR) || lpad(CAST((t * 1000 + event_id) % 1000000000 AS VARCHAR), 9, '0') AS stamp FROM sig")
def stamp_names(spark, sf_dir):
    return sig(spark, sf_dir).select("event_id", text.stamp(F.col("t") * 1000 + F.col("event_id")).alias("stamp"))


@query("topic_names", r"""SELECT page_id, translate(trim(regexp_replace(url, '^https?:/', ''), '/'), '/', '_') AS topic, regexp_extract(rtrim(regexp_replace(url, '[?#].*$', ''), '/'), '([^/]+?)(\.[^./]*)?$', 1) AS stem,
 split_part('clip' || page_id || '_CAM_FRONT_00001_x_CAM_B', '_CAM_', 1) AS clip, 'CAM_FRONT' AS channel FROM pages""")
def topic_names(spark, sf_dir):
    name = F.concat(F.lit("clip"), F.col("page_id").cast("string"), F.lit("_CAM_FRONT_00001_x_CAM_B"))
    clip = text.before_camera(name)
    rest = F.call_function("substr", name, F.length(clip) + 2)
    return table(spark, sf_dir, "pages").select(
        "page_id", text.topic_name(F.regexp_replace("url", "^https?:/", "")).alias("topic"), text.stem(F.regexp_replace("url", "[?#].*$", "")).alias("stem"), clip.alias("clip"), text.channel_of(rest).alias("channel")
    )


@query("attr_lines", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, '- 2D box: part' || l_partkey || CASE WHEN l_discount > 0.05 THEN ' (' || l_returnflag || ', tax ' || printf('%.2f', l_tax) || ')' ELSE '' END AS line FROM lineitem""")
def attr_lines(spark, sf_dir):
    attributes = F.when(F.col("l_discount") > 0.05, F.array(F.col("l_returnflag"), F.format_string("tax %.2f", F.col("l_tax")))).otherwise(F.array().cast("array<string>"))
    line = text.box_line("2D box", F.concat(F.lit("part"), F.col("l_partkey").cast("string")), attributes)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", line.alias("line"))


@query("array_ops", """SELECT vec_id, len(list_filter(embedding, lambda x, i: (i - 1) % 4 = 0)) AS strided, round(CAST(list_max(embedding) AS DOUBLE), 6) AS largest, CASE WHEN label = 0 THEN 1.0 ELSE label END AS score,
 array_to_string(list_sort(list_distinct([label % 3, label % 2, 1])), ',') AS marks FROM embeddings""")
def array_ops(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.size(F.filter("embedding", lambda x, i: i % 4 == 0)).cast("long").alias("strided"),
        F.round(F.array_max("embedding").cast("double"), 6).alias("largest"),
        text.or_default(F.col("label").cast("double"), 1.0).alias("score"),
        F.array_join(F.array_sort(F.array_distinct(F.array(F.col("label") % 3, F.col("label") % 2, F.lit(1)))), ",").alias("marks"),
    )


@query("prompts", """SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'F' THEN 'Check closed orders.' END, 'Check all boxes.') || chr(10) || CASE WHEN o_orderpriority = '5-LOW' THEN '(no annotations)' ELSE '- 2D box: ' || o_orderpriority END AS prompt FROM orders""")
def prompts(spark, sf_dir):
    none = F.array().cast("array<string>")
    lines = F.when(F.col("o_orderpriority") == "5-LOW", none).otherwise(F.array(text.box_line("2D box", F.col("o_orderpriority"), none)))
    guidance = F.when(F.col("o_orderstatus") == "F", F.lit("Check closed orders."))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.prompt(lines, guidance, "Check all boxes.").alias("prompt"))
