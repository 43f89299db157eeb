"""Nested configuration documents as rows: read, flattened, overlaid and looked up.

A document is a row (document, rank, body), the body a VARIANT. ``leaves`` takes
it apart into (document, rank, path, value), one row for each value that is no
object; a path is an array of names, so names may hold any character. Overlaying
documents is then an aggregate: of each path the value of the highest rank wins,
and whole objects give way to a value in their place and the other way round. So
thousands of documents, of one vehicle each for instance, are overlaid at once,
by a key, without a driver loop over files.

Results by case: what is no JSON object has no leaves; empty objects have none,
empty arrays and nulls are values; of equal ranks the document that comes last by
name wins; a missing path gives the default; values of another kind than asked
for give null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Objects nest no deeper than that; deeper ones stay values.
DEPTH = 8


def read(spark: SparkSession, paths: str | Sequence[str], rank: int = 0) -> DataFrame:
    """(document, rank, body) of JSON documents, and of YAML ones where the yaml package is there."""
    files = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths)).select(F.col("path").alias("document"), "content")

    def texts(batches):
        import json

        for pdf in batches:
            out = []
            for name, raw in zip(pdf["document"], pdf["content"]):
                if name.endswith((".yaml", ".yml")):
                    import yaml

                    raw = json.dumps(yaml.safe_load(raw), default=str).encode()
                out.append(raw.decode("utf-8", "replace"))
            yield pdf[["document"]].assign(text=out)

    found = files.mapInPandas(texts, "document string, text string")
    return found.select("document", F.lit(rank).alias("rank"), F.try_parse_json("text").alias("body"))


def leaves(docs: DataFrame, by: Sequence[str] = (), depth: int = DEPTH) -> DataFrame:
    """(by, document, rank, path, value) of all values of documents; below ``depth`` names objects are values."""
    keep = [*by, "document", "rank"]
    names = "array<string>"

    def opened(rows: DataFrame) -> DataFrame:
        # as a map of variants an object opens by one level, in Spark's own functions
        pairs = F.explode(F.map_entries(F.try_variant_get("value", "$", "map<string,variant>"))).alias("_e")
        return rows.select(*keep, "path", pairs).select(*keep, F.concat("path", F.array("_e.key")).alias("path"), F.col("_e.value").alias("value"))

    is_object = F.schema_of_variant("value").startswith("OBJECT")
    level = docs.select(*keep, F.array().cast(names).alias("path"), F.col("body").alias("value")).where(F.col("value").isNotNull() & is_object)
    out = None
    for k in range(depth):
        level = opened(level)
        inner = F.coalesce(is_object, F.lit(False))
        done = level if k == depth - 1 else level.where(~inner)
        out = done if out is None else out.unionByName(done)
        if k < depth - 1:
            level = level.where(inner)
    return out


def overlaid(values: DataFrame, by: Sequence[str] = (), whole: int | None = None) -> DataFrame:
    """(by, path, value, document) of all documents of a key laid over each other.

    ``whole`` 1 replaces what a later document names at the top as a whole, as when
    one table of settings updates another; 2 goes a level deeper, and None lays
    values over values, however deep.
    """
    order = F.struct("rank", "document")
    rows = values.withColumn("_at", order)
    if whole is not None:
        head = F.slice("path", 1, whole)
        last = rows.groupBy(*by, head.alias("_head")).agg(F.max("_at").alias("_last"))
        same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)]
        last = last.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], F.col("_head").alias("_h"), "_last")
        on = head == F.col("_h")
        for c in same:
            on &= c
        rows = rows.join(last, on).where(F.col("_at") == F.col("_last"))
    best = rows.groupBy(*by, "path").agg(F.max_by(F.struct("value", "document", "_at"), "_at").alias("_b")).select(*by, "path", "_b.*")
    # a value that a later document puts in place of an object, or an object in place of a value, ends what was there
    above = best.select(*by, F.explode(F.transform(F.sequence(F.lit(1), F.size("path")), lambda n: F.slice("path", F.lit(1), n))).alias("_p"), (F.size("path")).alias("_n"), "_at")
    place = above.groupBy(*by, "_p").agg(F.max("_at").alias("_new"), F.max(F.when(F.size("_p") == F.col("_n"), F.col("_at"))).alias("_own"), F.max(F.when(F.size("_p") < F.col("_n"), F.col("_at"))).alias("_below"))
    mixed = place.where("_own IS NOT NULL AND _below IS NOT NULL").select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], "_p", "_own", "_below")
    # each path meets the mixed places among its own beginnings, by an equi-join
    starts = best.withColumn("_start", F.explode(F.transform(F.sequence(F.lit(1), F.size("path")), lambda n: F.slice("path", F.lit(1), n))))
    hit = F.col("_start") == F.col("_p")
    for i, c in enumerate(by):
        hit &= F.col(c).eqNullSafe(F.col(f"_k{i}"))
    own = F.size("path") == F.size("_p")
    lost = F.when(own, F.col("_own") < F.col("_below")).otherwise(F.col("_at") < F.col("_own"))
    gone = starts.join(mixed, hit).where(lost).select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], F.col("path").alias("_gone")).distinct()
    away = F.col("path") == F.col("_gone")
    for i, c in enumerate(by):
        away &= F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return best.join(gone, away, "left_anti").select(*by, "path", "value", "document")


def looked_up(keys: DataFrame, values: DataFrame, by: Sequence[str], wanted: dict[str, tuple[Sequence[str], str, object]]) -> DataFrame:
    """The keys with a column for each wanted name: (path, type, default), from values by key; one aggregate for all names."""
    paths = [F.array(*[F.lit(p) for p in path]) for path, _, _ in wanted.values()]
    found = values.where(F.col("path").isin(paths) if paths else F.lit(False))
    picked = found.groupBy(*by).agg(*[F.max_by(F.try_variant_get("value", "$", kind), F.when(F.col("path") == p, F.lit(1))).alias(name) for p, (name, (_, kind, _)) in zip(paths, wanted.items())])
    out = keys.join(picked, list(by), "left")
    return out.select(*keys.columns, *[(F.coalesce(F.col(name), F.lit(default).cast(kind)) if default is not None else F.col(name)).alias(name) for name, (_, kind, default) in wanted.items()])


def children(values: DataFrame, by: Sequence[str] = (), fields: Sequence[str] = ("x", "y", "z", "roll", "pitch", "yaw")) -> DataFrame:
    """(by, parent, child, fields): transforms of trees parent, child, field; of a child with several parents the last one by rank and name wins, missing fields are 0."""
    rows = values.where(F.size("path") == 3).withColumns({"parent": F.get("path", F.lit(0)), "child": F.get("path", F.lit(1)), "field": F.get("path", F.lit(2))})
    number = F.try_variant_get("value", "$", "double")
    each = rows.groupBy(*by, "document", "rank", "parent", "child").agg(*[F.coalesce(F.max(F.when(F.col("field") == f, number)), F.lit(0.0)).alias(f) for f in fields])
    best = each.groupBy(*by, "child").agg(F.max_by(F.struct("parent", *fields), F.struct("rank", "document", "parent")).alias("_b"))
    return best.select(*by, "_b.parent", "child", *[F.col(f"_b.{f}").alias(f) for f in fields])
