"""Registry of named queries with the same question in SQL, and shared views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

#: The signal view of events in DuckDB; ``series`` is the user, ``sv`` the value with a sign, ``t`` microseconds.
SIG = """sig AS (SELECT event_id, user_id AS series, event_type, value, epoch_us(ts) AS t,
  CAST(json_extract(props, '$.k') AS INTEGER) AS k,
  CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) % 2 = 0 THEN value ELSE -value END AS sv FROM events)"""
EMB = """emb AS (SELECT vec_id, label AS scan, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y,
  CAST(embedding[3] AS DOUBLE) AS z, CAST(embedding[4] AS DOUBLE) AS intensity FROM embeddings)"""


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(ts: str):
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST({ts} AS TIMESTAMP_NTZ))")


def sig(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("series"), "event_type", "value", micros("ts").alias("t"), k.alias("k"), F.when(k % 2 == 0, F.col("value")).otherwise(-F.col("value")).alias("sv")
    )


def emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = lambda i: F.element_at("embedding", i).cast("double")
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("scan"), part(1).alias("x"), part(2).alias("y"), part(3).alias("z"), part(4).alias("intensity"))
