"""Views that bind the operators to the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalar import once, split_java
from tidemark.plans.ordering import dense_index, id_chunk
from tidemark.session import use_utc

PARTITIONS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as typed sensor records."""
    return table(spark, sf_dir, "events").selectExpr(
        "'o1' AS orgId", "event_type AS modelId",
        "concat('asset_', cast(user_id % 20 AS string)) AS assetId",
        "concat('user_', cast(user_id AS string)) AS pointId",
        "unix_millis(cast(ts AS timestamp)) AS time", "value", "cast(0 AS int) AS dq",
    )


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a log whose offset is the event id: ordered, with gaps."""
    return table(spark, sf_dir, "events").select(
        F.lit("events").alias("topic"),
        F.expr(f"cast(user_id % {PARTITIONS} AS int)").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("key"),
        F.col("value").alias("num"), "event_id", "user_id", "event_type", "props",
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a log with dense offsets from 0 in every partition."""
    return dense_index(raw_log(spark, sf_dir).drop("offset"), ["topic", "partition"], "event_id",
                       id_chunk("event_id"), "offset")


# Every kind of payload the parsers must cope with, chosen by the event id.
_PAYLOAD = """
    CASE event_id % 10
      WHEN 0 THEN concat('broken ', event_type)
      WHEN 1 THEN to_json(struct('o1' AS orgId, event_type AS modelId, concat('asset_', user_id % 20) AS assetId,
                                 concat('user_', user_id) AS pointId, t AS time, cast(value AS string) AS value, 0 AS dq))
      WHEN 2 THEN to_json(struct('o1' AS orgId, event_type AS modelId, concat('asset_', user_id % 20) AS assetId,
                                 concat('user_', user_id) AS pointId, t AS time, 0 AS dq))
      WHEN 3 THEN to_json(struct('o1' AS orgId, event_type AS modelId, concat('asset_', user_id % 20) AS assetId,
                                 concat('user_', user_id) AS pointId, t AS time, value > 50 AS value, 0 AS dq))
      WHEN 4 THEN to_json(struct('o1' AS orgId, event_type AS modelId, concat('asset_', user_id % 20) AS assetId,
                                 concat('user_', user_id) AS pointId, t AS time, cast(value AS bigint) AS value, 0 AS dq))
      WHEN 5 THEN to_json(struct('o1' AS orgId, event_type AS modelId,
                                 concat('user_', user_id) AS pointId, t AS time, value, 0 AS dq))
      WHEN 6 THEN to_json(struct('o1' AS orgId, event_type AS modelId, concat('asset_', user_id % 20) AS assetId,
                                 concat('user_', user_id) AS pointId, value, 0 AS dq))
      ELSE to_json(struct('o1' AS orgId, event_type AS modelId, concat('asset_', user_id % 20) AS assetId,
                          concat('user_', user_id) AS pointId, t AS time, value, 0 AS dq))
    END"""


def json_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows with binary JSON payloads, good and bad; offset is the event id."""
    return (
        once(raw_log(spark, sf_dir).withColumnRenamed("num", "value").withColumn("t", F.unix_millis("timestamp")),
             ["topic", "partition", "offset", "timestamp", "key", "event_id"], F.expr(_PAYLOAD), "payload")
        .select("topic", "partition", "offset", "timestamp", F.encode("key", "UTF-8").alias("key"),
                F.encode("payload", "UTF-8").alias("value"), "event_id")
    )


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per word of ``documents.text``."""
    texts = table(spark, sf_dir, "documents").select("text")
    return texts.select(F.explode(split_java(F.col("text"))).alias("word"))


def edges(spark: SparkSession, sf_dir: str, repeats: bool = True) -> DataFrame:
    """Parts and suppliers as nodes, one edge each way per line item (repeats stay, if not said otherwise).

    Repeats go while an edge is a pair of numbers, before it becomes two pairs of texts.
    """
    items = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    items = items if repeats else items.distinct()
    return items.select(
        F.explode(F.array(
            F.struct(F.concat(F.lit("p"), "l_partkey").alias("src"), F.concat(F.lit("s"), "l_suppkey").alias("dst")),
            F.struct(F.concat(F.lit("s"), "l_suppkey").alias("src"), F.concat(F.lit("p"), "l_partkey").alias("dst")),
        )).alias("e")
    ).select("e.src", "e.dst")


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch per series and hour of ``events``, with derived clock readings in ms."""
    hour = F.expr("unix_millis(cast(ts AS timestamp)) div 3600000")
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("series"), hour.alias("hour"))
        .agg(F.count(F.lit(1)).alias("num_records"), F.sum("user_id").alias("users"))
        .select(
            "series", F.col("hour").alias("batch_no"), (F.col("hour") * 3600000).alias("batch_time"),
            (F.col("hour") * 3600000 + 5).alias("submit_ms"),
            (F.col("hour") * 3600000 + 5 + F.col("users") % 40).alias("start_ms"),
            (F.col("hour") * 3600000 + 5 + F.col("users") % 40 + F.col("users") % 700).alias("end_ms"),
            "num_records",
        )
    )
