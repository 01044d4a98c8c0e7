"""Sources and sinks for a partitioned log, and start positions."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import LOG

TP = ["topic", "partition"]


def kafka_options(servers: str, topics: list[str] | None = None, pattern: str | None = None,
                  assign: dict[str, list[int]] | None = None,
                  starting: dict[str, dict[int, int]] | str | None = None,
                  ending: dict[str, dict[int, int]] | str | None = None,
                  max_offsets_per_trigger: int | None = None, headers: bool = False) -> dict[str, str]:
    """Options of Spark's ``kafka`` format for one of subscribe, pattern or assign."""
    chosen = [x for x in (topics, pattern, assign) if x]
    if len(chosen) != 1:
        raise ValueError("give exactly one of topics, pattern, assign")
    options = {"kafka.bootstrap.servers": servers, "includeHeaders": str(headers).lower()}
    if topics:
        options["subscribe"] = ",".join(topics)
    elif pattern:
        options["subscribePattern"] = pattern
    else:
        options["assign"] = json.dumps(assign)
    for name, value in (("startingOffsets", starting), ("endingOffsets", ending)):
        if value is not None:
            options[name] = value if isinstance(value, str) else json.dumps(
                {t: {str(p): o for p, o in ps.items()} for t, ps in value.items()})
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_stream(spark: SparkSession, **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(**options)).load()


def kafka_batch(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("kafka").options(**kafka_options(**options)).load()


def file_log_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The log envelope from parquet files that keep arriving in a folder."""
    reader = spark.readStream.schema(LOG)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def to_log_rows(df: DataFrame, key: Column, value: Column) -> DataFrame:
    """The two text columns a log sink takes."""
    return df.select(key.cast("string").alias("key"), value.cast("string").alias("value"))


def read_ranges(log: DataFrame, ranges: DataFrame) -> DataFrame:
    """Rows of the half-open ranges ``[from, until)``; ``from > until`` raises, equal ends give nothing.

    The range table has one row per partition, far fewer than the log; its size
    decides the join, and an explicit hint is not needed.
    """
    checked = ranges.select(
        *TP, F.col("from").alias("__from"),
        F.when(F.col("from") > F.col("until"), F.raise_error(F.concat(
            F.lit("bad range for partition "), F.col("partition").cast("string"))).cast("long"))
        .otherwise(F.col("until")).alias("__until"))
    return (
        log.join(checked, TP)
        .where((F.col("offset") >= F.col("__from")) & (F.col("offset") < F.col("__until")))
        .drop("__from", "__until")
    )


def topic_matches(topic: Column, pattern: str) -> Column:
    """True when the whole topic name matches."""
    return topic.rlike(f"^(?:{pattern})$")


def start_positions(partitions: DataFrame, reset: str, topics: list[str] | None = None, pattern: str | None = None,
                    assign: DataFrame | None = None, given: DataFrame | None = None,
                    checkpoint: DataFrame | None = None) -> DataFrame:
    """Where reading starts in each chosen partition.

    ``partitions`` has (topic, partition, begin, end). A checkpointed offset wins over a
    given one, and that over the reset point (earliest or latest).
    """
    chosen = partitions
    if topics:
        chosen = chosen.where(F.col("topic").isin(topics))
    if pattern:
        chosen = chosen.where(topic_matches(F.col("topic"), pattern))
    if assign is not None:
        chosen = chosen.join(assign.select(*TP).distinct(), TP, "left_semi")
    fallback = F.col({"earliest": "begin", "latest": "end"}[reset])
    offsets = []
    for name, positions in (("__checkpoint", checkpoint), ("__given", given)):
        if positions is not None:
            chosen = chosen.join(positions.select(*TP, F.col("offset").alias(name)), TP, "left")
            offsets.append(F.col(name))
    return chosen.select(*TP, F.coalesce(*offsets, fallback).alias("offset"))
