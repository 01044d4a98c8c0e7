"""Joins and lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.draws import draw
from tidemark.plans.ordering import CHUNK_ROWS, dense_index, id_chunk
from tidemark.sources.log import TP

# Stand-ins when a template names no organisation or asset.
DEFAULT_ORG = "myOrgId"
DEFAULT_ASSETS = ["testAsset_01", "testAsset_02", "testAsset_03"]

TEMPLATE = T.StructType([
    T.StructField("orgId", T.StringType()),
    T.StructField("assets", T.ArrayType(T.StringType())),
    T.StructField("modelAndPoints", T.ArrayType(T.StructType([T.StructField("inputPoint", T.StringType())]))),
])


def inner_equi(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """Inner join on equal columns; sizes seen at run time pick broadcast or sort-merge and split hot keys."""
    return left.join(right, on, "inner")


def template_records(templates: DataFrame, keys: list[str], payload: str = "value") -> DataFrame:
    """One record template per asset, model and point named in each JSON template, keyed by the asset.

    Both lists sit in the template's own row, so they are exploded there; no tables are crossed.
    """
    parsed = templates.select(*keys, F.from_json(payload, TEMPLATE).alias("t"))
    named = F.filter(F.coalesce("t.assets", F.array().cast("array<string>")), lambda a: F.coalesce(a, F.lit("")) != "")
    pairs = F.filter(
        F.transform("t.modelAndPoints", lambda m: F.split(F.regexp_replace(m["inputPoint"], "(::)+$", ""), "::")),
        lambda p: (F.size(p) == 2) & (p[1] != ""))
    return (
        parsed.select(
            *keys,
            F.coalesce(F.nullif(F.col("t.orgId"), F.lit("")), F.lit(DEFAULT_ORG)).alias("orgId"),
            F.when(F.size(named) > 0, named).otherwise(F.array(*map(F.lit, DEFAULT_ASSETS))).alias("assets"),
            F.explode(pairs).alias("pair"))
        .select(*keys, "orgId", F.explode("assets").alias("assetId"),
                F.col("pair")[0].alias("modelId"), F.col("pair")[1].alias("pointId"))
        .withColumn("key", F.col("assetId"))
    )


def sample_payloads(rows: DataFrame, number: str, sample: DataFrame, sample_order: str, seed: int) -> DataFrame:
    """Give every row one row of the sample, drawn by a seeded mix of ``number``.

    The count of the sample bounds the draw; sizes seen at run time choose the join.
    """
    size = sample.count()
    if size == 0:
        raise ValueError("the sample is empty")
    numbered = dense_index(sample.withColumn("__all", F.lit(0)), ["__all"], sample_order,
                           id_chunk(sample_order), "sample_index").drop("__all")
    drawn = rows.withColumn("sample_index", draw(F.col(number), seed, size).cast("long"))
    return drawn.join(numbered, "sample_index")


def first_at_or_after(log: DataFrame, targets: DataFrame, chunk_ms: int = CHUNK_ROWS) -> DataFrame:
    """Per target (topic, partition, target_ms): smallest offset whose time is not before it, else null.

    Log rows shrink to one per partition and millisecond. Time is cut into chunks of
    ``chunk_ms``, which bounds the rows of a chunk; later chunks count by their minimum.
    """
    points = (
        log.groupBy(*TP, F.unix_millis("timestamp").alias("at")).agg(F.min("offset").alias("offset"))
        .select(*TP, "at", F.struct("offset", F.col("at").alias("time_ms")).alias("hit"), F.lit(False).alias("wanted"))
    )
    wanted = targets.select(*TP, F.col("target_ms").alias("at")).distinct()
    both = points.unionByName(
        wanted.select(*TP, "at", F.lit(None).cast("struct<offset:bigint,time_ms:bigint>").alias("hit"),
                      F.lit(True).alias("wanted"))
    ).withColumn("chunk", F.floor(F.col("at") / F.lit(chunk_ms)))
    later = Window.partitionBy(*TP).orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        both.groupBy(*TP, "chunk").agg(F.min("hit").alias("m"))
        .select(*TP, "chunk", F.min("m").over(later).alias("carry"))
    )
    # Backwards, so that the frame only grows; by range, so that a log row of the target's own millisecond counts.
    local = (Window.partitionBy(*TP, "chunk").orderBy(F.desc("at"))
             .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        both.join(carry, [*TP, "chunk"])
        .withColumn("best", F.least(F.min("hit").over(local), F.col("carry")))
        .where("wanted")
        .select(*TP, F.col("at").alias("target_ms"), F.col("best.offset").alias("offset"),
                F.col("best.time_ms").alias("time_ms"))
    )


def new_partitions(seen: DataFrame, positions: DataFrame) -> DataFrame:
    """Partitions seen now that have no position yet."""
    return seen.select(*TP).distinct().join(positions.select(*TP), TP, "left_anti")


def merge_positions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new positions; the new one wins where both exist."""
    return (
        old.select(*TP, F.col("offset").alias("__old"))
        .join(new.select(*TP, F.col("offset").alias("__new")), TP, "full")
        .select(*TP, F.coalesce("__new", "__old").alias("offset"))
    )

