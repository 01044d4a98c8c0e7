"""Log positions as tables: bounds, resets, lag, commits, saved offsets, rate plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.ordering import CHUNK_ROWS, dense_index, id_chunk, next_non_null
from tidemark.sources.log import TP

# Control texts that end a transaction, version of the saved offset text.
COMMIT = "COMMIT"
ABORT = "ABORT"
STORE_VERSION = "1"


def begin_end_offsets(log: DataFrame) -> DataFrame:
    """First offset and end offset (last + 1) per partition."""
    return log.groupBy(*TP).agg(F.min("offset").alias("begin"), (F.max("offset") + 1).alias("end"))


def reset_positions(bounds: DataFrame, positions: DataFrame, policy: str) -> DataFrame:
    """Positions that are missing or out of range go to ``earliest`` or ``latest``; ``none`` raises."""
    held = positions.select(*TP, F.col("offset").alias("__held"))
    at = bounds.join(held, TP, "left")
    valid = F.col("__held").isNotNull() & F.col("__held").between(F.col("begin"), F.col("end"))
    if policy == "none":
        instead = F.raise_error(F.concat(F.lit("no valid position for partition "),
                                         F.col("partition").cast("string"))).cast("long")
    else:
        instead = F.col({"earliest": "begin", "latest": "end"}[policy])
    return at.select(*TP, F.when(valid, F.col("__held")).otherwise(instead).alias("offset"))


def reset_to_committed(bounds: DataFrame, committed: DataFrame) -> DataFrame:
    """The committed offset, else the beginning."""
    held = committed.select(*TP, F.col("offset").alias("__held"))
    return bounds.join(held, TP, "left").select(*TP, F.coalesce("__held", "begin").alias("offset"))


def consumer_lag(ends: DataFrame, positions: DataFrame, read_committed: bool = False) -> DataFrame:
    """End minus position per partition, with the greatest and mean lag of its topic.

    ``ends`` has ``high_watermark`` and, for read-committed, ``last_stable``; a null end gives a null lag.
    """
    end = F.col("last_stable" if read_committed else "high_watermark")
    lag = positions.select(*TP, F.col("offset").alias("position")).join(
        ends.select(*TP, end.alias("end")), TP, "left").withColumn("lag", F.col("end") - F.col("position"))
    topic = Window.partitionBy("topic")
    return lag.withColumns({"max_lag": F.max("lag").over(topic), "avg_lag": F.avg("lag").over(topic)})


def merge_commits(ranges: DataFrame) -> DataFrame:
    """Queued ranges collapse to the greatest ``until`` of each partition."""
    return ranges.groupBy(*TP).agg(F.max("until").alias("offset"))


def save_offsets(positions: DataFrame) -> DataFrame:
    """One saved text per topic: ``{"offset": "{\\"0\\":5}", "version": "1"}`` (one entry per partition)."""
    entries = F.map_from_entries(F.sort_array(F.collect_list(
        F.struct(F.col("partition").alias("key"), F.col("offset").alias("value")))))
    saved = positions.groupBy("topic").agg(F.to_json(F.transform_keys(entries, lambda k, _: k.cast("string"))).alias("offset"))
    return saved.select("topic", F.to_json(F.struct("offset", F.lit(STORE_VERSION).alias("version"))).alias("value"))


def load_offsets(saved: DataFrame, partitions: int) -> DataFrame:
    """Positions of a saved text; partitions above the greatest saved one start at 0, an empty text raises."""
    outer = F.from_json("value", "offset string, version string")
    inner = F.from_json(outer["offset"], "map<string,bigint>")
    checked = saved.select("topic", F.when(F.coalesce(F.size(inner), F.lit(0)) > 0, inner).otherwise(
        F.raise_error(F.lit("saved offsets are empty")).cast("map<string,bigint>")).alias("m"))
    greatest = F.array_max(F.transform(F.map_keys("m"), lambda k: k.cast("int")))
    added = F.when(greatest + 1 < partitions, F.sequence(greatest + 1, F.lit(partitions - 1))).otherwise(
        F.array().cast("array<int>"))
    entries = F.concat(
        F.transform(F.map_entries("m"),
                    lambda e: F.struct(e["key"].cast("int").alias("partition"), e["value"].alias("offset"))),
        F.transform(added, lambda p: F.struct(p.alias("partition"), F.lit(0).cast("long").alias("offset"))))
    return checked.select("topic", F.explode(entries).alias("e")).select("topic", "e.partition", "e.offset")


def replay_when_past(ranges: DataFrame, begins: DataFrame, limit: int, restart: int | None = None) -> DataFrame:
    """Next positions: ``until``, or all back to the beginning once any ``until`` is above ``limit``.

    ``restart`` is an explicit offset to go back to instead. The whole subscription goes back together, all topics;
    the plan has one row per partition, so its window stays small.
    """
    past = F.max(F.col("until") > limit).over(Window.partitionBy(F.lit(0)))
    back = F.col("begin") if restart is None else F.lit(restart).cast("long")
    return (
        ranges.select(*TP, "until").join(begins.select(*TP, "begin"), TP)
        .select(*TP, F.when(past, back).otherwise(F.col("until")).alias("offset"))
    )


def range_count(ranges: DataFrame) -> DataFrame:
    """Rows the ranges of each topic hold, without a scan (right for logs without gaps), and whether there are none."""
    return ranges.groupBy("topic").agg(F.sum(F.col("until") - F.col("from")).alias("count")).withColumn(
        "empty", F.col("count") == 0)


def _with_marker(log: DataFrame, chunk_rows: int) -> DataFrame:
    """Transactional rows with the next marker of their producer, as ``2 * offset + (1 if it commits)``.

    Rows look for it offset chunk by offset chunk; as one number it fits a hash aggregate.
    """
    code = F.when(F.col("control").isNotNull(), F.col("offset") * 2 + F.when(F.col("control") == COMMIT, 1).otherwise(0))
    return next_non_null(log.where("is_transactional").withColumn("__code", code), [*TP, "producer_id"], "offset",
                         "__code", id_chunk("offset", chunk_rows), "__marker").drop("__code")


def read_committed(log: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Data rows outside aborted or open transactions.

    Columns ``producer_id``, ``is_transactional`` and ``control`` (COMMIT, ABORT or null).
    """
    plain = log.where(~F.col("is_transactional") & F.col("control").isNull())
    inside = _with_marker(log, chunk_rows)
    committed = inside.where(F.col("control").isNull() & (F.col("__marker") % 2 == 1)).drop("__marker")
    return plain.unionByName(committed)


def aborted_spans(log: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Aborted transactions as (partition, producer, first offset, marker offset)."""
    inside = _with_marker(log, chunk_rows).where(F.col("control").isNull() & (F.col("__marker") % 2 == 0))
    return inside.groupBy(*TP, "producer_id", F.expr("__marker div 2").alias("last_offset")).agg(
        F.min("offset").alias("first_offset"))


def commit_groups(log: DataFrame, poll_rows: int, commit_rows: int, order: str | None = None,
                  chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Commit each row belongs to when polls of ``poll_rows`` rows fill a buffer of at least ``commit_rows``.

    Rows count, not offsets, so gaps in a log do no harm. Each partition has its own buffer; with ``order`` (a unique,
    non-negative integer in the order of consumption) one buffer serves the whole consumer. Result: per partition
    and commit its rows, next offset and whether it was made; a short tail stays uncommitted.
    """
    step = poll_rows * -(-commit_rows // poll_rows)
    keys = TP if order is None else ["__all"]
    rows = log.select(*TP, "offset", *([order] if order and order != "offset" else []), F.lit(0).alias("__all"))
    placed = dense_index(rows, keys, order or "offset", id_chunk(order or "offset", chunk_rows), "__row")
    groups = (placed.groupBy(*TP, F.expr(f"__row div {step}").alias("commit_no"))
              .agg(F.count(F.lit(1)).alias("rows"), (F.max("offset") + 1).alias("next_offset")))
    if order is None:
        return groups.withColumn("committed", F.col("rows") >= commit_rows)
    whole = groups.groupBy("commit_no").agg((F.sum("rows") >= commit_rows).alias("committed"))
    return groups.join(whole, "commit_no").select(*TP, "commit_no", "rows", "next_offset", "committed")


def rate_plan(positions: DataFrame, latest: DataFrame, batch_ms: int, rate: float = 0, max_rate: int = 0) -> DataFrame:
    """Next range of each partition under a total rate and a cap per partition (records/s).

    The rate is shared by lag; without one the cap counts; when the limits sum to 0 there is none.
    """
    at = positions.select(*TP, F.col("offset").alias("from")).join(
        latest.select(*TP, F.col("end").alias("latest")), TP)
    every = Window.partitionBy(F.lit(0))  # one row per partition of the subscription
    lag = F.greatest(F.col("latest") - F.col("from"), F.lit(0))
    if rate > 0:
        # A share is computed on floats and rounded half up; no lag at all gives 0.
        share = F.col("__lag").cast("float") / F.nullif(F.col("__total").cast("float"), F.lit(0).cast("float"))
        limit: Column = F.coalesce(F.floor((share * F.lit(int(rate)).cast("float")).cast("double") + F.lit(0.5)), F.lit(0)).cast("long")
        if max_rate > 0:
            limit = F.least(limit, F.lit(max_rate))
    else:
        limit = F.lit(max_rate).cast("long")
    planned = (
        at.withColumn("__lag", lag).withColumn("__total", F.sum("__lag").over(every))
        .withColumn("__limit", limit).withColumn("__any", F.sum("__limit").over(every) > 0)
    )
    step = F.floor(F.lit(batch_ms / 1000.0) * F.col("__limit")).cast("long")
    until = F.when(F.col("__any"), F.least(F.col("from") + step, F.col("latest"))).otherwise(F.col("latest"))
    return planned.select(*TP, "from", until.alias("until"))
