"""Sorts and limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.ordering import CHUNK_ROWS, id_chunk, running_sum
from tidemark.sources.log import TP


def sort_by_window(df: DataFrame, window: str = "window") -> DataFrame:
    """Global order by window; in a stream only Complete mode may sort."""
    return df.orderBy(window)


def metrics_by_name(metrics: DataFrame, order: str, value: str = "value") -> DataFrame:
    """``group:name:tags`` and value in alphabetical order; of equal labels the last one stays."""
    label = F.concat_ws(":", "group", "name", "tags")
    return metrics.groupBy(label.alias("label")).agg(F.max_by(value, order).alias("value")).orderBy("label")


def take_by_partition(log: DataFrame, ranges: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows, filling from non-empty ranges in partition order.

    Quotas come from the range ends (one row per partition); the log is read once with them as a filter.
    """
    before = Window.orderBy(*TP).rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranges.where(F.col("until") > F.col("from")).withColumn("__size", F.col("until") - F.col("from"))
    quotas = (
        sizes.withColumn("__left", F.lit(max(n, 0)) - F.coalesce(F.sum("__size").over(before), F.lit(0)))
        .where(F.col("__left") > 0)
        .select(*TP, F.col("from").alias("__from"),
                (F.col("from") + F.least("__left", "__size")).alias("__stop"))
    )
    return (
        log.join(quotas, TP).where((F.col("offset") >= F.col("__from")) & (F.col("offset") < F.col("__stop")))
        .drop("__from", "__stop")
    )


def until_count(df: DataFrame, batch: Column, n: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Whole batches in order until at least ``n`` rows are in; the last batch is not cut.

    ``batch`` is a non-negative number. Only batch sizes are summed in order; each batch
    holds a row, so the chosen ones number at most ``n``.
    """
    numbered = df.withColumn("batch", batch)
    sizes = numbered.groupBy("batch").agg(F.count(F.lit(1)).alias("__n")).withColumn("__all", F.lit(0))
    upto = running_sum(sizes, ["__all"], "batch", "__n", id_chunk("batch", chunk_rows), "__upto")
    chosen = upto.where(F.col("__upto") - F.col("__n") < n).select("batch")
    return numbered.join(chosen, "batch", "left_semi")
