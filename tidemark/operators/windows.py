"""Figures along an ordered series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.ordering import CHUNK_ROWS, dense_index, id_chunk, trailing_mean, with_previous


def moving_average(df: DataFrame, series: list[str], order: str, value: str, n: int, out: str = "mean",
                   warmup: int = 0, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Mean of the last ``n + 1`` values, HALF_UP to 3 decimals.

    ``order`` is a non-negative integer, unique in its series. The first ``warmup`` rows
    show 0.0 and never enter a mean.
    """
    indexed = dense_index(df, series, order, id_chunk(order, chunk_rows), "__i")
    late = F.col("__i") >= warmup
    # Decimal sums: the mean of few-digit figures may lie exactly between two roundings.
    # Warm-up rows are null to the mean, so a frame that reaches back into them leaves them out.
    valued = indexed.withColumn("__v", F.when(late, F.col(value).cast("decimal(28,12)")))
    meaned = trailing_mean(valued, series, "__i", "__v", n, out, chunk_rows)
    return meaned.withColumn(out, F.when(late, F.round(out, 3).cast("double")).otherwise(F.lit(0.0))).drop("__i", "__v")


def dense_mean(df: DataFrame, series: list[str], index: str, value: str, n: int, out: str = "mean",
               chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The moving average along an index that is dense already, as ``dense_index`` gives it: one window, no counts."""
    valued = df.withColumn("__v", F.col(value).cast("decimal(28,12)"))
    meaned = trailing_mean(valued, series, index, "__v", n, out, chunk_rows)
    return meaned.withColumn(out, F.round(out, 3).cast("double")).drop("__v")


def warmup_skip(df: DataFrame, series: list[str], order: str, value: str, n: int, k: int, out: str = "mean",
                chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The moving average once more than ``k`` batches are done; 0.0 before."""
    return moving_average(df, series, order, value, n, out, k + 1, chunk_rows)


def position_delta(polls: DataFrame, keys: list[str], poll: str, position: str,
                   chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Move of a position since the poll before; the first poll and moves of zero are left out."""
    moved = with_previous(polls, keys, poll, position, id_chunk(poll, chunk_rows), "previous")
    return (
        moved.where(F.col("previous").isNotNull() & (F.col(position) != F.col("previous")))
        .withColumn("delta", F.col(position) - F.col("previous"))
    )


def fetch_share(df: DataFrame, keys: list[str], fetch_ms: Column, total_ms: Column) -> DataFrame:
    """Per batch: part of the time spent in fetches, in percent with 2 decimals HALF_UP; none without time."""
    sums = df.groupBy(*keys).agg(F.sum(fetch_ms).alias("fetch_ms"), F.sum(total_ms).alias("total_ms"))
    share = F.try_divide(F.col("fetch_ms").cast("decimal(20,0)") * 100, F.col("total_ms").cast("decimal(20,0)"))
    return sums.where(F.col("total_ms") > 0).withColumn("share", F.round(share, 2).cast("double"))
