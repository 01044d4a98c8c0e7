"""Ordered work that stays parallel inside one hot key.

A plain ``Window.partitionBy(key)`` puts a whole key into one task. The helpers
here cut every key into *chunks* that follow the order, do the window inside the
chunk, and carry what a chunk needs from its neighbours through a table with one
row per chunk. A chunk column must not decrease along the order. For dense ids
``id_chunk`` bounds each chunk by construction; ``range_chunks`` cuts any other
order evenly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import shared_dir

CHUNK_ROWS = 1 << 18

_CHUNK = "__chunk"


def id_chunk(column: str, rows: int = CHUNK_ROWS) -> Column:
    """Chunk number from a non-negative integer that is unique inside its key."""
    return F.expr(f"`{column}` div {int(rows)}")


def range_chunks(df: DataFrame, order: Sequence[str], out: str = _CHUNK, partitions: int | None = None) -> DataFrame:
    """Number the range partitions of ``order`` and keep the number as data.

    ``order`` must be unique over the rows (aggregate equal rows first), so no
    value can be too hot to split. The checkpoint fixes the sampled bounds: a
    recomputed task could otherwise see other ones.
    """
    shared_dir(df.sparkSession)
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return ranged.withColumn(out, F.spark_partition_id().cast("long")).checkpoint()


def _prefix(totals: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    before = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *keys, _CHUNK,
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"__before_{c}") for c in columns],
    )


def dense_index(df: DataFrame, keys: Sequence[str], order: str, chunk: Column | str, out: str = "idx") -> DataFrame:
    """0-based position of every row in its key; ``order`` is unique inside a key, keys are not null."""
    keys = list(keys)
    tagged = df.withColumn(_CHUNK, chunk if isinstance(chunk, Column) else F.col(chunk))
    totals = tagged.groupBy(*keys, _CHUNK).agg(F.count(F.lit(1)).alias("n"))
    local = Window.partitionBy(*keys, _CHUNK).orderBy(order)
    return (
        tagged.join(_prefix(totals, keys, ["n"]), [*keys, _CHUNK])
        .withColumn(out, F.row_number().over(local) - 1 + F.col("__before_n"))
        .drop(_CHUNK, "__before_n")
    )


def running_sum(df: DataFrame, keys: Sequence[str], order: str, value: str, chunk: Column | str,
                out: str = "running") -> DataFrame:
    """Sum of ``value`` over the rows of the key up to and with the current one."""
    keys = list(keys)
    tagged = df.withColumn(_CHUNK, chunk if isinstance(chunk, Column) else F.col(chunk))
    totals = tagged.groupBy(*keys, _CHUNK).agg(F.sum(value).alias("v"))
    local = (Window.partitionBy(*keys, _CHUNK).orderBy(order)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        tagged.join(_prefix(totals, keys, ["v"]), [*keys, _CHUNK])
        .withColumn(out, F.sum(value).over(local) + F.col("__before_v"))
        .drop(_CHUNK, "__before_v")
    )


def with_previous(df: DataFrame, keys: Sequence[str], order: str, value: str, chunk: Column | str,
                  out: str = "previous") -> DataFrame:
    """Value of the row before, also across a chunk border."""
    keys = list(keys)
    tagged = df.withColumn(_CHUNK, chunk if isinstance(chunk, Column) else F.col(chunk))
    last = (
        tagged.groupBy(*keys, _CHUNK).agg(F.max_by(value, order).alias("last"))
        .select(*keys, _CHUNK, F.lag("last").over(Window.partitionBy(*keys).orderBy(_CHUNK)).alias("__carry"))
    )
    local = Window.partitionBy(*keys, _CHUNK).orderBy(order)
    return (
        tagged.join(last, [*keys, _CHUNK])
        .withColumn(out, F.when(F.row_number().over(local) == 1, F.col("__carry"))
                    .otherwise(F.lag(value).over(local)))
        .drop(_CHUNK, "__carry")
    )


def next_non_null(df: DataFrame, keys: Sequence[str], order: str, value: str, chunk: Column | str,
                  out: str = "next") -> DataFrame:
    """First non-null ``value`` at or after the current row."""
    keys = list(keys)
    tagged = df.withColumn(_CHUNK, chunk if isinstance(chunk, Column) else F.col(chunk))
    # Backwards with a growing frame: a frame that shrinks from the far end costs a pass per row.
    later = Window.partitionBy(*keys).orderBy(F.desc(_CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        tagged.groupBy(*keys, _CHUNK)
        .agg(F.min_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("first"))
        .select(*keys, _CHUNK, F.last("first", ignorenulls=True).over(later).alias("__carry"))
    )
    local = (Window.partitionBy(*keys, _CHUNK).orderBy(F.desc(order))
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        tagged.join(carry, [*keys, _CHUNK])
        .withColumn(out, F.coalesce(F.last(value, ignorenulls=True).over(local), F.col("__carry")))
        .drop(_CHUNK, "__carry")
    )


def trailing_mean(df: DataFrame, keys: Sequence[str], index: str, value: str, n_back: int,
                  out: str = "mean", chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Mean over the current row and the ``n_back`` rows before it.

    ``index`` is a dense position. The last ``n_back`` rows of a chunk are also
    sent to the next chunk, where they only serve as history.
    """
    if not 0 <= n_back < chunk_rows:
        raise ValueError("n_back must be at least 0 and below chunk_rows")
    keys = list(keys)
    own = F.expr(f"`{index}` div {chunk_rows}")
    near_end = F.expr(f"`{index}` % {chunk_rows}") >= chunk_rows - n_back
    copies = df.withColumn(_CHUNK, F.explode(F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))))
    frame = Window.partitionBy(*keys, _CHUNK).orderBy(index).rowsBetween(-n_back, Window.currentRow)
    return (
        copies.withColumn(out, F.avg(value).over(frame))
        .where(F.col(_CHUNK) == own)
        .drop(_CHUNK)
    )


def list_parts(df: DataFrame, keys: Sequence[str], item: str, limit: int, out: str = "part") -> DataFrame:
    """Part number of each ``item`` in its key's order: the first ``limit`` items are part 0, the next ones part 1.

    ``item`` is unique inside a key; keys may be null. Rows are cut by ranges of key and item, so a key of any size
    is numbered by many tasks.
    """
    keys = list(keys)
    ranged = range_chunks(df, [*keys, item])
    totals = ranged.groupBy(*keys, _CHUNK).agg(F.count(F.lit(1)).alias("n"))
    before = _prefix(totals, keys, ["n"]).select(
        *[F.col(k).alias(f"__{k}") for k in keys], F.col(_CHUNK).alias("__at"), "__before_n")
    same = F.col(_CHUNK) == F.col("__at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    local = Window.partitionBy(*keys, _CHUNK).orderBy(item)
    place = F.row_number().over(local) - 1 + F.col("__before_n")
    return (ranged.join(before, same).withColumn(out, F.floor(place / F.lit(limit)).cast("int"))
            .drop(_CHUNK, "__at", "__before_n", *[f"__{k}" for k in keys]))
