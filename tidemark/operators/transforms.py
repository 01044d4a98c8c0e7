"""User functions on tables, transform chains, placement and caching."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Transform = Callable[[DataFrame], DataFrame]

# Bytes of the values whose lists a worker holds at once, and bytes that a value counts at least.
SLICE_BYTES = 1 << 20
VALUE_BYTES = 1 << 10

# The storage levels in use.
LEVELS = {
    "MEMORY_ONLY": StorageLevel.MEMORY_ONLY,
    "DISK_ONLY": StorageLevel.DISK_ONLY,
    "DISK_ONLY_2": StorageLevel.DISK_ONLY_2,
    "MEMORY_AND_DISK": StorageLevel.MEMORY_AND_DISK,
}


def map_rows(df: DataFrame, **columns: Column) -> DataFrame:
    """One row out per row in."""
    return df.select(*[c.alias(n) for n, c in columns.items()])


def map_values(df: DataFrame, fn: Callable[[pd.Series], pd.Series], column: str, name: str, kind: str,
               keep: Sequence[str] = ()) -> DataFrame:
    """A user function on the values of a column, a batch at a time."""
    return df.select(*keep, F.pandas_udf(fn, kind)(column).alias(name))


def filter_rows(df: DataFrame, fn: Callable[[pd.Series], pd.Series], column: str) -> DataFrame:
    """Rows for whose value a user function says true."""
    return df.where(F.pandas_udf(fn, "boolean")(column))


def flat_map_values(df: DataFrame, fn: Callable[[pd.Series], pd.Series], column: str, name: str, kind: str,
                    keep: Sequence[str] = ()) -> DataFrame:
    """One row per item of the list that a user function gives for each value; ``kind`` is the item's type.

    Lists of Python objects take many times the bytes of a value, so the function gets a batch in slices of about
    ``SLICE_BYTES``.
    """
    def lists(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            taken = np.cumsum([max(sys.getsizeof(v), VALUE_BYTES) for v in values]) // SLICE_BYTES
            for _, part in values.groupby(taken, sort=False):
                yield fn(part.reset_index(drop=True))

    return df.select(*keep, F.explode(F.pandas_udf(lists, f"array<{kind}>")(column)).alias(name))


def flat_map_rows(df: DataFrame, items: Column, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row out per item of an array expression."""
    return df.select(*keep, F.explode(items).alias(name))


def map_partitions(df: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
                   schema: str, with_index: bool = False) -> DataFrame:
    """A function from the batches of a partition to batches; ``partition_index`` on request."""
    source = df.withColumn("partition_index", F.spark_partition_id()) if with_index else df
    return source.mapInPandas(fn, schema)


def table_function(df: DataFrame, handler: type, schema: str, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """A user's table function on the rows of each key, in an order.

    A fresh ``handler`` serves each key: its ``eval`` gets the rows a batch at a time and yields tables, ``terminate`` may
    yield what is left.
    """
    rows = df.asTable().partitionBy(*keys)
    return F.arrow_udtf(handler, returnType=schema)(rows.orderBy(*order) if order else rows)


def repartition_to(df: DataFrame, partitions: int, merge_only: bool = False) -> DataFrame:
    """This many partitions, as is when 0 or less; no job runs while the plan is built.

    ``merge_only`` is for a source known to have more: its partitions are merged without a shuffle.
    """
    if partitions <= 0:
        return df
    return df.coalesce(partitions) if merge_only else df.repartition(partitions)


def chain(df: DataFrame, transforms: Iterable[Transform], partitions: int = 0) -> DataFrame:
    """Registered transforms in order; the last output is brought to the wanted partition count."""
    return repartition_to(reduce(lambda d, t: d.transform(t), transforms, df), partitions)


def intercepted(source: Callable[[], DataFrame], on_read: Iterable[Transform] = (),
                work: Transform = lambda d: d, on_write: Iterable[Transform] = ()) -> DataFrame:
    """Hooks that rewrite rows after a read and before a write, around the work itself."""
    return chain(work(chain(source(), on_read)), on_write)


@contextmanager
def kept(df: DataFrame, level: str = "MEMORY_AND_DISK"):
    """Keep an intermediate for the block and drop it after."""
    held = df.persist(LEVELS[level])
    try:
        yield held
    finally:
        held.unpersist()
