"""Key to partition, with the 32-bit murmur2 hash producers use."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.ordering import CHUNK_ROWS, dense_index

# Fixed values of the public murmur2 algorithm and the seed producers use.
SEED = 0x9747B28C
MULTIPLIER = 0x5BD1E995
MIX_SHIFT = 24
TAIL_SHIFTS = (13, 15)


def _hasher():
    """The hash of a batch as a closure: it travels by value, so executors need not have this package."""
    seed, multiplier, mix_shift, tail_shifts = SEED, MULTIPLIER, MIX_SHIFT, TAIL_SHIFTS

    def hash_batch(keys: pd.Series) -> pd.Series:
        """All keys of an Arrow batch at once: step i hashes the i-th word of every key that has one."""
        sizes = keys.map(len).to_numpy(dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(keys) + bytes(4), dtype=np.uint8).astype(np.uint32)
        factor = np.uint32(multiplier)
        hashes = np.uint32(seed) ^ sizes.astype(np.uint32)
        for word in range(int(sizes.max(initial=0)) // 4):
            rows = sizes >= 4 * (word + 1)
            at = starts[rows] + 4 * word
            mixed = (data[at] | data[at + 1] << 8 | data[at + 2] << 16 | data[at + 3] << 24) * factor
            mixed ^= mixed >> mix_shift
            hashes[rows] = hashes[rows] * factor ^ mixed * factor
        left = sizes % 4
        tail = np.zeros(len(sizes), dtype=np.uint32)
        for i in range(3):
            rows = left > i
            tail[rows] |= data[(starts + sizes - left)[rows] + i] << (8 * i)
        hashes = np.where(left > 0, (hashes ^ tail) * factor, hashes)
        hashes = (hashes ^ hashes >> tail_shifts[0]) * factor
        return pd.Series((hashes ^ hashes >> tail_shifts[1]).view(np.int32))

    return hash_batch


def murmur2(key: Column) -> Column:
    """Signed 32-bit murmur2 of a non-null binary column as int.

    Spark has no 32-bit overflow arithmetic on bytes: a JVM expression for this folds arrays
    in interpreted code and takes three times as long as Arrow batches do.
    """
    return F.pandas_udf(_hasher(), "int")(key)


def key_partition(key: Column, partitions: int) -> Column:
    """Partition of a non-null key."""
    return murmur2(key).bitwiseAND(F.lit(0x7FFFFFFF)) % F.lit(partitions)


def assign_partitions(df: DataFrame, key: str, order: str, partitions: int, out: str = "partition",
                      chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Hash keyed rows; rows with a null key take turns in ``order`` (a unique, non-negative integer)."""
    keyed = df.where(F.col(key).isNotNull()).withColumn(out, key_partition(F.col(key), partitions).cast("int"))
    # Only the rows without a key need their place in the order; the others do not move.
    free = dense_index(df.where(F.col(key).isNull()).withColumn("__all", F.lit(0)), ["__all"], order,
                       F.expr(f"`{order}` div {chunk_rows}"), "__turn")
    turns = free.withColumn(out, (F.col("__turn") % partitions).cast("int")).drop("__all", "__turn")
    return keyed.unionByName(turns)
