"""Rows and positions stored as one unit, so that each input counts once.

A batch keeps only rows at or after the stored position of their partition, writes them into a fresh folder, and then
commits the folder and the next offset of every partition to a ledger. Readers only see folders that the ledger names,
so a failed attempt leaves nothing behind, and it does not matter whether a restarted query has its checkpoint, or cuts
its batches as before. Offsets of a partition must arrive in order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import POSITIONS
from tidemark.sources.log import TP
from tidemark.streaming.ledger import Ledger, State


def exactly_once_writer(path: str, work: Callable[[DataFrame], DataFrame] = lambda d: d,
                        before_commit: Callable[[int], None] = lambda batch_id: None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: ``work`` on rows that are new, rows out, then the ledger entry.

    ``before_commit`` runs between the two writes; an error there leaves the batch unseen. Offsets are read in a pass of
    their own, over their columns alone.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ledger = Ledger(spark, f"{path}/ledger")
        state = ledger.state()
        fresh = unread(batch, _positions(spark, state))
        ends = fresh.groupBy(*TP).agg((F.max("offset") + 1).alias("next")).collect()  # one row per partition of the log
        if not ends:
            return
        folder = f"rows/{state.version + 1}-{uuid.uuid4().hex}"
        work(fresh).write.parquet(f"{path}/{folder}")
        before_commit(batch_id)
        ledger.commit(state, [folder], [(r["topic"], r["partition"], r["next"]) for r in ends])

    return write


def abort_every_other(path: str, work: Callable[[DataFrame], DataFrame] = lambda d: d) -> Callable[[DataFrame, int], None]:
    """Odd batches are staged, given up before the commit, and then replayed."""
    commit = exactly_once_writer(path, work)

    class Abort(Exception):
        pass

    def give_up(batch_id: int) -> None:
        raise Abort

    staged_only = exactly_once_writer(path, work, give_up)

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id % 2:
            try:
                staged_only(batch, batch_id)
            except Abort:
                pass
        commit(batch, batch_id)

    return write


def delivered(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Rows of the folders in the ledger; where nothing was delivered yet, an empty table of ``schema``."""
    folders = Ledger(spark, f"{path}/ledger").state().folders
    if not folders:
        return spark.createDataFrame([], schema or T.StructType())
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(*[f"{path}/{folder}" for folder in folders])


def _positions(spark: SparkSession, state: State) -> DataFrame:
    return spark.createDataFrame([(*key, offset) for key, offset in state.positions.items()],
                                 "topic string, partition int, offset bigint")


def stored_positions(spark: SparkSession, path: str) -> DataFrame:
    """Next offset per partition."""
    return _positions(spark, Ledger(spark, f"{path}/ledger").state()).withColumn(
        "metadata", F.lit(None).cast(POSITIONS["metadata"].dataType))


def unread(log: DataFrame, positions: DataFrame) -> DataFrame:
    """Rows at or after the stored position; partitions without one start at 0."""
    held = positions.select(*TP, F.col("offset").alias("__held"))
    return log.join(held, TP, "left").where(F.col("offset") >= F.coalesce("__held", F.lit(0))).drop("__held")
