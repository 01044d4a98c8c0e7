"""Rows of a transactional log as they become visible, while the log is still being written."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.positions import COMMIT
from tidemark.sources.log import TP
from tidemark.session import by_value

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_KEYS = [*TP, "producer_id"]
_BUCKET, _WHO, _SEEN = "__bucket", "__who", "__seen"

# Groups of producers, whatever their number: about 1000 calls a batch.
BUCKETS = 1024


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside this block keep their state where processors with lists and timers can have it."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


class OpenTransactions(StatefulProcessor):
    """Holds the rows of open transactions, many producers in a group; a commit marker lets a producer's rows out, an abort
    marker drops them.

    Work is done on the whole group at once: a call for each producer costs many times what its few rows do. With
    ``timeout_ms`` a transaction that gets no row and no marker for so long counts as aborted.
    """

    def __init__(self, schema: T.StructType, timeout_ms: int | None) -> None:
        self.schema, self.timeout_ms = schema, timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", T.StructType([*self.schema, T.StructField(_SEEN, T.LongType())]))

    def handleInputRows(self, key, rows, timerValues):
        names = self.schema.names
        now = 0 if self.timeout_ms is None else timerValues.getCurrentProcessingTimeInMs()
        parts = [pdf[names].assign(**{_SEEN: now}) for pdf in rows]
        held = self._held()
        if len(held):
            parts.insert(0, held)
        table = pd.concat(parts, ignore_index=True)
        table[_WHO] = table.groupby(_KEYS, dropna=False, sort=False).ngroup()
        # A row puts off the time of its whole transaction; one that is late and got none is over.
        table[_SEEN] = table.groupby(_WHO)[_SEEN].transform("max")
        if self.timeout_ms is not None:
            table = table[table[_SEEN] > now - self.timeout_ms]
        table = table.sort_values([_WHO, "offset"], kind="stable", ignore_index=True)
        who, control = table[_WHO].to_numpy(), table["control"].to_numpy(dtype=object)
        inside = table["control"].isna().to_numpy()
        markers = np.flatnonzero(~inside)
        # The next marker of each row; the row beyond the last marker belongs to nobody.
        after = np.append(markers, len(table))[np.searchsorted(markers, np.arange(len(table)))]
        done = np.append(who, -1)[after] == who
        visible = done & inside & (np.append(control, None)[after] == COMMIT)
        self._hold(table[~done])
        if visible.any():
            yield table.loc[visible, names]

    def _held(self) -> pd.DataFrame:
        names = [*self.schema.names, _SEEN]
        return pd.DataFrame(list(self.rows.get()) if self.rows.exists() else [], columns=names)

    def _hold(self, left: pd.DataFrame) -> None:
        """Keep these rows only, with a timer for the first transaction that will be late."""
        left = left[[*self.schema.names, _SEEN]]
        if len(left):
            self.rows.put(list(left.astype(object).where(left.notna(), None).itertuples(index=False, name=None)))
        else:
            self.rows.clear()
        if self.timeout_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if len(left):
                self.handle.registerTimer(int(left[_SEEN].min()) + self.timeout_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = self._held()
        self._hold(held[held[_SEEN] > timerValues.getCurrentProcessingTimeInMs() - self.timeout_ms])
        return iter([])

    def close(self) -> None:
        pass


def read_committed_stream(log: DataFrame, timeout_ms: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The rows that ``operators.positions.read_committed`` gives, each as soon as it is visible.

    Rows outside transactions come at once, those of a transaction with its commit marker. Offsets of a partition have to
    arrive in order of batches; inside a batch any order will do. Start the query inside ``keyed_state``. With ``timeout_ms``
    the clock makes batches too, so such a query goes on until it is stopped. Producers are dealt out to ``buckets`` groups;
    a task holds the rows that a group has in a batch and its open ones, and a checkpoint is bound to the number.
    """
    plain = log.where(~F.col("is_transactional") & F.col("control").isNull())
    # Numbers that may be null go as text: pandas would make doubles of them, and with that lose digits.
    exact = {f.name: f.dataType for f in log.schema if isinstance(f.dataType, T.NumericType) and f.name != "offset"}
    inside = log.where("is_transactional").select(
        *[F.col(c).cast("string").alias(c) if c in exact else F.col(c) for c in log.columns],
        F.pmod(F.xxhash64(*_KEYS), F.lit(buckets)).alias(_BUCKET))
    held = T.StructType([f for f in inside.schema if f.name != _BUCKET])
    freed = inside.groupBy(_BUCKET).transformWithStateInPandas(
        statefulProcessor=OpenTransactions(held, timeout_ms), outputStructType=held, outputMode="Append",
        timeMode="None" if timeout_ms is None else "ProcessingTime")
    return plain.unionByName(freed.select(*[F.col(c).cast(exact[c]).alias(c) if c in exact else F.col(c) for c in log.columns]))


by_value(__name__)
