"""Figures of micro-batches written down while their queries run."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.operators.monitor import BATCH_ROW, progress_row

ROWS = f"run_id string, {BATCH_ROW}, observed string"


class BatchCapture(StreamingQueryListener):
    """Appends one row for every progress report of the session's streaming queries to a table.

    A query itself keeps only its latest reports. Rows are held until ``rows_per_file`` of them make a file, or a query
    ends; figures that the stream was told to ``observe`` come along as JSON.
    """

    def __init__(self, spark: SparkSession, path: str, rows_per_file: int = 100) -> None:
        self.spark, self.path, self.rows_per_file = spark, path, rows_per_file
        self.lock = threading.Lock()
        self.held: list[tuple] = []
        self.running: set[str] = set()
        self.ended: set[str] = set()

    def onQueryStarted(self, event) -> None:
        with self.lock:
            self.running.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        report = json.loads(event.progress.json)
        observed = report.get("observedMetrics")
        with self.lock:
            self.held.append((report["runId"], *progress_row(report), json.dumps(observed) if observed else None))
            full = len(self.held) >= self.rows_per_file
        if full:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.flush()
        with self.lock:
            self.ended.add(str(event.runId))

    def flush(self) -> None:
        with self.lock:
            rows, self.held = self.held, []
        if rows:
            self.spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(self.path)

    def settle(self, seconds: float = 60) -> None:
        """Wait until the ends of all queries that are over have been seen."""
        until = time.monotonic() + seconds
        while time.monotonic() < until:
            active = {str(q.runId) for q in self.spark.streams.active}
            with self.lock:
                if self.running <= self.ended | active:
                    break
            time.sleep(0.05)
        self.flush()


@contextmanager
def captured(spark: SparkSession, path: str, rows_per_file: int = 100) -> Iterator[BatchCapture]:
    """Write down the batches of all queries that run inside this block."""
    spark.createDataFrame([], ROWS).write.mode("append").parquet(path)
    listener = BatchCapture(spark, path, rows_per_file)
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        listener.settle()
        spark.streams.removeListener(listener)


def captured_batches(spark: SparkSession, path: str) -> DataFrame:
    """One row for each batch, as ``operators.monitor.batch_metrics`` takes them; reports of idle triggers do not count."""
    rows = spark.read.schema(ROWS).parquet(path)
    values = [c for c in rows.columns if c not in ("run_id", "series", "batch_no")]
    newest = rows.groupBy("run_id", "series", "batch_no").agg(
        F.max_by(F.struct(*values), F.struct("num_records", "batch_time")).alias("v"))
    return newest.select("run_id", "series", "batch_no", "v.*")
