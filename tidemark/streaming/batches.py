"""Prepared batches, one per trigger, and work done inside a micro-batch."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.streaming.runs import run_batches

ROWS_PER_FILE = 5_000_000
FILES_AT_LEAST = 4


def prepare_batches(df: DataFrame, order: str, path: str, batches: int, top: int,
                    numbers: Iterable[int] | None = None) -> int:
    """Write ``df`` as ``batches`` prepared batches by equal spans of ``order`` in ``[0, top]``.

    The batches are written one after the other, each as the same number of files, so a
    file stream that takes that many files per trigger sees one batch per trigger. The
    number of files is given back; a span is a range filter, which prunes row groups.
    ``numbers`` picks the batches to write now.
    """
    span = -(-(top + 1) // batches)
    files = max(FILES_AT_LEAST, -(-span // ROWS_PER_FILE))
    for number in numbers if numbers is not None else range(batches):
        part = df.where((F.col(order) >= number * span) & (F.col(order) < (number + 1) * span))
        (part.withColumn("batch_key", F.lit(number)).repartition(files)
         .write.mode("append").parquet(path))
    return files


def batch_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def text_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of text files that keep arriving."""
    reader = spark.readStream
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def each_batch_table(stream: DataFrame, work: Callable[[DataFrame], DataFrame], path: str) -> DataFrame:
    """Apply ``work`` inside each micro-batch only and keep the rows with their ``batch_id``."""
    spark = stream.sparkSession
    # An empty part, so that a stream without a batch gives an empty table.
    work(spark.createDataFrame([], stream.schema)).write.mode("overwrite").parquet(f"{path}/rows/batch_id=-1")

    def write(batch: DataFrame, batch_id: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")

    run_batches(stream, write, f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/rows")


def driver_batches(stream: DataFrame, summary: Callable[[DataFrame], DataFrame],
                   receive: Callable[[int, list], None], checkpoint: str) -> None:
    """Bring a small aggregate of each micro-batch to the driver; ``summary`` must end in a fixed number of rows."""
    run_batches(stream, lambda batch, batch_id: receive(batch_id, summary(batch).collect()), checkpoint)


def rate_stream(spark: SparkSession, rows_per_batch: int, interval_ms: int = 1000) -> DataFrame:
    """``rows_per_batch`` numbered rows per interval: (timestamp, value)."""
    return (
        spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch)
        .option("advanceMillisPerBatch", interval_ms).load()
    )
