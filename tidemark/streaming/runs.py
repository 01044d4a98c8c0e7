"""Run a stream to the end of what is there, and keep its result as a table."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

BatchFn = Callable[[DataFrame, int], None]


def run_batches(stream: DataFrame, fn: BatchFn, checkpoint: str, mode: str = "append") -> list[dict]:
    """Hand every micro-batch to ``fn`` until the input is used up; gives back the progress reports."""
    query = (
        stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).foreachBatch(fn).start()
    )
    query.awaitTermination()
    return [json.loads(p.json) for p in query.recentProgress]


def planned_batches(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``batch_id, batch_time, watermark_ms, offsets, committed`` of the batches that a checkpoint knows of.

    A batch is planned, with the offsets of its sources and its time, before it runs, and committed after; what is planned
    and not committed, a restart runs again. Spark keeps a number of batches that ``spark.sql.streaming.minBatchesToRetain``
    sets.
    """
    def entries(log: str) -> DataFrame:
        files = spark.read.text(f"{checkpoint}/{log}", wholetext=True)
        number = F.regexp_extract(F.input_file_name(), "([0-9]+)$", 1).cast("long")
        return files.select(number.alias("batch_id"), F.split("value", "\n").alias("lines")).where("batch_id is not null")

    # The first line is the format's version, the second one the batch, the others one source each.
    plan = F.from_json(F.col("lines")[1], "batchWatermarkMs bigint, batchTimestampMs bigint")
    planned = entries("offsets").select(
        "batch_id", F.timestamp_millis(plan["batchTimestampMs"]).alias("batch_time"), plan["batchWatermarkMs"].alias("watermark_ms"),
        F.filter(F.slice("lines", 3, F.greatest(F.size("lines") - 2, F.lit(0))), lambda line: line != "").alias("offsets"))
    # A query that never ended a batch has no log of commits.
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    done = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(
        spark._jvm.org.apache.hadoop.fs.Path(path, "[0-9]*"))
    if not done:
        return planned.withColumn("committed", F.lit(False))
    commits = entries("commits").select("batch_id", F.lit(True).alias("committed"))
    return planned.join(commits, "batch_id", "left").withColumn("committed", F.coalesce("committed", F.lit(False)))


def pending_batches(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Batches that were planned and not committed, which a restart runs again before any new one, in order of time."""
    return planned_batches(spark, checkpoint).where("NOT committed").drop("committed").orderBy("batch_time", "batch_id")


def update_table(stream: DataFrame, keys: list[str], label: str, path: str | None = None) -> DataFrame:
    """Result of a stream aggregate as a table.

    Update mode writes only the groups a batch changed, into a folder of that batch which a
    replay overwrites; the reader takes the newest row of each group. Nothing passes
    through the driver and no batch rewrites the whole result.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, label)
    spark.createDataFrame([], stream.schema).write.mode("overwrite").parquet(f"{path}/rows/batch_id=-1")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")

    run_batches(stream, write, f"{path}/checkpoint", "update")
    return newest_rows(spark, f"{path}/rows", keys)


# Event time of the row that closes a stream; later than any real one, and in reach of every width.
END_TIME = "9000-01-01"


def closed_table(source: DataFrame, build: Callable[[DataFrame], DataFrame], time: str, label: str,
                 path: str | None = None) -> DataFrame:
    """Result of ``build`` on a whole stream with a watermark, as a table.

    Append mode writes a group once, when the watermark has passed it, and forgets it. To let the last ones out, a row
    with nothing but a time beyond all others ends the stream; ``build`` must keep ``time`` and stand null columns.
    """
    spark = source.sparkSession
    path = path or scratch_path(spark, label)
    nothing = spark.createDataFrame([], source.schema)
    nothing.write.mode("append").parquet(f"{path}/end")
    stream = build(source.unionByName(spark.readStream.schema(source.schema).parquet(f"{path}/end")))
    spark.createDataFrame([], stream.schema).write.mode("overwrite").parquet(f"{path}/rows/batch_id=-1")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")

    run_batches(stream, write, f"{path}/checkpoint")
    end = spark.range(1).select(*[
        (F.lit(END_TIME) if f.name == time else F.lit(None)).cast(f.dataType).alias(f.name) for f in source.schema])
    end.write.mode("append").parquet(f"{path}/end")
    run_batches(stream, write, f"{path}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{path}/rows").select(*stream.columns)


def newest_rows(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in (*keys, "batch_id")]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("v"))
    return newest.select(*keys, *[F.col(f"v.{c}").alias(c) for c in values])


def console(stream: DataFrame, checkpoint: str, rows: int = 20):
    """Complete mode to the console, untruncated."""
    return (
        stream.writeStream.outputMode("complete").format("console").option("truncate", False)
        .option("numRows", rows).option("checkpointLocation", checkpoint).start()
    )


def complete_table(stream: DataFrame, label: str, order: str | None = None) -> DataFrame:
    """Complete mode: every batch replaces the stored result, sorted when asked."""
    spark = stream.sparkSession
    path = scratch_path(spark, label)
    sorted_stream = stream.orderBy(order) if order else stream
    spark.createDataFrame([], stream.schema).write.mode("overwrite").parquet(f"{path}/result")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/result")

    run_batches(sorted_stream, write, f"{path}/checkpoint", "complete")
    return spark.read.parquet(f"{path}/result")


def kafka_sink(rows: DataFrame, servers: str, topic: str, checkpoint: str, mode: str = "complete"):
    """(key, value) rows back to a topic; a checkpoint location is required."""
    if not checkpoint:
        raise ValueError("a log sink needs a checkpoint location")
    return (
        rows.writeStream.outputMode(mode).format("kafka").option("kafka.bootstrap.servers", servers)
        .option("topic", topic).option("checkpointLocation", checkpoint).start()
    )
