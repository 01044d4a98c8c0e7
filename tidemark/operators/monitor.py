"""Job, stage, task and batch figures as tables, and statistics of sampled series."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import half_up, once, rate_per_second
from tidemark.operators.sampling import SAMPLE_WINDOW_MS, SAMPLES
from tidemark.operators.windows import dense_mean
from tidemark.plans.ordering import CHUNK_ROWS, dense_index, id_chunk, range_chunks, running_sum
from tidemark.session import scratch_path

# Codes of task types, bytes of a MiB, milliseconds per unit.
TASK_TYPES = {"resulttask": 0, "shufflemaptask": 1}
OTHER_TASK_TYPE = -1
MIB = 1048576.0
UNIT_MS = {
    "nanoseconds": 1e-6, "microseconds": 1e-3, "milliseconds": 1.0, "seconds": 1e3,
    "minutes": 6e4, "hours": 3.6e6, "days": 8.64e7,
}

_TASK_INFO = ("struct<`Task ID`:bigint,`Index`:int,`Attempt`:int,`Launch Time`:bigint,`Executor ID`:string,"
              "`Host`:string,`Locality`:string,`Finish Time`:bigint,`Failed`:boolean,`Killed`:boolean>")
_SHUFFLE_READ = ("struct<`Remote Blocks Fetched`:bigint,`Local Blocks Fetched`:bigint,`Fetch Wait Time`:bigint,"
                 "`Remote Bytes Read`:bigint,`Local Bytes Read`:bigint,`Total Records Read`:bigint>")
_SHUFFLE_WRITE = ("struct<`Shuffle Bytes Written`:bigint,`Shuffle Write Time`:bigint,"
                  "`Shuffle Records Written`:bigint>")
_TASK_METRICS = (
    "struct<`Executor Deserialize Time`:bigint,`Executor Deserialize CPU Time`:bigint,`Executor Run Time`:bigint,"
    "`Executor CPU Time`:bigint,`Peak Execution Memory`:bigint,`Result Size`:bigint,`JVM GC Time`:bigint,"
    "`Result Serialization Time`:bigint,`Memory Bytes Spilled`:bigint,`Disk Bytes Spilled`:bigint,"
    f"`Shuffle Read Metrics`:{_SHUFFLE_READ},`Shuffle Write Metrics`:{_SHUFFLE_WRITE},"
    "`Input Metrics`:struct<`Bytes Read`:bigint,`Records Read`:bigint>,"
    "`Output Metrics`:struct<`Bytes Written`:bigint,`Records Written`:bigint>>")
_REASON = ("struct<`Reason`:string,`Kill Reason`:string,`Class Name`:string,`Description`:string,"
           "`Full Stack Trace`:string>")
# The public event log format: only the kinds of events and fields used here.
EVENTS = {
    "SparkListenerTaskEnd": f"`Stage ID` int, `Stage Attempt ID` int, `Task Type` string, `Task End Reason` {_REASON}, "
                            f"`Task Info` {_TASK_INFO}, `Task Metrics` {_TASK_METRICS}",
    "SparkListenerStageCompleted": "`Stage Info` struct<`Stage ID`:int,`Stage Attempt ID`:int,`Number of Tasks`:int,"
                                   "`Submission Time`:bigint,`Completion Time`:bigint>",
    "SparkListenerJobStart": "`Job ID` int, `Submission Time` bigint",
    "SparkListenerJobEnd": "`Job ID` int, `Completion Time` bigint, `Job Result` struct<`Result`:string>",
}
def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """Event log lines with the file they came from as the application."""
    return spark.read.text(path).select(F.input_file_name().alias("app"), "value")


def parse_events(lines: DataFrame, keys: list[str], value: str = "value", kinds: list[str] | None = None) -> DataFrame:
    """Events of some kinds (all known ones, if not said) with the fields of those kinds.

    A line begins with its kind, so no other line is parsed, and those that are, for the fields of their kinds alone.
    """
    kinds = kinds or list(EVENTS)
    fields = {f.strip().split("`")[1]: f.strip() for kind in kinds for f in _fields(EVENTS[kind])}
    known = F.lit(False)
    for kind in kinds:
        known = known | F.col(value).startswith(f'{{"Event":"{kind}"')
    schema = ", ".join(["`Event` string", *fields.values()])
    return once(lines.where(known), keys, F.from_json(value, schema), "e").select(*keys, "e.*")


def stored_events(events: DataFrame) -> DataFrame:
    """The same events from a scratch table: where several figures read them, no line is parsed twice."""
    path = scratch_path(events.sparkSession, "events")
    events.write.parquet(path)
    return events.sparkSession.read.schema(events.schema).parquet(path)


def _fields(schema: str) -> list[str]:
    """Top-level fields of a schema text."""
    out, depth = [""], 0
    for char in schema:
        depth += (char == "<") - (char == ">")
        if char == "," and not depth:
            out.append("")
        else:
            out[-1] += char
    return out


def _task_ends(events: DataFrame) -> DataFrame:
    return events.where((F.col("Event") == "SparkListenerTaskEnd") & F.col("Task Info").isNotNull()
                        & (F.col("Stage Attempt ID") != -1))


def _error_text() -> Column:
    reason = F.col("Task End Reason")
    failed = F.coalesce(
        F.nullif(reason["Full Stack Trace"], F.lit("")),
        F.when(reason["Class Name"].isNotNull(),
               F.concat_ws(": ", reason["Class Name"], reason["Description"])),
        reason["Reason"])
    return F.when(reason["Reason"] == "TaskKilled",
                  F.concat(F.lit("TaskKilled ("), F.coalesce(reason["Kill Reason"], F.lit("")), F.lit(")"))
                  ).otherwise(failed)


def _task_columns() -> dict[str, Column]:
    info, metrics = F.col("Task Info"), F.col("Task Metrics")
    task_id = F.concat_ws(".", info["Index"].cast("string"), info["Attempt"].cast("string"))
    reason = F.col("Task End Reason")["Reason"]
    kind = F.lower(F.col("Task Type"))
    code = F.lit(OTHER_TASK_TYPE)
    for name, number in TASK_TYPES.items():
        code = F.when(kind == name, F.lit(number)).otherwise(code)
    duration = info["Finish Time"] - info["Launch Time"]
    return {
        "taskAttemptKey": F.concat_ws("_", F.col("Stage ID").cast("string"), F.col("Stage Attempt ID").cast("string"),
                                      task_id, info["Attempt"].cast("string")),
        "taskId": task_id,
        "success": F.coalesce(reason == "Success", F.lit(False)),
        "reasonMsg": F.when(reason == "Success", F.lit("Success"))
        .when(reason == "TaskKilled", F.concat(F.lit("TaskKilled:"), _error_text()))
        .when(reason.isNotNull(), F.concat(F.lit("TaskFailed: "), _error_text()))
        .otherwise(F.lit("Task ended for an unknown reason")),
        "host": info["Host"], "executorId": info["Executor ID"], "taskLocality": info["Locality"],
        "stageId": F.col("Stage ID"), "stageAttemptId": F.col("Stage Attempt ID"), "taskType": code,
        "launchTime": info["Launch Time"], "finishTime": info["Finish Time"],
        "duration": duration, "listenedDuration": duration,
        "executorDeserializeTime": metrics["Executor Deserialize Time"],
        "executorDeserializeCpuTime": metrics["Executor Deserialize CPU Time"],
        "executorRunTime": metrics["Executor Run Time"],
        "resultSerializationTime": metrics["Result Serialization Time"],
        "jvmGCTime": metrics["JVM GC Time"], "resultSize": metrics["Result Size"],
        "memoryBytesSpilled": metrics["Memory Bytes Spilled"], "diskBytesSpilled": metrics["Disk Bytes Spilled"],
        "peakExecutionMemory": metrics["Peak Execution Memory"],
        "bytesRead": metrics["Input Metrics"]["Bytes Read"], "recordsRead": metrics["Input Metrics"]["Records Read"],
        "inputRateSec": rate_per_second(metrics["Input Metrics"]["Records Read"], duration),
        "bytesWritten": metrics["Output Metrics"]["Bytes Written"],
        "recordsWritten": metrics["Output Metrics"]["Records Written"],
        "outputRateSec": rate_per_second(metrics["Output Metrics"]["Records Written"], duration),
    }


def task_metrics(events: DataFrame, keys: list[str]) -> DataFrame:
    """The 29 figures of every ended task attempt."""
    return _task_ends(events).select(*keys, *[c.alias(n) for n, c in _task_columns().items()])


def task_failures(events: DataFrame, keys: list[str]) -> DataFrame:
    """Failed and killed attempts: error text, place, and task, input, output and shuffle figures."""
    metrics = F.col("Task Metrics")
    read, write = metrics["Shuffle Read Metrics"], metrics["Shuffle Write Metrics"]
    info = F.col("Task Info")
    extra = {
        "errorMessage": _error_text(), "failed": info["Failed"], "executorCpuTime": metrics["Executor CPU Time"],
        "shuffleRecordsRead": read["Total Records Read"], "fetchWaitTime": read["Fetch Wait Time"],
        "localBlocksFetched": read["Local Blocks Fetched"], "localBytesRead": read["Local Bytes Read"],
        "remoteBlocksFetched": read["Remote Blocks Fetched"], "remoteBytesRead": read["Remote Bytes Read"],
        "totalBlocksFetched": read["Local Blocks Fetched"] + read["Remote Blocks Fetched"],
        "totalBytesRead": read["Local Bytes Read"] + read["Remote Bytes Read"],
        "shuffleWriteTime": write["Shuffle Write Time"], "shuffleBytesWritten": write["Shuffle Bytes Written"],
        "shuffleRecordsWritten": write["Shuffle Records Written"],
    }
    bad = _task_ends(events).where(F.col("Task End Reason")["Reason"] != "Success")
    return bad.select(*keys, *[c.alias(n) for n, c in {**_task_columns(), **extra}.items()])


def expected_load(config: DataFrame, batch_ms: str, rate: str, partitions: str, record_bytes: str) -> DataFrame:
    """Records a task and a stage should see in a batch, and their MiB."""
    per_task = F.expr(f"cast(`{batch_ms}` * `{rate}` div 1000 AS bigint)")
    return (
        config.withColumn("task_records", per_task)
        .withColumn("stage_records", F.col("task_records") * F.col(partitions))
        .withColumn("task_mib", F.col("task_records") * F.col(record_bytes) / F.lit(MIB))
        .withColumn("stage_mib", F.col("stage_records") * F.col(record_bytes) / F.lit(MIB))
    )


def _means_after_warmup(rows: DataFrame, job_ends: DataFrame | None, keys: list[str], means: dict[str, str], n: int,
                        warmup: int) -> DataFrame:
    """Moving means in the order of completion, of rows by whose time more than ``warmup`` jobs have ended.

    ``rows`` have ``at`` (completion, ms) and ``id`` (unique among equal times); ``job_ends`` have the keys, ``at`` and ``id``. Without
    them the rows are job ends themselves, of which those without a value only count. ``means`` maps new columns to
    values. Rows of the warm-up show 0.0 and enter no mean. A stage or task counts before a job that ends in the same ms.
    """
    values = [c for c in rows.columns if c not in (*keys, "at", "id")]
    usable = F.col(next(iter(means.values()))).isNotNull()
    marked = rows.select(*keys, "at", "id", F.when(usable, F.struct(*values)).alias("row"), F.lit(0).alias("side"),
                         F.lit(1 if job_ends is None else 0).alias("ended"))
    if job_ends is not None:
        marked = marked.unionByName(job_ends.select(*keys, "at", "id", F.lit(1).alias("side"), F.lit(1).alias("ended")),
                                    allowMissingColumns=True)
    # Ranges of the completion order, so that a busy hour is cut as any other.
    marked = range_chunks(marked.withColumn("place", F.struct("at", "side", "id")), [*keys, "place"], "__range")
    # Where the warm-up ends: the place of the job after it. A rank filter keeps that many rows a key from each task.
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("place"))
    start = marked.where("ended = 1").select(*keys, "place").withColumn("__nth", nth).where(
        F.col("__nth") == warmup + 1).select(*keys, F.col("place").alias("__start"))
    rows = marked.where("row is not null").select(*keys, "place", "__range", "row.*").join(start, keys, "left")
    warm = F.coalesce(F.col("place") >= F.col("__start"), F.lit(False))
    late = dense_index(rows.where(warm).drop("__start"), keys, "place", "__range", "__n")
    for name, value in means.items():
        late = dense_mean(late, keys, "__n", value, n, name)
    early = rows.where(~warm).drop("__start").withColumns({name: F.lit(0.0) for name in means})
    return late.drop("__n").unionByName(early).drop("place", "__range")


def _job_ends(events: DataFrame, keys: list[str]) -> DataFrame:
    """Jobs that were seen to start and to end, whatever their result."""
    starts = events.where(F.col("Event") == "SparkListenerJobStart").select(
        *keys, F.col("Job ID").cast("long").alias("id"), F.col("Submission Time").alias("started"))
    ends = events.where(F.col("Event") == "SparkListenerJobEnd").select(
        *keys, F.col("Job ID").cast("long").alias("id"), F.col("Completion Time").alias("at"),
        F.col("Job Result")["Result"].alias("result"))
    return starts.join(ends, [*keys, "id"])


def _mib_rate(mib: float) -> Column:
    return half_up(F.lit(mib) / (F.col("duration") / F.lit(1000.0)), 2)


def task_rates(events: DataFrame, keys: list[str], task_records: int, task_mib: float, n: int, warmup: int) -> DataFrame:
    """Records/s and MiB/s of each ended task from its duration, with their moving means in the order of ending."""
    info = F.col("Task Info")
    tasks = (
        _task_ends(events)
        .select(*keys, F.col("Stage ID").alias("stage_id"), F.col("Stage Attempt ID").alias("attempt"), info["Index"].alias("index"),
                info["Attempt"].alias("task_attempt"), info["Finish Time"].alias("at"),
                (info["Finish Time"] - info["Launch Time"]).alias("duration"))
        .where(F.col("duration") > 0)
        .withColumn("id", F.struct("stage_id", "attempt", "index", "task_attempt"))
        .withColumn("rate", rate_per_second(F.lit(task_records).cast("long"), F.col("duration")))
        .withColumn("mib_rate", _mib_rate(task_mib))
    )
    ends = _job_ends(events, keys).select(*keys, "at", F.struct(*[F.col("id").cast("int").alias(c) for c in (
        "stage_id", "attempt", "index", "task_attempt")]).alias("id"))
    return _means_after_warmup(tasks, ends, keys, {"mean_rate": "rate", "mean_mib_rate": "mib_rate"}, n, warmup)


def stage_rates(events: DataFrame, keys: list[str], task_records: int, stage_mib: float, n: int,
                warmup: int) -> DataFrame:
    """Records/s and MiB/s of each completed stage from its duration, with the moving mean in the order of completion.

    The mean starts once more than ``warmup`` jobs have ended, failed ones too.
    """
    info = F.col("Stage Info")
    stages = (
        events.where((F.col("Event") == "SparkListenerStageCompleted") & (info["Stage Attempt ID"] != -1))
        .select(*keys, info["Stage ID"].alias("stage_id"), info["Stage Attempt ID"].alias("attempt"),
                info["Number of Tasks"].alias("tasks"), info["Completion Time"].alias("at"),
                (info["Completion Time"] - info["Submission Time"]).alias("duration"))
        .where(F.col("duration") > 0)
        .withColumn("id", F.struct("stage_id", "attempt"))
        .withColumn("rate", rate_per_second(F.col("tasks").cast("long") * task_records, F.col("duration")))
        .withColumn("mib_rate", _mib_rate(stage_mib))
    )
    ends = _job_ends(events, keys).select(*keys, "at", F.struct(*[F.col("id").cast("int").alias(c) for c in (
        "stage_id", "attempt")]).alias("id"))
    return _means_after_warmup(stages, ends, keys, {"mean_rate": "rate"}, n, warmup)


def job_rates(events: DataFrame, keys: list[str], stage_records: int, stage_mib: float, n: int,
              warmup: int) -> DataFrame:
    """The same for successful jobs, from job start to job end; a job's own end counts for the warm-up."""
    usable = (F.col("result") == "JobSucceeded") & (F.col("duration") > 0)
    jobs = (
        _job_ends(events, keys).withColumn("duration", F.col("at") - F.col("started")).withColumn("job_id", F.col("id"))
        .withColumn("rate", F.when(usable, rate_per_second(F.lit(stage_records).cast("long"), F.col("duration"))))
        .withColumn("mib_rate", F.when(usable, _mib_rate(stage_mib)))
    )
    return _means_after_warmup(jobs.drop("started", "result"), None, keys, {"mean_rate": "rate"}, n, warmup)


def batch_metrics(batches: DataFrame, expected_mib: float) -> DataFrame:
    """Delays of each batch in ms, records/s and MiB/s over its processing time."""
    processing = F.col("end_ms") - F.col("start_ms")
    return batches.select(
        "series", "batch_no", "batch_time", "num_records",
        (F.col("start_ms") - F.col("submit_ms")).alias("scheduling_ms"),
        processing.alias("processing_ms"),
        (F.col("end_ms") - F.col("submit_ms")).alias("total_ms"),
        rate_per_second(F.col("num_records"), processing).alias("records_per_s"),
        F.when(processing > 0, half_up(F.lit(expected_mib) / (processing / F.lit(1000.0)), 2))
        .otherwise(F.lit(0.0)).alias("mib_per_s"))


def batch_info(batches: DataFrame) -> DataFrame:
    """The four columns of the stored batch table."""
    return batches.select("batch_time", F.col("start_ms").alias("processing_start_time"),
                          F.col("end_ms").alias("processing_end_time"), "num_records")


BATCH_ROW = ("series string, batch_no bigint, batch_time bigint, submit_ms bigint, start_ms bigint, end_ms bigint, "
             "num_records bigint")


def progress_row(report: dict) -> tuple:
    """The figures of a batch, as in ``BATCH_ROW``, from a progress report."""
    at = int(pd.Timestamp(report["timestamp"]).timestamp() * 1000)
    took = report["durationMs"]
    ready = at + int(took.get("latestOffset", 0)) + int(took.get("queryPlanning", 0))
    return (report["name"] or report["id"], int(report["batchId"]), at, at, ready, at + int(took.get("triggerExecution", 0)),
            int(report["numInputRows"]))


def progress_rows(spark: SparkSession, progress: list[dict]) -> DataFrame:
    """Batch rows of progress reports; ``streaming.capture`` collects them while queries run."""
    return spark.createDataFrame([progress_row(p) for p in progress], BATCH_ROW)


def sampled_stats(live: DataFrame, series: DataFrame) -> DataFrame:
    """Avg, count, min, max, sum per series; without samples avg 0, count 0 and the start values of min and max.

    ``series`` lists every series once.
    """
    sums = live.groupBy("series").agg(
        F.sum("count").alias("count"), F.sum("sum").alias("sum"), F.min("min").alias("min"),
        F.max("max").alias("max"), F.min("start_ms").alias("oldest_ms"))
    return series.join(sums, "series", "left").select(
        "series", F.coalesce("count", F.lit(0)).alias("count"), F.coalesce("sum", F.lit(0.0)).alias("sum"),
        F.coalesce(F.try_divide("sum", "count"), F.lit(0.0)).alias("avg"),
        F.coalesce("min", F.lit(float(np.finfo(np.float64).max))).alias("min"),
        F.coalesce("max", F.lit(float("-inf"))).alias("max"), "oldest_ms")


def sampled_rate(stats: DataFrame, now_ms: int, n_samples: int = SAMPLES, window_ms: int = SAMPLE_WINDOW_MS,
                 unit: str = "seconds", simple: bool = False, out: str = "rate",
                 elapsed_out: str = "elapsed_ms") -> DataFrame:
    """Add the sampled total by elapsed time, which counts as ``n_samples - 1`` full windows at least (simple: as one)."""
    elapsed = F.lit(now_ms) - F.coalesce("oldest_ms", F.lit(now_ms))
    if simple:
        padded = F.greatest(elapsed, F.lit(window_ms).cast("long"))
    else:
        missing = F.greatest(F.lit(n_samples - 1) - F.floor(elapsed / F.lit(window_ms)), F.lit(0))
        padded = elapsed + missing * window_ms
    return stats.withColumns({
        elapsed_out: padded, out: F.try_divide(F.col("sum"), padded / F.lit(UNIT_MS[unit]))})


def total_and_last(df: DataFrame, series: list[str], order: str, value: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Running total per row and the last value of its series."""
    last = df.groupBy(*series).agg(F.max_by(value, order).alias("last"))
    return running_sum(df, series, order, value, id_chunk(order, chunk_rows), "total").join(last, series)
