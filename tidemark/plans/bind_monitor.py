"""Job figures and sampled statistics on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalar import once
from tidemark.operators import monitor as M
from tidemark.operators import sampling
from tidemark.plans import views as V
from tidemark.plans.catalog import BATCHES, SENSOR, half_up_sql, mean3_sql, query, rounded
from tidemark.session import scratch_path
from tidemark.streaming import batches as B


@query("mon_batch_metrics", f"""
  WITH {BATCHES} SELECT series, batch_no, batch_time, num_records, start_ms - submit_ms AS scheduling_ms, end_ms - start_ms AS processing_ms,
    end_ms - submit_ms AS total_ms,
    CASE WHEN end_ms = start_ms THEN 0.0 ELSE {half_up_sql('num_records * 1000.0 / (end_ms - start_ms)', 2)} END AS records_per_s,
    CASE WHEN end_ms = start_ms THEN 0.0 ELSE {half_up_sql('12.5 / ((end_ms - start_ms) / 1000.0)', 2)} END AS mib_per_s FROM batches""")
def _(spark, sf):
    return M.batch_metrics(V.batches(spark, sf), 12.5)


@query("sink_jdbc_metrics", f"""
  WITH {BATCHES} SELECT batch_time, start_ms AS processing_start_time, end_ms AS processing_end_time, num_records FROM batches""")
def _(spark, sf):
    # The writer a database gets is sources.jdbc.append_jdbc; here the same rows go to parquet, batch by batch.
    path = scratch_path(spark, "metrics")
    batches = V.batches(spark, sf)
    batches.write.parquet(f"{path}/in")
    stream = B.batch_stream(spark, f"{path}/in", batches.schema)
    return B.each_batch_table(stream, M.batch_info, path).drop("batch_id")


def task_lines(spark, sf):
    """One task-end line of an event log per order; the order's fields stand for the figures."""
    orders = V.table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "app")
    return once(orders, ["app"], F.expr("""to_json(named_struct(
          'Event', 'SparkListenerTaskEnd', 'Stage ID', cast(o_custkey % 50 AS int), 'Stage Attempt ID', if(o_orderkey % 97 = 0, -1, 0),
          'Task Type', CASE o_orderkey % 3 WHEN 0 THEN 'ResultTask' WHEN 1 THEN 'ShuffleMapTask' ELSE 'OtherTask' END,
          'Task End Reason', named_struct(
             'Reason', CASE o_orderkey % 10 WHEN 0 THEN 'TaskKilled' WHEN 1 THEN 'ExceptionFailure' ELSE 'Success' END,
             'Kill Reason', if(o_orderkey % 10 = 0, 'stage cancelled', null),
             'Class Name', if(o_orderkey % 10 = 1, 'java.lang.Error', null),
             'Description', if(o_orderkey % 10 = 1, concat('order ', o_orderkey), null)),
          'Task Info', named_struct('Task ID', o_orderkey, 'Index', cast(o_orderkey AS int), 'Attempt', cast(o_orderkey % 2 AS int),
             'Launch Time', unix_millis(cast(o_orderdate AS timestamp)), 'Executor ID', cast(o_custkey % 7 AS string), 'Host', 'host',
             'Locality', 'ANY', 'Finish Time', unix_millis(cast(o_orderdate AS timestamp)) + o_custkey % 5000,
             'Failed', o_orderkey % 10 = 1, 'Killed', o_orderkey % 10 = 0),
          'Task Metrics', named_struct('Executor Deserialize Time', o_custkey, 'Executor Deserialize CPU Time', o_custkey + 1,
             'Executor Run Time', o_custkey + 2, 'Executor CPU Time', o_custkey + 3, 'Peak Execution Memory', o_custkey + 4,
             'Result Size', o_custkey + 5, 'JVM GC Time', o_custkey + 6, 'Result Serialization Time', o_custkey + 7,
             'Memory Bytes Spilled', o_custkey + 8, 'Disk Bytes Spilled', o_custkey + 9,
             'Shuffle Read Metrics', named_struct('Remote Blocks Fetched', o_orderkey + 1, 'Local Blocks Fetched', o_orderkey + 2,
                'Fetch Wait Time', o_orderkey + 3, 'Remote Bytes Read', o_orderkey + 4, 'Local Bytes Read', o_orderkey + 5,
                'Total Records Read', o_orderkey + 6),
             'Shuffle Write Metrics', named_struct('Shuffle Bytes Written', o_orderkey + 7, 'Shuffle Write Time', o_orderkey + 8,
                'Shuffle Records Written', o_orderkey + 9),
             'Input Metrics', named_struct('Bytes Read', o_orderkey * 10, 'Records Read', o_orderkey),
             'Output Metrics', named_struct('Bytes Written', o_orderkey * 20, 'Records Written', o_orderkey * 2))))"""), "value")


_TASK_SQL = f"""tasks AS (SELECT o_orderpriority AS app, o_orderkey AS k, o_custkey AS c, epoch_us(o_orderdate) // 1000 AS launch, o_custkey % 5000 AS d
    FROM orders WHERE o_orderkey % 97 <> 0), figures AS (
  SELECT app, k, c, (c % 50) || '_0_' || k || '.' || (k % 2) || '_' || (k % 2) AS "taskAttemptKey", k || '.' || (k % 2) AS "taskId", k % 10 > 1 AS success,
    CASE k % 10 WHEN 0 THEN 'TaskKilled:TaskKilled (stage cancelled)' WHEN 1 THEN 'TaskFailed: java.lang.Error: order ' || k ELSE 'Success' END AS "reasonMsg",
    'host' AS host, (c % 7)::VARCHAR AS "executorId", 'ANY' AS "taskLocality", (c % 50)::INT AS "stageId", 0::INT AS "stageAttemptId",
    CASE k % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE -1 END::INT AS "taskType", launch AS "launchTime", launch + d AS "finishTime", d AS duration,
    d AS "listenedDuration", c AS "executorDeserializeTime", c + 1 AS "executorDeserializeCpuTime", c + 2 AS "executorRunTime",
    c + 7 AS "resultSerializationTime", c + 6 AS "jvmGCTime", c + 5 AS "resultSize", c + 8 AS "memoryBytesSpilled", c + 9 AS "diskBytesSpilled",
    c + 4 AS "peakExecutionMemory", k * 10 AS "bytesRead", k AS "recordsRead",
    CASE WHEN d = 0 THEN 0.0 ELSE {half_up_sql('k * 1000.0 / d', 2)} END AS "inputRateSec", k * 20 AS "bytesWritten", k * 2 AS "recordsWritten",
    CASE WHEN d = 0 THEN 0.0 ELSE {half_up_sql('k * 2000.0 / d', 2)} END AS "outputRateSec" FROM tasks)"""


@query("mon_task_metrics", f"WITH {_TASK_SQL} SELECT * EXCLUDE (k, c) FROM figures")
def _(spark, sf):
    return M.task_metrics(M.parse_events(task_lines(spark, sf), ["app"], kinds=["SparkListenerTaskEnd"]), ["app"])


@query("mon_task_failures", f"""
  WITH {_TASK_SQL} SELECT * EXCLUDE (k, c), CASE k % 10 WHEN 0 THEN 'TaskKilled (stage cancelled)' ELSE 'java.lang.Error: order ' || k END AS "errorMessage",
    k % 10 = 1 AS failed, c + 3 AS "executorCpuTime", k + 6 AS "shuffleRecordsRead", k + 3 AS "fetchWaitTime", k + 2 AS "localBlocksFetched",
    k + 5 AS "localBytesRead", k + 1 AS "remoteBlocksFetched", k + 4 AS "remoteBytesRead", 2 * k + 3 AS "totalBlocksFetched", 2 * k + 9 AS "totalBytesRead",
    k + 8 AS "shuffleWriteTime", k + 7 AS "shuffleBytesWritten", k + 9 AS "shuffleRecordsWritten" FROM figures WHERE NOT success""")
def _(spark, sf):
    return M.task_failures(M.parse_events(task_lines(spark, sf), ["app"], kinds=["SparkListenerTaskEnd"]), ["app"])


STAGE_AND_JOB = ["SparkListenerStageCompleted", "SparkListenerJobStart", "SparkListenerJobEnd"]
JOB_START = "(cast(c_custkey AS bigint) * 7919 % 100003 * 1000)"


def stage_job_lines(spark, sf):
    """Per customer one completed stage, one job start and one job end; the segment is the application.

    Times do not follow the ids. A customer is a few bytes and its lines are long, so customers are spread over tasks first.
    """
    t = JOB_START
    return V.table(spark, sf, "customer").repartition("c_custkey").select(F.col("c_mktsegment").alias("app"), F.explode(F.array(*map(F.expr, [
        f"""to_json(named_struct('Event', 'SparkListenerStageCompleted', 'Stage Info', named_struct('Stage ID', cast(c_custkey AS int),
             'Stage Attempt ID', 0, 'Number of Tasks', c_nationkey + 1, 'Submission Time', {t}, 'Completion Time', {t} + c_custkey * 37 % 900)))""",
        f"""to_json(named_struct('Event', 'SparkListenerJobStart', 'Job ID', cast(c_custkey AS int), 'Submission Time', {t}))""",
        f"""to_json(named_struct('Event', 'SparkListenerJobEnd', 'Job ID', cast(c_custkey AS int), 'Completion Time', {t} + c_custkey * 53 % 800,
             'Job Result', named_struct('Result', if(c_custkey % 7 = 0, 'JobFailed', 'JobSucceeded'))))""",
    ]))).alias("value"))


_MEAN5 = mean3_sql('rate', 'PARTITION BY app ORDER BY "at", number ROWS 5 PRECEDING')
_START = JOB_START.replace("cast(c_custkey AS bigint)", "c_custkey::BIGINT")


def _kind_sql(name: str, duration: str, records: str, usable: str, jobs: str) -> str:
    return f"""{name}0 AS (SELECT c_mktsegment AS app, '{name}' AS kind, c_custkey::BIGINT AS number, {_START} + {duration} AS "at",
        ({duration})::BIGINT AS duration, {half_up_sql(f'({records}) * 1000.0 / nullif({duration}, 0)', 2)} AS rate,
        {half_up_sql(f'2.5 / (nullif({duration}, 0) / 1000.0)', 2)} AS mib_rate, {usable} AND ({duration}) > 0 AS usable FROM customer),
    {name}1 AS (SELECT *, {jobs} AS jobs FROM {name}0 x),
    {name} AS (SELECT * EXCLUDE (jobs, "at", usable), {_MEAN5} AS mean_rate FROM {name}1 WHERE usable AND jobs > 10
               UNION ALL SELECT * EXCLUDE (jobs, "at", usable), 0.0 FROM {name}1 WHERE usable AND jobs <= 10)"""


_JOBS_BEFORE = """(SELECT count(*) FROM job0 j WHERE j.app = x.app AND j."at" < x."at")"""


@query("mon_stage_job_rates", f"""
  WITH {_kind_sql('job', 'c_custkey * 53 % 800', '80000', 'c_custkey % 7 <> 0',
                  'row_number() OVER (PARTITION BY app ORDER BY "at", number)')},
       {_kind_sql('stage', 'c_custkey * 37 % 900', '5000 * (c_nationkey + 1)', 'true', _JOBS_BEFORE)}
  SELECT * FROM stage UNION ALL SELECT * FROM job""")
def _(spark, sf):
    events = M.stored_events(M.parse_events(stage_job_lines(spark, sf), ["app"], kinds=STAGE_AND_JOB))
    columns = ["app", "kind", "number", "duration", "rate", "mib_rate", "mean_rate"]
    stages = M.stage_rates(events, ["app"], 5000, 2.5, 5, 10).withColumns(
        {"kind": F.lit("stage"), "number": F.col("stage_id").cast("long")}).select(*columns)
    jobs = M.job_rates(events, ["app"], 80000, 2.5, 5, 10).withColumns(
        {"kind": F.lit("job"), "number": F.col("job_id").cast("long")}).select(*columns)
    return stages.unionByName(jobs)


@query("mon_expected_load", """
  SELECT p_partkey, (p_size * 100 * (p_partkey % 5000) // 1000)::BIGINT AS task_records, (p_size * 100 * (p_partkey % 5000) // 1000)::BIGINT * 16 AS stage_records,
    round((p_size * 100 * (p_partkey % 5000) // 1000) * 260 / 1048576.0, 8) AS task_mib, round((p_size * 100 * (p_partkey % 5000) // 1000) * 16 * 260 / 1048576.0, 8) AS stage_mib
  FROM part""")
def _(spark, sf):
    config = V.table(spark, sf, "part").selectExpr(
        "p_partkey", "p_size * 100L AS batch_ms", "p_partkey % 5000 AS rate", "16L AS partitions", "260L AS bytes")
    load = M.expected_load(config, "batch_ms", "rate", "partitions", "bytes")
    return load.select("p_partkey", "task_records", "stage_records", rounded("task_mib", 8), rounded("stage_mib", 8))


_NOW = 1_706_659_200_000
_WINDOW = 43_200_000
_SAMPLES = 4

# Greedy samples per point: each starts with the first record at least a window after the last start.
_LIVE = f"""WITH RECURSIVE {SENSOR},
  starts AS (SELECT pointId, min(time) AS s FROM sensor GROUP BY 1
    UNION ALL SELECT st.pointId, min(x.time) FROM starts st JOIN sensor x ON x.pointId = st.pointId AND x.time >= st.s + {_WINDOW} GROUP BY st.pointId, st.s),
  spans AS (SELECT pointId, s, lead(s, 1, 9223372036854775807) OVER (PARTITION BY pointId ORDER BY s) AS nxt FROM starts),
  rows AS (SELECT sp.pointId, s, value FROM spans sp JOIN sensor x ON x.pointId = sp.pointId AND time >= s AND time < nxt WHERE s > {_NOW - _SAMPLES * _WINDOW}),
  stats AS (SELECT p.pointId AS series, count(value) AS count, coalesce(sum(value), 0.0) AS sum, coalesce(avg(value), 0.0) AS avg,
      coalesce(min(value), 1.7976931348623157e308::DOUBLE) AS min, coalesce(max(value), '-inf'::DOUBLE) AS max, min(s) AS oldest_ms
    FROM (SELECT DISTINCT pointId FROM sensor) p LEFT JOIN rows USING (pointId) GROUP BY 1)"""


def _sampled(spark, sf):
    records = V.sensor(spark, sf)
    ordered = V.table(spark, sf, "events").select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("pointId"), "event_id",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("time"), "value")
    live = sampling.samples(ordered, "pointId", "event_id", "time", "value", _NOW, _SAMPLES, _WINDOW)
    return M.sampled_stats(live, records.select(F.col("pointId").alias("series")).distinct())


@query("mon_sampled_stats", f"""
  {_LIVE} SELECT series, count, round(sum, 4) AS sum, round(avg, 6) AS avg, min, max, oldest_ms FROM stats""")
def _(spark, sf):
    return _sampled(spark, sf).select("series", "count", rounded("sum"), rounded("avg", 6), "min", "max", "oldest_ms")


@query("mon_rate", f"""
  {_LIVE}, e AS (SELECT series, sum, {_NOW} - coalesce(oldest_ms, {_NOW}) AS e FROM stats),
  p AS (SELECT series, sum, e + greatest({_SAMPLES - 1} - e // {_WINDOW}, 0) * {_WINDOW} AS elapsed_ms, greatest(e, {_WINDOW}) AS simple_ms FROM e)
  SELECT series, round(sum, 4) AS sum, elapsed_ms, round(sum / (elapsed_ms / 60000.0), 8) AS rate, round(sum / (simple_ms / 1000.0), 8) AS simple_rate FROM p""")
def _(spark, sf):
    padded = M.sampled_rate(_sampled(spark, sf), _NOW, _SAMPLES, _WINDOW, "minutes")
    both = M.sampled_rate(padded, _NOW, _SAMPLES, _WINDOW, "seconds", True, "simple_rate", "simple_ms")
    return both.select(
        "series", rounded("sum"), "elapsed_ms", rounded("rate", 8), rounded("simple_rate", 8))


@query("mon_total_last", """
  SELECT event_type, event_id, sum(user_id) OVER (PARTITION BY event_type ORDER BY event_id)::BIGINT AS total,
    last_value(user_id) OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last FROM events""")
def _(spark, sf):
    events = V.table(spark, sf, "events").select("event_type", "event_id", "user_id")
    return M.total_and_last(events, ["event_type"], "event_id", "user_id").select("event_type", "event_id", "total", "last")
