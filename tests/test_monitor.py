"""Figures from a real event log and from sampled series."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import monitor as M
from tidemark.operators import sampling
from tidemark.streaming import batches as B
from tidemark.streaming import capture, runs


def greedy(events, now, n, window, limit):
    """Live samples of one series by walking through its records."""
    out = []
    for t, v in events:
        if not out or t - out[-1][0] >= window or (limit and out[-1][1] >= limit):
            out.append([t, 0, 0.0, float("inf"), float("-inf")])
        s = out[-1]
        s[1:] = [s[1] + 1, s[2] + v, min(s[3], v), max(s[4], v)]
    return [tuple(s) for s in out[-n:] if now - s[0] < n * window]


@pytest.mark.parametrize("limit", [None, 1, 4])
@pytest.mark.parametrize("chunk_rows,partitions", [(7, 3), (1 << 18, 40)])
def test_samples_against_a_walk(spark, limit, chunk_rows, partitions):
    rnd = random.Random(3)
    data, lists = [], {}
    for name in "abc":
        t = 0
        for o in range(120):
            t += rnd.choice([0, 1, 2, 5, 9, 40])
            v = float(rnd.randrange(50))
            data.append((name, o, t, v))
            lists.setdefault(name, []).append((t, v))
    now = max(d[2] for d in data) - 3
    lists["a"] = [(t, v) for t, v in lists["a"] if t < now]
    data = [d for d in data if d[0] != "a" or d[2] < now]
    df = spark.createDataFrame(data, "s string, o bigint, t bigint, v double").repartition(6)
    got = sampling.samples(df, "s", "o", "t", "v", now, 3, 20, limit, chunk_rows, partitions)
    found = {}
    for r in got.collect():
        found.setdefault(r["series"], []).append((r["start_ms"], r["count"], r["sum"], r["min"], r["max"]))
    want = {k: greedy(v, now, 3, 20, limit) for k, v in lists.items()}
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items() if v}


@pytest.mark.parametrize("limit", [None, 1, 3, 50])
def test_functions_of_chunks_compose(limit):
    """What chunks do one after the other is what all their records do, for every sample that may be open before."""
    rnd = np.random.default_rng(4)
    for pause in (0, 1, 4, 30):
        t = np.cumsum(rnd.integers(0, pause + 1, 200))
        order, window = np.arange(200) * 3, 17
        whole = sampling.Steps.of(t, order, window, limit)
        for cuts in ([100], [1, 2, 3], sorted(rnd.choice(199, 30, replace=False) + 1)):
            parts = [sampling.Steps.of(t[a:b], order[a:b], window, limit) for a, b in zip([0, *cuts], [*cuts, 200])]
            made = parts[0]
            for part in parts[1:]:
                made = made.then(part, window, limit)
            assert made.size == 200 and made.through == whole.through
            for start in range(int(t[0]) - 2 * window, int(t[0]) + 1):
                for age in (1, 2, 49, 200):
                    if limit and age > limit:
                        continue
                    steps = [int(x.find(start, -age, window, limit)) for x in (whole, made)]
                    ends = [x.start_order[i] if i < len(x.end_t) else None for x, i in zip((whole, made), steps)]
                    assert ends[0] == ends[1]


def test_a_series_without_a_pause_uses_all_chunks(spark):
    """One hot series, a record a millisecond: many tasks sum it, and the plain walk agrees."""
    n = 60_000
    df = spark.range(n).selectExpr("'hot' AS s", "id AS o", "id AS t", "cast(id % 97 AS double) AS v")
    got = sampling.samples(df, "s", "o", "t", "v", n + 10, 2000, 250, None, 1000, 32)
    found = sorted((r["start_ms"], r["count"], r["sum"], r["min"], r["max"]) for r in got.collect())
    assert found == greedy([(i, float(i % 97)) for i in range(n)], n + 10, 2000, 250, None)
    chunked = sampling.range_chunks(df, ["s", "o"], "c", 32)
    assert chunked.groupBy("c").count().count() > 16


def test_stats_without_samples(spark):
    empty = spark.createDataFrame([], "series string, start_ms bigint, count bigint, sum double, min double, max double")
    row = M.sampled_stats(empty, spark.createDataFrame([("s",)], "series string")).first()
    assert (row["avg"], row["count"], row["max"], row["min"]) == (0.0, 0, float("-inf"), 1.7976931348623157e308)


def test_own_event_log(spark, event_log_dir):
    spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("k")).count().collect()
    with pytest.raises(Exception, match="by hand"):
        spark.range(1).select(F.raise_error(F.lit("failed by hand"))).collect()
    events = M.parse_events(M.read_event_log(spark, event_log_dir), ["app"]).cache()
    tasks = M.task_metrics(events, ["app"])
    assert len(tasks.columns) == 1 + 29
    good = tasks.where("success AND taskType = 1 AND launchTime > 0 AND executorRunTime >= 0 AND duration >= 0")
    assert not good.isEmpty() and tasks.select("taskAttemptKey").distinct().count() == tasks.count()
    failed = M.task_failures(events, ["app"]).where(F.col("errorMessage").contains("failed by hand"))
    assert not failed.isEmpty() and failed.first()["reasonMsg"].startswith("TaskFailed: ")
    stages = M.stage_rates(events, ["app"], 1000, 1.0, 5, 2)
    assert not stages.isEmpty() and stages.where("rate <= 0").isEmpty()
    assert not M.job_rates(events, ["app"], 1000, 1.0, 5, 2).isEmpty()
    events.unpersist()


def test_batch_rows_from_progress(spark, tmp_path):
    df = spark.range(40).selectExpr("id", "id AS o")
    files = B.prepare_batches(df, "o", f"{tmp_path}/in", 2, 39)
    stream = B.batch_stream(spark, f"{tmp_path}/in", df.withColumn("batch_key", F.lit(0)).schema, files)
    progress = runs.run_batches(stream, lambda d, i: d.count(), f"{tmp_path}/cp")
    table = M.batch_metrics(M.progress_rows(spark, [p for p in progress if p["numInputRows"]]), 2.0)
    got = table.orderBy("batch_no").collect()
    assert [(r["batch_no"], r["num_records"]) for r in got] == [(0, 20), (1, 20)]
    assert all(r["total_ms"] >= r["processing_ms"] >= 0 and r["records_per_s"] > 0 for r in got)
    info = M.batch_info(M.progress_rows(spark, progress))
    assert info.columns == ["batch_time", "processing_start_time", "processing_end_time", "num_records"]


def test_every_batch_is_captured(spark, tmp_path):
    """More batches than a query keeps reports of; each has one row."""
    df = spark.range(120).selectExpr("id", "id AS o")
    files = B.prepare_batches(df, "o", f"{tmp_path}/in", 12, 119)
    schema = df.withColumn("batch_key", F.lit(0)).schema
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        with capture.captured(spark, f"{tmp_path}/batches", 7):
            stream = B.batch_stream(spark, f"{tmp_path}/in", schema, files)
            watched = stream.observe("seen", F.count(F.lit(1)).alias("rows"), F.max("id").alias("last"))
            kept = runs.run_batches(watched, lambda d, i: d.write.mode("append").parquet(f"{tmp_path}/out"), f"{tmp_path}/cp")
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    table = capture.captured_batches(spark, f"{tmp_path}/batches")
    got = sorted((r["batch_no"], r["num_records"], json.loads(r["observed"])["seen"]["last"]) for r in table.collect())
    assert len(kept) <= 3 and got == [(i, 10, 10 * i + 9) for i in range(12)]
    assert M.batch_metrics(table, 2.0).where("total_ms < processing_ms OR records_per_s <= 0").isEmpty()
    # Outside the block nothing is written down.
    runs.run_batches(B.batch_stream(spark, f"{tmp_path}/in", schema, files), lambda d, i: d.count(), f"{tmp_path}/cp2")
    assert capture.captured_batches(spark, f"{tmp_path}/batches").count() == 12
