"""Whole subscriptions, logs with gaps, tables in parts, restarted delivery, and code that travels by value."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from tests.compare import connect, difference
from tests.test_streams import LOG
from tidemark.operators import aggregates, joins, positions, transforms
from tidemark.operators import monitor as M
from tidemark.session import scratch, scratch_path
from tidemark.streaming import batches as B
from tidemark.streaming import delivery as D
from tidemark.streaming import runs
from tidemark.streaming.windows import pack_means

SF_DIR = "/root/testdata/sf0.001"
STREAMS = [n for n in queries() if n.startswith(("stream_", "sink_stream_")) and n != "stream_rate_plan"] + ["src_log_stream"]


@pytest.fixture(scope="module")
def parts_dir(spark, tmp_path_factory):
    """The tables with ``events`` as a folder of three part files."""
    path = tmp_path_factory.mktemp("parts")
    for name in os.listdir(SF_DIR):
        if name != "events.parquet":
            os.symlink(f"{SF_DIR}/{name}", f"{path}/{name}")
    spark.read.parquet(f"{SF_DIR}/events.parquet").repartition(3).write.parquet(f"{path}/events.parquet")
    return str(path)


@pytest.mark.parametrize("name", STREAMS)
def test_streams_read_a_folder_of_parts(spark, parts_dir, name):
    assert difference(queries()[name](spark, parts_dir), connect(SF_DIR), oracle_sql()[name]) == ""


def test_streams_without_a_file_give_empty_tables(spark, tmp_path):
    stream = spark.readStream.schema(LOG).parquet(str(tmp_path))
    assert B.each_batch_table(stream, lambda d: d, f"{tmp_path}-out").count() == 0
    assert runs.complete_table(stream.groupBy("topic").count(), "none").count() == 0


def log_rows(spark, upto):
    return spark.range(upto).selectExpr("'t' AS topic", "cast(id % 2 AS int) AS partition", "id AS offset", "id * 1D AS num")


@pytest.mark.parametrize("files", [1, 3, 8])
def test_lost_checkpoint_new_rows_and_other_batches(spark, tmp_path, files):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    write = D.exactly_once_writer(out)
    per_batch = B.prepare_batches(log_rows(spark, 20), "offset", source, 2, 19)
    schema = log_rows(spark, 1).withColumn("batch_key", F.lit(0)).schema
    runs.run_batches(B.batch_stream(spark, source, schema, per_batch), write, f"{tmp_path}/cp-0")
    B.prepare_batches(log_rows(spark, 40), "offset", source, 4, 39, range(2, 4))
    runs.run_batches(B.batch_stream(spark, source, schema, 4 * files), write, f"{tmp_path}/cp-1")
    assert sorted(r.offset for r in D.delivered(spark, out).collect()) == list(range(40))
    assert sorted((r.partition, r.offset) for r in D.stored_positions(spark, out).collect()) == [(0, 39), (1, 40)]


def test_parts_follow_the_order_of_the_key(spark):
    means = spark.range(10).selectExpr("'a' AS asset", "timestamp_millis(id * 1000) AS startTime", "cast(id AS string) AS v")
    got = [(r.part, r.avgValues) for r in pack_means(means, F.col("v"), 4).orderBy("part").collect()]
    assert got == [(0, "0 1 2 3"), (1, "4 5 6 7"), (2, "8 9")]
    nodes = spark.createDataFrame([(None, "b"), (None, "a"), ("x", "c")], "src string, dst string")
    assert sorted(map(str, aggregates.adjacency(nodes, 1).collect())) == sorted(
        ["Row(src=None, part=0, neighbours=['a'])", "Row(src=None, part=1, neighbours=['b'])", "Row(src='x', part=0, neighbours=['c'])"])


def test_rate_reset_and_commits_span_topics(spark, rows):
    at = spark.createDataFrame([("a", 0, 0), ("b", 0, 0)], "topic string, partition int, offset bigint")
    ends = spark.createDataFrame([("a", 0, 1000), ("b", 0, 3000)], "topic string, partition int, end bigint")
    assert rows(positions.rate_plan(at, ends, 1000, rate=100), "topic", "until") == [("a", 25), ("b", 75)]
    ranges = spark.createDataFrame([("a", 0, 0, 50), ("b", 0, 0, 5)], "topic string, partition int, `from` bigint, until bigint")
    begins = spark.createDataFrame([("a", 0, 1), ("b", 0, 2)], "topic string, partition int, begin bigint")
    assert rows(positions.replay_when_past(ranges, begins, 20), "topic", "offset") == [("a", 1), ("b", 2)]
    assert rows(positions.replay_when_past(ranges, begins, 99), "topic", "offset") == [("a", 50), ("b", 5)]


@pytest.mark.parametrize("chunk", [7, 1000])
def test_commits_count_rows_of_logs_with_gaps(spark, rows, chunk):
    log = spark.range(267).selectExpr("'t' AS topic", "0 AS partition", "id * 3 AS offset")
    assert rows(positions.commit_groups(log, 50, 200, chunk_rows=chunk), "rows", "next_offset", "committed") == [
        (200, 598, True), (67, 799, False)]
    two = spark.range(250).selectExpr("'t' AS topic", "cast(id % 2 AS int) AS partition", "id div 2 * 5 AS offset", "id AS seen")
    got = rows(positions.commit_groups(two, 50, 200, "seen", chunk), "partition", "commit_no", "rows", "committed")
    assert got == [(0, 0, 100, True), (0, 1, 25, False), (1, 0, 100, True), (1, 1, 25, False)]


def test_template_points_drop_trailing_empty_parts(spark, rows):
    text = '{"orgId":"o","assets":["x"],"modelAndPoints":[{"inputPoint":"a::b::"},{"inputPoint":"a::"},{"inputPoint":"c::d"},{"inputPoint":"e::f::g"}]}'
    df = spark.createDataFrame([(1, text)], "id int, value string")
    assert rows(joins.template_records(df, ["id"]), "modelId", "pointId") == [("a", "b"), ("c", "d")]


def test_user_functions_and_filter(spark, rows):
    df = spark.createDataFrame([(1, "a b"), (2, "c")], "id int, text string")
    assert rows(transforms.map_values(df, lambda s: s.str.upper(), "text", "up", "string", ["id"])) == [(1, "A B"), (2, "C")]
    assert rows(transforms.filter_rows(df, lambda s: s.str.len() > 1, "text"), "id") == [(1,)]
    assert rows(transforms.flat_map_values(df, lambda s: s.str.split(), "text", "word", "string", ["id"])) == [
        (1, "a"), (1, "b"), (2, "c")]


def test_a_flat_map_gets_its_texts_in_bounded_slices(spark):
    """Long texts of one batch: no slice holds much more than the bound, and every text comes out once."""
    texts = spark.range(0, 120, 1, 1).selectExpr("id", "if(id % 40 = 7, null, repeat('ab ', 20000)) AS text")
    taken = transforms.flat_map_values(texts, lambda s: s.map(lambda _: [s.str.len().sum()]), "text", "held", "long", ["id"]).collect()
    assert sorted(r["id"] for r in taken) == list(range(120))
    assert 0 < max(r["held"] for r in taken) <= transforms.SLICE_BYTES + 60_000
    short = spark.range(0, 9000, 1, 1).selectExpr("id", "cast(id AS string) AS text")
    flat = transforms.flat_map_values(short, lambda s: s.map(lambda t: [t, t]), "text", "item", "string", ["id"])
    assert flat.count() == 18_000 and flat.where("item <> cast(id AS string)").isEmpty()


def stage_event(stage, start, end):
    return (f'{{"Event":"SparkListenerStageCompleted","Stage Info":{{"Stage ID":{stage},"Stage Attempt ID":0,"Number of Tasks":1,'
            f'"Submission Time":{start},"Completion Time":{end}}}}}')


def test_means_follow_completion_and_count_ended_jobs(spark):
    lines = ['{"Event":"SparkListenerJobStart","Job ID":%d,"Submission Time":0}' % j for j in range(3)]
    lines += ['{"Event":"SparkListenerJobEnd","Job ID":%d,"Completion Time":%d,"Job Result":{"Result":"%s"}}' % x
              for x in ((0, 50, "JobFailed"), (1, 100, "JobSucceeded"), (2, 5000, "JobSucceeded"))]
    lines += [stage_event(1, 0, 1000), stage_event(2, 0, 2000), stage_event(0, 0, 10_000), stage_event(5, 10, 60)]
    events = M.parse_events(spark.createDataFrame([("a", x) for x in lines], "app string, value string"), ["app"])
    means = {r.stage_id: (r.rate, r.mean_rate) for r in M.stage_rates(events, ["app"], 1000, 1.0, 5, 1).collect()}
    assert means == {5: (20_000.0, 0.0), 1: (1000.0, 1000.0), 2: (500.0, 750.0), 0: (100.0, 533.333)}
    jobs = {r.job_id: (r.rate, r.mean_rate) for r in M.job_rates(events, ["app"], 1000, 1.0, 5, 1).collect()}
    assert jobs == {1: (10_000.0, 10_000.0), 2: (200.0, 5100.0)}


def test_rates_parse_a_line_once_and_agree_with_a_loop(spark):
    """Both rates read stored events; jobs that end together, failed ones and two applications as a loop has them."""
    ends = [(100 + j // 3 * 10, j) for j in range(40)]
    done = [(100 + s % 20 * 10, s) for s in range(40)]
    lines = ['{"Event":"SparkListenerJobStart","Job ID":%d,"Submission Time":0}' % j for _, j in ends]
    lines += ['{"Event":"SparkListenerJobEnd","Job ID":%d,"Completion Time":%d,"Job Result":{"Result":"%s"}}' % (
        j, at, "JobSucceeded" if j % 4 else "JobFailed") for at, j in ends]
    lines += [stage_event(s, 0, at) for at, s in done]
    parsed = M.parse_events(spark.createDataFrame([(a, x) for a in "ab" for x in lines], "app string, value string"), ["app"])
    events = M.stored_events(parsed)
    assert "from_json" in parsed._jdf.queryExecution().toString() and "from_json" not in events._jdf.queryExecution().toString()

    def loop(items, ended):
        out, seen = {}, []
        for place, (at, number) in enumerate(items):
            if ended(place, at) > 5:
                seen.append(round(1e6 / at, 2))
            out[number] = sum(seen[-3:]) / len(seen[-3:]) if seen else 0.0
        return out
    stages = loop(sorted(done), lambda place, at: sum(e < at for e, _ in ends))
    good = [e for e in ends if e[1] % 4]
    jobs = loop(good, lambda place, at: ends.index(good[place]) + 1)
    for got, number, want in ((M.stage_rates(events, ["app"], 1000, 1.0, 2, 5), "stage_id", stages),
                              (M.job_rates(events, ["app"], 1000, 1.0, 2, 5), "job_id", jobs)):
        means = {(r["app"], r[number]): r["mean_rate"] for r in got.collect()}
        assert means == pytest.approx({(a, k): v for a in "ab" for k, v in want.items()}, abs=0.00051)


def test_lag_up_to_the_last_stable_offset(spark, rows):
    ends = spark.createDataFrame([("t", 0, 10, 6), ("t", 1, 8, 8)], "topic string, partition int, high_watermark long, last_stable long")
    at = spark.createDataFrame([("t", 0, 4), ("t", 1, 8), ("t", 2, 1)], "topic string, partition int, offset long")
    assert rows(positions.consumer_lag(ends, at), "partition", "lag", "max_lag") == [(0, 6, 6), (1, 0, 6), (2, None, 6)]
    assert rows(positions.consumer_lag(ends, at, True), "partition", "lag", "max_lag") == [(0, 2, 2), (1, 0, 2), (2, None, 2)]


def test_scratch_tables_go_with_their_block(spark):
    with scratch(spark) as folder:
        path = scratch_path(spark, "mine")
        spark.range(3).write.parquet(path)
        assert path.startswith(folder) and spark.read.parquet(path).count() == 3
    assert not os.path.exists(folder.removeprefix("file:"))
    assert not scratch_path(spark, "mine").startswith(folder)


def test_building_a_chain_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("no-jobs", "building only")
    transforms.chain(spark.range(100).groupBy("id").count(), [lambda d: d.where("id > 3")] * 3, 5)
    assert tracker.getJobIdsForGroup("no-jobs") == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_key_hash_runs_where_the_package_is_unknown(tmp_path):
    """Workers start in another folder and have no path to the package."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (f"import sys; sys.path.insert(0, {root!r})\n"
            "from tidemark.session import build_session\nfrom __spark_entry__ import queries\n"
            f"s = build_session('away', 2, 2)\nprint('rows', queries()['fn_key_partition'](s, {SF_DIR!r}).count())\n"
            f"queries()['fn_key_partition'](s, {SF_DIR!r}).write.format('noop').mode('overwrite').save()\nprint('done')\n")
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_CONF_DIR")}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "done" in out.stdout, out.stderr[-2000:]
