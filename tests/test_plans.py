"""Shape of the physical plans that must hold at scale."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregates as A
from tidemark.operators import positions as P
from tidemark.plans import views as V
from tidemark.plans.bindings import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


# Streams are run by building their query, so they have no plan of their own to look at.
STREAMED = ("stream_", "log_exactly", "log_consume_", "src_one", "src_log_stream", "src_line_stream", "sink_", "graph")
BATCH = [n for n in QUERIES if not n.startswith(STREAMED) or n == "stream_rate_plan"]


@pytest.mark.parametrize("name", BATCH)
def test_no_pairs_of_everything(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in text


def test_scan_reads_only_what_is_used(spark):
    text = plan(A.tumbling_records(V.sensor(spark, SF_DIR)))
    assert "props" not in re.findall(r"ReadSchema: (.*)", text)[0]
    text = plan(V.table(spark, SF_DIR, "events").where("event_id < 10").select("user_id"))
    assert "LessThan(event_id,10)" in text and "ReadSchema: struct<event_id:bigint,user_id:bigint>" in text


def test_label_keeps_few_rows_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(A.tumbling_records(V.sensor(spark, SF_DIR)))


def test_simple_aggregates_combine_before_one_shuffle(spark):
    for name in ("agg_word_count", "agg_by_point", "agg_histogram_constant", "agg_throughput_report", "agg_retention_summary"):
        text = plan(QUERIES[name](spark, SF_DIR))
        tree = text.split("\n\n")[0]
        assert tree.count("Exchange") - tree.count("BroadcastExchange") <= 2 and "SortAggregate" not in tree


def test_parse_runs_once(spark):
    text = plan(QUERIES["proj_record7"](spark, SF_DIR))
    assert len(re.findall(r"explode\(array\(from_json|from_json\(", text)) <= 2 and "Generate" in text


def test_range_count_reads_no_log(spark):
    ranges = spark.createDataFrame([("t", 0, 1, 5)], "topic string, partition int, `from` bigint, until bigint")
    assert "FileScan" not in plan(P.range_count(ranges))


def test_word_count_stays_in_the_jvm(spark):
    text = plan(V.words(spark, SF_DIR).groupBy("word").agg(F.count(F.lit(1))))
    assert "Python" not in text and "HashAggregate" in text


def test_tumbling_aggregate_reads_its_table_once(spark):
    df = A.tumbling_records(V.sensor(spark, SF_DIR))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in final and final.count("FileScan") == 1


def test_small_scans_are_not_dealt_anew(spark):
    for name in ("proj_record7", "agg_word_count", "mon_task_metrics", "join_sample_payload"):
        assert "REPARTITION" not in plan(QUERIES[name](spark, SF_DIR))
