"""Chunked windows give what a plain window gives, at chunk sizes that force many borders."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.aggregates import adjacency, nearest_rank, partition_profile
from tidemark.operators.limits import until_count
from tidemark.operators.positions import aborted_spans, read_committed
from tidemark.operators.windows import moving_average, position_delta
from tidemark.plans import ordering as O


@pytest.fixture(scope="module")
def series(spark):
    # One key holds two thirds of the rows; the ids of a key have gaps.
    rnd = random.Random(5)
    data = [("hot" if rnd.random() < 0.66 else f"k{rnd.randrange(4)}", i, rnd.randrange(20), rnd.choice([None, None, None, "A", "B"]))
            for i in range(600) if rnd.random() < 0.9]
    return spark.createDataFrame(data, "k string, o bigint, v bigint, c string").repartition(7).cache()


def by_key():
    return Window.partitionBy("k").orderBy("o")


@pytest.mark.parametrize("size", [1, 3, 16, 10_000])
def test_dense_index(series, rows, size):
    got = O.dense_index(series, ["k"], "o", O.id_chunk("o", size), "i")
    assert rows(got, "k", "o", "i") == rows(series.withColumn("i", F.row_number().over(by_key()) - 1), "k", "o", "i")


@pytest.mark.parametrize("size", [1, 7, 10_000])
def test_running_sum(series, rows, size):
    got = O.running_sum(series, ["k"], "o", "v", O.id_chunk("o", size), "s")
    assert rows(got, "k", "o", "s") == rows(series.withColumn("s", F.sum("v").over(by_key())), "k", "o", "s")


@pytest.mark.parametrize("size", [1, 7, 10_000])
def test_with_previous(series, rows, size):
    got = O.with_previous(series, ["k"], "o", "c", O.id_chunk("o", size), "p")
    assert rows(got, "k", "o", "p") == rows(series.withColumn("p", F.lag("c").over(by_key())), "k", "o", "p")


@pytest.mark.parametrize("size", [1, 7, 10_000])
def test_next_non_null(series, rows, size):
    got = O.next_non_null(series, ["k"], "o", "c", O.id_chunk("o", size), "n")
    plain = by_key().rowsBetween(Window.currentRow, Window.unboundedFollowing)
    want = series.withColumn("n", F.first("c", ignorenulls=True).over(plain))
    assert rows(got, "k", "o", "n") == rows(want, "k", "o", "n")


@pytest.mark.parametrize("size,back", [(5, 4), (8, 3), (10_000, 20)])
def test_trailing_mean(series, rows, size, back):
    indexed = series.withColumn("i", F.row_number().over(by_key()) - 1)
    got = O.trailing_mean(indexed, ["k"], "i", "v", back, "m", size)
    want = series.withColumn("m", F.avg("v").over(by_key().rowsBetween(-back, 0)))
    assert rows(got, "k", "o", "m") == rows(want, "k", "o", "m")


def test_range_chunks_follow_the_order(series):
    chunked = O.range_chunks(series.select("k", "o"), ["k", "o"], "c", 5)
    spans = chunked.groupBy("c").agg(F.min(F.struct("k", "o")).alias("a"), F.max(F.struct("k", "o")).alias("b"))
    spans = [(r["a"], r["b"]) for r in spans.orderBy("c").collect()]
    assert len(spans) > 1 and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_moving_average_and_delta_ignore_chunk_size(series, rows):
    a = moving_average(series, ["k"], "o", "v", 5, chunk_rows=8)
    b = moving_average(series, ["k"], "o", "v", 5)
    assert rows(a, "k", "o", "mean") == rows(b, "k", "o", "mean")
    assert rows(position_delta(series, ["k"], "o", "v", 8), "k", "o", "delta") == rows(
        position_delta(series, ["k"], "o", "v"), "k", "o", "delta")


def test_nearest_rank_against_sorted_lists(spark, series):
    shares = (0.0, 0.5, 0.95, 0.999)
    got = {(r["k"], r["p"]): r["value"] for r in nearest_rank(series, ["k"], "v", shares, 6).collect()}
    lists = {}
    for r in series.collect():
        lists.setdefault(r["k"], []).append(r["v"])
    assert got == {(k, p): sorted(v)[int(p * len(v))] for k, v in lists.items() for p in shares}


def test_lists_come_in_parts_and_stay_whole(spark):
    edges = spark.range(1000).selectExpr("'hub' AS src", "concat('n', id % 400) AS dst")
    parts = adjacency(edges, 50).collect()
    assert len(parts) == 8 and {len(p["neighbours"]) for p in parts} == {50}
    ordered = [x for p in sorted(parts, key=lambda p: p["part"]) for x in p["neighbours"]]
    assert ordered == sorted(f"n{i}" for i in range(400))
    assert sorted(x for p in parts for x in p["neighbours"]) == sorted(f"n{i}" for i in range(400))
    profile = partition_profile(edges.selectExpr("1 AS p", "dst"), "p", "dst", 100).collect()
    assert {(r["rows"], r["points"]) for r in profile} == {(1000, 400)} and sum(len(r["ids"]) for r in profile) == 400


def test_until_count_ignores_chunk_size(series, rows):
    batch = F.expr("o div 10")
    assert rows(until_count(series, batch, 100, 2), "o") == rows(until_count(series, batch, 100), "o")


def test_read_committed_is_a_subset_and_ignores_chunk_size(series, rows):
    log = series.selectExpr("'t' AS topic", "0 AS partition", "o AS offset", "k AS producer_id", "v > 3 AS is_transactional",
                            "CASE WHEN v > 3 THEN CASE c WHEN 'A' THEN 'COMMIT' WHEN 'B' THEN 'ABORT' END END AS control")
    small, large = rows(read_committed(log, 4), "offset"), rows(read_committed(log), "offset")
    assert small == large and set(small) < set(rows(log, "offset"))
    spans = rows(aborted_spans(log, 4), "producer_id", "first_offset", "last_offset")
    assert spans == rows(aborted_spans(log), "producer_id", "first_offset", "last_offset")
    hidden = {(r["producer_id"], r["offset"]) for r in log.where("is_transactional AND control IS NULL").collect()}
    shown = {(r["producer_id"], r["offset"]) for r in read_committed(log).where("is_transactional").collect()}
    assert all(not any(p == q and lo <= o <= hi for q, lo, hi in spans) for p, o in shown)
    assert all(any(p == q and lo <= o <= hi for q, lo, hi in spans) or o > max(
        (h for q, _, h in spans if q == p), default=-1) for p, o in hidden - shown)
