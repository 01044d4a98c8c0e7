"""Streams: equal to the batch result, replays, faults, restarts."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators import positions as P
from tidemark.sources import log as L
from tidemark.sources.jdbc import as_strings
from tidemark.streaming import batches as B
from tidemark.streaming import capture
from tidemark.streaming import delivery as D
from tidemark.streaming import ledger, runs, transactions
from tidemark.streaming import windows as W

LOG = "topic string, partition int, offset bigint, num double"


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def log_batches(spark, folder, n=4, size=25):
    """``n`` prepared batches of a two-partition log."""
    log = spark.range(n * size).selectExpr("'t' AS topic", "cast(id % 2 AS int) AS partition", "id AS offset",
                                           "cast(id AS double) AS num")
    files = B.prepare_batches(log, "offset", f"{folder}/in", n, n * size - 1)
    return B.batch_stream(spark, f"{folder}/in", log.withColumn("batch_key", F.lit(0)).schema, files)


def test_one_batch_per_trigger(spark, folder):
    seen = []
    runs.run_batches(log_batches(spark, folder), lambda d, i: seen.append(
        (i, d.count(), {r[0] for r in d.select("batch_key").distinct().collect()})), f"{folder}/cp")
    assert seen == [(i, 25, {i}) for i in range(4)]


def test_stream_equals_batch_over_several_triggers(spark, folder, rows):
    events = spark.range(400).selectExpr("timestamp_millis(id * 700) AS timestamp", "concat('w', id % 5) AS word",
                                         "id AS n", "id AS o")
    files = B.prepare_batches(events, "o", f"{folder}/in", 5, 399)
    stream = B.batch_stream(spark, f"{folder}/in", events.withColumn("batch_key", F.lit(0)).schema, files)
    got = runs.update_table(W.word_sliding(stream), ["window_start", "window_end", "word"], "t", f"{folder}/a")
    assert rows(got) == rows(W.word_sliding(events))
    got = runs.update_table(W.reduce_by_key_window(stream, "word", "n"), ["window_start", "window_end", "word"], "t", f"{folder}/b")
    assert rows(got) == rows(W.reduce_by_key_window(events, "word", "n"))
    counts = stream.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    assert rows(runs.complete_table(counts, "t", "word")) == [(f"w{i}", 80) for i in range(5)]


def test_watermark_is_optional_and_bounds_late_rows(spark, folder):
    events = spark.range(100).selectExpr("timestamp_millis(id * 1000) AS timestamp", "'w' AS word")
    events.write.parquet(f"{folder}/in")
    stream = B.batch_stream(spark, f"{folder}/in", events.schema)
    with_mark = W.word_sliding(stream, watermark="10 seconds")
    assert runs.update_table(with_mark, ["window_start", "window_end", "word"], "t", f"{folder}/a").count() == \
        W.word_sliding(events).count()


def test_replay_changes_nothing(spark, folder, rows):
    stream, out = log_batches(spark, folder), f"{folder}/out"
    write = D.exactly_once_writer(out)
    runs.run_batches(stream, write, f"{folder}/cp1")
    first = rows(D.delivered(spark, out), "offset", "num"), rows(D.stored_positions(spark, out))
    runs.run_batches(stream, write, f"{folder}/cp2")
    assert (rows(D.delivered(spark, out), "offset", "num"), rows(D.stored_positions(spark, out))) == first
    assert len(first[0]) == 100 and first[1] == [("t", 0, 99, None), ("t", 1, 100, None)]


def test_fault_between_rows_and_ledger(spark, folder, rows):
    stream, out = log_batches(spark, folder), f"{folder}/out"
    failing = {2}

    def fault(batch_id):
        if batch_id in failing:
            raise RuntimeError("lost before commit")

    write = D.exactly_once_writer(out, before_commit=fault)
    with pytest.raises(Exception, match="lost before commit"):
        runs.run_batches(stream, write, f"{folder}/cp")
    # Rows of the third batch are staged but nobody sees them.
    assert D.delivered(spark, out).count() == 50
    assert spark.read.option("recursiveFileLookup", True).parquet(f"{out}/rows").count() == 75
    failing.clear()
    runs.run_batches(stream, write, f"{folder}/cp")
    assert rows(D.delivered(spark, out), "offset") == sorted(((i,) for i in range(100)), key=lambda t: str(t[0]))


def test_aborted_batches_count_once(spark, folder):
    stream, out = log_batches(spark, folder, 5, 10), f"{folder}/out"
    runs.run_batches(stream, D.abort_every_other(out, lambda d: d.withColumn("num", F.col("num") + 1)), f"{folder}/cp")
    got = [r["num"] for r in D.delivered(spark, out).collect()]
    assert sorted(got) == [float(i + 1) for i in range(50)]


def test_unread_starts_at_stored_positions(spark, rows):
    log = spark.range(6).selectExpr("'t' AS topic", "cast(id % 2 AS int) AS partition", "id AS offset")
    held = spark.createDataFrame([("t", 0, 3)], "topic string, partition int, offset bigint")
    assert rows(D.unread(log, held), "offset") == [(1,), (3,), (4,), (5,)]


def test_resume_takes_up_pending_batches_in_order(spark, folder):
    stream, seen, limit = log_batches(spark, folder), [], {"n": 2}

    def write(batch, batch_id):
        if batch_id >= limit["n"]:
            raise RuntimeError("stopped here")
        seen.append((batch_id, batch.count()))

    with pytest.raises(Exception, match="stopped here"):
        runs.run_batches(stream, write, f"{folder}/cp")
    limit["n"] = 99
    runs.run_batches(stream, write, f"{folder}/cp")
    assert seen == [(i, 25) for i in range(4)]


def test_log_envelope_stream(spark, folder, rows):
    log = spark.sql("""SELECT 't' AS topic, 0 AS partition, 7L AS offset, timestamp_millis(5) AS timestamp, 0 AS timestampType,
        cast('k' AS binary) AS key, cast('v' AS binary) AS value, array(named_struct('key', 'h', 'value', X'31')) AS headers""")
    log.write.parquet(f"{folder}/in")
    got = B.each_batch_table(L.file_log_stream(spark, f"{folder}/in", 1), lambda d: d, f"{folder}/out")
    row = got.first()
    assert (row["offset"], bytes(row["value"]), row["headers"][0]["key"]) == (7, b"v", "h")


def test_rate_stream_and_driver_batches(spark, folder):
    from tidemark.operators.generate import word_line

    stream = B.rate_stream(spark, 7).select(word_line(F.col("value")).alias("line"))
    received = []

    def take(batch, batch_id):
        received.append((batch_id, batch.count()))

    query = stream.writeStream.option("checkpointLocation", f"{folder}/cp").foreachBatch(take).start()
    while len(received) < 3 and query.isActive:
        query.awaitTermination(1)
    query.stop()
    assert all(n == 7 for _, n in received[:3])


def test_console_sink_runs(spark, folder):
    stream = log_batches(spark, folder).groupBy("partition").count()
    query = runs.console(stream, f"{folder}/cp")
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None


def test_log_sink_needs_a_checkpoint(spark, folder):
    with pytest.raises(ValueError):
        runs.kafka_sink(spark.range(1), "h:1", "t", "")


def test_as_strings(spark):
    assert spark.range(1).transform(as_strings).dtypes == [("id", "string")]


@pytest.mark.parametrize("build,batch", [
    (lambda d: W.word_sliding(d, "5 seconds", "3 seconds", "20 seconds", True), lambda d: W.word_sliding(d, "5 seconds", "3 seconds")),
    (lambda d: W.reduce_by_key_window(d, "word", "n", "6 seconds", "4 seconds", "20 seconds", True),
     lambda d: W.reduce_by_key_window(d, "word", "n", "6 seconds", "4 seconds"))])
def test_panes_drop_state_and_late_rows(spark, rows, tmp_path, build, batch):
    """Windows of panes equal windows of rows; state stays small over many batches, and a row that comes too late is lost."""
    def part(a, b):
        return spark.range(a, b).selectExpr("cast(id % 3 AS string) AS word", "cast(id AS bigint) AS n",
                                            "timestamp_millis(1700000000000 + id * 500) AS timestamp")
    whole = part(0, 4000)
    for i in range(8):
        part(500 * i, 500 * i + 500).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    late = part(0, 40).coalesce(1)
    source = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    seen = []
    with capture.captured(spark, f"{tmp_path}/progress") as listener:
        held = listener.onQueryProgress
        listener.onQueryProgress = lambda e: (seen.append(sum(s.numRowsTotal for s in e.progress.stateOperators)), held(e))
        table = runs.closed_table(source, build, "timestamp", "panes", f"{tmp_path}/out")
    got = table.where("word is not null")
    first = rows(got)
    assert first == rows(batch(whole), *got.columns) and len(seen) > 8
    assert max(seen[1:]) < 1500  # of about 6000 panes and windows; one batch of 250 s is open, and 20 s before it
    assert max(seen[-1:]) < 20
    # After the end everything is late.
    late.write.mode("append").parquet(f"{tmp_path}/in")
    runs.closed_table(source, build, "timestamp", "panes", f"{tmp_path}/out")
    assert rows(spark.read.schema(table.schema).parquet(f"{tmp_path}/out/rows").where("word is not null"),
                *got.columns) == first


def test_nothing_delivered_yet(spark, folder):
    assert D.delivered(spark, folder, LOG).columns == ["topic", "partition", "offset", "num"]
    assert D.delivered(spark, folder).count() == D.stored_positions(spark, folder).count() == 0


def test_ledger_is_compacted_and_survives_crashes(spark, folder, monkeypatch):
    """Reads touch one snapshot and the commits after it; a crash before, within or after a switch changes nothing."""
    monkeypatch.setattr(ledger, "SNAPSHOT_EVERY", 5)
    book = ledger.Ledger(spark, f"{folder}/ledger")
    names = lambda: sorted(f.name.lstrip("0") for f in (Path(folder) / "ledger").iterdir() if f.name[0] != ".")
    for i in range(13):
        book.commit(book.state(), [f"f{i}"], [("t", i % 2, i + 1)])
    state = book.state()
    assert (state.version, state.folders) == (13, [f"f{i}" for i in range(13)])
    assert state.positions == {("t", 0): 13, ("t", 1): 12}
    assert names() == ["10.snapshot", "11.commit", "12.commit", "13.commit"]
    # Two writers from one state: the second one fails and leaves no trace.
    book.commit(state, ["a"], [("t", 0, 20)])
    with pytest.raises(Exception, match="(?i)exist"):
        book.commit(state, ["b"], [("t", 0, 21)])
    assert book.state().folders[-1] == "a" and len(list((Path(folder) / "ledger").glob(".*[!c]"))) <= 2
    # A crash before the snapshot is in place: the commit stands.
    def lost(*args):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(ledger.Ledger, "compact", lost)
        with pytest.raises(RuntimeError):
            book.commit(book.state(), ["c"], [("t", 0, 30)])
    assert book.state().version == 15 and "15.snapshot" not in names()
    # A crash between the switch and the removal: both are there, and read as one.
    with monkeypatch.context() as m:
        m.setattr(ledger.Ledger, "clean", lost)
        with pytest.raises(RuntimeError):
            book.compact()
    both = names()
    assert {"15.snapshot", "15.commit", "10.snapshot"} <= set(both)
    assert book.state().folders == [*(f"f{i}" for i in range(13)), "a", "c"] and book.state().version == 15
    book.commit(book.state(), ["d"], [("t", 1, 99)])
    book.clean()
    assert names() == ["15.snapshot", "16.commit"] and book.state().positions == {("t", 0): 30, ("t", 1): 99}


def test_committed_rows_come_out_over_batches_and_a_restart(spark, folder, rows):
    """Producers that take turns, transactions over several batches: what came out is what a batch over all would give."""
    log = spark.range(400).selectExpr(
        "'t' AS topic", "cast(id % 2 AS int) AS partition", "id AS offset", "(id * 7) % 5 AS producer_id", "id % 11 <> 3 AS is_transactional",
        "CASE WHEN id % 11 = 3 THEN null WHEN id % 23 = 5 THEN 'COMMIT' WHEN id % 31 = 9 THEN 'ABORT' END AS control", "id AS num")
    files = B.prepare_batches(log, "offset", f"{folder}/in", 5, 399, range(3))
    schema = log.withColumn("batch_key", F.lit(0)).schema

    def run():
        stream = B.batch_stream(spark, f"{folder}/in", schema, files).drop("batch_key")
        runs.run_batches(transactions.read_committed_stream(stream), lambda d, i: d.write.mode("overwrite").parquet(
            f"{folder}/out/batch_id={i}"), f"{folder}/cp")

    with transactions.keyed_state(spark):
        run()
        part = spark.read.schema(log.schema).parquet(f"{folder}/out").drop("batch_id")
        assert rows(part) == rows(P.read_committed(log.where("offset < 240")), *log.columns)
        B.prepare_batches(log, "offset", f"{folder}/in", 5, 399, range(3, 5))
        run()
    whole = spark.read.schema(log.schema).parquet(f"{folder}/out").drop("batch_id")
    assert rows(whole) == rows(P.read_committed(log), *log.columns) and 50 < whole.count() < 400


def test_producers_share_a_group_and_numbers_keep_their_digits(spark, folder, rows):
    """Many producers in two groups: a call serves many, and null numbers cost others no digit."""
    log = spark.range(300).selectExpr(
        "'t' AS topic", "cast(id % 2 AS int) AS partition", "id AS offset", "id % 30 AS producer_id", "true AS is_transactional",
        "CASE WHEN id % 70 > 45 THEN if(id % 3 = 0, 'ABORT', 'COMMIT') END AS control", "if(id % 4 = 1, null, 9007199254740993 + id) AS num")
    files = B.prepare_batches(log, "offset", f"{folder}/in", 2, 299)
    stream = B.batch_stream(spark, f"{folder}/in", log.withColumn("batch_key", F.lit(0)).schema, files).drop("batch_key")
    with transactions.keyed_state(spark):
        reports = runs.run_batches(transactions.read_committed_stream(stream, buckets=2), lambda d, i: d.write.mode(
            "overwrite").parquet(f"{folder}/out/batch_id={i}"), f"{folder}/cp")
    whole = spark.read.schema(log.schema).parquet(f"{folder}/out").drop("batch_id")
    assert rows(whole) == rows(P.read_committed(log), *log.columns) and whole.count() > 50
    assert len([p for p in reports if p["numInputRows"]]) == 2


def test_a_transaction_without_an_end_times_out(spark, folder):
    def part(i, rows):
        spark.createDataFrame([("t", 0, o, 1, True, c) for o, c in rows],
                              "topic string, partition int, offset long, producer_id long, is_transactional boolean, control string"
                              ).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    part(0, [(0, None), (1, None)])
    stream = spark.readStream.schema(spark.read.parquet(f"{folder}/in").schema).parquet(f"{folder}/in")
    out = []
    with transactions.keyed_state(spark):
        query = transactions.read_committed_stream(stream, 1500).writeStream.option(
            "checkpointLocation", f"{folder}/cp").foreachBatch(lambda d, i: out.extend(r.offset for r in d.collect())).start()

    def wait(done, seconds=30):
        until = time.monotonic() + seconds
        while time.monotonic() < until and query.isActive and not done():
            time.sleep(0.1)

    try:
        wait(lambda: any(p["numInputRows"] for p in query.recentProgress))
        wait(lambda: False, 4)  # the clock goes on without rows
        part(1, [(2, "COMMIT")])  # too late
        part(2, [(3, None), (4, "COMMIT")])
        wait(lambda: 3 in out)
    finally:
        query.stop()
    assert out == [3]


@pytest.mark.parametrize("stop", [0, 2])
def test_pending_batches_are_what_a_restart_runs(spark, folder, stop):
    stream, seen = log_batches(spark, folder), []

    def write(batch, batch_id):
        if batch_id == stop and not seen.count("again"):
            raise RuntimeError("between plan and commit")
        seen.append((batch_id, batch.count()))

    with pytest.raises(Exception, match="between plan and commit"):
        runs.run_batches(stream, write, f"{folder}/cp")
    pending = runs.pending_batches(spark, f"{folder}/cp").collect()
    assert [r["batch_id"] for r in pending] == [stop] and "logOffset" in pending[0]["offsets"][0] and pending[0]["batch_time"]
    known = {r["batch_id"]: r["committed"] for r in runs.planned_batches(spark, f"{folder}/cp").collect()}
    assert known == {i: i < stop for i in range(stop + 1)}
    seen[:] = ["again"]
    runs.run_batches(stream, write, f"{folder}/cp")
    assert seen == ["again", *((i, 25) for i in range(stop, 4))]
    assert runs.pending_batches(spark, f"{folder}/cp").isEmpty()
