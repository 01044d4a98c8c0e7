"""Streams over the given tables. Each query reads files as a stream until all are used."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import generate as G
from tidemark.plans import views as V
from tidemark.plans.catalog import (BATCH_KEYS, SENSOR, WORDS, ms, query, rounded, windows_sql)
from tidemark.plans.bind_aggregates import draw_sql
from tidemark.plans.bind_positions import READ_COMMITTED, transactional
from tidemark.functions.scalar import split_java
from tidemark.schemas import EVENTS
from tidemark.session import scratch_path, use_utc
from tidemark.sources import files
from tidemark.sources.log import to_log_rows
from tidemark.streaming import batches as B
from tidemark.streaming import delivery as D
from tidemark.streaming import runs
from tidemark.streaming import transactions as X
from tidemark.streaming import windows as W


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    # A pattern matches the table whether it is one file or a folder of parts.
    stream = spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/events.parque[t]")
    return stream.withColumn("timestamp", F.col("ts").cast("timestamp"))


def _values(spark, sf):
    return event_stream(spark, sf).select(F.col("timestamp").alias("time"), "value",
                                          F.concat(F.lit("asset_"), F.col("user_id") % 20).alias("asset"))


def _words(spark, sf):
    return W.line_words(event_stream(spark, sf), "event_type")


def _timed(spark, sf, label):
    """``events`` as a stream of four batches that follow the time."""
    events = V.table(spark, sf, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("timestamp"))
    seconds = F.unix_seconds("timestamp")
    ends = events.agg(F.min(seconds), F.max(seconds)).first()
    events = events.withColumn("second", seconds - (ends[0] or 0))
    path = f"{scratch_path(spark, label)}/in"
    per_batch = B.prepare_batches(events, "second", path, 4, (ends[1] or 0) - (ends[0] or 0))
    return B.batch_stream(spark, path, events.withColumn("batch_key", F.lit(0)).schema, per_batch).drop("second", "batch_key")


# ---------------------------------------------------------------- sources


@query("src_log_stream", """SELECT event_id, props AS value, epoch_us(ts) // 1000 AS "timestamp" FROM events""")
def _(spark, sf):
    stream = event_stream(spark, sf).select("event_id", F.col("props").alias("value"), "timestamp")
    return B.each_batch_table(stream, lambda d: d, scratch_path(spark, "log-stream")).select(
        "event_id", "value", ms("timestamp"))


@query("src_line_stream", f"WITH {WORDS} SELECT word, count(*) AS count FROM words GROUP BY ALL")
def _(spark, sf):
    path = scratch_path(spark, "lines")
    # Line breaks are no blanks: keep them inside one line by an escape and undo it after the read.
    lines = V.table(spark, sf, "documents").select(F.replace("text", F.lit("\n"), F.lit("\u0001")).alias("value"))
    files.write_text(lines, f"{path}/in")
    back = B.text_stream(spark, f"{path}/in").select(F.replace("value", F.lit("\u0001"), F.lit("\n")).alias("value"))
    counts = back.select(F.explode(split_java(F.col("value"))).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("count"))
    return runs.update_table(counts, ["word"], "line-counts")


def _prepared(spark, sf, label, path=None, numbers=range(4)):
    """``events`` as four prepared batches; gives the stream and the folder."""
    events = V.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    top = events.agg(F.max("event_id")).first()[0]
    path = path or scratch_path(spark, label)
    per_batch = B.prepare_batches(events, "event_id", f"{path}/in", 4, top, numbers)
    schema = events.withColumn("batch_key", F.lit(0)).schema
    return B.batch_stream(spark, f"{path}/in", schema, per_batch), path


@query("src_one_batch_per_trigger", f"""
  WITH {BATCH_KEYS} SELECT batch_key::INT AS batch_key, count(*) AS rows, sum(user_id)::BIGINT AS users, 1::BIGINT AS triggers FROM keyed GROUP BY 1""")
def _(spark, sf):
    stream, path = _prepared(spark, sf, "one-batch")
    rows = B.each_batch_table(stream, lambda d: d.groupBy("batch_key").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("user_id").alias("users")), path)
    return rows.groupBy("batch_key").agg(F.sum("rows").alias("rows"), F.sum("users").alias("users"),
                                         F.count_distinct("batch_id").alias("triggers"))


def words_sql(number: str, seed: int) -> str:
    """operators.generate.word_line in SQL."""
    words = "[" + ",".join(f"'{w}'" for w in G.WORDS) + "]"
    bound = draw_sql(f"({number}) * 16 + x", seed, 8)
    pick = draw_sql(f"({number}) * 16 + y", seed + 1, 10)
    length = f"list_min(list_filter(range(10), lambda x: x >= {bound} + 2))"
    return f"array_to_string(list_transform(range(1, {length} + 1), lambda y: {words}[{pick} + 1]), ' ')"


@query("src_fixed_rate", f"""
  WITH m AS (SELECT DISTINCT (epoch_us(ts) // 1000) // 60000 * 60000 AS start FROM events),
  r AS (SELECT start, unnest(range(3)) AS i FROM m)
  SELECT start, i::VARCHAR AS "key", {words_sql('(start // 1000) * 3 + i', 0)} AS value FROM r""")
def _(spark, sf):
    # Starts of intervals come as a stream, and each lets so many rows out.
    path = scratch_path(spark, "fixed-rate")
    minutes = V.sensor(spark, sf).select(F.expr("time div 60000 * 60000").alias("start")).distinct()
    minutes.write.parquet(f"{path}/in")
    stream = G.fixed_rate(B.batch_stream(spark, f"{path}/in", minutes.schema, 4), "start", 3)
    return B.each_batch_table(stream, lambda d: d, path).drop("batch_id")


# ---------------------------------------------------------------- sinks


@query("sink_stream_console", "SELECT event_type AS word, count(*) AS count FROM events GROUP BY 1")
def _(spark, sf):
    # The console sink itself prints; the same Complete mode result is kept as a table here.
    counts = _words(spark, sf).groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    return runs.complete_table(counts, "complete", "word")


_MEAN = windows_sql("sensor", 6_000_000, 3_000_000, 'assetId AS asset, value')


@query("sink_stream_log", f"""
  WITH {SENSOR}, w AS ({_MEAN})
  SELECT asset || '-' || (ws // 1000) AS "key", CAST(CAST(avg(value) AS DECIMAL(18,9)) AS VARCHAR) AS value FROM w GROUP BY ws, asset""")
def _(spark, sf):
    means = W.mean_by_asset(_values(spark, sf))
    rows = to_log_rows(means, F.concat_ws("-", "asset", F.unix_millis("startTime").cast("string")),
                       F.col("avgValue").cast("decimal(18,9)"))
    return runs.update_table(rows, ["key"], "log-rows")


@query("sink_driver_batches", f"""
  WITH {BATCH_KEYS} SELECT event_type, batch_key AS batch_id, count(*) AS n FROM keyed GROUP BY ALL""")
def _(spark, sf):
    stream, path = _prepared(spark, sf, "driver")
    received = []
    B.driver_batches(stream, lambda d: d.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")),
                     lambda batch_id, rows: received.extend((r["event_type"], batch_id, r["n"]) for r in rows),
                     f"{path}/checkpoint")
    return spark.createDataFrame(received, "event_type string, batch_id bigint, n bigint")


# ---------------------------------------------------------------- event-time aggregates


@query("stream_word_sliding", f"""
  WITH w AS ({windows_sql('events', 5_000_000, 3_000_000, 'event_type AS word')})
  SELECT ws // 1000 AS window_start, ws // 1000 + 5000 AS window_end, word, count(*) AS count FROM w GROUP BY ALL""")
def _(spark, sf):
    table = runs.update_table(W.word_sliding(_words(spark, sf)), ["window_start", "window_end", "word"], "words")
    return table.select(ms("window_start"), ms("window_end"), "word", "count")


@query("stream_sum_max_sliding", f"""
  WITH w AS ({windows_sql('events', 6_000_000, 3_000_000, 'value')})
  SELECT ws // 1000 AS window_start, ws // 1000 + 6000 AS window_end, round(sum(value), 4) AS sum, max(value) AS max FROM w GROUP BY ws""")
def _(spark, sf):
    table = runs.update_table(W.sum_max_sliding(_values(spark, sf)), ["window_start", "window_end"], "sum-max")
    return table.select(ms("window_start"), ms("window_end"), rounded("sum"), "max")


@query("stream_mean_by_asset", f"""
  WITH {SENSOR}, w AS ({_MEAN}) SELECT ws // 1000 AS "startTime", asset, round(avg(value), 6) AS "avgValue" FROM w GROUP BY ALL""")
def _(spark, sf):
    table = runs.update_table(W.mean_by_asset(_values(spark, sf)), ["startTime", "asset"], "means")
    return table.select(ms("startTime"), "asset", rounded("avgValue", 6))


@query("stream_pack_means", f"""
  WITH {SENSOR}, w AS ({windows_sql('sensor', 86_400_000_000, 43_200_000_000, 'assetId AS asset, value')}),
  m AS (SELECT asset, ws, CAST(CAST(avg(value) AS DECIMAL(18,9)) AS VARCHAR) AS v FROM w GROUP BY ALL),
  p AS (SELECT *, (row_number() OVER (PARTITION BY asset ORDER BY ws) - 1) // 100000 AS part FROM m)
  SELECT asset || '-' || strftime(make_timestamp(min(ws)), '%Y-%m-%d %H:%M:%S') AS "key", part::INT AS part,
         string_agg(v, ' ' ORDER BY ws) AS "avgValues" FROM p GROUP BY asset, part""")
def _(spark, sf):
    means = runs.update_table(W.mean_by_asset(_values(spark, sf), "24 hours", "12 hours"), ["startTime", "asset"], "to-pack")
    return W.pack_means(means, F.col("avgValue").cast("decimal(18,9)").cast("string"))


_20_10 = windows_sql('events', 20_000_000, 10_000_000, 'event_type AS word, user_id')


@query("stream_word_window_20_10", f"""
  WITH w AS ({_20_10}) SELECT ws // 1000 AS window_start, ws // 1000 + 20000 AS window_end, word, count(*) AS count FROM w GROUP BY ALL""")
def _(spark, sf):
    # Batches follow the time, so nothing is late; the watermark lets go of windows that are over.
    words = _timed(spark, sf, "words-20").select(F.col("event_type").alias("word"), "timestamp")
    counts = runs.closed_table(words, lambda d: W.word_sliding(d, "20 seconds", "10 seconds", "1 minute", True), "timestamp", "words-20")
    return counts.where("word is not null").select(ms("window_start"), ms("window_end"), "word", "count")


@query("stream_reduce_by_key_window", f"""
  WITH w AS ({_20_10}) SELECT ws // 1000 AS window_start, ws // 1000 + 20000 AS window_end, word, sum(user_id)::BIGINT AS sum FROM w GROUP BY ALL""")
def _(spark, sf):
    pairs = _timed(spark, sf, "sums-20").select("timestamp", F.col("event_type").alias("word"), "user_id")
    sums = runs.closed_table(pairs, lambda d: W.reduce_by_key_window(d, "word", "user_id", watermark="1 minute", panes=True), "timestamp", "sums-20")
    return sums.where("word is not null").select(ms("window_start"), ms("window_end"), "word", "sum")


@query("stream_word_per_batch", f"""
  WITH {BATCH_KEYS} SELECT batch_key::INT AS batch_key, event_type AS word, count(*) AS count FROM keyed GROUP BY ALL""")
def _(spark, sf):
    stream, path = _prepared(spark, sf, "per-batch")
    counts = B.each_batch_table(
        stream, lambda d: d.groupBy("batch_key", F.col("event_type").alias("word")).agg(F.count(F.lit(1)).alias("count")), path)
    return counts.select("batch_key", "word", "count")


@query("stream_second_group", """
  WITH c AS (SELECT date_trunc('second', ts) AS s, event_type AS word, count(*) AS n FROM events GROUP BY ALL),
  p AS (SELECT *, (row_number() OVER (PARTITION BY s ORDER BY word) - 1) // 100000 AS part FROM c)
  SELECT epoch_us(s) // 1000 AS second, part::INT AS part, string_agg(word || '=' || n, ',' ORDER BY word) AS words FROM p GROUP BY s, part""")
def _(spark, sf):
    path = scratch_path(spark, "seconds")
    groups = B.each_batch_table(_words(spark, sf), W.second_groups, path)
    text = F.array_join(F.transform("words", lambda w: F.concat_ws("=", w["word"], w["count"].cast("string"))), ",")
    return groups.select(ms("second"), "part", text.alias("words"))


@query("stream_checkpoint_resume", f"""
  WITH {BATCH_KEYS} SELECT batch_key::INT AS batch_key, count(*) AS rows, 1::BIGINT AS times FROM keyed GROUP BY 1""")
def _(spark, sf):
    path = scratch_path(spark, "resume")

    def write(batch, batch_id):
        batch.groupBy("batch_key").agg(F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(
            f"{path}/rows/batch_id={batch_id}")

    # The first run ends after two batches; the second one starts where the checkpoint says.
    for numbers in (range(2), range(2, 4)):
        stream, _ = _prepared(spark, sf, "resume", path, numbers)
        runs.run_batches(stream, write, f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/rows").groupBy("batch_key").agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("times"))


# ---------------------------------------------------------------- delivery


def _log_rows(stream):
    return stream.select(F.lit("events").alias("topic"), F.expr(f"cast(user_id % {V.PARTITIONS} AS int)").alias("partition"),
                         F.col("event_id").alias("offset"), "event_type", "value", "user_id")


@query("log_exactly_once_sink", """
  SELECT 'row' AS kind, event_id AS "offset", (user_id % 4)::INT AS "partition", value FROM events
  UNION ALL SELECT 'position', max(event_id) + 1, (user_id % 4)::INT, NULL FROM events GROUP BY 3""")
def _(spark, sf):
    stream, path = _prepared(spark, sf, "once", numbers=range(3))
    write = D.exactly_once_writer(f"{path}/out")
    runs.run_batches(_log_rows(stream), write, f"{path}/checkpoint-0")
    # A second run without its checkpoint, after new rows came and with other batches, starts at the stored positions.
    _prepared(spark, sf, "once", path, range(3, 4))
    again = B.batch_stream(spark, f"{path}/in", V.table(spark, sf, "events").select(
        "event_id", "ts", "user_id", "event_type", "value").withColumn("batch_key", F.lit(0)).schema)
    runs.run_batches(_log_rows(again), write, f"{path}/checkpoint-1")
    rows = D.delivered(spark, f"{path}/out").select(F.lit("row").alias("kind"), "offset", "partition", "value")
    held = D.stored_positions(spark, f"{path}/out")
    return rows.unionByName(held.select(F.lit("position").alias("kind"), "offset", "partition",
                                        F.lit(None).cast("double").alias("value")))


@query("log_consume_transform_produce", """
  SELECT event_id AS "offset", (user_id % 4)::INT AS "partition", upper(event_type) AS word, value * 2 AS value FROM events""")
def _(spark, sf):
    stream, path = _prepared(spark, sf, "transform")
    work = lambda d: d.select(
        "topic", "partition", "offset", F.upper("event_type").alias("word"), (F.col("value") * 2).alias("value"))
    runs.run_batches(_log_rows(stream), D.abort_every_other(f"{path}/out", work), f"{path}/checkpoint")
    return D.delivered(spark, f"{path}/out").select("offset", "partition", "word", "value")


@query("stream_read_committed", READ_COMMITTED)
def _(spark, sf):
    path = scratch_path(spark, "committed")

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")

    # Transactions that are open when the first run ends go on in the second one.
    with X.keyed_state(spark):
        for numbers in (range(2), range(2, 4)):
            stream, _ = _prepared(spark, sf, "committed", path, numbers)
            rows = X.read_committed_stream(transactional(_log_rows(stream)))
            runs.run_batches(rows, write, f"{path}/checkpoint")
    return spark.read.schema(rows.schema).parquet(f"{path}/rows").select("partition", "offset", "producer_id")


# ---------------------------------------------------------------- generators


@query("gen_sensor_records", f"""
  SELECT event_id, 'orgId' AS "orgId", 'modelId' AS "modelId", '/modelId' AS "modelIdPath", 'assetId' AS "assetId", 'user_' || user_id AS "pointId",
         epoch_us(ts) // 1000 AS time, {draw_sql('event_id', 3, 2147483648)} / 2147483648.0::DOUBLE AS value, 0::INT AS "calQuality", 1::INT AS id,
         0::BIGINT AS dq, 0::INT AS quality FROM events""")
def _(spark, sf):
    events = V.table(spark, sf, "events")
    made = G.sensor_records(events, "event_id", F.unix_millis(F.col("ts").cast("timestamp")), 3,
                            {"pointId": F.concat(F.lit("user_"), F.col("user_id").cast("string"))})
    return made.select(*[c for c in made.columns if c != "attr"], "attr.calQuality", "attr.id")


@query("gen_fixed_payload", f"""
  WITH p AS (SELECT string_agg(chr((65 + {draw_sql('i', 0, 26)})::INT), '' ORDER BY i) AS payload FROM range(64) t(i))
  SELECT event_id, payload FROM events, p""")
def _(spark, sf):
    return V.table(spark, sf, "events").select("event_id", G.fixed_payload(64).alias("payload"))


@query("gen_words", f"SELECT event_id, {words_sql('event_id', 5)} AS line FROM events")
def _(spark, sf):
    return V.table(spark, sf, "events").select("event_id", G.word_line(F.col("event_id"), 5).alias("line"))
