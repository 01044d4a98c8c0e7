"""Sources, sinks, projections, filters and functions on the given tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import binary, partitioner, scalar, typed
from tidemark.operators import records as R
from tidemark.operators import transforms as X
from tidemark.plans import views as V
from tidemark.plans.catalog import (LINES, RAW_BOUNDS, RAW_LOG, SENSOR, half_up_sql, ms, query, rounded)
from tidemark.session import by_value, scratch_path
from tidemark.sources import files, jdbc
from tidemark.sources import log as L
from tidemark.operators.positions import begin_end_offsets

# ---------------------------------------------------------------- sources and sinks


@query("src_text_lines", f"WITH {LINES} SELECT value FROM lines")
def _(spark, sf):
    return files.round_trip_text(V.table(spark, sf, "documents"), "text", 2)


@query("src_text_delimited", "SELECT text AS value FROM documents")
def _(spark, sf):
    # Whole texts keep their line breaks: the payloads end at a delimiter of their own.
    path = scratch_path(spark, "payloads")
    mark = "\u0001#\u0001"
    V.table(spark, sf, "documents").select("text").write.option("lineSep", mark).text(path)
    return files.text_delimited(spark, path, mark)


@query("src_json_lines", """
  SELECT 'o1' AS "orgId", event_type AS "modelId",
         CASE WHEN event_id % 10 = 5 THEN NULL ELSE 'asset_' || (user_id % 20) END AS "assetId", 'user_' || user_id AS "pointId",
         CASE WHEN event_id % 10 = 6 THEN NULL ELSE epoch_us(ts) // 1000 END AS time,
         CASE event_id % 10 WHEN 2 THEN NULL WHEN 4 THEN trunc(value) ELSE value END AS value, 0::INT AS dq
  FROM events WHERE event_id % 10 NOT IN (0, 1, 3)""")
def _(spark, sf):
    lines = V.json_log(spark, sf).select(F.col("value").cast("string").alias("value"))
    path = scratch_path(spark, "json")
    files.write_text(lines, path)
    return files.read_json_lines(spark, path)


@query("src_json_document", """
  SELECT event_type, event_id, user_id, count(*) OVER (PARTITION BY event_type, event_id // 100000)::BIGINT AS size FROM events""")
def _(spark, sf):
    events = V.table(spark, sf, "events")
    documents = files.json_documents(events, ["event_type"], ["user_id", "event_type"], "event_id",
                                     F.lit(0).cast("long"))
    path = scratch_path(spark, "documents")
    files.write_json_documents(documents, path)
    record = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                           T.StructField("event_type", T.StringType())])
    return files.json_document(spark, path, record).select("event_type", "event_id", "user_id", "size")


@query("sink_json_document", """
  SELECT event_type, event_id // 100000 AS part, count(*) AS size, sum(event_id)::BIGINT AS ids
  FROM events GROUP BY ALL""")
def _(spark, sf):
    documents = files.json_documents(V.table(spark, sf, "events"), ["event_type"], ["value"], "event_id",
                                     F.lit(0).cast("long"))
    ids = F.from_json("value", "records array<struct<event_id:bigint>>")["records"]["event_id"]
    return documents.select("event_type", "part", "size",
                            F.aggregate(ids, F.lit(0).cast("long"), lambda a, x: a + x).alias("ids"))


@query("src_inline_rows", """
  SELECT label, count(*) AS n FROM events
  JOIN (VALUES ('click', 'browse'), ('view', 'browse'), ('purchase', 'buy'), ('signup', 'join'), ('error', 'fail')) m(event_type, label)
  USING (event_type) GROUP BY ALL""")
def _(spark, sf):
    labels = files.inline_rows(spark, [("click", "browse"), ("view", "browse"), ("purchase", "buy"),
                                       ("signup", "join"), ("error", "fail")], "event_type string, label string")
    return V.table(spark, sf, "events").join(labels, "event_type").groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def _ranges(log):
    """A quarter to three quarters of each partition; the range of partition 3 is empty."""
    bounds = begin_end_offsets(log)
    return bounds.select(
        *L.TP, F.expr("end div 4").alias("from"),
        F.when(F.col("partition") == 3, F.expr("end div 4")).otherwise(F.expr("end * 3 div 4")).alias("until"))


@query("src_log_batch_ranges", f"""
  WITH {RAW_BOUNDS}, r AS (SELECT topic, "partition", e // 4 AS f,
      CASE WHEN "partition" = 3 THEN e // 4 ELSE e * 3 // 4 END AS u FROM bounds)
  SELECT log."partition", log."offset", log.event_id FROM raw_log log JOIN r USING (topic, "partition")
  WHERE "offset" >= f AND "offset" < u""")
def _(spark, sf):
    log = V.raw_log(spark, sf)
    return L.read_ranges(log, _ranges(log)).select("partition", "offset", "event_id")


@query("src_log_assign", f"""
  WITH {RAW_BOUNDS}
  SELECT topic, "partition", CASE WHEN "partition" = 0 THEN e - 10 WHEN "partition" <= 1 THEN e // 2 ELSE b END AS "offset"
  FROM bounds WHERE "partition" <> 3""")
def _(spark, sf):
    bounds = begin_end_offsets(V.raw_log(spark, sf))
    given = bounds.where("partition <= 1").select(*L.TP, F.expr("end div 2").alias("offset"))
    saved = bounds.where("partition = 0").select(*L.TP, F.expr("end - 10").alias("offset"))
    return L.start_positions(bounds, "earliest", pattern="ev.*", assign=bounds.where("partition <> 3"),
                             given=given, checkpoint=saved)


@query("src_jdbc_table", """
  SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_nationkey::VARCHAR AS c_nationkey,
         c_acctbal::VARCHAR AS c_acctbal, c_mktsegment FROM customer""")
def _(spark, sf):
    return jdbc.as_strings(V.table(spark, sf, "customer"))


@query("sink_text", "SELECT c_name AS value FROM customer")
def _(spark, sf):
    return files.round_trip_text(V.table(spark, sf, "customer"), "c_name")


# ---------------------------------------------------------------- projections and filters


def _binary_log(spark, sf):
    return V.raw_log(spark, sf).withColumns({
        "key": F.encode("key", "UTF-8"), "value": F.encode("props", "UTF-8")})


@query("proj_value_timestamp", f"WITH {RAW_LOG} SELECT props AS value, t AS \"timestamp\" FROM raw_log")
def _(spark, sf):
    return R.value_timestamp(_binary_log(spark, sf)).select("value", ms("timestamp"))


@query("proj_key_value_strings", f'WITH {RAW_LOG} SELECT "key", props AS value FROM raw_log')
def _(spark, sf):
    return R.key_value_strings(_binary_log(spark, sf))


@query("proj_log_listing", f"""
  WITH {RAW_LOG} SELECT "partition", "offset", "key", props AS payload, strlen(props)::INT AS size, t AS "timestamp"
  FROM raw_log""")
def _(spark, sf):
    return R.log_listing(_binary_log(spark, sf)).select("partition", "offset", "key", "payload", "size", ms("timestamp"))


_RECORD_SQL = """
  SELECT 'o1' AS "orgId", event_type AS "modelId",
         CASE WHEN event_id % 10 = 5 THEN NULL ELSE 'asset_' || (user_id % 20) END AS "assetId", 'user_' || user_id AS "pointId",
         CASE WHEN event_id % 10 = 6 THEN NULL ELSE epoch_us(ts) // 1000 END AS time,
         CASE event_id % 10 WHEN 2 THEN NULL WHEN 4 THEN trunc(value) ELSE value END AS value, 0::INT AS dq
  FROM events WHERE event_id % 10 NOT IN (0, 1, 3)"""


@query("proj_record7", _RECORD_SQL)
def _(spark, sf):
    return R.records(V.json_log(spark, sf))


@query("proj_time_value", f"""
  WITH r AS ({_RECORD_SQL}) SELECT time, value FROM r WHERE time IS NOT NULL AND value IS NOT NULL""")
def _(spark, sf):
    return R.time_value(V.json_log(spark, sf)).select(ms("time"), "value")


@query("proj_asset_time_value", f"""
  WITH r AS ({_RECORD_SQL}) SELECT "assetId" AS asset, time, value FROM r
  WHERE time IS NOT NULL AND value IS NOT NULL AND "assetId" IS NOT NULL""")
def _(spark, sf):
    return R.time_value(V.json_log(spark, sf), with_asset=True).select("asset", ms("time"), "value")


@query("filter_numeric_value", "SELECT event_id FROM events WHERE event_id % 10 >= 4")
def _(spark, sf):
    return R.numeric_values(V.json_log(spark, sf)).select("event_id")


@query("filter_non_empty_lines", f"WITH {LINES} SELECT value FROM lines WHERE length(value) > 0")
def _(spark, sf):
    lines = V.table(spark, sf, "documents").select(F.explode(F.split("text", "\n")).alias("value"))
    return R.non_empty_lines(lines)


@query("filter_valid_json", "SELECT event_id FROM events WHERE event_id % 10 <> 0")
def _(spark, sf):
    return R.valid_json(V.json_log(spark, sf)).select("event_id")


@query("default_partition_key", """
  SELECT event_id, CASE WHEN user_id % 5 = 0 THEN 'UNKNOWN_PARTITION' ELSE 'user_' || user_id END AS "key" FROM events""")
def _(spark, sf):
    key = F.when(F.col("user_id") % 5 != 0, F.col("key"))
    return V.raw_log(spark, sf).select("event_id", R.default_key(key).alias("key"))


@query("null_value_literal", """
  SELECT event_id, CASE WHEN user_id % 5 = 0 THEN 'NULL' ELSE props END AS value FROM events""")
def _(spark, sf):
    value = F.when(F.col("user_id") % 5 != 0, F.col("props"))
    return V.raw_log(spark, sf).select("event_id", R.null_literal(value).alias("value"))


@query("add_window_and_partition", f"""
  WITH {RAW_LOG} SELECT event_id, t // 300000 * 300000 AS "windowTime", "partition" FROM raw_log""")
def _(spark, sf):
    bucket = scalar.bucket_millis(F.unix_millis("timestamp"), 300_000)
    return R.with_window_and_partition(V.raw_log(spark, sf), bucket, F.col("partition")).select(
        "event_id", "windowTime", "partition")


@query("drop_fields", f'WITH {SENSOR} SELECT assetId AS "assetId", pointId AS "pointId", time, value, dq FROM sensor')
def _(spark, sf):
    return R.drop_fields(V.sensor(spark, sf))


@query("enrich_attr_map", """
  SELECT event_id, 'k=' || props || ';run=nightly;zone=new' AS attr FROM events""")
def _(spark, sf):
    rows = V.table(spark, sf, "events").withColumn("attr", F.create_map(
        F.lit("k"), F.col("props"), F.lit("zone"), F.lit("old")))
    out = R.with_attributes(rows, {"zone": "new", "run": "nightly"})
    entries = F.array_sort(F.transform(F.map_entries("attr"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return out.select("event_id", F.array_join(entries, ";").alias("attr"))


@query("split_good_errors", """
  SELECT event_id, CASE WHEN event_id % 10 IN (0, 1, 3) THEN 'not a sensor record' WHEN event_id % 10 = 2
         THEN 'no numeric value' ELSE 'good' END AS outcome FROM events""")
def _(spark, sf):
    good, bad = R.split_good_errors(V.json_log(spark, sf), ["event_id"])
    return good.select("event_id", F.lit("good").alias("outcome")).unionByName(
        bad.select("event_id", F.col("error").alias("outcome")))


_INT_TEXT = """CASE event_id % 6 WHEN 0 THEN concat(' ', user_id) WHEN 1 THEN concat(user_id, '.5')
               WHEN 2 THEN NULL WHEN 3 THEN event_type WHEN 4 THEN concat('+', user_id)
               ELSE concat(user_id, '') END"""


@query("parse_int_or_zero_plus", f"""
  SELECT event_id, n::VARCHAR AS "key", (n + 10)::VARCHAR AS value FROM (
    SELECT event_id, CASE WHEN event_id % 6 >= 4 THEN user_id ELSE 0 END AS n FROM events)""")
def _(spark, sf):
    rows = V.table(spark, sf, "events").withColumn("text", F.expr(_INT_TEXT))
    n = scalar.parse_int_or_zero(F.col("text"))
    return rows.select("event_id", n.cast("string").alias("key"), (n + 10).cast("string").alias("value"))


_HEADERS = """array(named_struct('key', 'transactionStatus', 'value', encode(CASE event_id % 3 WHEN 0 THEN 'committed' ELSE 'open' END, 'UTF-8')),
                    named_struct('key', 'trace', 'value', encode(cast(user_id AS string), 'UTF-8')),
                    named_struct('key', 'trace', 'value', encode(event_type, 'UTF-8')))"""


@query("filter_header_status", "SELECT event_id FROM events WHERE event_id % 3 = 0")
def _(spark, sf):
    rows = V.table(spark, sf, "events").withColumn("headers", F.expr(_HEADERS))
    return rows.where(R.header_equals(F.col("headers"), "transactionStatus", "committed")).select("event_id")


@query("proj_last_header", "SELECT event_id, event_type AS trace, NULL::VARCHAR AS missing FROM events")
def _(spark, sf):
    rows = V.table(spark, sf, "events").withColumn("headers", F.expr(_HEADERS))
    return rows.select("event_id", *[F.decode(R.last_header(F.col("headers"), n), "UTF-8").alias(a)
                                     for n, a in (("trace", "trace"), ("absent", "missing"))])


@query("filter_topic_pattern", """
  SELECT event_id, topic FROM (SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 'test' ELSE 'mytest' END || event_type AS topic
  FROM events) WHERE topic LIKE 'test%'""")
def _(spark, sf):
    topic = F.concat(F.when(F.col("user_id") % 2 == 0, "test").otherwise("mytest"), "event_type")
    rows = V.table(spark, sf, "events").select("event_id", topic.alias("topic"))
    return rows.where(L.topic_matches(F.col("topic"), "test.*"))


@query("filter_offset_seek", f"""
  WITH {RAW_BOUNDS} SELECT log."partition", "offset", event_id FROM raw_log log JOIN bounds USING (topic, "partition")
  WHERE "offset" >= e - 100 - "partition" """)
def _(spark, sf):
    log = V.raw_log(spark, sf)
    targets = begin_end_offsets(log).select(*L.TP, (F.col("end") - 100 - F.col("partition")).alias("offset"))
    return R.from_position(log, targets).select("partition", "offset", "event_id")


@query("sample_every_kth", """
  WITH i AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS i,
             count(*) OVER (PARTITION BY event_type) AS n FROM events)
  SELECT event_type, event_id FROM i WHERE i % (n // least(n, 100)) = 0""")
def _(spark, sf):
    events = V.table(spark, sf, "events").select("event_type", "event_id")
    return R.every_kth(events, ["event_type"], "event_id", 100)


# ---------------------------------------------------------------- functions


@query("fn_split_java", """
  SELECT doc_id, len(string_split(rtrim(text, ' '), ' '))::INT AS n, string_split(rtrim(text, ' '), ' ')[1] AS head
  FROM documents""")
def _(spark, sf):
    docs = V.table(spark, sf, "documents").select("doc_id", scalar.split_java(F.col("text")).alias("w"))
    return docs.select("doc_id", F.size("w").alias("n"), F.element_at("w", 1).alias("head"))


@query("fn_split_whitespace", "SELECT o_orderkey, o_orderstatus AS first, 'c' || o_custkey AS second FROM orders")
def _(spark, sf):
    lines = V.table(spark, sf, "orders").select(
        "o_orderkey", F.concat("o_orderstatus", F.lit(" \t "), F.lit("c"), "o_custkey", F.lit("  x")).alias("line"))
    pair = scalar.split_whitespace(F.col("line"))
    return lines.select("o_orderkey", pair["first"].alias("first"), pair["second"].alias("second"))


@query("fn_bucket_millis", """
  SELECT event_id, t // 60000 * 60000 AS bucket, -((t // 7000) * 7000) AS before_epoch
  FROM (SELECT event_id, epoch_us(ts) // 1000 AS t FROM events)""")
def _(spark, sf):
    t = F.unix_millis(F.col("ts").cast("timestamp"))
    return V.table(spark, sf, "events").select(
        "event_id", scalar.bucket_millis(t, 60_000).alias("bucket"), scalar.bucket_millis(-t, 7_000).alias("before_epoch"))


@query("fn_format_time", """
  SELECT event_id, strftime(ts, '%H:%M:%S') AS clock, strftime(ts, '%H:%M:%S.') || lpad((epoch_us(ts) // 1000 % 1000)::VARCHAR, 3, '0') AS clock_millis,
         strftime(ts, '%Y-%m-%d %H:%M:%S,') || lpad((epoch_us(ts) // 1000 % 1000)::VARCHAR, 3, '0') AS log_line,
         strftime(ts, '%Y-%m-%d') AS day,
         strftime(ts, '%Y年 %M分%S秒 ') || lpad((epoch_us(ts) // 1000 % 1000)::VARCHAR, 3, '0') AS minute_second
  FROM events""")
def _(spark, sf):
    ts = F.col("ts").cast("timestamp")
    return V.table(spark, sf, "events").select(
        "event_id", *[scalar.format_time(ts, n).alias(n) for n in scalar.TIME_PATTERNS])


@query("fn_rate_per_second", f"""
  SELECT event_id, CASE WHEN user_id = 0 THEN 0.0 ELSE {half_up_sql('event_id * 1000.0 / user_id', 2)} END AS rate,
         CASE WHEN user_id = 0 THEN 0.0 ELSE {half_up_sql('event_id * 1000.0 / user_id', 3)} END AS rate3 FROM events""")
def _(spark, sf):
    n, t = F.col("event_id"), F.col("user_id")
    return V.table(spark, sf, "events").select(
        "event_id", scalar.rate_per_second(n, t, -1).alias("rate"), scalar.rate_per_second(n, t, 3).alias("rate3"))


@query("fn_rate_ten_thousands", f"SELECT o_orderkey, {half_up_sql('o_totalprice / 10000.0', 2)} AS rate FROM orders")
def _(spark, sf):
    return V.table(spark, sf, "orders").select("o_orderkey", scalar.rate_ten_thousands(F.col("o_totalprice")).alias("rate"))


@query("fn_typed_map", """
  SELECT event_id, u.path, u.type, u.value FROM events, LATERAL (VALUES
    ('', 'MAP', NULL), ('/name', 'STRING', event_type), ('/n', 'LONG', user_id::VARCHAR),
    ('/flag', 'BOOLEAN', CASE WHEN user_id > 50 THEN 'true' ELSE 'false' END), ('/list', 'LIST', NULL), ('/list[0]', 'LONG', event_id::VARCHAR),
    ('/list[1]', 'LONG', (event_id + 1)::VARCHAR), ('/inner', 'MAP', NULL), ('/inner/none', 'STRING', NULL)) u(path, type, value)""")
def _(spark, sf):
    text = F.expr("""concat('{"name":"', event_type, '","n":', user_id, ',"flag":', user_id > 50, ',"list":[', event_id, ',',
                     event_id + 1, '],"inner":{"none":null}}')""")
    rows = V.table(spark, sf, "events").select("event_id", text.alias("payload"))
    return typed.typed_fields(rows, ["event_id"], "payload")


@query("fn_decode_binary", """
  SELECT event_id, (user_id - 75)::INT AS i, (user_id - 75)::SMALLINT AS s, (event_id - 5000) * 1000000007 AS l,
         value AS d, 'user_' || user_id AS t FROM events""")
def _(spark, sf):
    source = {"i": ("int", F.col("user_id") - 75), "s": ("short", F.col("user_id") - 75),
              "l": ("long", (F.col("event_id") - 5000) * 1000000007), "d": ("double", F.col("value")),
              "t": ("string", F.concat(F.lit("user_"), "user_id"))}
    packed = V.table(spark, sf, "events").select(
        "event_id", *[binary.encode_binary(c, kind).alias(n) for n, (kind, c) in source.items()])
    return packed.select("event_id", *[binary.decode_binary(F.col(n), kind).alias(n) for n, (kind, _) in source.items()])


@query("fn_json_bytes", """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def _(spark, sf):
    rows = _binary_log(spark, sf)
    return rows.select("event_id", F.from_json(F.decode("value", "UTF-8"), "k bigint")["k"].alias("k"))


@query("fn_md5_hex", "SELECT doc_id, md5(text) AS md5 FROM documents")
def _(spark, sf):
    return V.table(spark, sf, "documents").select("doc_id", scalar.md5_hex(F.col("text")).alias("md5"))


_B = "ord(substr(k, ({}) + 1, 1))"


def _mul(x: str) -> str:
    return f"((({x}) * 1540483477) & 4294967295)"


def _sh(x: str, n: int) -> str:
    return f"xor({x}, ({x}) >> {n})"


_MURMUR = f"""
  k0 AS (SELECT event_id, CASE WHEN user_id % 7 = 0 THEN NULL ELSE 'user_' || user_id END AS k FROM events),
  k1 AS (SELECT *, strlen(k)::BIGINT AS n FROM k0),
  k2 AS (SELECT *, [ord(substr(k, (i + 1)::INT, 1))::BIGINT FOR i IN range(n)] AS b FROM k1 WHERE k IS NOT NULL),
  k3 AS (SELECT *, [b[4 * i + 1] + b[4 * i + 2] * 256 + b[4 * i + 3] * 65536 + b[4 * i + 4] * 16777216
                    FOR i IN range(n // 4)] AS w FROM k2),
  k4 AS (SELECT *, [((x * 1540483477) & 4294967295) FOR x IN w] AS m FROM k3),
  k5 AS (SELECT *, [((xor(x, x >> 24) * 1540483477) & 4294967295) FOR x IN m] AS q FROM k4),
  k6 AS (SELECT *, list_reduce(list_prepend(xor(2538058380, n), q),
                               lambda h, x: xor((h * 1540483477) & 4294967295, x)) AS h FROM k5),
  k7 AS (SELECT *, CASE WHEN n % 4 = 0 THEN h ELSE
      ((xor(h, CASE n % 4 WHEN 1 THEN b[n] WHEN 2 THEN b[n - 1] + b[n] * 256
                ELSE b[n - 2] + b[n - 1] * 256 + b[n] * 65536 END) * 1540483477) & 4294967295) END AS h2 FROM k6),
  k8 AS (SELECT *, ((xor(h2, h2 >> 13) * 1540483477) & 4294967295) AS h3 FROM k7),
  k9 AS (SELECT event_id, xor(h3, h3 >> 15) AS u FROM k8)"""


@query("fn_key_partition", f"""
  WITH {_MURMUR}
  SELECT event_id, ((u & 2147483647) % 6)::INT AS "partition" FROM k9
  UNION ALL SELECT event_id, ((row_number() OVER (ORDER BY event_id) - 1) % 6)::INT FROM k0 WHERE k IS NULL""")
def _(spark, sf):
    rows = V.table(spark, sf, "events").select(
        "event_id", F.when(F.col("user_id") % 7 != 0, F.encode(F.concat(F.lit("user_"), "user_id"), "UTF-8")).alias("key"))
    return partitioner.assign_partitions(rows, "key", "event_id", 6).select("event_id", "partition")


# ---------------------------------------------------------------- user functions and placement


@query("udf_row_and_flat", """
  SELECT lower(word) AS word, count(*) AS n FROM (SELECT unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM documents)
  WHERE length(word) > 3 GROUP BY ALL""")
def _(spark, sf):
    # Three user functions, each on whole batches: a list for each text, a choice of words, a word for a word.
    docs = V.table(spark, sf, "documents").where("text is not null").select("text")
    flat = X.flat_map_values(docs, lambda texts: texts.str.rstrip(" ").str.split(" "), "text", "word", "string")
    long = X.filter_rows(flat, lambda words: words.str.len() > 3, "word")
    return X.map_values(long, lambda words: words.str.lower(), "word", "word", "string").groupBy("word").agg(
        F.count(F.lit(1)).alias("n"))


@query("udf_partition", "SELECT event_id, value * 2 AS doubled FROM events")
def _(spark, sf):
    def double(batches):
        for pdf in batches:
            yield pdf.assign(doubled=pdf["value"] * 2)[["event_id", "doubled"]]

    return X.map_partitions(V.table(spark, sf, "events").select("event_id", "value"), double,
                            "event_id bigint, doubled double")


class _Before:
    """The value of the row before, in the order of a key's rows."""

    def __init__(self):
        self.last = None

    def eval(self, batch):
        values = batch.column("value")
        before = pa.concat_arrays([pa.array([self.last], values.type), values[:-1]])
        self.last = values[-1].as_py()
        yield pa.table({"event_id": batch.column("event_id"), "previous": before})


@query("udf_partition_ordered", "SELECT event_id, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS previous FROM events")
def _(spark, sf):
    events = V.table(spark, sf, "events").select("user_id", "event_id", "value")
    return X.table_function(events, _Before, "event_id bigint, previous double", ["user_id"], ["event_id"])


@query("udf_transform_chain", f"""
  WITH {SENSOR} SELECT pointId AS "pointId", time, value * 10 AS scaled FROM sensor WHERE value > 50""")
def _(spark, sf):
    steps = [lambda d: d.where(F.col("value") > 50), lambda d: d.withColumn("scaled", F.col("value") * 10),
             lambda d: d.select("pointId", "time", "scaled")]
    return X.chain(V.sensor(spark, sf), steps, 4)


@query("udf_interceptors", f"""
  WITH {SENSOR} SELECT 'r_' || pointId AS "pointId", count(*) AS n, true AS sent FROM sensor WHERE value > 10 GROUP BY ALL""")
def _(spark, sf):
    return X.intercepted(
        lambda: V.sensor(spark, sf),
        on_read=[lambda d: d.where(F.col("value") > 10), lambda d: d.withColumn("pointId", F.concat(F.lit("r_"), "pointId"))],
        work=lambda d: d.groupBy("pointId").agg(F.count(F.lit(1)).alias("n")),
        on_write=[lambda d: d.withColumn("sent", F.lit(True))])


@query("place_repartition_to", "SELECT event_id, 4 AS partitions FROM events")
def _(spark, sf):
    placed = X.repartition_to(V.table(spark, sf, "events").select("event_id"), 4)
    return placed.withColumn("partitions", F.lit(placed.rdd.getNumPartitions()))


@query("place_cache_levels", """
  SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL""")
def _(spark, sf):
    path = scratch_path(spark, "kept")
    sums = V.table(spark, sf, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    # Two actions on one intermediate; it is gone after the block.
    with X.kept(sums, "DISK_ONLY") as held:
        held.select("event_type", "n").write.parquet(f"{path}/n")
        held.select("event_type", "total").write.parquet(f"{path}/total")
    return spark.read.parquet(f"{path}/n").join(spark.read.parquet(f"{path}/total"), "event_type").select(
        "event_type", "n", rounded("total"))


by_value(__name__)
