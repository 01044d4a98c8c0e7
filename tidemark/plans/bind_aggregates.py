"""Joins, aggregates, windows, limits and the graph on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import aggregates as A
from tidemark.operators import graph, joins, limits, windows
from tidemark.operators.positions import begin_end_offsets
from tidemark.plans import views as V
from tidemark.plans.catalog import (BATCHES, BOUNDS, EDGES, LOG, RAW_BOUNDS, RAW_LOG, SENSOR, WORDS, half_up_sql, mean3_sql, ms, query,
                                    rounded)
from tidemark.functions.scalar import bucket_millis, rate_per_second
from tidemark.operators.records import drop_fields, with_window_and_partition
from tidemark.sources.log import TP

# ---------------------------------------------------------------- joins and lookups


@query("join_inner_equi", """
  SELECT o_orderkey, o_orderpriority, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""")
def _(spark, sf):
    orders = V.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.col("o_custkey").alias("custkey"))
    customers = V.table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_name", "c_mktsegment")
    return joins.inner_equi(orders, customers, "custkey").drop("custkey")


@query("join_cross_template", """
  SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'myOrgId' ELSE p_brand END AS "orgId", a AS "assetId", a AS "key",
         m[1] AS "modelId", m[2] AS "pointId"
  FROM (SELECT *, unnest(CASE WHEN p_partkey % 3 = 0 THEN ['testAsset_01', 'testAsset_02', 'testAsset_03']
                              ELSE [p_name, p_name || '_b'] END) AS a FROM part),
       LATERAL (SELECT unnest([[p_type, p_size::VARCHAR], [p_brand, 'x']]) AS m)""")
def _(spark, sf):
    template = F.to_json(F.struct(
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_brand")).otherwise("").alias("orgId"),
        F.when(F.col("p_partkey") % 3 == 0, F.array(F.lit(""))).otherwise(
            F.array("p_name", F.lit(""), F.concat("p_name", F.lit("_b")))).alias("assets"),
        F.array(*[F.struct(p.alias("inputPoint")) for p in (
            F.concat_ws("::", "p_type", F.col("p_size").cast("string")), F.lit("no point"), F.lit("a::b::c"),
            F.lit("a::"), F.concat("p_brand", F.lit("::x")))]).alias("modelAndPoints")))
    templates = V.table(spark, sf, "part").select("p_partkey", template.alias("value"))
    return joins.template_records(templates, ["p_partkey"])


def draw_sql(number: str, seed: int, size: int) -> str:
    """functions.draws.draw in SQL; ``number`` is not negative."""
    h = f"(({number}) % 2147483648)"
    for salt in (seed, 12345):
        h = f"(({h} * 1103515245 + {12345 + salt}) % 2147483648)"
        h = f"list_transform([{h}], lambda h: xor(h, h >> 16))[1]"
    return f"(({h} * {size}) >> 31)"


@query("join_sample_payload", f"""
  SELECT event_id, n_name FROM (SELECT event_id, {draw_sql('event_id', 7, 25)} AS i FROM events) JOIN nation ON n_nationkey = i""")
def _(spark, sf):
    rows = V.table(spark, sf, "events").select("event_id")
    sample = V.table(spark, sf, "nation").select("n_nationkey", "n_name")
    return joins.sample_payloads(rows, "event_id", sample, "n_nationkey", 7).select("event_id", "n_name")


@query("asof_first_at_or_after", f"""
  WITH {RAW_LOG}, log AS (SELECT * FROM raw_log), targets AS (SELECT DISTINCT "partition", o AS target_ms FROM
      (SELECT epoch_us(o_orderdate) // 1000 % 2600000000 + 1704067200000 AS o FROM orders), (SELECT DISTINCT "partition" FROM log)),
  best AS (SELECT "partition", t, "offset", lead("offset") OVER w AS nxt FROM log WINDOW w AS (PARTITION BY "partition" ORDER BY "offset"))
  SELECT g."partition", g.target_ms, b."offset", b.t AS time_ms
  FROM targets g ASOF LEFT JOIN best b ON g."partition" = b."partition" AND g.target_ms <= b.t""")
def _(spark, sf):
    log = V.raw_log(spark, sf)
    days = V.table(spark, sf, "orders").select(
        (F.unix_millis(F.col("o_orderdate").cast("timestamp")) % 2600000000 + 1704067200000).alias("target_ms")).distinct()
    targets = days.select("target_ms", F.lit("events").alias("topic"),
                          F.explode(F.sequence(F.lit(0), F.lit(V.PARTITIONS - 1))).alias("partition"))
    return joins.first_at_or_after(log, targets).select("partition", "target_ms", "offset", "time_ms")


@query("anti_new_partitions", f'WITH {RAW_LOG} SELECT DISTINCT topic, "partition" FROM raw_log WHERE "partition" >= 2')
def _(spark, sf):
    log = V.raw_log(spark, sf)
    return joins.new_partitions(log, begin_end_offsets(log).where("partition < 2"))


@query("merge_positions", f"""
  WITH {RAW_BOUNDS} SELECT topic, "partition", CASE WHEN "partition" >= 2 THEN e ELSE b + 5 END AS "offset" FROM bounds""")
def _(spark, sf):
    bounds = begin_end_offsets(V.raw_log(spark, sf))
    old = bounds.where("partition < 3").select(*TP, (F.col("begin") + 5).alias("offset"))
    return joins.merge_positions(old, bounds.where("partition >= 2").select(*TP, F.col("end").alias("offset")))


# ---------------------------------------------------------------- aggregates


@query("agg_word_count", f"WITH {WORDS} SELECT word, count(*) AS count FROM words GROUP BY ALL")
def _(spark, sf):
    return A.word_count(V.words(spark, sf))


_TUMBLING = f"""WITH {SENSOR}
  SELECT time // 300000 * 300000 AS start, count(*) AS count, round(sum(value), 4) AS sum, round(sum(value) / count(*), 6) AS avg,
         CASE WHEN count(DISTINCT pointId) > 5 THEN count(DISTINCT pointId)::VARCHAR
              ELSE 'Set(' || array_to_string(list_sort(list(DISTINCT pointId)), ', ') || ')' END AS points
  FROM sensor GROUP BY 1"""


@query("agg_tumbling_record", _TUMBLING)
def _(spark, sf):
    return A.tumbling_records(V.sensor(spark, sf)).select("start", "count", rounded("sum"), rounded("avg", 6), "points")


@query("agg_by_point", """
  SELECT CASE WHEN user_id = 0 THEN NULL ELSE 'user_' || user_id END AS "pointId", count(*) AS count, round(sum(value), 4) AS sum,
         round(avg(value), 6) AS avg, 'Set(' || CASE WHEN user_id = 0 THEN 'null' ELSE 'user_' || user_id END || ')' AS points
  FROM events GROUP BY user_id""")
def _(spark, sf):
    records = V.sensor(spark, sf).withColumn("pointId", F.when(F.col("pointId") != "user_0", F.col("pointId")))
    return A.by_point(records).select("pointId", "count", rounded("sum"), rounded("avg", 6), "points")


@query("distinct_label", """
  SELECT o_custkey, CASE WHEN count(DISTINCT o_orderpriority) > 5 THEN count(DISTINCT o_orderpriority)::VARCHAR ELSE
         'Set(' || array_to_string(list_sort(list(DISTINCT o_orderpriority)), ', ') || ')' END AS priorities,
         CASE WHEN count(*) > 5 THEN count(*)::VARCHAR ELSE
         'Set(' || array_to_string(list_sort(list(lpad(o_orderkey::VARCHAR, 9, '0'))), ', ') || ')' END AS orders
  FROM orders GROUP BY 1""")
def _(spark, sf):
    orders = V.table(spark, sf, "orders").select(
        "o_custkey", "o_orderpriority", F.lpad(F.col("o_orderkey").cast("string"), 9, "0").alias("o_orderkey"),
        F.lit(0.0).alias("v"))
    a = A.labelled_sums(orders, ["o_custkey"], "o_orderpriority", "v").select("o_custkey", F.col("points").alias("priorities"))
    b = A.labelled_sums(orders, ["o_custkey"], "o_orderkey", "v").select("o_custkey", F.col("points").alias("orders"))
    return a.join(b, "o_custkey")


def _event_window():
    return bucket_millis(F.unix_millis("timestamp"), 300_000)


@query("agg_partial_counts", f"""
  WITH {RAW_LOG} SELECT "partition", t // 300000 * 300000 AS start, count(*) AS count FROM raw_log GROUP BY ALL""")
def _(spark, sf):
    return A.partial_counts(V.raw_log(spark, sf), _event_window(), F.col("partition"))


@query("agg_partition_local_groups", f"""
  WITH {RAW_LOG} SELECT "partition", "key", count(*) AS count FROM raw_log GROUP BY ALL""")
def _(spark, sf):
    return A.partition_local_groups(V.raw_log(spark, sf), "key")


@query("agg_partition_profile", f"""
  WITH {RAW_LOG}, pairs AS (SELECT "partition", "key", count(*) AS n FROM raw_log GROUP BY ALL),
  placed AS (SELECT *, (row_number() OVER (PARTITION BY "partition" ORDER BY "key") - 1) // {A.LIST_ROWS} AS part,
             sum(n) OVER (PARTITION BY "partition") AS rows, count(*) OVER (PARTITION BY "partition") AS points FROM pairs)
  SELECT "partition", rows::BIGINT AS rows, points, part::INT AS part, string_agg("key", ',' ORDER BY "key") AS ids
  FROM placed GROUP BY "partition", rows, points, part""")
def _(spark, sf):
    rows = V.sensor(spark, sf).withColumn("p", F.expr(f"cast(substring(pointId, 6) AS bigint) % {V.PARTITIONS}"))
    tagged = drop_fields(with_window_and_partition(rows, bucket_millis(F.col("time"), 300_000), F.col("p").cast("int")))
    profile = A.partition_profile(tagged, "partition", "pointId")
    return profile.select("partition", "rows", "points", "part", F.array_join("ids", ",").alias("ids"))


@query("agg_partition_counts", f"""
  WITH {RAW_LOG} SELECT topic, "partition", count(*) AS count, (SELECT count(*) FROM raw_log) AS total FROM raw_log GROUP BY ALL""")
def _(spark, sf):
    return A.partition_counts(V.raw_log(spark, sf))


@query("agg_offset_summary", f"""
  WITH {RAW_LOG}, kept AS (SELECT "partition", "offset", event_id % 10 <> 2 AS kept FROM raw_log)
  SELECT "partition", count_if(kept)::BIGINT AS size, min("offset") FILTER (kept) AS min_offset, max("offset") FILTER (kept) AS max_offset
  FROM kept GROUP BY 1""")
def _(spark, sf):
    return A.offset_summary(V.json_log(spark, sf), offsets_unique=True)


@query("agg_poll_summary", f"""
  WITH {LOG} SELECT topic, "partition", "offset" // 50 AS poll, count(*) AS size, min("offset") AS first, max("offset") AS last
  FROM log GROUP BY ALL""")
def _(spark, sf):
    return A.poll_summary(V.log(spark, sf), 50)


@query("agg_second_bucket_list", """
  SELECT epoch_us(date_trunc('second', ts)) // 1000 AS second, event_id // 100000 AS part,
         array_to_string(list(event_type ORDER BY event_id), ',') AS records, sum(strlen(props))::BIGINT AS part_size,
         sum(sum(strlen(props))) OVER (PARTITION BY date_trunc('second', ts))::BIGINT AS size
  FROM events GROUP BY date_trunc('second', ts), event_id // 100000""")
def _(spark, sf):
    events = V.table(spark, sf, "events").withColumn("timestamp", F.col("ts").cast("timestamp"))
    lists = A.second_bucket_lists(events, "timestamp", "event_id", "event_type", F.octet_length("props").cast("long"))
    return lists.select(ms("second"), "part", F.array_join("records", ",").alias("records"), "part_size", "size")


@query("agg_group_lists", f"WITH {WORDS} SELECT word, count(*) AS length FROM words GROUP BY ALL")
def _(spark, sf):
    return A.group_lengths(V.words(spark, sf), "word")


@query("agg_adjacency", f"""
  WITH {EDGES} SELECT src, part::INT AS part, string_agg(dst, ',' ORDER BY dst) AS neighbours FROM (
    SELECT *, (row_number() OVER (PARTITION BY src ORDER BY dst) - 1) // {A.LIST_ROWS} AS part FROM (SELECT DISTINCT src, dst FROM edges))
  GROUP BY ALL""")
def _(spark, sf):
    return A.adjacency(V.edges(spark, sf)).select("src", "part", F.array_join("neighbours", ",").alias("neighbours"))


@query("distinct_rows", f"WITH {EDGES} SELECT DISTINCT src, dst FROM edges")
def _(spark, sf):
    return A.distinct_rows(V.edges(spark, sf))


@query("agg_throughput_total", f"""
  WITH {RAW_LOG}, s AS (SELECT "partition", count(*) AS messages, sum(strlen("key") + strlen(props))::BIGINT AS bytes, max(t) - min(t) AS elapsed_ms
             FROM raw_log GROUP BY 1)
  SELECT "partition", messages, bytes, elapsed_ms, round(bytes / 1048576.0, 6) AS mb,
         round(bytes / 1048576.0 / (elapsed_ms / 1000.0), 10) AS mb_per_s, round(messages / (elapsed_ms / 1000.0), 10) AS messages_per_s FROM s""")
def _(spark, sf):
    log = V.raw_log(spark, sf).withColumn("value", F.col("props"))
    total = A.throughput_total(log, group=["partition"])
    return total.select("partition", "messages", "bytes", "elapsed_ms", rounded("mb", 6), rounded("mb_per_s", 10),
                        rounded("messages_per_s", 10))


@query("agg_throughput_report", """
  SELECT event_type, (epoch_us(ts) // 1000) // 3600000 * 3600000 AS start, count(*) AS count, round(count(*) / 3600.0, 8) AS per_s,
         round(avg(user_id), 6) AS mean_latency, max(user_id) AS max_latency, round(sum(strlen(props)) / 1048576.0 / 3600.0, 12) AS mb_per_s
  FROM events GROUP BY ALL""")
def _(spark, sf):
    report = A.throughput_report(
        V.table(spark, sf, "events"), F.unix_millis(F.col("ts").cast("timestamp")), "user_id",
        F.octet_length("props"), 3_600_000, ["event_type"])
    return report.select("event_type", "start", "count", rounded("per_s", 8), rounded("mean_latency", 6), "max_latency",
                         rounded("mb_per_s", 12))


@query("agg_nearest_rank_percentile", """
  WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i,
             count(*) OVER (PARTITION BY event_type) AS n FROM events)
  SELECT event_type, p::DOUBLE AS p, value FROM r, (VALUES (0.5::DOUBLE), (0.95), (0.99), (0.999)) v(p) WHERE i = floor(p * n)::BIGINT""")
def _(spark, sf):
    return A.nearest_rank(V.table(spark, sf, "events").select("event_type", "value"), ["event_type"], "value")


_HIST = (12, 10.0, 210.0)


@query("agg_histogram_constant", """
  SELECT event_type, (CASE WHEN value < 10 THEN 0 WHEN value > 210 THEN 11 ELSE floor((value - 10) / 20.0) + 1 END)::INT AS bin, count(*) AS count
  FROM events GROUP BY ALL""")
def _(spark, sf):
    return A.histogram(V.table(spark, sf, "events"), ["event_type"], A.constant_bin(F.col("value"), *_HIST))


@query("agg_histogram_linear", """
  SELECT event_type, (CASE WHEN value > 220 THEN 10 ELSE floor(-0.5 + sqrt(2.0 * (value / 4.0) + 0.25)) END)::INT AS bin, count(*) AS count
  FROM events GROUP BY ALL""")
def _(spark, sf):
    return A.histogram(V.table(spark, sf, "events"), ["event_type"], A.linear_bin(F.col("value"), 11, 220.0))


@query("agg_histogram_quantile", """
  WITH b AS (SELECT event_type, CASE WHEN value < 10 THEN 0 WHEN value > 210 THEN 11 ELSE floor((value - 10) / 20.0)::INT + 1 END AS bin, count(*) AS n
             FROM events GROUP BY ALL),
  s AS (SELECT event_type, bin, sum(n) OVER (PARTITION BY event_type ORDER BY bin) / sum(n) OVER (PARTITION BY event_type) AS share FROM b)
  SELECT event_type, CASE min(bin) WHEN 0 THEN '-inf'::DOUBLE WHEN 11 THEN 'inf'::DOUBLE ELSE 10 + (min(bin) - 1) * 20.0 END::DOUBLE AS value
  FROM s WHERE share > 0.75 GROUP BY 1""")
def _(spark, sf):
    bins = A.histogram(V.table(spark, sf, "events"), ["event_type"], A.constant_bin(F.col("value"), *_HIST))
    return A.histogram_quantile(bins, ["event_type"], 0.75, *_HIST)


@query("agg_retention_summary", f"""
  WITH {RAW_LOG} SELECT "partition", count(*) AS messages_read, sum(strlen(props))::BIGINT AS bytes_read,
    count_if(num > 50)::BIGINT AS messages_retained, coalesce(sum(strlen(props)) FILTER (num > 50), 0)::BIGINT AS bytes_retained,
    coalesce(max("offset") FILTER (num > 50), -1) AS max_offset, coalesce(max(t) FILTER (num > 50), -1) AS max_timestamp,
    coalesce(arg_max("offset", t * 1000000 - "offset") FILTER (num > 50), -1) AS offset_of_max_timestamp
  FROM raw_log GROUP BY 1""")
def _(spark, sf):
    log = V.raw_log(spark, sf).withColumn("value", F.col("props"))
    return A.retention_summary(log, F.col("num") > 50, ["partition"])


@query("agg_topic_partitions", f"""
  WITH {RAW_LOG} SELECT topic, count(DISTINCT "partition") AS partitions, array_to_string(list_sort(list(DISTINCT "partition")), ',') AS ids
  FROM raw_log GROUP BY 1""")
def _(spark, sf):
    out = A.topic_partitions(V.raw_log(spark, sf))
    return out.select("topic", "partitions", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


# ---------------------------------------------------------------- figures along a series


_RATED = BATCHES + f""", rated AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY batch_no) - 1 AS i,
  CASE WHEN end_ms = start_ms THEN 0.0 ELSE {half_up_sql('num_records * 1000.0 / (end_ms - start_ms)', 2)} END AS rate FROM batches)"""


def _rated(spark, sf):
    batches = V.batches(spark, sf)
    return batches.select("series", "batch_no", rate_per_second(
        F.col("num_records"), F.col("end_ms") - F.col("start_ms")).alias("rate"))


@query("win_moving_average", f"""
  WITH {_RATED} SELECT series, batch_no, {mean3_sql('rate', 'PARTITION BY series ORDER BY i ROWS 5 PRECEDING')} AS mean FROM rated""")
def _(spark, sf):
    return windows.moving_average(_rated(spark, sf), ["series"], "batch_no", "rate", 5).select("series", "batch_no", "mean")


@query("win_warmup_skip", f"""
  WITH {_RATED} SELECT series, batch_no, 0.0::DOUBLE AS mean FROM rated WHERE i <= 20 UNION ALL
  SELECT series, batch_no, {mean3_sql('rate', 'PARTITION BY series ORDER BY i ROWS 5 PRECEDING')} FROM rated WHERE i > 20""")
def _(spark, sf):
    return windows.warmup_skip(_rated(spark, sf), ["series"], "batch_no", "rate", 5, 20).select("series", "batch_no", "mean")


_POLLS = RAW_LOG + """, polls AS (SELECT "partition", t // 600000 AS poll, max("offset") // 20 * 20 AS pos FROM raw_log GROUP BY ALL)"""


@query("win_position_delta", f"""
  WITH {_POLLS}, d AS (SELECT *, lag(pos) OVER (PARTITION BY "partition" ORDER BY poll) AS previous FROM polls)
  SELECT "partition", poll, pos, previous, pos - previous AS delta FROM d WHERE previous IS NOT NULL AND pos <> previous""")
def _(spark, sf):
    polls = V.raw_log(spark, sf).groupBy("partition", F.expr("unix_millis(timestamp) div 600000").alias("poll")).agg(
        (F.expr("max(offset) div 20") * 20).alias("pos"))
    return windows.position_delta(polls, ["partition"], "poll", "pos")


@query("win_fetch_share", f"""
  SELECT event_type, h, f AS fetch_ms, t AS total_ms, {half_up_sql('f * 100.0 / t', 2)} AS share FROM (
    SELECT event_type, (epoch_us(ts) // 1000) // 3600000 AS h, sum(user_id)::BIGINT AS f, sum(user_id + event_id % 50)::BIGINT AS t FROM events GROUP BY ALL)
  WHERE t > 0""")
def _(spark, sf):
    rows = V.table(spark, sf, "events").withColumn("h", F.expr("unix_millis(cast(ts AS timestamp)) div 3600000"))
    return windows.fetch_share(rows, ["event_type", "h"], F.col("user_id"), F.col("user_id") + F.col("event_id") % 50)


# ---------------------------------------------------------------- sorts and limits


@query("sort_by_window", _TUMBLING)
def _(spark, sf):
    out = A.tumbling_records(V.sensor(spark, sf)).select("start", "count", rounded("sum"), rounded("avg", 6), "points")
    return limits.sort_by_window(out, "start")


@query("sort_metrics_by_name", """
  SELECT event_type || ':' || (user_id % 20) || ':{id=' || (user_id % 3) || '}' AS label, arg_max(value, event_id) AS value FROM events GROUP BY 1""")
def _(spark, sf):
    metrics = V.table(spark, sf, "events").select(
        F.col("event_type").alias("group"), (F.col("user_id") % 20).cast("string").alias("name"),
        F.concat(F.lit("{id="), F.col("user_id") % 3, F.lit("}")).alias("tags"), "event_id", "value")
    return limits.metrics_by_name(metrics, "event_id")


@query("limit_take_by_partition", f"""
  WITH {BOUNDS}, r AS (SELECT "partition", e // 4 AS f, CASE WHEN "partition" = 1 THEN e // 4 ELSE e * 3 // 4 END AS u FROM bounds),
  q AS (SELECT *, 2000 - coalesce(sum(u - f) OVER (ORDER BY "partition" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS quota FROM r)
  SELECT "partition", "offset", event_id FROM log JOIN q USING ("partition") WHERE "offset" >= f AND "offset" < least(u, f + quota)""")
def _(spark, sf):
    log = V.log(spark, sf)
    ranges = begin_end_offsets(log).select(
        *TP, F.expr("end div 4").alias("from"),
        F.when(F.col("partition") == 1, F.expr("end div 4")).otherwise(F.expr("end * 3 div 4")).alias("until"))
    return limits.take_by_partition(log, ranges, 2000).select("partition", "offset", "event_id")


@query("limit_until_count", """
  WITH b AS (SELECT event_id // 64 AS batch, count(*) AS n FROM events GROUP BY 1),
  c AS (SELECT batch, sum(n) OVER (ORDER BY batch) - n AS before FROM b)
  SELECT batch, event_id FROM (SELECT event_id, event_id // 64 AS batch FROM events) JOIN c USING (batch) WHERE before < 1000""")
def _(spark, sf):
    return limits.until_count(V.table(spark, sf, "events").select("event_id"), F.expr("event_id div 64"), 1000)


# ---------------------------------------------------------------- graph


def _rank_sql(rounds: int) -> str:
    steps = ["r0 AS (SELECT src AS node, 1.0::DOUBLE AS rank FROM d)"]
    for k in range(rounds):
        steps.append(f"""r{k + 1} AS (SELECT dst AS node, 0.15 + 0.85 * sum(rank / n) AS rank
          FROM u JOIN d USING (src) JOIN r{k} ON node = src GROUP BY dst)""")
    return f"""WITH {EDGES}, u AS (SELECT DISTINCT src, dst FROM edges), d AS (SELECT src, count(*) AS n FROM u GROUP BY 1),
      {', '.join(steps)} SELECT node, round(rank, 6) AS rank FROM r{rounds}"""


@query("graph_pagerank", _rank_sql(3))
def _(spark, sf):
    return graph.pagerank(V.edges(spark, sf, repeats=False), 3, repeats=False).select("node", rounded("rank", 6))
