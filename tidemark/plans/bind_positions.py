"""Log positions and read-committed views on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import positions as P
from tidemark.plans import views as V
from tidemark.plans.catalog import BOUNDS, LOG, RAW_BOUNDS, RAW_LOG, query
from tidemark.sources.log import TP


def _bounds(spark, sf):
    return P.begin_end_offsets(V.raw_log(spark, sf))


# Partition 0 holds a position inside its range, 1 one past the end, 2 none, 3 one before the start.
_HELD = """CASE "partition" WHEN 0 THEN e // 2 WHEN 1 THEN e + 7 WHEN 3 THEN -4 END"""


def _held(bounds):
    offset = F.when(F.col("partition") == 0, F.expr("end div 2")).when(
        F.col("partition") == 1, F.col("end") + 7).when(F.col("partition") == 3, F.lit(-4))
    return bounds.where("partition <> 2").select(*TP, offset.alias("offset"))


@query("log_begin_end_offsets", f'WITH {RAW_BOUNDS} SELECT topic, "partition", b AS "begin", e AS "end" FROM bounds')
def _(spark, sf):
    return _bounds(spark, sf)


@query("log_reset_policy", f"""
  WITH {RAW_BOUNDS}, h AS (SELECT *, {_HELD} AS held FROM bounds)
  SELECT topic, "partition", 'earliest' AS policy, CASE WHEN held BETWEEN b AND e THEN held ELSE b END AS "offset" FROM h
  UNION ALL SELECT topic, "partition", 'latest', CASE WHEN held BETWEEN b AND e THEN held ELSE e END FROM h""")
def _(spark, sf):
    bounds = _bounds(spark, sf)
    both = [P.reset_positions(bounds, _held(bounds), p).withColumn("policy", F.lit(p)) for p in ("earliest", "latest")]
    return both[0].unionByName(both[1])


@query("log_reset_to_committed", f"""
  WITH {RAW_BOUNDS} SELECT topic, "partition", coalesce({_HELD}, b) AS "offset" FROM bounds""")
def _(spark, sf):
    bounds = _bounds(spark, sf)
    return P.reset_to_committed(bounds, _held(bounds))


@query("log_consumer_lag", f"""
  WITH {RAW_BOUNDS}, l AS (SELECT topic, "partition", e // 3 AS position, CASE WHEN "partition" < 3 THEN e END AS "end",
       CASE WHEN "partition" < 3 THEN e END - e // 3 AS lag FROM bounds)
  SELECT *, max(lag) OVER () AS max_lag, round(avg(lag) OVER (), 6) AS avg_lag FROM l""")
def _(spark, sf):
    bounds = _bounds(spark, sf)
    ends = bounds.select(*TP, F.when(F.col("partition") < 3, F.col("end")).alias("high_watermark"))
    held = bounds.select(*TP, F.expr("end div 3").alias("offset"))
    return P.consumer_lag(ends, held).withColumn("avg_lag", F.round("avg_lag", 6))


@query("log_commit_merge", f"""
  WITH {LOG} SELECT topic, "partition", max(u) AS "offset" FROM (
    SELECT topic, "partition", "offset" // 50 AS poll, max("offset") + 1 AS u FROM log GROUP BY ALL) GROUP BY ALL""")
def _(spark, sf):
    ranges = V.log(spark, sf).groupBy(*TP, F.expr("offset div 50").alias("poll")).agg(
        F.min("offset").alias("from"), (F.max("offset") + 1).alias("until"))
    return P.merge_commits(ranges)


@query("log_offset_store", f"""
  WITH {RAW_BOUNDS} SELECT topic, "partition", e AS "offset" FROM bounds WHERE "partition" <> 1
  UNION ALL SELECT DISTINCT topic, p::INT, 0::BIGINT FROM bounds, (SELECT unnest(range(4, 7)) AS p)""")
def _(spark, sf):
    held = _bounds(spark, sf).where("partition <> 1").select(*TP, F.col("end").alias("offset"))
    return P.load_offsets(P.save_offsets(held), 7)


@query("log_replay_when_past", f"""
  WITH {RAW_BOUNDS} SELECT topic, "partition", 'low' AS "limit", b AS "offset" FROM bounds
  UNION ALL SELECT topic, "partition", 'high', e FROM bounds""")
def _(spark, sf):
    bounds = _bounds(spark, sf)
    ranges = bounds.select(*TP, F.col("begin").alias("from"), F.col("end").alias("until"))
    both = [P.replay_when_past(ranges, bounds, limit).withColumn("limit", F.lit(name))
            for name, limit in (("low", 10), ("high", 2 ** 62))]
    return both[0].unionByName(both[1])


@query("log_range_count", f"""
  WITH {BOUNDS} SELECT topic, sum(e - e // 4)::BIGINT AS count, false AS empty FROM bounds GROUP BY 1""")
def _(spark, sf):
    # Offsets of a log without gaps: the ends are the counts, and nothing has to be numbered.
    ends = V.raw_log(spark, sf).groupBy(*TP).agg(F.count(F.lit(1)).alias("end"))
    ranges = ends.select(*TP, F.expr("end div 4").alias("from"), F.col("end").alias("until"))
    return P.range_count(ranges)


# Every user is a producer: type "error" aborts its open transaction, "signup" commits it, "view" rows are outside any.


def _transactional(spark, sf):
    return transactional(V.raw_log(spark, sf))


def transactional(log):
    control = F.when(F.col("event_type") == "error", P.ABORT).when(F.col("event_type") == "signup", P.COMMIT)
    return log.select(*TP, "offset", F.col("user_id").cast("bigint").alias("producer_id"),
                      (F.col("event_type") != "view").alias("is_transactional"), control.alias("control"))


_TX = RAW_LOG + """, tx AS (SELECT "partition", "offset", user_id AS producer_id, event_type <> 'view' AS tx,
    CASE event_type WHEN 'error' THEN 'ABORT' WHEN 'signup' THEN 'COMMIT' END AS control FROM raw_log),
  nxt AS (SELECT *, first_value(control IGNORE NULLS) OVER w AS marker,
            first_value(CASE WHEN control IS NOT NULL THEN "offset" END IGNORE NULLS) OVER w AS marker_offset
          FROM tx WHERE tx WINDOW w AS (PARTITION BY "partition", producer_id ORDER BY "offset"
                                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


READ_COMMITTED = f"""
  WITH {_TX} SELECT "partition", "offset", producer_id FROM tx WHERE NOT tx
  UNION ALL SELECT "partition", "offset", producer_id FROM nxt WHERE control IS NULL AND marker = 'COMMIT'"""


@query("log_read_committed", READ_COMMITTED)
def _(spark, sf):
    return P.read_committed(_transactional(spark, sf)).select("partition", "offset", "producer_id")


@query("log_aborted_spans", f"""
  WITH {_TX} SELECT "partition", producer_id, min("offset") AS first_offset, marker_offset AS last_offset
  FROM nxt WHERE control IS NULL AND marker = 'ABORT' GROUP BY "partition", producer_id, marker_offset""")
def _(spark, sf):
    return P.aborted_spans(_transactional(spark, sf)).select("partition", "producer_id", "first_offset", "last_offset")


@query("log_commit_every_n", f"""
  WITH {RAW_LOG}, n AS (SELECT *, (row_number() OVER (PARTITION BY "partition" ORDER BY "offset") - 1) // 200 AS commit_no FROM raw_log)
  SELECT topic, "partition", commit_no, count(*) AS rows, max("offset") + 1 AS next_offset, count(*) >= 200 AS committed
  FROM n GROUP BY ALL""")
def _(spark, sf):
    return P.commit_groups(V.raw_log(spark, sf), 50, 200)  # a log with gaps


@query("stream_rate_plan", f"""
  WITH {RAW_BOUNDS}, l AS (SELECT topic, "partition", e // (2 + "partition") AS f, e, (e - e // (2 + "partition")) AS lag FROM bounds),
  s AS (SELECT *, floor((lag::FLOAT / (sum(lag) OVER ())::FLOAT * 400::FLOAT)::DOUBLE + 0.5)::BIGINT AS share FROM l)
  SELECT topic, "partition", 'rate' AS plan, f AS "from", least(f + 2 * share, e) AS until FROM s
  UNION ALL SELECT topic, "partition", 'capped', f, least(f + 2 * least(share, 95), e) FROM s
  UNION ALL SELECT topic, "partition", 'cap only', f, least(f + 2 * 25, e) FROM s
  UNION ALL SELECT topic, "partition", 'free', f, e FROM s""")
def _(spark, sf):
    latest = _bounds(spark, sf)
    held = latest.select(*TP, F.expr("end div (2 + partition)").alias("offset"))
    plans = {"rate": (400, 0), "capped": (400, 95), "cap only": (0, 25), "free": (0, 0)}
    out = [P.rate_plan(held, latest, 2000, *args).withColumn("plan", F.lit(name)) for name, args in plans.items()]
    total = out[0]
    for part in out[1:]:
        total = total.unionByName(part)
    return total
