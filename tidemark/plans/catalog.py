"""Registry of named queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def ms(name: str, alias: str | None = None) -> Column:
    """A timestamp column as epoch milliseconds."""
    return F.unix_millis(name).alias(alias or name)


def rounded(name: str, places: int = 4) -> Column:
    return F.round(name, places).alias(name)


# SQL of the views in views.py; a query puts those it needs behind WITH.
SENSOR = """sensor AS (
  SELECT 'o1' AS orgId, event_type AS modelId, 'asset_' || (user_id % 20) AS assetId, 'user_' || user_id AS pointId,
         epoch_us(ts) // 1000 AS time, value, 0::INT AS dq, event_id, user_id, ts
  FROM events)"""
RAW_LOG = """raw_log AS (
  SELECT 'events' AS topic, (user_id % 4)::INT AS "partition", event_id AS "offset", ts AS "timestamp",
         epoch_us(ts) // 1000 AS t, 'user_' || user_id AS "key", value AS num, event_id, user_id, event_type, props
  FROM events)"""
LOG = """log AS (
  SELECT 'events' AS topic, (user_id % 4)::INT AS "partition",
         row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS "offset", ts AS "timestamp",
         epoch_us(ts) // 1000 AS t, 'user_' || user_id AS "key", value AS num, event_id, user_id, event_type, props
  FROM events)"""
BOUNDS = LOG + """, bounds AS (
  SELECT topic, "partition", min("offset") AS b, max("offset") + 1 AS e FROM log GROUP BY ALL)"""
RAW_BOUNDS = RAW_LOG + """, bounds AS (
  SELECT topic, "partition", min("offset") AS b, max("offset") + 1 AS e FROM raw_log GROUP BY ALL)"""
WORDS = """words AS (SELECT unnest(string_split(rtrim(text, ' '), ' ')) AS word FROM documents)"""
LINES = """lines AS (SELECT unnest(string_split(text, chr(10))) AS value FROM documents)"""
EDGES = """edges AS (
  SELECT 'p' || l_partkey AS src, 's' || l_suppkey AS dst FROM lineitem
  UNION ALL SELECT 's' || l_suppkey, 'p' || l_partkey FROM lineitem)"""
BATCHES = """batches AS (
  SELECT event_type AS series, h AS batch_no, h * 3600000 AS batch_time, h * 3600000 + 5 AS submit_ms,
         h * 3600000 + 5 + users % 40 AS start_ms, h * 3600000 + 5 + users % 40 + users % 700 AS end_ms, num_records
  FROM (SELECT event_type, (epoch_us(ts) // 1000) // 3600000 AS h, count(*) AS num_records, sum(user_id)::BIGINT AS users
        FROM events GROUP BY ALL))"""
BATCH_KEYS = """keyed AS (
  SELECT *, event_id // ((SELECT max(event_id) + 4 FROM events) // 4) AS batch_key FROM events)"""


def half_up_sql(x: str, places: int) -> str:
    """HALF_UP by decimal text, as in functions.scalar.half_up."""
    return f"round(CAST({x} AS DECIMAL(38,12)), {places})::DOUBLE"


def mean3_sql(value: str, window: str) -> str:
    """Mean of figures with 2 decimals, HALF_UP to 3, in whole numbers."""
    cents = f"sum(round({value} * 100)::BIGINT) OVER ({window})"
    n = f"count(*) OVER ({window})"
    return f"((({cents} * 20 + {n}) // (2 * {n}))::DOUBLE / 1000.0)"


def windows_sql(source: str, width_us: int, slide_us: int, columns: str) -> str:
    """Rows of ``source`` (with ``ts``) once per sliding window, as (ws, columns)."""
    copies = -(-width_us // slide_us)
    return f"""SELECT ws, {columns} FROM (
      SELECT *, (epoch_us(ts) // {slide_us}) * {slide_us} - k * {slide_us} AS ws
      FROM {source}, (SELECT unnest(range({copies})) AS k)) WHERE ws > epoch_us(ts) - {width_us}"""
