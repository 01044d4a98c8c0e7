"""Fixed schemas: log envelope, sensor record, ranges, positions, batches."""

from __future__ import annotations

from pyspark.sql import types as T

HEADERS = T.ArrayType(T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.BinaryType()),
]))

LOG = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("timestampType", T.IntegerType()),
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("headers", HEADERS),
])

RECORD = T.StructType([
    T.StructField("orgId", T.StringType()),
    T.StructField("modelId", T.StringType()),
    T.StructField("assetId", T.StringType()),
    T.StructField("pointId", T.StringType()),
    T.StructField("time", T.LongType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("dq", T.IntegerType()),
])

TIME_VALUE = T.StructType([
    T.StructField("time", T.LongType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("assetId", T.StringType()),
])

RANGES = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("from", T.LongType()),
    T.StructField("until", T.LongType()),
])

POSITIONS = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("metadata", T.StringType()),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
