"""Projections and filters on log rows and sensor records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalar import once
from tidemark.functions.typed import is_number
from tidemark.plans.ordering import CHUNK_ROWS, dense_index, id_chunk
from tidemark.schemas import RECORD, TIME_VALUE
from tidemark.sources.files import json_lines, parse_json
from tidemark.sources.log import TP

# Texts that stand for a missing key, record or value.
UNKNOWN_PARTITION = "UNKNOWN_PARTITION"
NULL_TEXT = "NULL"


def value_timestamp(log: DataFrame) -> DataFrame:
    return log.select(F.col("value").cast("string").alias("value"), "timestamp")


def key_value_strings(log: DataFrame) -> DataFrame:
    return log.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def log_listing(log: DataFrame) -> DataFrame:
    """Offset, key and payload text, payload bytes and time of each row."""
    return log.select("topic", "partition", "offset", F.decode("key", "UTF-8").alias("key"),
                      F.decode("value", "UTF-8").alias("payload"), F.octet_length("value").alias("size"), "timestamp")


def records(log: DataFrame, value: str = "value") -> DataFrame:
    """JSON payloads as sensor records; missing fields are null, malformed rows go."""
    return json_lines(log.select(F.col(value).cast("string").alias(value)), value, RECORD)


def time_value(log: DataFrame, value: str = "value", with_asset: bool = False) -> DataFrame:
    """(time, value), or (asset, time, value): rows that miss one of them are dropped."""
    names = [f.name for f in TIME_VALUE.fields if with_asset or f.name != "assetId"]
    parsed = json_lines(log.select(F.col(value).cast("string").alias(value)), value,
                        T.StructType([TIME_VALUE[n] for n in names])).dropna()
    out = [F.timestamp_millis("time").alias("time"), F.col("value")]
    return parsed.select(*([F.col("assetId").alias("asset")] if with_asset else []), *out)


def numeric_values(df: DataFrame, payload: str = "value") -> DataFrame:
    return df.where(is_number(F.col(payload).cast("string")))


def non_empty_lines(df: DataFrame, line: str = "value") -> DataFrame:
    """Empty lines go; lines of blanks stay."""
    return df.where(F.length(line) > 0)


def valid_json(df: DataFrame, payload: str = "value") -> DataFrame:
    """Rows whose payload parses as a JSON object."""
    kind = F.schema_of_variant(F.try_parse_json(F.col(payload).cast("string")))
    return df.where(F.coalesce(kind.startswith("OBJECT"), F.lit(False)))


def default_key(key: Column) -> Column:
    return F.coalesce(key, F.lit(UNKNOWN_PARTITION))


def null_literal(value: Column) -> Column:
    return F.coalesce(value, F.lit(NULL_TEXT))


def with_window_and_partition(df: DataFrame, window: Column, partition: Column | None = None) -> DataFrame:
    """Add ``windowTime`` and ``partition``; without a column for it, the task's partition number."""
    index = F.spark_partition_id() if partition is None else partition
    return df.withColumns({"windowTime": window, "partition": index})


def drop_fields(df: DataFrame, names: tuple[str, ...] = ("orgId", "test", "modelId")) -> DataFrame:
    return df.drop(*names)


def with_attributes(df: DataFrame, facts: Mapping[str, Column | str], column: str = "attr") -> DataFrame:
    """Merge facts into a map column; a fact replaces an entry of the same name, a missing map is made."""
    added = F.create_map(*[x for k, v in facts.items()
                           for x in (F.lit(k), (v if isinstance(v, Column) else F.lit(v)).cast("string"))])
    if column not in df.columns:
        return df.withColumn(column, added)
    kept = F.map_filter(F.col(column), lambda k, _: ~k.isin(*facts))
    return df.withColumn(column, F.map_concat(F.coalesce(kept, F.create_map().cast("map<string,string>")), added))


def split_good_errors(log: DataFrame, keys: list[str], value: str = "value") -> tuple[DataFrame, DataFrame]:
    """One parse, two outputs: typed rows, and rows with an error text."""
    payload = F.col(value).cast("string")
    texts = log.select(*keys, payload.alias("payload"))
    parsed = once(texts, [*keys, "payload"], parse_json(F.col("payload"), RECORD), "r")
    checked = parsed.withColumn(
        "error",
        F.when(F.col("r").isNull() | F.col("r._corrupt_record").isNotNull(), F.lit("not a sensor record"))
        .when(F.col("r.value").isNull(), F.lit("no numeric value")))
    good = checked.where(F.col("error").isNull()).select(*keys, *[f"r.{n}" for n in RECORD.names])
    return good, checked.where(F.col("error").isNotNull()).select(*keys, "payload", "error")


def header_equals(headers: Column, name: str, text: str) -> Column:
    """True when one header of that name holds the text."""
    return F.coalesce(F.exists(headers, lambda h: (h["key"] == name) & (F.decode(h["value"], "UTF-8") == text)),
                      F.lit(False))


def last_header(headers: Column, name: str) -> Column:
    """Bytes of the last header of that name, else null."""
    return F.try_element_at(F.filter(headers, lambda h: h["key"] == name), F.lit(-1))["value"]


def from_position(log: DataFrame, positions: DataFrame) -> DataFrame:
    """Rows at or after the target offset of their partition."""
    targets = positions.select(*TP, F.col("offset").alias("__target"))
    return log.join(targets, TP).where(F.col("offset") >= F.col("__target")).drop("__target")


def every_kth(df: DataFrame, keys: list[str], order: str, cap: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Evenly spaced rows per key: every k-th, with k = N / min(N, cap) in whole numbers."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    step = F.expr(f"__n div least(__n, {int(cap)})")
    indexed = dense_index(df, keys, order, id_chunk(order, chunk_rows), "__i")
    return indexed.join(sizes, keys).where(F.col("__i") % step == 0).drop("__i", "__n")
