"""File sources and sinks: text, delimited payloads, JSON lines and documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalar import once
from tidemark.schemas import RECORD
from tidemark.session import scratch_path

_CORRUPT = "_corrupt_record"


def text_lines(spark: SparkSession, path: str, min_partitions: int = 0) -> DataFrame:
    """One row per line of a file or folder; at least ``min_partitions`` input tasks."""
    lines = spark.read.text(path)
    if min_partitions > 1 and lines.rdd.getNumPartitions() < min_partitions:
        lines = lines.repartition(min_partitions)
    return lines


def text_delimited(spark: SparkSession, path: str, delimiter: str = "\n") -> DataFrame:
    """Payload rows cut at a plain-text delimiter; an empty source is an error."""
    payloads = spark.read.option("lineSep", delimiter).text(path)
    if payloads.isEmpty():
        raise ValueError(f"no payload in {path}")
    return payloads


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])


def parse_json(payload: Column, schema: T.StructType) -> Column:
    """JSON text to a struct that also holds the text of a malformed row."""
    return F.from_json(payload, _with_corrupt(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})


def json_lines(df: DataFrame, payload: str = "value", schema: T.StructType = RECORD) -> DataFrame:
    """Typed records of the lines that are well-formed objects with fields of these types; the others are dropped."""
    parsed = once(df, [], parse_json(F.col(payload), schema), "r").where(
        F.col("r").isNotNull() & F.col(f"r.{_CORRUPT}").isNull())
    return parsed.select(*[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields])


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType = RECORD) -> DataFrame:
    """The same from files; the corrupt-record column has to be read for the filter, so it is in the schema."""
    return json_lines(spark.read.text(path), "value", schema)


def json_document(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """Records of documents ``{records, size, time}``, one row per record."""
    schema = T.StructType([
        T.StructField("records", T.ArrayType(record)),
        T.StructField("size", T.LongType()),
        T.StructField("time", T.LongType()),
    ])
    documents = spark.read.schema(schema).option("multiLine", True).json(path)
    return documents.select("size", "time", F.explode("records").alias("r")).select("r.*", "size", "time")


def inline_rows(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """Rows written in the program, or an empty relation of a known schema."""
    return spark.createDataFrame(rows, schema)


def write_text(df: DataFrame, path: str, column: str = "value") -> None:
    """A text folder with one file per partition; an existing path is an error."""
    df.select(F.col(column).alias("value")).write.mode("errorifexists").text(path)


def json_documents(df: DataFrame, keys: list[str], columns: list[str], order: str, at_millis: Column,
                   part_rows: int = 100_000) -> DataFrame:
    """One JSON document ``{records, size, time}`` per key and part of at most ``part_rows`` ids.

    ``order`` is a non-negative integer unique inside the key, so a part is bounded
    however large its key is; a key is whole when its parts are read together.
    """
    part = F.expr(f"`{order}` div {part_rows}")
    grouped = (
        df.withColumn("part", part).groupBy(*keys, "part")
        .agg(F.sort_array(F.collect_list(F.struct(order, *[c for c in columns if c != order]))).alias("records"))
    )
    return grouped.select(
        *keys, "part", F.size("records").cast("long").alias("size"),
        F.to_json(F.struct("records", F.size("records").alias("size"), at_millis.alias("time"))).alias("value"))


def write_json_documents(documents: DataFrame, path: str) -> None:
    """Every document as a file of its own, which is what a multi-line reader takes."""
    documents.select("value").write.mode("errorifexists").option("maxRecordsPerFile", 1).text(path)


def round_trip_text(df: DataFrame, column: str, min_partitions: int = 0) -> DataFrame:
    """Write a column as text to the shared folder and read it back."""
    path = scratch_path(df.sparkSession, "text")
    write_text(df, path, column)
    return text_lines(df.sparkSession, path, min_partitions)
