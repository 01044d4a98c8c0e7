"""JDBC pass-through; connection options always come from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def as_strings(df: DataFrame) -> DataFrame:
    """Every column as text under its own name."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def jdbc_table(spark: SparkSession, url: str, name: str, partition_column: str | None = None,
               lower: int | None = None, upper: int | None = None, tasks: int = 1, **options: str) -> DataFrame:
    """A whole table as text columns; name a partition column and bounds to read it in parallel."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=name, **options)
    if partition_column is not None:
        reader = reader.options(partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
                                numPartitions=str(tasks))
    return as_strings(reader.load())


def append_jdbc(df: DataFrame, url: str, name: str, **options: str) -> None:
    df.write.format("jdbc").options(url=url, dbtable=name, **options).mode("append").save()
