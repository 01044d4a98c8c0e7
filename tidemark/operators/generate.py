"""Seeded records for load and tests; every row depends on its number and the seed alone."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.draws import draw, draw_int, draw_unit

# Words and their weights by repetition, shortest line and draw range of its bound, letters.
WORDS = ["java", "scala", "kafka", "java", "spark", "hadoop", "java", "big", "flink", "spark"]
LEAST_WORDS = 2
BOUND_DRAWS = 8
LETTERS = 26


def sensor_records(df: DataFrame, number: str, time_ms: Column, seed: int = 0,
                   overrides: Mapping[str, Column] | None = None) -> DataFrame:
    """One record per row with constant ids, a drawn value and a nested ``attr``; overrides come last and win."""
    columns: dict[str, Column] = {
        "orgId": F.lit("orgId"), "modelId": F.lit("modelId"), "modelIdPath": F.lit("/modelId"),
        "assetId": F.lit("assetId"), "pointId": F.lit("pointId"), "time": time_ms,
        "value": draw_unit(F.col(number), seed),
        "attr": F.struct(F.lit(0).alias("calQuality"), F.lit(1).alias("id")),
        "dq": F.lit(0).cast("long"), "quality": F.lit(0),
    }
    columns.update(overrides or {})
    return df.select(number, *[c.alias(n) for n, c in columns.items()])


def fixed_payload(size: int, seed: int = 0) -> Column:
    """The same text of capital letters for every record."""
    return F.lit("".join(chr(65 + draw_int(i, seed, LETTERS)) for i in range(size)))


def word_line(number: Column, seed: int = 0) -> Column:
    """A line of drawn words. Its bound is drawn anew before every word, so short lines are more likely."""
    longest = LEAST_WORDS + BOUND_DRAWS - 1
    slot = number * 16
    length = F.array_min(F.filter(
        F.array(*[F.lit(i) for i in range(longest + 1)]),
        lambda i: i >= draw(slot + i, seed, BOUND_DRAWS) + LEAST_WORDS))
    words = F.array(*map(F.lit, WORDS))
    return F.array_join(
        F.transform(F.sequence(F.lit(1), length),
                    lambda i: F.element_at(words, draw(slot + i, seed + 1, len(WORDS)) + 1)), " ")


def fixed_rate(intervals: DataFrame, start_ms: str, per_interval: int, kind: str = "words", seed: int = 0) -> DataFrame:
    """``per_interval`` log rows for each interval start: key the number in it, value a word line or a record."""
    rows = intervals.select(start_ms, F.explode(F.sequence(F.lit(0), F.lit(per_interval - 1))).alias("i"))
    number = F.expr(f"`{start_ms}` div 1000") * per_interval + F.col("i")
    if kind == "words":
        return rows.select(start_ms, F.col("i").cast("string").alias("key"), word_line(number, seed).alias("value"))
    made = sensor_records(rows.withColumn("number", number), "number", F.col(start_ms), seed,
                          {"key": F.col("i").cast("string"), start_ms: F.col(start_ms)})
    names = [c for c in made.columns if c not in ("number", "key", start_ms)]
    return made.select(start_ms, "key", F.to_json(F.struct(*names)).alias("value"))
