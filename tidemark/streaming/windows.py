"""Event-time aggregates; each takes a batch or a stream."""

from __future__ import annotations

from collections.abc import Callable
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import split_java
from tidemark.plans.ordering import list_parts


# Microseconds of the units of a width.
_UNITS = {"microsecond": 1, "millisecond": 1000, "second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000,
          "day": 86_400_000_000}


def micros(width: str) -> int:
    """Microseconds of a text like ``5 seconds``."""
    number, unit = width.split()
    return int(number) * _UNITS[unit.lower().removesuffix("s")]


def _sliding(rows: DataFrame, time: str, keys: list[str], parts: dict[str, tuple[Column, Callable[[str], Column]]],
             width: str, slide: str, watermark: str | None, panes: bool) -> DataFrame:
    """Aggregates of sliding windows: window, keys and parts. Each part names how rows make it and how parts add up.

    A watermark lets go of windows that it has passed. With ``panes`` a row goes into one pane only, as wide as the
    greatest common divisor of width and slide, and panes go into the windows that hold them; in a stream this needs
    append mode and a watermark. Without, each row is copied to its windows, in one step that any output mode takes.
    """
    rows = rows.withWatermark(time, watermark) if watermark else rows
    made = [value.alias(name) for name, (value, _) in parts.items()]
    if not panes:
        return rows.groupBy(F.window(time, width, slide).alias("window"), *keys).agg(*made)
    pane = F.window(time, f"{gcd(micros(width), micros(slide))} microseconds").alias("pane")
    return rows.groupBy(pane, *keys).agg(*made).groupBy(
        F.window(F.window_time("pane"), width, slide).alias("window"), *keys).agg(
        *[added(name).alias(name) for name, (_, added) in parts.items()])


def _flat(df: DataFrame) -> DataFrame:
    """Window struct as two columns."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


def line_words(lines: DataFrame, value: str = "value", timestamp: str = "timestamp") -> DataFrame:
    return lines.select(F.explode(split_java(F.col(value))).alias("word"), F.col(timestamp).alias("timestamp"))


def word_sliding(words: DataFrame, width: str = "5 seconds", slide: str = "3 seconds",
                 watermark: str | None = None, panes: bool = False) -> DataFrame:
    """Count per window and word."""
    return _flat(_sliding(words, "timestamp", ["word"], {"count": (F.count(F.lit(1)), F.sum)}, width, slide, watermark, panes))


def sum_max_sliding(values: DataFrame, width: str = "6 seconds", slide: str = "3 seconds",
                    watermark: str | None = None, panes: bool = False) -> DataFrame:
    """Sum and greatest value per window of (time, value) rows."""
    return _flat(_sliding(values, "time", [], {"sum": (F.sum("value"), F.sum), "max": (F.max("value"), F.max)},
                          width, slide, watermark, panes))


def mean_by_asset(values: DataFrame, width: str = "6 seconds", slide: str = "3 seconds",
                  watermark: str | None = None, panes: bool = False) -> DataFrame:
    """Mean per window and asset: (startTime, asset, avgValue)."""
    sums = _sliding(values, "time", ["asset"], {"total": (F.sum("value"), F.sum), "n": (F.count("value"), F.sum)},
                    width, slide, watermark, panes)
    return sums.select(F.col("window.start").alias("startTime"), "asset", F.try_divide("total", "n").alias("avgValue"))


def pack_means(means: DataFrame, text: Column, list_rows: int = 100_000) -> DataFrame:
    """Means of an asset in time order joined by blanks under the key ``asset-startTime`` of the first one.

    A long series comes in parts of about ``list_rows`` windows; ``text`` renders one mean. In a
    stream this second aggregation runs per micro-batch.
    """
    parts = list_parts(means.withColumn("__text", text), ["asset"], "startTime", list_rows)
    packed = parts.groupBy("asset", "part").agg(
        F.sort_array(F.collect_list(F.struct("startTime", "__text"))).alias("items"))
    first = F.date_format(F.col("items")[0]["startTime"], "yyyy-MM-dd HH:mm:ss")
    return packed.select(
        F.concat_ws("-", "asset", first).alias("key"), "part",
        F.array_join(F.transform("items", lambda i: i["__text"]), " ").alias("avgValues"))


def reduce_by_key_window(pairs: DataFrame, key: str, amount: str, width: str = "20 seconds",
                         slide: str = "10 seconds", watermark: str | None = None, panes: bool = False) -> DataFrame:
    """Sum of ``amount`` per window and key; the state store holds the running sums."""
    return _flat(_sliding(pairs, "timestamp", [key], {"sum": (F.sum(amount), F.sum)}, width, slide, watermark, panes))


def second_groups(words: DataFrame, clock: str = "timestamp", list_rows: int = 100_000) -> DataFrame:
    """Per second of the clock: the sorted (word, count) pairs, in parts of about ``list_rows``."""
    counts = words.groupBy(F.date_trunc("second", clock).alias("second"), "word").agg(
        F.count(F.lit(1)).alias("count"))
    parts = list_parts(counts, ["second"], "word", list_rows)
    return parts.groupBy("second", "part").agg(F.sort_array(F.collect_list(F.struct("word", "count"))).alias("words"))
