"""Column expressions: text, time, rates. All run inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Time text patterns in use.
TIME_PATTERNS = {
    "clock": "HH:mm:ss",
    "clock_millis": "HH:mm:ss.SSS",
    "log_line": "yyyy-MM-dd HH:mm:ss,SSS",
    "day": "yyyy-MM-dd",
    "minute_second": "yyyy年 mm分ss秒 SSS",
}


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def once(df: DataFrame, keys: Sequence[str], value: Column, name: str) -> DataFrame:
    """Keys and a costly expression that later filters and projections read but do not repeat.

    A filter on a projected expression is pushed below the projection with a copy of
    the expression in it; a generator of one item stops that.
    """
    return df.select(*keys, F.explode(F.array(value)).alias(name))


def split_java(text: Column) -> Column:
    """Split on one blank; empty strings stay inside and in front, not at the end."""
    return (
        F.when(text == "", F.array(F.lit("")))
        .when(F.trim(text) == "", F.array().cast("array<string>"))
        .otherwise(F.split(F.rtrim(text), " "))
    )


def split_whitespace(text: Column) -> Column:
    """First two fields of a whitespace split; a line with fewer raises under ANSI."""
    fields = F.split(text, "\\s+")
    return F.struct(F.element_at(fields, 1).alias("first"), F.element_at(fields, 2).alias("second"))


def bucket_millis(time: Column, width_ms: int) -> Column:
    """Bucket start by long division (toward zero for times before the epoch)."""
    if width_ms <= 0:
        raise ValueError("width_ms must be positive")
    return F.call_function("div", time, F.lit(width_ms).cast("long")) * F.lit(width_ms).cast("long")


def format_time(timestamp: Column, pattern: str) -> Column:
    """Time text in the session zone; ``pattern`` is a name from TIME_PATTERNS or a pattern."""
    return F.date_format(timestamp, TIME_PATTERNS.get(pattern, pattern))


def half_up(number: Column, scale: int) -> Column:
    """HALF_UP rounding of a double by its decimal text, as a double."""
    return F.round(number.cast("decimal(38,12)"), scale).cast("double")


def rate_per_second(count: Column, millis: Column, scale: int = 2) -> Column:
    """count / seconds, HALF_UP; 0.0 when no time went by. A negative scale means 2."""
    scale = 2 if scale < 0 else scale
    per_second = F.try_divide(count.cast("decimal(20,0)") * F.lit(1000), millis.cast("decimal(20,6)"))
    return F.coalesce(F.round(per_second, scale).cast("double"), F.lit(0.0))


def rate_ten_thousands(number: Column) -> Column:
    """Number in units of ten thousand, 2 decimals HALF_UP."""
    return half_up(number / F.lit(10000.0), 2)


def md5_hex(text: Column) -> Column:
    return F.md5(text)


def parse_int_or_zero(text: Column) -> Column:
    """Strict integer text (sign and digits, 32 bit) or 0."""
    return F.coalesce(F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("int")), F.lit(0))
