"""Integer arithmetic on Unix-nanosecond columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from teletide.model import NS_PER_DAY


def bucket(t: Column, step: int) -> Column:
    """Start of the epoch-aligned bucket of width ``step`` that holds ``t``."""
    if step <= 0:
        raise ValueError("step must be positive")
    return t - F.pmod(t, F.lit(step))


def floor_div(x: Column, n: int) -> Column:
    """Division rounding down, also for negative ``x``."""
    return F.call_function(
        "div", x - F.pmod(x, F.lit(n)), F.lit(n))


def ceil_div(x: Column, n: int) -> Column:
    return floor_div(x + F.lit(n - 1), n)


def to_timestamp(t: Column) -> Column:
    """Microsecond timestamp of a nanosecond instant, for partitions and watermarks."""
    return F.timestamp_micros(F.call_function("div", t, F.lit(1000)))


def to_day(t: Column) -> Column:
    """UTC day of an instant, as the integer of days since the epoch turned into a date."""
    return F.date_add(F.lit("1970-01-01").cast("date"), floor_div(t, NS_PER_DAY).cast("int"))


def in_range(df: DataFrame, column: str, start: int = 0, end: int = 0) -> DataFrame:
    """Rows with ``start <= column < end``; 0 leaves that side open.

    On a table partitioned by ``day`` the same bounds are repeated on the partition column, since
    Catalyst cannot infer them from the nanosecond column.
    """
    partitioned = "day" in df.columns
    if start:
        df = df.where(F.col(column) >= start)
        if partitioned:
            df = df.where(F.col("day") >= to_day(F.lit(start)))
    if end:
        df = df.where(F.col(column) < end)
        if partitioned:
            df = df.where(F.col("day") <= to_day(F.lit(end - 1)))
    return df
