"""Column helpers shared by the operators."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """Division that yields ``default`` where the divisor is zero (ANSI mode would raise)."""
    other = F.lit(default).cast("double")
    return F.when(den != 0, num / den).otherwise(F.when(den.isNotNull(), other))


def clip_lower(value: Column, bound: float) -> Column:
    """Lower clip that keeps null; ``greatest`` alone would turn null into the bound."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(bound)))


def flag(condition: Column) -> Column:
    """0/1 as bigint, an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("bigint")


def floor_div(value: Column, unit: int) -> Column:
    """Integer division rounding to minus infinity."""
    return ((value - F.pmod(value, F.lit(unit))) / F.lit(unit)).cast("bigint")


def millis(delta: timedelta) -> int:
    return delta // timedelta(milliseconds=1)


def micros(delta: timedelta) -> int:
    return delta // timedelta(microseconds=1)


def interval(delta: timedelta) -> str:
    return f"{millis(delta)} milliseconds"


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to a timestamp, null when it cannot be read."""
    return F.try_to_timestamp(text)


def end_of_day(ts: Column) -> Column:
    return ts + F.expr("interval 23 hours 59 minutes 59 seconds")


def day_of_week(ts: Column) -> Column:
    """Sunday is 0."""
    return F.dayofweek(ts) - 1
