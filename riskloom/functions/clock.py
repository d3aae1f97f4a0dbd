"""Time parts of a seconds counter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86400
WEEK = 604800
HOUR = 3600

# Fixed value: first calendar instant of the seconds counter.
CALENDAR_START = "2017-12-01"


def day(seconds: Column) -> Column:
    return F.floor(seconds / DAY).cast("long")


def week(seconds: Column) -> Column:
    return F.floor(seconds / WEEK).cast("long")


def hour(seconds: Column) -> Column:
    return F.floor((seconds % DAY) / HOUR).cast("int")


def weekday(seconds: Column) -> Column:
    """Day number modulo 7, counted from the first instant (0 = first day)."""
    return (day(seconds) % 7).cast("int")


def calendar(seconds: Column, start: str = CALENDAR_START) -> Column:
    return F.timestamp_seconds(F.unix_timestamp(F.lit(start).cast("timestamp")) + seconds)


def calendar_hour(seconds: Column, start: str = CALENDAR_START) -> Column:
    return F.hour(calendar(seconds, start))


def calendar_weekday(seconds: Column, start: str = CALENDAR_START) -> Column:
    """Monday = 0."""
    return F.weekday(calendar(seconds, start))


def in_range(value: Column, low: int, high: int) -> Column:
    """1 where low <= value < high, else 0."""
    return F.coalesce((value >= low) & (value < high), F.lit(False)).cast("int")


def on_circle(value: Column, period: int) -> tuple[Column, Column]:
    angle = value * F.lit(2.0) * F.pi() / F.lit(period)
    return F.sin(angle), F.cos(angle)
