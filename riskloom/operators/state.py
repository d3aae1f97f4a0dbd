"""What the timelines of keys leave behind: per (key, day) tables that later rows continue from.

New rows need the state of the rows before them, not the rows. A state has two tables: ``days`` sums each key's days
(rows, seconds with rows, first and last second, gaps inside the day), and ``ticks`` keeps the seconds of the last days,
as far back as the longest velocity window reaches. States of two stretches of time merge by summing, so a state is
carried forward by merging it with that of the new rows. Both tables hold one row per key and day, or second, and no sum
of theirs depends on the order of rows: gaps are whole seconds, added up exactly.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.functions import clock
from riskloom.operators.keyed import columns_as_keys, key_rows
from riskloom.session import written

_KEY = ["name", "key"]
_SUM = "decimal(38,0)"


def seconds_of(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """(name, key, at, n): rows per key and second; rows without a key or a time are left out."""
    rows = key_rows(df, columns_as_keys(df, keys), [F.col(time).alias("at")]).where(F.col("at").isNotNull())
    return rows.groupBy(*_KEY, "at").agg(F.count("*").alias("n"))


def day_of(at: str = "at"):
    return F.floor(F.col(at) / clock.DAY)


def day_table(seconds: DataFrame) -> DataFrame:
    """(name, key, day, n, ticks, first_at, last_at, gap_sum, gap_squares, gap_min, gap_max) of (name, key, at, n).

    Gaps are those between neighbouring seconds of the day.
    """
    # At most 86,400 seconds share a (key, day).
    today = Window.partitionBy(*_KEY, "day").orderBy("at")
    gap = (F.col("at") - F.lag("at").over(today)).cast(_SUM)
    return seconds.withColumn("day", day_of()).withColumn("gap", gap).groupBy(*_KEY, "day").agg(
        F.sum("n").alias("n"), F.count("*").alias("ticks"), F.min("at").alias("first_at"), F.max("at").alias("last_at"),
        F.coalesce(F.sum("gap"), F.lit(0)).cast(_SUM).alias("gap_sum"),
        F.coalesce(F.sum((F.col("gap") * F.col("gap")).cast(_SUM)), F.lit(0)).cast(_SUM).alias("gap_squares"),
        F.min("gap").alias("gap_min"), F.max("gap").alias("gap_max"))


def gap_table(days: DataFrame) -> DataFrame:
    """(name, key, n, mean_gap, std_gap, min_gap, max_gap) in hours: gaps between neighbouring rows of a key.

    Rows of one second are no time apart; a key's first row has no gap.
    """
    # One row per day of a key.
    order = Window.partitionBy(*_KEY).orderBy("day")
    over = (F.col("first_at") - F.lag("last_at").over(order)).cast(_SUM)
    sums = days.withColumn("over", over).groupBy(*_KEY).agg(
        F.sum("n").alias("n"), F.sum("ticks").alias("ticks"),
        (F.sum("gap_sum") + F.coalesce(F.sum("over"), F.lit(0))).cast(_SUM).alias("s"),
        (F.sum("gap_squares") + F.coalesce(F.sum((F.col("over") * F.col("over")).cast(_SUM)), F.lit(0))).cast(_SUM).alias("q"),
        F.least(F.min("gap_min"), F.min("over")).alias("low"), F.greatest(F.max("gap_max"), F.max("over")).alias("high"))
    gaps = F.col("n") - 1
    # All sums are whole, so that equal gaps have no spread at all.
    spread = (gaps.cast(_SUM) * F.col("q") - F.col("s") * F.col("s")).cast("double")
    crowded = F.col("n") > F.col("ticks")
    hours = F.lit(float(clock.HOUR))
    return sums.select(
        *_KEY, "n", F.try_divide(F.col("s").cast("double"), gaps.cast("double") * hours).alias("mean_gap"),
        F.when(gaps > 1, F.sqrt(spread / (gaps.cast("double") * (gaps - 1).cast("double"))) / hours).alias("std_gap"),
        F.when(gaps > 0, F.when(crowded, 0.0).otherwise(F.col("low").cast("double") / hours)).alias("min_gap"),
        F.when(gaps > 0, F.coalesce(F.col("high").cast("double"), F.lit(0.0)) / hours).alias("max_gap"))


class TimelineState:
    """The state of all rows up to ``end``; ``reach`` seconds before it can be looked at second by second."""

    def __init__(self, days: DataFrame, ticks: DataFrame, end: int | None, reach: int):
        self.days, self.ticks, self.end, self.reach = days, ticks, end, reach

    @classmethod
    def of(cls, df: DataFrame, keys: Sequence[str], time: str, windows: Mapping[str, int]) -> TimelineState:
        return cls.of_seconds(written(seconds_of(df, keys, time)), windows)

    @classmethod
    def of_seconds(cls, seconds: DataFrame, windows: Mapping[str, int]) -> TimelineState:
        """The state of the rows that a written ``seconds_of`` table counts."""
        reach = max(windows.values(), default=0)
        return cls._cut(written(day_table(seconds)), seconds, seconds.agg(F.max("at")).first()[0], reach)

    @classmethod
    def _cut(cls, days: DataFrame, seconds: DataFrame, end: int | None, reach: int) -> TimelineState:
        """Keep the seconds of whole days from ``reach`` before the end on."""
        first = 0 if end is None else (end - reach) // clock.DAY
        return cls(days, seconds.where(day_of() >= first), end, reach)

    @property
    def first_day(self) -> int:
        """The first day whose seconds are kept."""
        return 0 if self.end is None else (self.end - self.reach) // clock.DAY

    def merge(self, other: TimelineState) -> TimelineState:
        """The state of the rows of both; ``other`` begins after this one ends, the day they meet in may be shared."""
        if self.reach != other.reach:
            raise ValueError("states of different reach")
        if self.end is None or other.end is None:
            return other if self.end is None else self
        start = other.days.agg(F.min("first_at")).first()[0]
        if start <= self.end:
            raise ValueError(f"the later state begins at {start}, not after {self.end}")
        # A day of a key has a part in each state at most.
        parts = Window.partitionBy(*_KEY, "day").orderBy("first_at")
        both = self.days.unionByName(other.days).withColumn(
            "join", (F.col("first_at") - F.lag("last_at").over(parts)).cast(_SUM))
        total = lambda c: F.sum(c).cast(_SUM)
        seam = F.coalesce(F.col("join"), F.lit(0)).cast(_SUM)
        days = both.groupBy(*_KEY, "day").agg(
            F.sum("n").alias("n"), F.sum("ticks").alias("ticks"), F.min("first_at").alias("first_at"),
            F.max("last_at").alias("last_at"), total(F.col("gap_sum") + seam).alias("gap_sum"),
            total(F.col("gap_squares") + seam * seam).alias("gap_squares"),
            F.least(F.min("gap_min"), F.min("join")).alias("gap_min"), F.greatest(F.max("gap_max"), F.max("join")).alias("gap_max"))
        ticks = self.ticks.unionByName(other.ticks)
        return self._cut(written(days), written(ticks), other.end, self.reach)

    def carry(self, df: DataFrame, keys: Sequence[str], time: str, windows: Mapping[str, int]) -> TimelineState:
        """The state after the rows of ``df``, which come later than all rows so far."""
        return self.merge(TimelineState.of(df, keys, time, windows))

    def save(self, path: str) -> None:
        spark = self.days.sparkSession
        self.days.write.parquet(os.path.join(path, "days"))
        self.ticks.write.parquet(os.path.join(path, "ticks"))
        spark.createDataFrame([(self.end, self.reach)], "end long, reach long").write.parquet(os.path.join(path, "span"))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TimelineState:
        days, ticks, span = (spark.read.parquet(os.path.join(path, part)) for part in ("days", "ticks", "span"))
        row = span.first()
        return cls(days, ticks, row["end"], row["reach"])
