"""Grouped statistics of a value column, attached to every row of the group.

Shared by the aggregation, frequency and missingness features.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.keyed import KeyTable, attach, columns_as_keys, key_rows, key_table
from riskloom.operators.quantiles import medians


@dataclass(frozen=True)
class GroupRequest:
    """Which statistics of the value to attach for one key column, and under which name prefix."""

    key: str
    prefix: str
    stats: tuple[str, ...]

    def column(self, stat: str) -> str:
        return f"{self.prefix}_{stat}"


# Statistic -> aggregate function; the median takes the exact distributed path instead.
STATISTICS = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "sum": F.sum}


def group_table(df: DataFrame, value: str, stats_by_key: dict[str, Sequence[str]]) -> DataFrame:
    """(name, key, n, count, mean, ...) for several key columns from one scan and one shuffle."""
    rows = key_rows(df, columns_as_keys(df, list(stats_by_key)), [F.col(value).alias("_value")])
    plain = [s for s in STATISTICS if any(s in stats for stats in stats_by_key.values())]
    table = rows.groupBy("name", "key").agg(
        F.count("*").alias("n"), *[STATISTICS[s](F.col("_value")).alias(s) for s in plain])
    with_median = [k for k, stats in stats_by_key.items() if "median" in stats]
    if with_median:
        middle = medians(key_rows(df, columns_as_keys(df, with_median), [F.col(value).alias("_value")]),
                         ["name", "key"], "_value")
        table = table.join(middle, ["name", "key"], "left")
    return table


class GroupStats:
    """Statistics learnt on one frame and attached to any frame (fit / transform)."""

    def __init__(self, value: str, requests: Sequence[GroupRequest]):
        self.value, self.requests = value, list(requests)
        self.table: KeyTable | None = None

    def fit(self, df: DataFrame) -> GroupStats:
        self.requests = [r for r in self.requests if r.key in df.columns]
        stats: dict[str, list[str]] = {}
        for r in self.requests:
            stats.setdefault(r.key, []).extend(r.stats)
        self.table = key_table(group_table(df, self.value, stats)) if stats else None
        return self

    def transform(self, df: DataFrame, **options) -> DataFrame:
        if self.table is None:
            return df
        outputs: dict[str, dict[str, str]] = {}
        for r in self.requests:
            outputs.setdefault(r.key, {}).update({r.column(s): s for s in r.stats})
        out = attach(df, columns_as_keys(df, list(outputs)), self.table, outputs, **options)
        return out.select(*df.columns, *[r.column(s) for r in self.requests for s in r.stats])


def attach_group_stats(df: DataFrame, value: str, requests: Sequence[GroupRequest], **options) -> DataFrame:
    """Attach every requested statistic of ``df`` to its own rows.

    Absent key columns are skipped; null keys get nulls; requests on the same key share one group.
    """
    return GroupStats(value, requests).fit(df).transform(df, **options)


def value_frequency(df: DataFrame, columns: Sequence[str], **options) -> DataFrame:
    """``<c>_freq`` (rows with the same value) and ``<c>_freq_log`` = log(1 + freq)."""
    keys = columns_as_keys(df, columns)
    if not keys:
        return df
    table = key_table(key_rows(df, keys).groupBy("name", "key").agg(F.count("*").alias("n")))
    out = attach(df, keys, table, {c: {f"{c}_freq": "n"} for c in keys}, **options)
    return out.withColumns({f"{c}_freq_log": F.log1p(f"{c}_freq") for c in keys})
