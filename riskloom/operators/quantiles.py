"""Exact interpolated quantiles without holding a group's values in one task.

The built-in exact percentile keeps every distinct value of a group in one buffer. Two ways do without it:

* ``column_quantiles`` for columns of a frame, in few groups: a mergeable sketch brackets each quantile, one counting
  pass places the brackets, and only the cells inside them, some ten-thousandths, are put in order;
* ``exact_quantiles`` for many groups: equal values collapse map-side, the (group, value) table is put in a
  global order, and the values at the two positions around each quantile are picked out.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.keyed import join_totals
from riskloom.operators.ordering import running_totals

#: The sketch's rank error is below 1 / ACCURACY of the rows; brackets reach twice as far to both sides.
ACCURACY = 10_000
#: Brackets (groups x columns x probabilities) beyond which the long form is ordered instead.
BRACKETS = 100_000


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float]) -> DataFrame:
    """One row per group with a column per entry of ``probs`` (column name -> probability).

    Linear interpolation between order statistics. Rows with a null value or key are left out.
    """
    present = df.where(F.col(value).isNotNull())
    for k in keys:
        present = present.where(F.col(k).isNotNull())
    group = list(keys) or ["_all"]
    source = present if keys else present.withColumn("_all", F.lit(0))
    counts = source.groupBy(*group, value).agg(F.count("*").alias("n"))
    steps = running_totals(counts.withColumn(value, F.col(value).cast("double")), [*group, value], ["n"])
    span = steps.groupBy(*group).agg(
        F.min("n_before").alias("_start"), F.sum("n").alias("_total"), F.count("*").alias("_rows"))
    placed = join_totals(steps, span, group, "_rows").withColumn("_at", F.col("n_before") - F.col("_start"))
    picks = []
    for name, p in probs.items():
        spot = F.lit(float(p)) * (F.col("_total") - 1)
        for side, pos in (("lo", F.floor(spot)), ("hi", F.ceil(spot))):
            here = (F.col("_at") <= pos) & (pos < F.col("_at") + F.col("n"))
            picks.append(F.max(F.when(here, F.col(value))).alias(f"_{side}_{name}"))
    found = placed.groupBy(*group).agg(F.max("_total").alias("_total"), *picks)
    out = []
    for name, p in probs.items():
        spot = F.lit(float(p)) * (F.col("_total") - 1)
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        out.append((low + (high - low) * (spot - F.floor(spot))).alias(name))
    return found.select(*keys, *out)


def medians(df: DataFrame, keys: Sequence[str], value: str, name: str = "median") -> DataFrame:
    return exact_quantiles(df, keys, value, {name: 0.5})


def stacked(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), kind: str = "double",
            feature: str = "feature", value: str = "value") -> DataFrame:
    """Long form: one (feature, value) row per cell of ``columns``."""
    cells = [F.struct(F.lit(c).alias(feature), F.col(f"`{c}`").cast(kind).alias(value)) for c in columns]
    return df.select(*keep, F.inline(F.array(*cells)))


class _Bracket:
    """Where one quantile of one column and group lies: the two positions asked for, and bounds of their values."""

    def __init__(self, group: tuple, slot: int, p: float, n: int, low: float, high: float, least: float, most: float):
        self.group, self.slot, self.n = group, slot, n
        spot = p * (n - 1)
        self.positions, self.share = (math.floor(spot), math.ceil(spot)), spot - math.floor(spot)
        self.low = least if p <= 2 / ACCURACY else low
        self.high = most if p >= 1 - 2 / ACCURACY else high
        self.least, self.most = least, most
        self.below = 0
        self.found: list[float] | None = None

    def count(self, below: int, up_to: int) -> None:
        """Take the numbers of smaller values and of values up to the upper bound; a bracket that misses is opened wide."""
        self.below = below
        if not (below <= self.positions[0] and self.positions[1] < up_to):
            self.low, self.high, self.below = self.least, self.most, 0
        if self.low == self.high or (self.low != self.low and self.high != self.high):
            self.found = [self.low, self.low]

    def value(self) -> float:
        low, high = self.found
        return low + (high - low) * self.share


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Mapping[str, float], by: Sequence[str] = (),
                     basics: Mapping[str, Callable[[Column], Column]] | None = None) -> DataFrame:
    """(feature, *by, *basics, *probs): exact quantiles of each column, with other aggregates of the same scan.

    Columns are taken as doubles. A column without values in a group has no row there, nor has a group with a
    null key. Groups are meant to be few: one number per group, column and probability comes to the driver, at most
    ``BRACKETS``; beyond that the long form goes through ``exact_quantiles``.
    """
    columns, by, basics, names = list(columns), list(by), dict(basics or {}), list(probs)
    cells = [F.col(f"`{c}`").cast("double") for c in columns]
    rows = df.select(*[F.col(f"`{b}`") for b in by], *[c.alias(f"c{i}") for i, c in enumerate(cells)])
    for b in by:
        rows = rows.where(F.col(f"`{b}`").isNotNull())
    asked = [min(1.0, max(0.0, probs[n] + d)) for n in names for d in (-2 / ACCURACY, 2 / ACCURACY)]
    values = [F.col(f"c{i}") for i in range(len(columns))]
    sketch = [F.struct(
        F.count(v).alias("n"), F.min(v).alias("least"), F.max(v).alias("most"),
        F.percentile_approx(v, asked, ACCURACY).alias("marks"), *[f(v).alias(f"b_{k}") for k, f in basics.items()],
    ).alias(f"s{i}") for i, v in enumerate(values)]
    kinds = {k: rows.select(f(values[0])).schema[0].dataType for k, f in basics.items()} if columns else {}
    schema = T.StructType([T.StructField("feature", T.StringType())] + [df.schema[b] for b in by]
                          + [T.StructField(k, kinds.get(k, T.DoubleType())) for k in basics]
                          + [T.StructField(n, T.DoubleType()) for n in names])
    spark = df.sparkSession
    if not columns:
        return spark.createDataFrame([], schema)
    most = BRACKETS // (len(columns) * max(1, len(names))) + 1
    told = rows.groupBy(*by).agg(*sketch).limit(most).collect()
    if len(told) == most and by:
        return _from_long(df, columns, probs, by, basics).select(*schema.names)
    brackets: dict[tuple, _Bracket] = {}
    for row in told:
        group = tuple(row[b] for b in by)
        for i in range(len(columns)):
            s = row[f"s{i}"]
            for k, name in enumerate(names if s["n"] else ()):
                brackets[group, i * len(names) + k] = _Bracket(
                    group, i * len(names) + k, probs[name], s["n"], s["marks"][2 * k], s["marks"][2 * k + 1], s["least"], s["most"])
    if brackets:
        _count(rows, values, by, brackets, len(names))
        if any(b.found is None for b in brackets.values()):
            _order(rows, values, by, brackets, len(names), df)
    out = []
    for row in told:
        group = tuple(row[b] for b in by)
        for i, c in enumerate(columns):
            s = row[f"s{i}"]
            if s["n"]:
                marks = [brackets[group, i * len(names) + k].value() for k in range(len(names))]
                out.append(Row(c, *group, *[s[f"b_{k}"] for k in basics], *marks))
    return spark.createDataFrame(out, schema)


def _from_long(df: DataFrame, columns: Sequence[str], probs: Mapping[str, float], by: Sequence[str],
               basics: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    long = stacked(df, columns, keep=by).where(F.col("value").isNotNull())
    keys = ["feature", *by]
    marks = exact_quantiles(long, keys, "value", probs)
    if not basics:
        return marks
    return long.groupBy(*keys).agg(*[f(F.col("value")).alias(k) for k, f in basics.items()]).join(marks, keys)


def _bounded(rows: DataFrame, by: Sequence[str], brackets: Mapping[tuple, _Bracket]) -> DataFrame:
    """Add ``_low`` and ``_high``, arrays of the bounds of the row's group by slot; null where there is no bracket."""
    size = 1 + max(b.slot for b in brackets.values())
    bounds: dict[tuple, tuple[list, list]] = {}
    for b in brackets.values():
        low, high = bounds.setdefault(b.group, ([None] * size, [None] * size))
        low[b.slot], high[b.slot] = b.low, b.high
    kind = T.ArrayType(T.DoubleType())
    schema = T.StructType([T.StructField(f"_g{k}", rows.schema[b].dataType) for k, b in enumerate(by)]
                          + [T.StructField("_low", kind), T.StructField("_high", kind)])
    table = rows.sparkSession.createDataFrame([(*g, *both) for g, both in bounds.items()], schema)
    same = F.lit(True)
    for k, b in enumerate(by):
        same = same & (F.col(f"`{b}`") == F.col(f"_g{k}"))
    # At most BRACKETS numbers.
    return rows.join(F.broadcast(table), same)


def _count(rows: DataFrame, values: list[Column], by: Sequence[str], brackets: Mapping[tuple, _Bracket], many: int) -> None:
    """Count, per bracket, the smaller values and those up to its upper bound."""
    slots = sorted({b.slot for b in brackets.values()})
    counts = [f for s in slots for f in (
        F.count_if(values[s // many] < F.col("_low")[s]).alias(f"l{s}"), F.count_if(values[s // many] <= F.col("_high")[s]).alias(f"h{s}"))]
    for row in _bounded(rows, by, brackets).groupBy(*by).agg(*counts).collect():
        group = tuple(row[b] for b in by)
        for s in slots:
            if (group, s) in brackets:
                brackets[group, s].count(row[f"l{s}"], row[f"h{s}"])


def _order(rows: DataFrame, values: list[Column], by: Sequence[str], brackets: Mapping[tuple, _Bracket], many: int,
           df: DataFrame) -> None:
    """Put the cells inside the open brackets in order and read the values at their positions."""
    open_ = {k: b for k, b in brackets.items() if b.found is None}
    cells = [F.when((values[s // many] >= F.col("_low")[s]) & (values[s // many] <= F.col("_high")[s]),
                    F.struct(F.lit(s).alias("slot"), values[s // many].alias("value")))
             for s in sorted({b.slot for b in open_.values()})]
    keys = [f"_g{k}" for k in range(len(by))]
    inside = _bounded(rows, by, open_).select(*keys, F.inline(F.filter(F.array(*cells), lambda c: c.isNotNull())))
    steps = running_totals(inside.groupBy(*keys, "slot", "value").agg(F.count("*").alias("n")), [*keys, "slot", "value"], ["n"])
    first = steps.groupBy(*keys, "slot").agg(F.min("n_before").alias("_start"))
    kinds = [T.StructField(k, df.schema[b].dataType) for k, b in zip(keys, by)]
    schema = T.StructType([*kinds, *[T.StructField(n, T.LongType()) for n in ("slot", "_below", "_one", "_two")]])
    spots = df.sparkSession.createDataFrame([(*b.group, b.slot, b.below, *b.positions) for b in open_.values()], schema)
    # Both have a row per open bracket.
    placed = steps.join(F.broadcast(first), [*keys, "slot"]).join(F.broadcast(spots), [*keys, "slot"])
    at = F.col("_below") + F.col("n_before") - F.col("_start")
    picks = [F.max(F.when((at <= F.col(p)) & (F.col(p) < at + F.col("n")), F.col("value"))).alias(f"at{p}") for p in ("_one", "_two")]
    for row in placed.groupBy(*keys, "slot").agg(*picks).collect():
        open_[tuple(row[k] for k in keys), row["slot"]].found = [row["at_one"], row["at_two"]]
