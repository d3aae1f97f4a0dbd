"""Right-closed interval bins (ml.Bucketizer closes on the left and cannot be used)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = float("inf")


def _chosen(value: Column, edges: Sequence[float], choices: Sequence, include_lowest: bool) -> Column:
    """choices[i] where value lies in (edges[i], edges[i+1]]; null outside and for missing values."""
    below = value < edges[0] if include_lowest else value <= edges[0]
    out = F.when(value.isNull() | F.isnan(value.cast("double")) | below, F.lit(None))
    for upper, choice in zip(edges[1:], choices):
        out = out.when(value <= upper, F.lit(choice))
    return out


def interval_index(value: Column, edges: Sequence[float], include_lowest: bool = False) -> Column:
    """0-based number of the interval ``(edges[i], edges[i+1]]``; null outside all of them."""
    return _chosen(value, edges, range(len(edges) - 1), include_lowest).cast("int")


def labelled(value: Column, edges: Sequence[float], labels: Sequence[str], include_lowest: bool = False) -> Column:
    """Label of the interval that holds ``value``; null outside all of them."""
    return _chosen(value, edges, labels, include_lowest)


def equal_width_index(value: Column, low: float, high: float, bins: int) -> Column:
    """Histogram bin number 0..bins-1 over [low, high]; the last bin is closed; null outside."""
    width = (high - low) / bins
    if width <= 0:
        return F.when(value == low, F.lit(0)).cast("int")
    raw = F.floor((value - F.lit(float(low))) / F.lit(float(width)))
    return F.when((value >= low) & (value <= high), F.least(raw, F.lit(bins - 1))).cast("int")
