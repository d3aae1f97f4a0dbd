"""Missingness expressions. NULL and NaN both count as missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_missing(df: DataFrame, name: str) -> Column:
    col = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def folded_sum(terms: Sequence[Column]) -> Column:
    """Sum as a balanced tree, so that hundreds of terms do not nest hundreds deep."""
    level = list(terms) or [F.lit(0)]
    while len(level) > 1:
        pairs = [level[i] + level[i + 1] for i in range(0, len(level) - 1, 2)]
        level = pairs + ([level[-1]] if len(level) % 2 else [])
    return level[0]


def missing_in(df: DataFrame, names: Sequence[str]) -> Column:
    """Number of missing cells of the row among ``names``."""
    return folded_sum([is_missing(df, n).cast("int") for n in names])


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column, once, at the source."""
    cols = [
        F.when(~F.isnan(F.col(f"`{f.name}`")), F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*cols)
