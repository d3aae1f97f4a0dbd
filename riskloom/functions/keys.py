"""Composite keys as text, with the missing value printed rather than dropped."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING_TEXT = "nan"


def as_text(column: str | Column) -> Column:
    col = F.col(column) if isinstance(column, str) else column
    return F.coalesce(col.cast("string"), F.lit(MISSING_TEXT))


def combined(*columns: str | Column) -> Column:
    """``a_b_c`` with missing parts printed as ``nan``; never null."""
    return F.concat_ws("_", *[as_text(c) for c in columns])


def same(a: str, b: str) -> Column:
    """1 where both sides are present and equal, else 0."""
    return F.coalesce(F.col(a) == F.col(b), F.lit(False)).cast("int")
