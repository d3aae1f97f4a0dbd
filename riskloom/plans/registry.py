"""Named queries, each with its column list and, where SQL can state it, the checking text.

A column list such as ``"TransactionID:i card1_mean:d ProductCD:s"`` fixes names, order and types
of the result on both engines: i = whole number, d = double, s = text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.plans.fixture import TXN_SQL

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    columns: tuple[tuple[str, str], ...]
    build: Build
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return shaped(self.build(spark, sf_dir), self.columns)

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        casts = {"i": 'CAST("{0}" AS BIGINT)', "d": 'CAST("{0}" AS DOUBLE)', "s": 'CAST("{0}" AS VARCHAR)'}
        out = ", ".join(f'{casts[kind].format(name)} AS "{name}"' for name, kind in self.columns)
        body = self.sql.strip()
        extra = ""
        if body.upper().startswith("WITH "):
            # The text may bring its own WITH list, closed by a line holding only "--".
            extra, body = body[5:].split("\n--\n", 1)
            extra = f", {extra.strip()}"
        return f"WITH {TXN_SQL.strip()}{extra}\nSELECT {out} FROM (\n{body}\n) q"


def shaped(df: DataFrame, columns: tuple[tuple[str, str], ...]) -> DataFrame:
    casts = {
        "i": lambda c: c.cast("bigint"),
        "d": lambda c: c.cast("double"),
        "s": lambda c: c.cast("string"),
    }
    return df.select(*[casts[kind](F.col(f"`{name}`")).alias(name) for name, kind in columns])


REGISTRY: dict[str, Query] = {}


def register(name: str, columns: str, build: Build, sql: str | None = None) -> None:
    if name in REGISTRY:
        raise ValueError(f"query {name} is registered twice")
    pairs = tuple(tuple(c.rsplit(":", 1)) for c in columns.split())
    REGISTRY[name] = Query(name, pairs, build, sql)
