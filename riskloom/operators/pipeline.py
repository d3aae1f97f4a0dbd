"""The whole feature build, and its fit / transform form for train and test frames."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.keys import combined
from riskloom.operators import aggregation, interaction, missing, temporal
from riskloom.operators.group_stats import GroupStats
from riskloom.operators.keyed import broadcast_budget
from riskloom.session import written

ID = "TransactionID"
FAMILIES = ("missing", "aggregation", "interaction", "temporal")


def build_features(df: DataFrame, families: Sequence[str] = FAMILIES, rate_mode: str = "out_of_fold",
                   include_velocity: bool = True) -> tuple[DataFrame, dict[str, list[str]]]:
    """All features of one frame and their names per family; every family looks at the input columns alone."""
    unknown = set(families) - set(FAMILIES)
    if unknown:
        raise ValueError(f"unknown families {sorted(unknown)}")
    # Most look-ups first, while rows are narrow; the missingness flags are plain expressions and come last.
    steps = {
        "temporal": lambda d: temporal.create_temporal_features(d, include_velocity, source=df),
        "aggregation": lambda d: aggregation.create_aggregation_features(d, source=df),
        "interaction": lambda d: interaction.create_interaction_features(d, rate_mode, source=df),
        "missing": lambda d: missing.create_missing_value_features(d, source=df),
    }
    # Every family reads the rows several times; what made them runs once.
    df = written(df)
    out, names = df, {}
    with broadcast_budget(df, _with_keys(df)):
        for family, step in steps.items():
            if family in families:
                out, names[family] = step(out)
    compile_wide_rows(df.sparkSession, len(out.columns))
    added = [c for c in out.columns if c not in df.columns]
    placed = [c for f in FAMILIES for c in names.get(f, [])]
    return out.select(*df.columns, *placed, *[c for c in added if c not in set(placed)]), {
        f: names[f] for f in FAMILIES if f in names}


def compile_wide_rows(spark: SparkSession, columns: int) -> None:
    """Raise the session's column limit for compiled stages to twice the width of the result.

    Beyond the limit (100 by default) every look-up copies the wide row in interpreted steps.
    """
    name = "spark.sql.codegen.maxFields"
    if int(spark.conf.get(name)) < 2 * columns:
        spark.conf.set(name, str(2 * columns))


def _with_keys(df: DataFrame) -> DataFrame:
    """The rows with every composite that some family looks up."""
    out = aggregation.with_composites(df, [r for f in aggregation.FAMILIES.values() for r in f])
    if {"TransactionAmt", "ProductCD"} <= set(df.columns):
        out = out.withColumn("amt_bin", interaction.amount_band(F.col("TransactionAmt")))
    combos = {n: p for f in interaction.FAMILIES.values() for n, p in f.items() if set(p) <= set(out.columns)}
    return out.withColumns({n: combined(*p) for n, p in combos.items()}) if combos else out


class FeatureBuilder:
    """All features, learnt on the training frame: every statistic a feature compares a row with comes from there.

    Training rows and later rows get the same columns. Features of a row's own past (times since, counts, velocities) go
    on from the state the training rows leave behind, so that later rows need no training rows.
    """

    def __init__(self, target: str = "isFraud", value: str = "TransactionAmt"):
        self.target, self.value = target, value
        self.requests = [r for f in aggregation.FAMILIES.values() for r in f]
        self.stats: GroupStats | None = None
        self.rates: interaction.RateEncoder | None = None
        self.missing: missing.MissingFeatures | None = None
        self.temporal: temporal.TemporalFeatures | None = None

    def _prepared(self, df: DataFrame) -> DataFrame:
        out = aggregation.with_composites(df, self.requests)
        if {"TransactionAmt", "ProductCD"} <= set(df.columns):
            out = out.withColumn("amt_bin", interaction.amount_band(F.col("TransactionAmt")))
        return out

    def fit(self, train: DataFrame) -> FeatureBuilder:
        train = written(train)
        self._fit(train).rates.fit(self._prepared(train))
        return self

    def _fit(self, train: DataFrame) -> FeatureBuilder:
        """Learn all but the rates from written rows, which every statistic reads anew."""
        base = self._prepared(train)
        self.missing = missing.MissingFeatures().fit(train)
        self.temporal = temporal.TemporalFeatures().fit(train)
        self.stats = GroupStats(self.value, self.requests).fit(base)
        combos = {n: p for f in interaction.FAMILIES.values() for n, p in f.items()}
        self.rates = interaction.RateEncoder(combos, self.target)
        return self

    def fit_transform(self, train: DataFrame) -> DataFrame:
        """Learn from ``train`` and return its own features; its target rates leave out each row's fold."""
        train = written(train)
        self._fit(train)
        return self._features(train, None, partial(self.rates.fit_transform, source=self._prepared(train)), own=True)

    def transform(self, df: DataFrame, history: DataFrame | None = None) -> DataFrame:
        """Features of ``df``, whose rows come after the training rows; with ``history`` its rows are their past instead."""
        if self.stats is None or self.rates is None or self.rates.table is None:
            raise ValueError("call fit first")
        # As with the training rows, what made them runs once.
        return self._features(written(df), history, self.rates.transform, own=False)

    def _features(self, df: DataFrame, history: DataFrame | None, rated: Callable[[DataFrame], DataFrame], own: bool) -> DataFrame:
        with broadcast_budget(df, _with_keys(df)):
            out = self.temporal.transform(df, history, own)
            out = self.stats.transform(self._prepared(out))
            out = out.withColumns(aggregation.derived_columns(out.columns, {r.prefix for r in self.requests}, self.value))
            out, _ = self.missing.transform(rated(out))
        compile_wide_rows(df.sparkSession, len(out.columns))
        return out
