"""Missingness features: which cells of a row are empty, by column, by column family and against averages.

Column families are resolved once against the input columns, so the engine's own indicator
columns never count as members of a family.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.nulls import is_missing, missing_in
from riskloom.operators.group_stats import GroupRequest, GroupStats

# Columns that are neither profiled for indicators nor features.
NOT_FEATURES = ("isFraud", "TransactionID")
INDICATOR_RATE = 0.05
INDICATOR_LIMIT: int | None = None
# Fixed value: V columns from which on a high share of missing ones is a feature.
V_COLUMNS_ABOVE = 50

# Column-name prefixes per family.
PREFIX_GROUPS = {"V": "V", "C": "C", "D": "D", "M": "M", "id": "id_"}
# Columns looked at together.
TOGETHER = {
    "email": ("P_emaildomain", "R_emaildomain"),
    "address": ("addr1", "addr2"),
    "device": ("DeviceType", "DeviceInfo"),
    "identity": ("id_30", "id_31", "id_33"),
}
CRITICAL = ("TransactionAmt", "ProductCD", "card1", "card2")


def _flag(test: Column) -> Column:
    """1 / 0. Written as a choice, not a cast: a flag that equals a term of the row sums would make the
    optimizer restate every sum once per combination of flags."""
    return F.when(test, 1).otherwise(0)


def missing_flag(df: DataFrame, name: str) -> Column:
    return _flag(is_missing(df, name))


def prefix_groups(columns: Sequence[str]) -> dict[str, list[str]]:
    """Case-sensitive prefix families of the given columns; empty ones are left out."""
    found = {g: [c for c in columns if c.startswith(p)] for g, p in PREFIX_GROUPS.items()}
    return {g: cols for g, cols in found.items() if cols}


def missing_rates(df: DataFrame) -> dict[str, float]:
    """Share of missing cells per column, in schema order, from one pass; 0 rows give 0."""
    row = df.agg(F.count("*").alias("_rows"),
                 *[F.sum(is_missing(df, c).cast("long")).alias(f"_{i}") for i, c in enumerate(df.columns)]).first()
    total = row["_rows"]
    return {c: (row[f"_{i}"] / total if total else 0.0) for i, c in enumerate(df.columns)}


def row_missing(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """total_missing_count and its share of the profiled columns."""
    columns = columns or df.columns
    out = df.withColumn("total_missing_count", missing_in(df, columns)).withColumn(
        "total_missing_pct", F.col("total_missing_count") / len(columns))
    return out, ["total_missing_count", "total_missing_pct"]


def often_missing(rates: dict[str, float], limit: int | None = INDICATOR_LIMIT) -> list[str]:
    """Columns with a missing rate above 5 %; with ``limit`` the first ones."""
    return [c for c, r in rates.items() if r > INDICATOR_RATE and c not in NOT_FEATURES][:limit]


def create_basic_missing_indicators(df: DataFrame, source: DataFrame | None = None,
                                    limit: int | None = INDICATOR_LIMIT) -> tuple[DataFrame, list[str]]:
    """Row totals plus ``<c>_ismissing`` for every column whose missing rate is above 5 %; with ``limit`` the first ones."""
    rates = missing_rates(df if source is None else source)
    return _indicators(df, list(rates), often_missing(rates, limit))


def _indicators(df: DataFrame, columns: list[str], flagged: list[str]) -> tuple[DataFrame, list[str]]:
    out, names = row_missing(df, columns)
    made = {f"{c}_ismissing": missing_flag(df, c) for c in flagged}
    return (out.withColumns(made) if made else out), names + list(made)


def create_group_missing_features(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    groups = prefix_groups(columns or df.columns)
    made = {}
    for g, cols in groups.items():
        count = missing_in(df, cols)
        made[f"{g}_missing_count"] = count
        made[f"{g}_missing_pct"] = count / len(cols)
        made[f"{g}_all_missing"] = _flag(count == len(cols))
        made[f"{g}_none_missing"] = _flag(count == 0)
    return (df.withColumns(made) if made else df), list(made)


def create_cooccurrence_features(df: DataFrame) -> tuple[DataFrame, list[str]]:
    made = {}
    for g, cols in TOGETHER.items():
        here = [c for c in cols if c in df.columns]
        if len(here) < 2:
            continue
        count = missing_in(df, here)
        made[f"{g}_both_missing"] = _flag(count == len(here))
        made[f"{g}_one_missing"] = _flag(count == 1)
        made[f"{g}_all_present"] = _flag(count == 0)
    return (df.withColumns(made) if made else df), list(made)


def create_card_missing_patterns(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    cards = [c for c in (columns or df.columns) if re.fullmatch(r"card\d+", c)]
    if not cards:
        return df, []
    count = missing_in(df, cards)
    made = {"card_missing_count": count, "card_missing_pct": count / len(cards),
            **{f"{c}_missing": missing_flag(df, c) for c in cards}}
    return df.withColumns(made), list(made)


def create_unusual_missing_patterns(df: DataFrame, columns: Sequence[str] | None = None, source: DataFrame | None = None,
                                    average: float | None = None, v_columns_above: int = V_COLUMNS_ABOVE) -> tuple[DataFrame, list[str]]:
    """Flags of missing cells that seldom go together; ``high_V_missing`` only with more than ``v_columns_above`` V columns.

    The average share of missing cells is that of ``source`` (the frame itself by default) unless it is given.
    """
    columns = list(columns or df.columns)
    have, made = set(columns), {}
    critical = [c for c in CRITICAL if c in have]
    if critical:
        count = missing_in(df, critical)
        made["critical_missing_count"] = count
        made["has_critical_missing"] = _flag(count > 0)
    if {"DeviceInfo", "DeviceType"} <= have:
        made["device_info_anomaly"] = _flag(is_missing(df, "DeviceInfo") & ~is_missing(df, "DeviceType"))
    for name, a, b in (("email_mismatch_pattern", "P_emaildomain", "R_emaildomain"),
                       ("addr_mismatch_pattern", "addr1", "addr2")):
        if {a, b} <= have:
            made[name] = _flag(is_missing(df, a) != is_missing(df, b))
    v_columns = [c for c in columns if c.startswith("V")]
    if len(v_columns) > v_columns_above:
        made["high_V_missing"] = _flag(missing_in(df, v_columns) > len(v_columns) * 0.7)
    if "total_missing_pct" in df.columns:
        mean = (df if source is None else source).agg(F.avg("total_missing_pct")).scalar() if average is None else F.lit(average)
        made["missing_above_avg"] = _flag(F.col("total_missing_pct") > mean * 1.5)
        made["missing_below_avg"] = _flag(F.col("total_missing_pct") < mean * 0.5)
    return (df.withColumns(made) if made else df), list(made)


def create_missing_interaction_features(df: DataFrame, source: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """The row's missing count next to the mean of its product, card and purchaser e-mail domain."""
    if "total_missing_count" not in df.columns:
        return df, []
    return _versus_groups(df, _group_averages(df if source is None else source))


# Groups whose average missing count is shown next to the row's.
AVERAGES = {"ProductCD": "ProductCD_avg_missing", "card1": "card1_avg_missing", "P_emaildomain": "email_avg_missing"}


def _group_averages(source: DataFrame) -> GroupStats:
    requests = [GroupRequest(k, f"_{k}", ("mean",)) for k in AVERAGES if k in source.columns]
    return GroupStats("total_missing_count", requests).fit(source)


def _versus_groups(df: DataFrame, learnt: GroupStats) -> tuple[DataFrame, list[str]]:
    present = {r.key: AVERAGES[r.key] for r in learnt.requests}
    out = learnt.transform(df)
    out = out.withColumnsRenamed({f"_{k}_mean": name for k, name in present.items()})
    names = list(present.values())
    if "ProductCD" in present:
        out = out.withColumn("missing_vs_product_avg", F.col("total_missing_count") - F.col("ProductCD_avg_missing"))
        names.append("missing_vs_product_avg")
    return out, names


class MissingFeatures:
    """All missingness features, with columns, rates and averages learnt on one frame."""

    def fit(self, source: DataFrame) -> MissingFeatures:
        self.columns = list(source.columns)
        self.flagged = often_missing(missing_rates(source))
        counted = row_missing(source)[0]
        self.average = counted.agg(F.avg("total_missing_pct")).first()[0]
        self.groups = _group_averages(counted)
        return self

    def transform(self, df: DataFrame) -> tuple[DataFrame, list[str]]:
        out, names = df, []
        for step in (
            lambda d: _indicators(d, self.columns, self.flagged),
            lambda d: create_group_missing_features(d, self.columns),
            create_cooccurrence_features,
            lambda d: create_card_missing_patterns(d, self.columns),
            lambda d: create_unusual_missing_patterns(d, self.columns, average=self.average or 0.0),
            lambda d: _versus_groups(d, self.groups),
        ):
            out, made = step(out)
            names += made
        return out, names


def create_missing_value_features(df: DataFrame, source: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """All missingness features of the columns of ``source`` (the frame itself by default)."""
    return MissingFeatures().fit(df if source is None else source).transform(df)


def null_counts(df: DataFrame) -> DataFrame:
    """The short variant: total, share and counts of the V, C, D and M families."""
    groups = prefix_groups(df.columns)
    total = missing_in(df, df.columns)
    return df.withColumns({
        "null_count": total, "null_percentage": total / len(df.columns),
        **{f"null_count_{g}": missing_in(df, groups.get(g, [])) for g in ("V", "C", "D", "M")},
    })
