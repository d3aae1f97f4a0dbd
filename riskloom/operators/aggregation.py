"""Aggregation features: how a transaction's amount compares with its card, email, device, product or address."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.keys import combined
from riskloom.operators.group_stats import GroupRequest, GroupStats, attach_group_stats, value_frequency

EPSILON = 1e-5

CARD_REQUESTS = (
    GroupRequest("card1", "card1", ("count", "mean", "std", "min", "max", "median", "sum")),
    GroupRequest("card2", "card2", ("count", "mean", "std")),
    GroupRequest("card3", "card3", ("count", "mean")),
    GroupRequest("card4", "card4", ("count", "mean", "std")),
    GroupRequest("card5", "card5", ("count", "mean")),
    GroupRequest("card6", "card6", ("count", "mean")),
    GroupRequest("card1_card2", "card12", ("count", "mean", "std")),
)
EMAIL_REQUESTS = (
    GroupRequest("P_emaildomain", "P_email", ("count", "mean", "std", "min", "max")),
    GroupRequest("R_emaildomain", "R_email", ("count", "mean", "std")),
    GroupRequest("email_combination", "email_comb", ("count", "mean")),
)
DEVICE_REQUESTS = (
    GroupRequest("DeviceType", "DeviceType", ("count", "mean", "std")),
    GroupRequest("DeviceInfo", "DeviceInfo", ("count", "mean", "std", "min", "max")),
    GroupRequest("id_30", "OS", ("count", "mean")),
    GroupRequest("id_31", "browser", ("count", "mean")),
)
PRODUCT_REQUESTS = (
    GroupRequest("ProductCD", "ProductCD", ("count", "mean", "std", "min", "max", "median")),
)
ADDRESS_REQUESTS = (
    GroupRequest("addr1", "addr1", ("count", "mean", "std", "min", "max")),
    GroupRequest("addr2", "addr2", ("count", "mean", "std")),
    GroupRequest("addr_combined", "addr_comb", ("count", "mean")),
)
FAMILIES = {
    "card": CARD_REQUESTS,
    "email": EMAIL_REQUESTS,
    "device": DEVICE_REQUESTS,
    "product": PRODUCT_REQUESTS,
    "address": ADDRESS_REQUESTS,
}
# Composite key column -> its parts.
COMPOSITES = {
    "card1_card2": ("card1", "card2"),
    "email_combination": ("P_emaildomain", "R_emaildomain"),
    "addr_combined": ("addr1", "addr2"),
}
# Feature name prefix -> count column, for 1 / (count + 1).
RARITY = {"P_email": "P_email_count", "R_email": "R_email_count",
          "DeviceInfo": "DeviceInfo_count", "addr1": "addr1_count"}


def with_composites(df: DataFrame, requests: Sequence[GroupRequest]) -> DataFrame:
    wanted = {r.key for r in requests}
    return df.withColumns({
        key: combined(*parts) for key, parts in COMPOSITES.items()
        if key in wanted and set(parts) <= set(df.columns)
    })


def derived_columns(columns: Sequence[str], prefixes: set[str], value: str) -> dict:
    """Ratios and differences computed from the attached statistics."""
    have, out, amount = set(columns), {}, F.col(value)
    if "card1" in prefixes and "card1_mean" in have:
        mean, std = F.col("card1_mean"), F.col("card1_std")
        out["card1_range"] = F.col("card1_max") - F.col("card1_min")
        out["card1_mean_to_std_ratio"] = F.try_divide(mean, std + EPSILON)
        out["card1_amt_deviation"] = amount - mean
        out["card1_amt_deviation_ratio"] = F.try_divide(amount, mean + 1)
        out["card1_amt_zscore"] = F.try_divide(amount - mean, std + EPSILON)
    for prefix, count in RARITY.items():
        if prefix in prefixes and count in have:
            out[f"{prefix}_risk_score"] = F.lit(1.0) / (F.col(count) + 1)
    if "ProductCD" in prefixes and "ProductCD_mean" in have:
        out["ProductCD_amt_deviation"] = amount - F.col("ProductCD_mean")
        out["ProductCD_amt_ratio"] = F.try_divide(amount, F.col("ProductCD_mean") + 1)
    return out


def aggregation_features(df: DataFrame, target_col: str = "TransactionAmt",
                         families: Sequence[str] = tuple(FAMILIES),
                         prefixes: Sequence[str] | None = None,
                         source: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """Attach the statistics of the chosen families; returns the frame and the feature names.

    ``prefixes`` narrows a family to some of its requests. Groups are formed from ``source`` (the
    frame itself by default), which keeps their plans free of whatever was attached to ``df`` before.
    """
    requests = [r for f in families for r in FAMILIES[f] if prefixes is None or r.prefix in prefixes]
    learnt = GroupStats(target_col, requests).fit(with_composites(df if source is None else source, requests))
    out = learnt.transform(with_composites(df, requests))
    out = out.withColumns(derived_columns(out.columns, {r.prefix for r in requests}, target_col) or {})
    composite_keys = set(COMPOSITES)
    names = [c for c in out.columns if c not in df.columns and c not in composite_keys]
    return out, names


def create_card_aggregations(df: DataFrame, target_col: str = "TransactionAmt") -> DataFrame:
    return aggregation_features(df, target_col, ["card"])[0]


def create_email_aggregations(df: DataFrame, target_col: str = "TransactionAmt") -> DataFrame:
    return aggregation_features(df, target_col, ["email"])[0]


def create_device_aggregations(df: DataFrame, target_col: str = "TransactionAmt") -> DataFrame:
    return aggregation_features(df, target_col, ["device"])[0]


def create_product_aggregations(df: DataFrame, target_col: str = "TransactionAmt") -> DataFrame:
    return aggregation_features(df, target_col, ["product"])[0]


def create_address_aggregations(df: DataFrame, target_col: str = "TransactionAmt") -> DataFrame:
    return aggregation_features(df, target_col, ["address"])[0]


def create_aggregation_features(df: DataFrame, target_col: str = "TransactionAmt",
                                source: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    return aggregation_features(df, target_col, source=source)


def kernel_aggregations(df: DataFrame, value: str = "TransactionAmt") -> DataFrame:
    """The shorter variant: card1, card2, card pair and addr1, with names ``<key>_<value>_<stat>``."""
    requests = [
        GroupRequest("card1", f"card1_{value}", ("mean", "std", "min", "max", "count")),
        GroupRequest("card2", f"card2_{value}", ("mean", "count")),
        GroupRequest("card12", f"card12_{value}", ("mean", "count")),
        GroupRequest("addr1", f"addr1_{value}", ("mean", "count")),
    ]
    out = attach_group_stats(df.withColumn("card12", combined("card1", "card2")), value, requests)
    mean = F.col(f"card1_{value}_mean")
    return out.withColumns({
        f"{value}_card1_deviation": F.col(value) - mean,
        f"{value}_card1_ratio": F.try_divide(F.col(value), mean + 1),
    })


# The columns that are frequency-encoded by default.
FREQUENCY_COLUMNS = ("card1", "card2", "card3", "card5", "addr1", "addr2", "P_emaildomain", "R_emaildomain")


def frequency_encoding(df: DataFrame, columns: Sequence[str] = FREQUENCY_COLUMNS) -> DataFrame:
    return value_frequency(df, columns)
