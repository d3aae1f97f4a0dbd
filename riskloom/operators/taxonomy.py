"""Feature families by column name."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values: (family, how to look, text); the first rule that matches decides.
RULES: tuple[tuple[str, str, str], ...] = (
    ("V_features", "prefix", "V"),
    ("C_features", "prefix", "C"),
    ("D_features", "prefix", "D"),
    ("M_features", "prefix", "M"),
    ("card_features", "prefix", "card"),
    ("addr_features", "prefix", "addr"),
    ("dist_features", "prefix", "dist"),
    ("email_features", "part", "email"),
    ("device_features", "part", "device"),
    ("id_features", "prefix", "id"),
)
OTHER = "other_features"

# The variants used for missing reports and for importance tables.
MISSING_RULES = tuple(r for r in RULES if r[0] not in ("addr_features", "dist_features"))
IMPORTANCE_RULES: tuple[tuple[str, str, str], ...] = (
    ("V_features", "prefix", "V"),
    ("C_features", "prefix", "C"),
    ("D_features", "prefix", "D"),
    ("M_features", "prefix", "M"),
    ("card_features", "prefix", "card"),
    ("time_features", "prefix", "DT_"),
    ("id_features", "prefix", "id"),
    ("email_features", "part", "email"),
    ("device_features", "part", "device"),
)


def family_of(feature: str | Column, rules: Sequence[tuple[str, str, str]] = RULES, other: str = OTHER) -> Column:
    """Family of a feature-name column: the first rule that matches."""
    name = F.col(feature) if isinstance(feature, str) else feature
    tests: dict[str, Callable[[str], Column]] = {
        "prefix": lambda text: name.startswith(text),
        "part": lambda text: F.contains(F.lower(name), F.lit(text)),
    }
    out = F
    for family, how, text in rules:
        out = out.when(tests[how](text), family)
    return out.otherwise(other)


def families(column: str, rules: Sequence[tuple[str, str, str]] = RULES) -> list[str]:
    """All families a column name belongs to; ``other_features`` when there is none."""
    found = [f for f, how, text in rules
             if (column.startswith(text) if how == "prefix" else text in column.lower())]
    return found or [OTHER]


def feature_taxonomy(df: DataFrame, exclude: Sequence[str] = ("TransactionID", "isFraud")) -> DataFrame:
    """(feature, category, present): every column in every family it belongs to, with its non-missing cells."""
    columns = [c for c in df.columns if c not in exclude]
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(columns)])
    cells = [F.struct(F.lit(c).alias("feature"), F.lit(f).alias("category"), F.col(f"n{i}").alias("present"))
             for i, c in enumerate(columns) for f in families(c)]
    return row.select(F.inline(F.array(*cells)))


def importance_by_family(importances: DataFrame, rules=IMPORTANCE_RULES) -> DataFrame:
    """Sum, mean and count of importance per family."""
    return importances.groupBy(family_of("feature", rules).alias("category")).agg(
        F.sum("importance").alias("importance_sum"), F.avg("importance").alias("importance_mean"),
        F.count("*").alias("n_features"))


def top_share_by_family(importances: DataFrame, k: int = 50, rules=IMPORTANCE_RULES) -> DataFrame:
    """How many of the k most important features each family supplies."""
    top = importances.orderBy(F.col("importance").desc(), "feature").limit(k)
    return top.groupBy(family_of("feature", rules).alias("category")).agg(
        F.count("*").alias("n_top"), (F.count("*") * 100.0 / k).alias("top_pct"))


def selection_rate(features: DataFrame, selected: DataFrame, rules=IMPORTANCE_RULES) -> DataFrame:
    """Per family: features, selected features and their share in percent."""
    flagged = features.select("feature").join(
        selected.select("feature", F.lit(1).alias("_in")), "feature", "left")
    return flagged.groupBy(family_of("feature", rules).alias("category")).agg(
        F.count("*").alias("n_total"), F.count("_in").alias("n_selected"),
        (F.count("_in") * 100.0 / F.count("*")).alias("selected_pct"))


def importance_compare(a: DataFrame, b: DataFrame, k: int = 20) -> DataFrame:
    """Rank by rank, the k leading features of two importance tables."""
    def ranked(t: DataFrame, label: str) -> DataFrame:
        # At most k rows reach the un-partitioned window.
        top = t.orderBy(F.col("importance").desc(), "feature").limit(k)
        order = Window.orderBy(F.col("importance").desc(), "feature")
        return top.select(F.row_number().over(order).alias("place"), F.col("feature").alias(label))

    return ranked(a, "feature_a").join(ranked(b, "feature_b"), "place", "full")
