"""Profiling reports. Every report is one or two aggregations whose result has a row per column or group."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import clock
from riskloom.functions.bins import equal_width_index, labelled
from riskloom.functions.nulls import is_missing
from riskloom.functions.stats import erfc, pearson, share
from riskloom.operators.ordering import running_totals
from riskloom.operators.preprocess import frequency_table
from riskloom.operators.quantiles import column_quantiles, stacked
from riskloom.operators.taxonomy import MISSING_RULES, families, family_of

ID, LABEL, TIME, AMOUNT = "TransactionID", "isFraud", "TransactionDT", "TransactionAmt"

# Bands of the missing percentage and of the number of distinct values.
SEVERITY_EDGES = (0, 10, 30, 50, 70, 100)
SEVERITY = ("<10% (Low)", "10-30% (Medium)", "30-50% (High)", "50-70% (Very High)", ">70% (Critical)")
CARDINALITY_EDGES = (0, 5, 20, 50, 100)
CARDINALITY = ("Very Low (≤5)", "Low (6-20)", "Medium (21-50)", "High (51-100)")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = (ID, LABEL)) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _long_row(row: DataFrame, fields: dict[str, list[Column]], names: Sequence[str]) -> DataFrame:
    """One wide row to one row per feature: fields maps output name -> column per feature."""
    cells = [F.struct(F.lit(n).alias("feature"), *[cols[i].alias(f) for f, cols in fields.items()])
             for i, n in enumerate(names)]
    return row.select(F.inline(F.array(*cells)))


def coverage(transactions: DataFrame, identities: DataFrame) -> DataFrame:
    """Row and column counts, and the share of transactions that have identity attributes."""
    n = transactions.agg(F.count("*").alias("n_transactions"))
    m = identities.agg(F.count("*")).scalar()
    matched = transactions.join(identities.select(ID), ID, "left_semi").agg(F.count("*")).scalar()
    return n.select(
        "n_transactions", m.alias("n_identities"), matched.alias("n_matched"),
        F.lit(len(transactions.columns)).alias("transaction_columns"),
        F.lit(len(identities.columns)).alias("identity_columns"),
    ).withColumn("coverage_pct", share(F.col("n_identities") * 100, F.col("n_transactions")))


def class_balance(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Count and percentage per label, and how many rows of other labels stand against one of it."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*")).scalar()
    return counts.select(label, "n", (F.col("n") * 100.0 / total).alias("pct"),
                         share(total - F.col("n"), F.col("n")).alias("others_per_row"))


def dtype_counts(df: DataFrame) -> DataFrame:
    """Columns and non-missing cells per kind of type."""
    kinds = {f.name: ("number" if isinstance(f.dataType, T.NumericType) else
                      "text" if isinstance(f.dataType, T.StringType) else f.dataType.simpleString())
             for f in df.schema.fields}
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    long = _long_row(row, {"kind": [F.lit(kinds[c]) for c in df.columns],
                           "n": [F.col(f"c{i}") for i in range(len(df.columns))]}, df.columns)
    return long.groupBy("kind").agg(F.count("*").alias("n_columns"), F.sum("n").alias("n_cells"))


def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: missing count and percentage, family and severity band (null when nothing is missing)."""
    columns = list(columns or df.columns)
    row = df.agg(F.count("*").alias("rows"),
                 *[F.sum(is_missing(df, c).cast("long")).alias(f"m{i}") for i, c in enumerate(columns)])
    long = _long_row(row, {"missing_count": [F.coalesce(F.col(f"m{i}"), F.lit(0)) for i in range(len(columns))],
                           "n_rows": [F.col("rows")] * len(columns)}, columns)
    pct = share(F.col("missing_count") * 100, F.col("n_rows"))
    return long.withColumn("missing_pct", pct).withColumn("category", family_of("feature", MISSING_RULES, "other")).withColumn(
        "severity", labelled(F.col("missing_pct"), SEVERITY_EDGES, SEVERITY))


def missing_overview(report: DataFrame) -> DataFrame:
    """Whole-table summary of a missing report."""
    return report.agg(
        F.count_if(F.col("missing_count") > 0).alias("columns_with_missing"), F.count("*").alias("n_columns"),
        F.sum("missing_count").alias("missing_cells"),
        share(F.sum("missing_count") * 100, F.sum("n_rows")).alias("overall_pct"),
        F.count_if(F.col("missing_pct") > 50).alias("above_50"), F.count_if(F.col("missing_pct") > 80).alias("above_80"))


def missing_group_summary(report: DataFrame) -> DataFrame:
    """Average, least and greatest missing percentage per family, and columns above 50 %."""
    return report.groupBy("category").agg(
        F.count("*").alias("n_features"), F.avg("missing_pct").alias("avg_pct"), F.min("missing_pct").alias("min_pct"),
        F.max("missing_pct").alias("max_pct"), F.count_if(F.col("missing_pct") > 50).alias("above_50"))


QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def describe(df: DataFrame, columns: Sequence[str], by: str | None = None) -> DataFrame:
    """Count, mean, std, min, quartiles and max per column, optionally per group."""
    basics = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "low": F.min, "high": F.max}
    return column_quantiles(df, columns, QUARTILES, [by] if by else [], basics)


def cardinality(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-missing values and missing percentage per column, with a band up to 100 values."""
    counts = frequency_table(df, columns).groupBy("feature").agg(
        F.count("*").alias("n_unique"), F.sum("n").alias("present"))
    report = missing_report(df, columns).select("feature", "missing_pct")
    return report.join(counts, "feature", "left").select(
        "feature", F.coalesce("n_unique", F.lit(0)).alias("n_unique"), "missing_pct").withColumn(
        "cardinality", labelled(F.col("n_unique"), CARDINALITY_EDGES, CARDINALITY, include_lowest=True))


def low_cardinality_numeric(df: DataFrame, limit: int = 100,
                            exclude: Sequence[str] = (ID, TIME, AMOUNT, LABEL)) -> DataFrame:
    """Numeric columns with fewer than ``limit`` distinct values."""
    return cardinality(df, numeric_columns(df, exclude)).where(F.col("n_unique") < limit)


def value_counts(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """The k most frequent values per column with their share of all rows; ties by value."""
    total = df.agg(F.count("*")).scalar()
    # row_number() <= k is cut per task before the shuffle, so a wide column stays small.
    order = Window.partitionBy("feature").orderBy(F.col("n").desc(), "value")
    ranked = frequency_table(df, columns).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    return ranked.withColumn("pct", F.col("n") * 100.0 / total)


def correlation_with_label(df: DataFrame, columns: Sequence[str], label: str = LABEL, top: int | None = None) -> DataFrame:
    """Pairwise-complete correlation of each column with the label, strongest first."""
    row = df.agg(*[pearson(F.col(f"`{c}`"), F.col(label)).alias(f"r{i}") for i, c in enumerate(columns)])
    long = _long_row(row, {"corr": [F.col(f"r{i}") for i in range(len(columns))]}, columns)
    out = long.withColumn("abs_corr", F.abs("corr"))
    return out.orderBy(F.col("abs_corr").desc_nulls_last(), "feature").limit(top) if top else out


def rank_sum_test(df: DataFrame, columns: Sequence[str], label: str = LABEL) -> DataFrame:
    """Two-sided Mann-Whitney test per column between label 1 and label 0, over all rows.

    Normal approximation with tie and continuity correction. Equal values collapse before ranking.
    """
    long = stacked(df, columns, keep=[label]).where(F.col("value").isNotNull() & F.col(label).isNotNull())
    counts = long.groupBy("feature", "value").agg(
        F.count("*").alias("n"), F.sum(F.col(label).cast("long")).alias("ones"))
    steps = running_totals(counts, ["feature", "value"], ["n"])
    # One row per profiled column.
    base = steps.groupBy("feature").agg(F.min("n_before").alias("start"))
    placed = steps.join(F.broadcast(base), "feature").withColumn(
        "rank", F.col("n_before") - F.col("start") + (F.col("n") + 1) / 2)
    n, ties = F.col("n").cast("double"), F.pow(F.col("n").cast("double"), F.lit(3.0))
    sums = placed.groupBy("feature").agg(
        F.sum("ones").alias("n1"), (F.sum("n") - F.sum("ones")).alias("n0"),
        F.sum(F.col("rank") * F.col("ones")).alias("rank_sum"), F.sum(ties - n).alias("tie_sum"))
    n1, n0 = F.col("n1").cast("double"), F.col("n0").cast("double")
    total = n1 + n0
    u = F.col("rank_sum") - n1 * (n1 + 1) / 2
    spread = F.sqrt(n1 * n0 / 12 * (total + 1 - F.try_divide(F.col("tie_sum"), total * (total - 1))))
    top = F.greatest(u, n1 * n0 - u)
    z = F.try_divide(top - n1 * n0 / 2 - 0.5, spread)
    return sums.select("feature", "n1", "n0", u.alias("u"), z.alias("z")).withColumn("p_value", two_sided(F.col("z")))


def two_sided(z: Column) -> Column:
    """2 * (1 - Phi(z)), at most 1."""
    return F.when(z <= 0, 1.0).otherwise(erfc(z / math.sqrt(2.0)))


def group_summary(df: DataFrame, columns: Sequence[str], label: str = LABEL) -> DataFrame:
    """Mean, median and std per column and label."""
    return column_quantiles(df, columns, {"median": 0.5}, [label], {"mean": F.avg, "std": F.stddev_samp})


def histogram(df: DataFrame, value: str, bins: int, by: str | None = None, low: float | None = None,
              high: float | None = None) -> DataFrame:
    """Equal-width bin counts between the given or observed bounds; empty bins are left out."""
    if low is None or high is None:
        seen = df.agg(F.min(value), F.max(value)).first()
        low, high = (seen[0] if low is None else low), (seen[1] if high is None else high)
    keys = ["bin"] + ([by] if by else [])
    if low is None:
        return df.where(F.lit(False)).withColumn("bin", F.lit(0)).groupBy(*keys).agg(F.count("*").alias("n"))
    binned = df.withColumn("bin", equal_width_index(F.col(value), low, high, bins)).where(F.col("bin").isNotNull())
    width = (high - low) / bins
    return binned.groupBy(*keys).agg(F.count("*").alias("n")).withColumn(
        "left_edge", F.lit(float(low)) + F.col("bin") * F.lit(float(width)))


# --- label rates -----------------------------------------------------------------------------

_PARTS = {"week": clock.week, "hour": clock.hour, "dow": clock.weekday}
_DAY_PARTS = ("Night", "Morning", "Afternoon", "Evening")
# Names of day numbers 0..6.
DAY_NAMES = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")


def time_part(part: str, time: str = TIME) -> Column:
    if part == "daypart":
        return labelled(clock.hour(F.col(time)), (0, 6, 12, 18, 24), _DAY_PARTS, include_lowest=True)
    return _PARTS[part](F.col(time))


def rate_by(df: DataFrame, key: Column, name: str, label: str = LABEL) -> DataFrame:
    """Positives, rows and positive rate in percent per group."""
    return df.groupBy(key.alias(name)).agg(
        F.sum(label).alias("fraud_count"), F.count(label).alias("total_count"), (F.avg(label) * 100).alias("fraud_rate"))


def rate_by_part(df: DataFrame, part: str) -> DataFrame:
    out = rate_by(df, time_part(part), part)
    if part == "dow":
        out = out.withColumn("day_name", F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), F.col("dow") + 1))
    return out


def weekly_rate_trend(df: DataFrame, window: int = 5) -> DataFrame:
    """Weekly rate with its centred moving average, null unless the window is full."""
    half = window // 2
    # One row per week: the ordered window sees a few hundred rows at most.
    around = Window.orderBy("week").rowsBetween(-half, half)
    average = F.when(F.count("fraud_rate").over(around) == window, F.avg("fraud_rate").over(around))
    return rate_by_part(df, "week").withColumn("fraud_rate_ma", average)


def weekly_rate_summary(df: DataFrame) -> DataFrame:
    return rate_by_part(df, "week").agg(
        F.count("*").alias("n_weeks"), F.min("fraud_rate").alias("min_rate"), F.max("fraud_rate").alias("max_rate"),
        F.stddev_samp("fraud_rate").alias("std_rate"))


def rate_heatmap(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Hour rows, weekday columns: rate in percent (r0..r6) and rows (n0..n6)."""
    parts = df.select(clock.hour(F.col(TIME)).alias("hour"), clock.weekday(F.col(TIME)).alias("dow"), label)
    cells = []
    for d in range(7):
        here = F.col("dow") == d
        cells += [(F.avg(F.when(here, F.col(label))) * 100).alias(f"r{d}"), F.count_if(here).alias(f"n{d}")]
    return parts.groupBy("hour").agg(*cells)


def rate_by_flag(df: DataFrame, flags: Sequence[str], label: str = LABEL) -> DataFrame:
    """Rows and label rate where each 0/1 flag is 0 and where it is 1."""
    return stacked(df, flags, keep=[label], kind="int").groupBy("feature", "value").agg(
        F.count("*").alias("n"), F.avg(label).alias("rate"))


def amount_by(df: DataFrame, part: str, amount: str = AMOUNT, by_label: bool = False) -> DataFrame:
    """Mean, median and std of the amount per time part (and label)."""
    keys = [part] + ([LABEL] if by_label else [])
    rows = df.select(time_part(part).alias(part), LABEL, F.col(amount).alias("amount"))
    return column_quantiles(rows, ["amount"], {"median_amt": 0.5}, keys, {"mean_amt": F.avg, "std_amt": F.stddev_samp}).drop("feature")


def time_span(train: DataFrame, test: DataFrame, time: str = TIME) -> DataFrame:
    """First and last instant of both frames, the gap between them and whether they overlap."""
    one = train.agg(F.min(time).alias("train_start"), F.max(time).alias("train_end"))
    start, end = test.agg(F.min(time)).scalar(), test.agg(F.max(time)).scalar()
    return one.select("*", start.alias("test_start"), end.alias("test_end")).withColumns({
        "train_range": F.col("train_end") - F.col("train_start"), "test_range": F.col("test_end") - F.col("test_start"),
        "gap": F.col("test_start") - F.col("train_end"),
        "overlaps": (F.col("test_start") < F.col("train_end")).cast("int")})


def taxonomy_export(df: DataFrame) -> DataFrame:
    """(list_name, feature): families, categorical, mostly missing and many-valued columns."""
    text = text_columns(df)
    numeric = numeric_columns(df, (ID, TIME, AMOUNT, LABEL))
    values = cardinality(df, text + numeric).withColumn("is_text", F.col("feature").isin(text))
    categorical = values.where(F.col("is_text") | (F.col("n_unique") < 100))
    report = missing_report(df)
    columns = [c for c in df.columns if c not in (ID, LABEL)]
    pairs = F.array(*[F.struct(F.lit(f).alias("list_name"), F.lit(c).alias("feature")) for c in columns for f in families(c)])
    named = df.agg(F.count("*")).select(F.inline(pairs))
    return (named
            .unionByName(categorical.select(F.lit("categorical_features").alias("list_name"), "feature"))
            .unionByName(report.where(F.col("missing_pct") > 50).select(
                F.lit("high_missing_features").alias("list_name"), "feature"))
            .unionByName(categorical.where(F.col("n_unique") > 50).select(
                F.lit("high_cardinality_features").alias("list_name"), "feature")))
