"""Evaluation of scores against labels, and analysis of score distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.stats import share
from riskloom.operators.keyed import join_totals
from riskloom.operators.ordering import running_totals
from riskloom.operators.quantiles import column_quantiles, stacked

ID, LABEL = "TransactionID", "isFraud"


# --- ranking quality -------------------------------------------------------------------------

def _score_steps(df: DataFrame, keys: Sequence[str], score: str, label: str, times: str | None = None) -> DataFrame:
    """One row per (group, distinct score) with positives and negatives here and below.

    Groups share one global order over (group, score), so a large group spreads over many slices.
    """
    rows = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    n = F.lit(1).cast("long") if times is None else F.col(times).cast("long")
    counts = rows.groupBy(*keys, score).agg(
        F.sum((F.col(label) == 1).cast("long") * n).alias("pos"), F.sum((F.col(label) != 1).cast("long") * n).alias("neg"))
    steps = running_totals(counts, [*keys, score], ["pos", "neg"])
    span = steps.groupBy(*keys).agg(
        F.min("pos_before").alias("_p0"), F.min("neg_before").alias("_n0"),
        F.sum("pos").alias("pos_total"), F.sum("neg").alias("neg_total"), F.count("*").alias("_rows"))
    return join_totals(steps, span, keys, "_rows").select(
        *keys, score, "pos", "neg", "pos_total", "neg_total",
        (F.col("pos_before") - F.col("_p0")).alias("pos_below"),
        (F.col("neg_before") - F.col("_n0")).alias("neg_below"))


def grouped_auc(df: DataFrame, keys: Sequence[str], score: str, label: str = LABEL, times: str | None = None) -> DataFrame:
    """Area under the ROC curve per group, ties counted half; null when a class is absent. A row counts ``times`` times."""
    steps = _score_steps(df, keys, score, label, times)
    wins = F.sum(F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg") / 2))
    pairs = F.max("pos_total").cast("double") * F.max("neg_total").cast("double")
    return steps.groupBy(*keys).agg(F.try_divide(wins, pairs).alias("auc"), F.max("pos_total").alias("n_pos"),
                                    F.max("neg_total").alias("n_neg"))


def roc_auc(df: DataFrame, score: str, label: str = LABEL) -> DataFrame:
    """One row (auc, n_pos, n_neg)."""
    return grouped_auc(df.withColumn("_g", F.lit(0)), ["_g"], score, label).drop("_g")


def auc_value(df: DataFrame, score: str, label: str = LABEL) -> float | None:
    row = roc_auc(df, score, label).first()
    return None if row is None else row["auc"]


def roc_curve(df: DataFrame, score: str, label: str = LABEL) -> DataFrame:
    """(threshold, fpr, tpr) for ``score >= threshold`` at every distinct score.

    The starting point (0, 0) has no finite threshold and is not listed.
    """
    steps = _score_steps(df.withColumn("_g", F.lit(0)), ["_g"], score, label)
    return steps.select(
        F.col(score).alias("threshold"),
        share(F.col("neg_total") - F.col("neg_below"), F.col("neg_total")).alias("fpr"),
        share(F.col("pos_total") - F.col("pos_below"), F.col("pos_total")).alias("tpr"))


# --- one threshold ---------------------------------------------------------------------------

def threshold_metrics(df: DataFrame, score: str, label: str = LABEL, threshold: float = 0.5) -> DataFrame:
    """Confusion counts, accuracy, precision, recall and F1; undefined ratios are 0."""
    hit, real = F.col(score) >= threshold, F.col(label) == 1
    counts = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).agg(
        F.count_if(hit & real).alias("tp"), F.count_if(hit & ~real).alias("fp"),
        F.count_if(~hit & ~real).alias("tn"), F.count_if(~hit & real).alias("fn"))
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    zero = F.lit(0.0)
    out = counts.withColumns({
        "accuracy": F.coalesce(share(tp + tn, tp + tn + fp + fn), zero),
        "precision": F.coalesce(share(tp, tp + fp), zero), "recall": F.coalesce(share(tp, tp + fn), zero)})
    p, r = F.col("precision"), F.col("recall")
    return out.withColumn("f1", F.coalesce(F.try_divide(2 * p * r, p + r), zero))


def evaluate_model(df: DataFrame, score: str, label: str = LABEL, threshold: float = 0.5) -> dict[str, float]:
    """AUC and the metrics of one threshold as a small dictionary."""
    return {"auc": auc_value(df, score, label), **threshold_metrics(df, score, label, threshold).first().asDict()}


def confusion_matrix(df: DataFrame, score: str, label: str = LABEL, threshold: float = 0.5) -> DataFrame:
    """(actual, predicted, n, share of the actual class)."""
    cells = df.groupBy(F.col(label).alias("actual"), (F.col(score) >= threshold).cast("int").alias("predicted")).agg(
        F.count("*").alias("n"))
    rows = cells.groupBy("actual").agg(F.sum("n").alias("_row"))
    return cells.join(rows, "actual").select("actual", "predicted", "n", share(F.col("n"), F.col("_row")).alias("row_share"))


# --- score distributions ---------------------------------------------------------------------

# Percentiles of a score profile.
PERCENTILES = (1, 5, 10, 25, 50, 75, 90, 95, 99)


def prediction_profile(df: DataFrame, score: str, uncertainty: str | None = None,
                       percentiles: Sequence[int] = PERCENTILES) -> DataFrame:
    """Count, mean, population deviation, range and percentiles; with the same basics of the uncertainty."""
    basics = [F.count(score).alias("n"), F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"),
              F.min(score).alias("low"), F.max(score).alias("high")]
    if uncertainty:
        basics += [F.avg(uncertainty).alias("unc_mean"), F.stddev_pop(uncertainty).alias("unc_std"),
                   F.min(uncertainty).alias("unc_low"), F.max(uncertainty).alias("unc_high")]
    marks = column_quantiles(df, [score], {f"p{p}": p / 100 for p in percentiles}).drop("feature")
    # Both sides have one row by construction; the percentiles have none if no score is present.
    return df.agg(*basics).join(F.broadcast(marks), F.lit(True), "left")


def score_by_label(df: DataFrame, score: str, label: str = LABEL) -> DataFrame:
    basic = df.groupBy(label).agg(F.count(score).alias("n"), F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"))
    return basic.join(column_quantiles(df, [score], {"median": 0.5}, [label]).drop("feature"), label)


# Segments closed on the left, the last one open-ended.
SEGMENTS = (("Very Low", 0.2), ("Low", 0.4), ("Medium", 0.6), ("High", 0.8))
LAST_SEGMENT = "Very High"


def segment_of(score: Column) -> Column:
    out = F.when(score.isNull(), None)
    for name, upper in SEGMENTS:
        out = out.when(score < upper, name)
    return out.otherwise(LAST_SEGMENT)


def score_segments(df: DataFrame, score: str) -> DataFrame:
    total = df.where(F.col(score).isNotNull()).agg(F.count("*")).scalar()
    return df.where(F.col(score).isNotNull()).groupBy(segment_of(F.col(score)).alias("segment")).agg(
        F.count("*").alias("n")).withColumn("pct", F.col("n") * 100.0 / total)


def confidence_counts(df: DataFrame, score: str, uncertainty: str) -> DataFrame:
    """High and low scores, expected positives, and rows beyond the 90th / 10th uncertainty percentile."""
    marks = column_quantiles(df, [uncertainty], {"p10": 0.1, "p90": 0.9})
    # The percentiles are one row by construction.
    flagged = df.select(F.col(score).alias("s"), F.col(uncertainty).alias("u")).join(
        F.broadcast(marks.select(F.col("p10").alias("_lo"), F.col("p90").alias("_hi"))), F.lit(True), "left")
    return flagged.agg(
        F.count("*").alias("n"), F.count_if(F.col("s") > 0.8).alias("high_score"),
        F.count_if(F.col("s") < 0.2).alias("low_score"), F.sum("s").alias("expected_positives"),
        F.count_if(F.col("u") > F.col("_hi")).alias("high_uncertainty"),
        F.count_if(F.col("u") < F.col("_lo")).alias("low_uncertainty"))


DRIFT_MARKS = {"median": 0.5, "p95": 0.95, "p99": 0.99}


def score_drift(train: DataFrame, test: DataFrame, score: str, limit: float = 0.01) -> DataFrame:
    """(metric, train, test, difference) for mean, median, std, p95 and p99, and whether the means are close."""
    both = train.select(F.lit("train").alias("part"), F.col(score).alias("s")).unionByName(
        test.select(F.lit("test").alias("part"), F.col(score).alias("s")))
    basic = both.groupBy("part").agg(F.avg("s").alias("mean"), F.stddev_pop("s").alias("std"))
    wide = basic.join(column_quantiles(both, ["s"], DRIFT_MARKS, ["part"]).drop("feature"), "part")
    long = stacked(wide, ["mean", "median", "std", "p95", "p99"], keep=["part"], feature="metric")
    out = long.groupBy("metric").agg(
        F.max(F.when(F.col("part") == "train", F.col("value"))).alias("train"),
        F.max(F.when(F.col("part") == "test", F.col("value"))).alias("test"))
    out = out.withColumn("difference", F.col("test") - F.col("train"))
    return out.withColumn("is_similar", F.when(
        F.col("metric") == "mean", (F.abs("difference") < limit).cast("int")))


def metric_gaps(metrics: DataFrame, target: float, baseline: str) -> DataFrame:
    """From (model, train_auc, val_auc): over-fit gap, distance to a target, gain over the baseline model."""
    base = metrics.where(F.col("model") == baseline).agg(F.max("val_auc")).scalar()
    return metrics.withColumns({
        "overfit_gap": F.col("train_auc") - F.col("val_auc"), "to_target": F.lit(float(target)) - F.col("val_auc"),
        "gain": F.col("val_auc") - base})
