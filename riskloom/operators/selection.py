"""Feature selection by missing rate, constancy, mutual correlation and importance rules."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators.blocks import bucket, tree_sum
from riskloom.operators.missing import missing_rates
from riskloom.operators.ordering import running_totals
from riskloom.operators.profiling import numeric_columns

MIN_KEPT = 50


def remove_missing_features(df: DataFrame, threshold: float = 0.9) -> list[str]:
    """Columns whose missing rate is strictly above the threshold, in schema order."""
    return [c for c, r in missing_rates(df).items() if r > threshold]


def remove_single_value_features(df: DataFrame) -> list[str]:
    """Columns with at most one distinct non-missing value: least = greatest, or nothing present."""
    aggs = []
    for i, c in enumerate(df.columns):
        col = F.col(f"`{c}`")
        aggs.append(F.coalesce(F.min(col) == F.max(col), F.lit(True)).alias(f"c{i}"))
    row = df.agg(*aggs).first()
    return [c for i, c in enumerate(df.columns) if row[f"c{i}"]]


# --- correlation -----------------------------------------------------------------------------

_SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")
#: Columns of a block.
BLOCK = 64


def _blocks(size: int, block: int) -> list[tuple[int, int]]:
    """Pairs of column blocks, the first not after the second."""
    n = -(-size // block)
    return [(p, q) for p in range(n) for q in range(p, n)]


def _products(size: int, centres: list[float], block: int):
    """Per task: pairwise-complete sums of centred columns, one row per pair of column blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([
                batch.column(i).to_numpy(zero_copy_only=False).astype("float64") for i in range(size)])
            mask = ~np.isnan(x)
            x = np.where(mask, x - centres, 0.0)
            m, square = mask.astype("float64"), x * x
            own = (m.T @ m, x.T @ m, m.T @ x, square.T @ m, m.T @ square, x.T @ x)
            totals = own if totals is None else tuple(np.add(t, o, out=t) for t, o in zip(totals, own))
        if totals is None:
            return
        for p, q in _blocks(size, block):
            cut = [t[p * block:(p + 1) * block, q * block:(q + 1) * block] for t in totals]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p], pa.int32()), pa.array([q], pa.int32()), pa.array([bucket()], pa.int32()),
                 pa.array([np.stack(cut).tobytes()], pa.binary())], names=["p", "q", "bucket", "data"])
    return run


def _unfolded(size: int, block: int):
    """(i, j, sums) for the column pairs i < j of summed blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, q, data in zip(*[c.to_pylist() for c in batch.columns]):
                i, j = (np.arange(k * block, min((k + 1) * block, size)) for k in (p, q))
                sums = np.frombuffer(data).reshape(len(_SUMS), len(i), len(j))
                above = i[:, None] < j[None, :]
                i, j = np.broadcast_arrays(i[:, None], j[None, :])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(i[above], pa.int32()), pa.array(j[above], pa.int32()), *[pa.array(s[above]) for s in sums]],
                    names=["i", "j", *_SUMS])
    return run


def correlation_pairs(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature_a, feature_b, corr) for every pair in schema order; null when a side is constant.

    Each task reduces its rows to matrices of sums, cut into pairs of column blocks, which are added up by
    ``tree_sum``; pairs become rows only after that.
    """
    columns = list(columns or numeric_columns(df))
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    row = values.agg(*[F.avg(F.col(f"`{c}`")).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    centres = [row[f"m{i}"] or 0.0 for i in range(len(columns))]
    parts = values.mapInArrow(_products(len(columns), centres, BLOCK), "p int, q int, bucket int, data binary")
    sums = tree_sum(parts, ["p", "q"], "float64").mapInArrow(
        _unfolded(len(columns), BLOCK), "i int, j int, " + ", ".join(f"{s} double" for s in _SUMS))
    n, sx, sy, sxx, syy, sxy = (F.col(s) for s in _SUMS)
    vx, vy = n * sxx - sx * sx, n * syy - sy * sy
    # A constant side leaves only rounding noise of its squared sum.
    flat = (vx <= 1e-12 * n * sxx) | (vy <= 1e-12 * n * syy)
    corr = F.when(~flat, F.try_divide(n * sxy - sx * sy, F.sqrt(vx * vy)))
    names = F.array(*[F.lit(c) for c in columns])
    return sums.select(
        F.col("i").alias("place_a"), F.col("j").alias("place_b"),
        F.element_at(names, F.col("i") + 1).alias("feature_a"), F.element_at(names, F.col("j") + 1).alias("feature_b"),
        F.when(n >= 2, corr).alias("corr"))


def correlated_features(df: DataFrame, threshold: float = 0.95, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, partner, corr): later columns of a too-close pair with their first partner."""
    close = correlation_pairs(df, columns).where(F.abs("corr") > threshold)
    first = F.min(F.struct("place_a", "feature_a", "corr"))
    return close.groupBy("place_b", F.col("feature_b").alias("feature")).agg(first.alias("f")).select(
        "place_b", "feature", F.col("f.feature_a").alias("partner"), F.col("f.corr").alias("corr"))


def remove_correlated_features(df: DataFrame, threshold: float = 0.95, columns: Sequence[str] | None = None) -> list[str]:
    return [r["feature"] for r in correlated_features(df, threshold, columns).orderBy("place_b").collect()]


# --- importance rules ------------------------------------------------------------------------

def importance_cut(importances: DataFrame, threshold: float = 0.95, min_kept: int = MIN_KEPT) -> DataFrame:
    """Adds place, cumulative share and keep (1/0): kept while the share is at most the threshold.

    When fewer than ``min_kept`` features pass, the top ``min_kept`` are kept instead. Features without
    an importance come last. Places and shares come from running totals, however long the table is.
    """
    value = F.coalesce(F.col("importance").cast("double"), F.lit(0.0))
    falling = F.coalesce(-F.col("importance").cast("double"), F.lit(float("inf")))
    steps = running_totals(
        importances.select("feature", "importance", falling.alias("_order"), value.alias("_value"), F.lit(1).alias("_one")),
        ["_order", "feature"], ["_value", "_one"])
    # One row each by construction.
    total = steps.agg(F.sum("_value").alias("_total"))
    placed = steps.crossJoin(F.broadcast(total)).select(
        "feature", "importance", (F.col("_one_before") + 1).cast("int").alias("place"),
        F.try_divide(F.col("_value_before") + F.col("_value"), F.col("_total")).alias("cumulative_share"))
    within = F.coalesce(F.col("cumulative_share") <= threshold, F.lit(False))
    passing = placed.agg(F.count_if(within).alias("_passing"))
    return placed.crossJoin(F.broadcast(passing)).withColumn(
        "keep", F.when(F.col("_passing") >= min_kept, within).otherwise(F.col("place") <= min_kept).cast("int")).drop("_passing")


def null_importance_rule(actual: DataFrame, null_runs: DataFrame) -> DataFrame:
    """Compare (feature, importance) with (feature, run, importance) from shuffled labels.

    keep = above every null run, or ratio to the null mean above 2, or z-score above 2. The last two add 1 to what
    they divide by, so importances are expected as gains over rows and trees and not as shares of 1.
    """
    null = null_runs.groupBy("feature").agg(
        F.avg("importance").alias("null_mean"), F.stddev_samp("importance").alias("null_std"),
        F.max("importance").alias("null_max"), F.count("*").alias("n_runs"))
    gain = F.col("importance") - F.col("null_mean")
    both = actual.join(null, "feature").withColumns({
        "importance_ratio": F.col("importance") / (F.col("null_mean") + 1), "zscore": gain / (F.col("null_std") + 1)})
    test = (F.col("importance") > F.col("null_max")) | (F.col("importance_ratio") > 2.0) | (F.col("zscore") > 2.0)
    return both.withColumn("keep", F.coalesce(test, F.lit(False)).cast("int"))


def align_features(requested: Sequence[str], *frames: DataFrame) -> tuple[list[str], list[str]]:
    """(usable, absent): requested features, in order, that every frame has, and the rest."""
    usable = [f for f in requested if all(f in d.columns for d in frames)]
    return usable, [f for f in requested if f not in usable]


