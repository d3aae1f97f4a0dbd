"""Validation folds. Fold geometry is driver arithmetic on the row count; membership is a column expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.ordering import before_mark, hash_number, position_marks, row_index

ID, LABEL, TIME = "TransactionID", "isFraud", "TransactionDT"


def time_series_bounds(n: int, n_splits: int = 5, test_size: float = 0.2) -> list[tuple[int, int]]:
    """(validation start, validation end) per fold; training is everything before the start.

    Folds overlap: each validates up to ``test_size`` of the rows, starts move by test_size / n_splits.
    """
    width, out = int(n * test_size), []
    for i in range(n_splits):
        start = int(n * (1 - test_size * (n_splits - i) / n_splits))
        end = min(start + width, n)
        if start > 0 and end > start:
            out.append((start, end))
    return out


def expanding_bounds(n: int, n_splits: int = 5) -> list[tuple[int, int]]:
    """Blocks of n // (n_splits + 1): fold i trains on the first i blocks and validates on the next."""
    block = n // (n_splits + 1)
    return [((i + 1) * block, min((i + 2) * block, n)) for i in range(n_splits)]


def fold_tests(df: DataFrame, bounds: Sequence[tuple[int, int]], time: str = TIME,
               row_id: str = ID) -> list[tuple[Column, Column]]:
    """(is training row, is validation row) per fold, as comparisons with the rows at the fold bounds."""
    marks = position_marks(df, [p for b in bounds for p in b], time, row_id)
    tests = []
    for start, end in bounds:
        early = before_mark(df, marks.get(start), time, row_id)
        tests.append((early, ~early & before_mark(df, marks.get(end), time, row_id)))
    return tests


def fold_membership(df: DataFrame, tests: Sequence[tuple[Column, Column]], keep: Sequence[str]) -> DataFrame:
    """Long table (keep..., fold, part): part is ``train`` or ``valid``; rows after a fold's end are absent."""
    entries = [F.struct(F.lit(i + 1).alias("fold"), F.when(train, "train").when(valid, "valid").alias("part"))
               for i, (train, valid) in enumerate(tests)]
    return df.select(*keep, F.inline(F.array(*entries))).where(F.col("part").isNotNull())


def time_series_folds(df: DataFrame, n_splits: int = 5, test_size: float = 0.2,
                      keep: Sequence[str] = (ID,)) -> DataFrame:
    return fold_membership(df, fold_tests(df, time_series_bounds(df.count(), n_splits, test_size)), keep)


def fold_plan(df: DataFrame, kind: str = "expanding", n_splits: int = 5, label: str = LABEL) -> DataFrame:
    """Sizes and label rates in percent per fold and part."""
    n = df.count()
    bounds = expanding_bounds(n, n_splits) if kind == "expanding" else time_series_bounds(n, n_splits)
    return fold_membership(df, fold_tests(df, bounds), [label]).groupBy("fold").agg(
        F.count_if(F.col("part") == "train").alias("train_size"), F.count_if(F.col("part") == "valid").alias("val_size"),
        (F.avg(F.when(F.col("part") == "train", F.col(label))) * 100).alias("train_rate"),
        (F.avg(F.when(F.col("part") == "valid", F.col(label))) * 100).alias("val_rate"))


def hashed_fold(row_id: str = ID, k: int = 5, seed: int = 42) -> Column:
    """Fold 0..k-1 from the id alone: no shuffle, equal sizes only in expectation."""
    return (hash_number(row_id, seed) % k).cast("int")


def stratified_folds(df: DataFrame, k: int = 5, seed: int = 42, label: str = LABEL, row_id: str = ID) -> DataFrame:
    """(id, fold) with every class spread evenly: position modulo k in (label, hash, id) order."""
    keyed = df.select(row_id, label, hash_number(row_id, seed).alias("_h"))
    return row_index(keyed, [label, "_h", row_id]).select(row_id, (F.col("row_pos") % k).cast("int").alias("fold"))


def shuffled_folds(df: DataFrame, k: int = 5, seed: int = 42, row_id: str = ID) -> DataFrame:
    """(id, fold) of equal sizes in hash order."""
    keyed = df.select(row_id, hash_number(row_id, seed).alias("_h"))
    return row_index(keyed, ["_h", row_id]).select(row_id, (F.col("row_pos") % k).cast("int").alias("fold"))


def contiguous_bounds(n: int, k: int) -> list[tuple[int, int]]:
    """(start, end) of k consecutive folds; the first n % k are one row longer."""
    size, extra = divmod(n, k)
    edges = [i * size + min(i, extra) for i in range(k + 1)]
    return list(zip(edges[:-1], edges[1:]))


def contiguous_fold(df: DataFrame, k: int) -> Column:
    """Fold number 0..k-1 of consecutive folds in time order."""
    starts = [s for s, _ in contiguous_bounds(df.count(), k)][1:]
    marks = position_marks(df, starts)
    fold = F.lit(0)
    for s in starts:
        fold = fold + (~before_mark(df, marks.get(s))).cast("int")
    return fold


def contiguous_folds(df: DataFrame, k: int = 5) -> DataFrame:
    return df.select(ID, contiguous_fold(df, k).alias("fold"))


def fold_stability(folds: DataFrame, fold: str = "fold", score: str = "val_auc") -> DataFrame:
    """Mean, population deviation, range, largest step between neighbours and stability of fold scores."""
    # One row per fold.
    order = Window.orderBy(fold)
    steps = folds.withColumn("_step", F.abs(F.col(score) - F.lag(score).over(order)))
    out = steps.agg(
        F.avg(score).alias("mean_score"), F.stddev_pop(score).alias("std_score"), F.min(score).alias("min_score"),
        F.max(score).alias("max_score"), F.max("_step").alias("max_step"))
    ratio = F.try_divide(F.col("std_score"), F.col("mean_score"))
    return out.withColumns({"score_range": F.col("max_score") - F.col("min_score"), "variation": ratio,
                            "stability": 1 - ratio})
