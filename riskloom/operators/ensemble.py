"""Combining predictions: means, blends, rank averages, weight search."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.nulls import folded_sum
from riskloom.operators.blocks import bucket, tree_sum
from riskloom.operators.evaluation import grouped_auc
from riskloom.operators.keyed import attach, columns_as_keys, key_table
from riskloom.operators.ordering import running_totals
from riskloom.operators.quantiles import stacked
from riskloom.session import written

#: Cells of a score histogram.
CELLS = 4096

ID, LABEL = "TransactionID", "isFraud"


def mean_prediction(long: DataFrame, row_id: str = ID, value: str = "prediction") -> DataFrame:
    """Average over models or folds of a long (id, model, prediction) table."""
    return long.groupBy(row_id).agg(F.avg(value).alias("prediction"))


def prediction_uncertainty(long: DataFrame, row_id: str = ID, value: str = "prediction") -> DataFrame:
    """Average and population deviation across models."""
    return long.groupBy(row_id).agg(F.avg(value).alias("prediction"), F.stddev_pop(value).alias("uncertainty"))


def normalised(columns: Sequence[str], weights: Mapping[str, float] | None = None) -> dict[str, float]:
    if weights is None:
        return dict.fromkeys(columns, 1.0 / len(columns))
    if set(weights) != set(columns):
        raise ValueError("weights must name exactly the prediction columns")
    total = sum(weights.values())
    return {c: weights[c] / total for c in columns}


def blend_predictions(df: DataFrame, columns: Sequence[str], weights: Mapping[str, float] | None = None,
                      name: str = "blend") -> DataFrame:
    """Weighted sum of prediction columns; weights are scaled to sum 1, equal by default."""
    shares = normalised(columns, weights)
    return df.withColumn(name, folded_sum([F.col(c) * F.lit(shares[c]) for c in columns]))


def predict_with_diversity(df: DataFrame, columns: Sequence[str], weights: Mapping[str, float] | None = None) -> DataFrame:
    """Blend plus the unweighted population deviation across the columns."""
    n = len(columns)
    blended = blend_predictions(df, columns, weights, "prediction")
    mean = folded_sum([F.col(c) for c in columns]) / n
    return blended.withColumn("diversity", F.sqrt(folded_sum([F.pow(F.col(c) - mean, F.lit(2.0)) for c in columns]) / n))


def rank_average(df: DataFrame, columns: Sequence[str], name: str = "rank_blend", row_id: str = ID) -> DataFrame:
    """Mean over columns of the average-tie rank divided by the row count.

    All columns are ranked in one ordered pass over the distinct (column, value) pairs.
    """
    long = stacked(df, columns, keep=[row_id])
    counts = long.where(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count("*").alias("n"))
    steps = running_totals(counts, ["feature", "value"], ["n"])
    span = steps.groupBy("feature").agg(F.min("n_before").alias("_start"), F.sum("n").alias("_total"))
    rank = (F.col("n_before") - F.col("_start") + (F.col("n") + 1) / 2) / F.col("_total")
    ranks = key_table(steps.join(F.broadcast(span), "feature").select(
        F.col("feature").alias("name"), F.col("value").alias("key"), "n", rank.alias("rank")))
    out = attach(df, columns_as_keys(df, columns), ranks, {c: {f"_r_{c}": "rank"} for c in columns}, row_id, "double")
    return out.withColumn(name, folded_sum([F.col(f"_r_{c}") for c in columns]) / len(columns)).drop(
        *[f"_r_{c}" for c in columns])


def weight_candidates(n_models: int, steps: int = 11) -> list[tuple[float, ...]]:
    """Weight vectors in search order: a line for 2 models, a triangle for 3, equal weights otherwise."""
    def line(stop: float) -> list[float]:
        gap = stop / (steps - 1)
        return [i * gap for i in range(steps - 1)] + [stop]

    if n_models == 2:
        return [(w, 1 - w) for w in line(1.0)]
    if n_models == 3:
        return [(w1, w2, 1 - w1 - w2) for w1 in line(1.0) for w2 in line(1 - w1)]
    return [tuple([1.0 / n_models] * n_models)]


def neighbours(weights: Sequence[float], steps: int = 11) -> list[tuple[float, ...]]:
    """The weights, and for each model and share on a line the weights with that share, the others scaled to the rest."""
    n, out = len(weights), [tuple(weights)]
    for j, own in enumerate(weights):
        for i in range(steps):
            share = i / (steps - 1)
            rest = [(w / (1 - own) if own < 1 else 1 / (n - 1)) * (1 - share) for w in weights]
            out.append(tuple(share if k == j else w for k, w in enumerate(rest)))
    return out


class _Grid:
    """Scores of rows under many weight vectors, and the cells of equal width they fall into."""

    def __init__(self, grid: Sequence[tuple[float, ...]], lows: Sequence[float], highs: Sequence[float], cells: int):
        self.grid, self.cells = [tuple(v) for v in grid], cells
        ends = [(self._sum(v, [min(w * a, w * b) for w, a, b in zip(v, lows, highs)]),
                 self._sum(v, [max(w * a, w * b) for w, a, b in zip(v, lows, highs)])) for v in self.grid]
        self.ends = [(low, cells / (high - low) if high > low else 0.0) for low, high in ends]

    @staticmethod
    def _sum(vector: tuple[float, ...], terms: Sequence) -> float:
        total = terms[0]
        for term in terms[1:]:
            total = total + term
        return total

    def scores(self, x: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(position, scores, cells) per weight vector; a greater score is never in a lower cell."""
        for position, vector in enumerate(self.grid):
            score = self._sum(vector, [c * w for c, w in zip(x, vector)])
            low, scale = self.ends[position]
            yield position, score, np.clip((score - low) * scale, 0, self.cells - 1).astype(np.int64)


def _read(batch: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    *x, pos, neg = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
    return x, pos, neg


def _histograms(scorer: _Grid):
    """Per task and weight vector: positives and negatives by cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(scorer.grid), 2, scorer.cells), dtype=np.int64)
        for batch in batches:
            x, pos, neg = _read(batch)
            for position, _, cell in scorer.scores(x):
                np.add.at(counts[position, 0], cell, pos)
                np.add.at(counts[position, 1], cell, neg)
        for position in range(len(counts)):
            yield pa.record_batch([pa.array([position], pa.int32()), pa.array([bucket()], pa.int32()),
                                   pa.array([counts[position].tobytes()], pa.binary())], ["position", "bucket", "data"])
    return run


def _mixed_rows(scorer: _Grid, bases: Broadcast):
    """(position, score, pos, neg, base) of the rows in cells with both classes; base: negatives of earlier such cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = bases.value
        for batch in batches:
            x, pos, neg = _read(batch)
            for position, score, cell in scorer.scores(x):
                start = base[position][cell] if position in base else np.full(len(cell), -1)
                own = np.flatnonzero(start >= 0)
                if len(own):
                    yield pa.record_batch(
                        [pa.array(np.full(len(own), position, dtype=np.int32)), pa.array(score[own]), pa.array(pos[own]),
                         pa.array(neg[own]), pa.array(start[own])], ["position", "score", "pos", "neg", "base"])
    return run


def grid_aucs(df: DataFrame, columns: Sequence[str], label: str, grid: Sequence[tuple[float, ...]],
              best_only: bool = False) -> dict[int, float | None]:
    """AUC per place in ``grid``, exact, ties counted half; with ``best_only`` only of those that may be the best.

    Rows that have all predictions collapse by predictions and label. Tasks count both classes by cell of score, for
    every weight vector. Pairs of rows in different cells are told by these counts; rows of cells that hold both
    classes are put in order. The counts alone bound each AUC from both sides, so that a search for the best orders
    rows of few vectors only.
    """
    present = df.where(F.col(label).isNotNull())
    for c in columns:
        present = present.where(F.col(f"`{c}`").isNotNull() & ~F.isnan(F.col(f"`{c}`").cast("double")))
    counts = written(present.groupBy(*[F.col(f"`{c}`").cast("double").alias(f"x{j}") for j, c in enumerate(columns)]).agg(
        F.sum((F.col(label) == 1).cast("long")).alias("pos"), F.sum((F.col(label) != 1).cast("long")).alias("neg")))
    names = [f"x{j}" for j in range(len(columns))]
    row = counts.agg(*[f(n).alias(f"{k}{n}") for n in names for k, f in (("l", F.min), ("h", F.max))]).first()
    if row[0] is None:
        return dict.fromkeys(range(len(grid)))
    scorer = _Grid(grid, [row[f"l{n}"] for n in names], [row[f"h{n}"] for n in names], CELLS)
    parts = counts.mapInArrow(_histograms(scorer), "position int, bucket int, data binary")
    # CELLS numbers per weight vector and class, whatever the number of rows.
    histograms = {r["position"]: np.frombuffer(r["data"], dtype=np.int64).reshape(2, CELLS)
                  for r in tree_sum(parts, ["position"], "int64").collect()}
    pairs, sure, open_ = {}, {}, {}
    for position, (pos, neg) in histograms.items():
        pairs[position] = int(pos.sum()) * int(neg.sum())
        sure[position] = sum(int(p) * int(n) for p, n in zip(pos, np.cumsum(neg) - neg) if p)
        open_[position] = sum(int(p) * int(n) for p, n in zip(pos, neg) if p and n)
    if not next(iter(pairs.values())):
        return dict.fromkeys(range(len(grid)))
    least = max(sure.values()) if best_only else 0
    kept = [p for p in sorted(histograms) if sure[p] + open_[p] >= least]
    bases, total = {}, 0
    for position in (p for p in kept if open_[p]):
        pos, neg = histograms[position]
        mixed = (pos > 0) & (neg > 0)
        own = np.where(mixed, neg, 0)
        bases[position] = np.where(mixed, total + np.cumsum(own) - own, -1)
        total += int(own.sum())
    wins = dict.fromkeys(kept, 0.0)
    if bases:
        shared = df.sparkSession.sparkContext.broadcast(bases)
        rows = counts.mapInArrow(_mixed_rows(scorer, shared), "position int, score double, pos long, neg long, base long")
        steps = running_totals(rows.groupBy("position", "score").agg(
            F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.min("base").alias("base")), ["position", "score"], ["neg"])
        inside = F.sum(F.col("pos").cast("double") * (F.col("neg_before") - F.col("base") + F.col("neg") / 2))
        wins |= {r["position"]: r["wins"] for r in steps.groupBy("position").agg(inside.alias("wins")).collect()}
    return {p: (sure[p] + wins[p]) / pairs[p] for p in kept}


def weight_grid(df: DataFrame, columns: Sequence[str], label: str = LABEL, steps: int = 11,
                grid: Sequence[tuple[float, ...]] | None = None, best_only: bool = False) -> DataFrame:
    """(position, w1.., auc) for every candidate weight vector, ``weight_candidates`` unless given.

    Rows that lack a prediction or the label are left out; the AUC is null when a class is absent. With
    ``best_only`` vectors that cannot be the best by their counts have no row.
    """
    grid = list(grid or weight_candidates(len(columns), steps))
    aucs = grid_aucs(df, columns, label, grid, best_only)
    names = "".join(f"w{j + 1} double, " for j in range(len(columns)))
    return df.sparkSession.createDataFrame([(p, *grid[p], a) for p, a in sorted(aucs.items())], f"position int, {names}auc double")


def optimize_weights(df: DataFrame, columns: Sequence[str], label: str = LABEL) -> dict[str, float]:
    """The candidate with the greatest AUC; the earliest one on a tie.

    With over three models the search starts at equal weights and moves along one model's share at a time,
    until no move betters the AUC.
    """
    def best_of(grid: Sequence[tuple[float, ...]]) -> tuple[float | None, tuple[float, ...]]:
        aucs = grid_aucs(df, columns, label, grid, best_only=True)
        place = min(aucs, key=lambda p: (aucs[p] is None, -(aucs[p] or 0.0), p))
        return aucs[place], grid[place]

    auc, best = best_of(weight_candidates(len(columns)))
    while auc is not None and len(columns) > 3:
        other, step = best_of(neighbours(best))
        if other is None or other <= auc + 1e-12:
            break
        auc, best = other, step
    return dict(zip(columns, best)) if auc is not None else normalised(columns)


def model_aucs(df: DataFrame, columns: Sequence[str], label: str = LABEL) -> DataFrame:
    """(model, auc) of several prediction columns in one pass."""
    long = stacked(df, columns, keep=[label], feature="model", value="score")
    return grouped_auc(long, ["model"], "score", label)


# Methods in the order in which a later one must be strictly better to win.
METHODS = ("average", "weighted", "meta")


def best_method(aucs: DataFrame) -> DataFrame:
    """From (method, auc): the winner and its gain over plain averaging."""
    place = F.element_at(F.map_from_arrays(
        F.array(*[F.lit(m) for m in METHODS]), F.array(*[F.lit(-i) for i in range(len(METHODS))])), F.col("method"))
    average = F.max(F.when(F.col("method") == "average", F.col("auc")))
    return aucs.agg(F.max_by("method", F.struct("auc", place.alias("p"))).alias("best_method"),
                    F.max("auc").alias("best_auc"), (F.max("auc") - average).alias("gain"))
