"""Boosted trees of many parameter sets, grown together.

A search fits dozens of small models to the same rows. One after the other, each of Spark ML's fits reads the rows three
times before its first tree and keeps a binned copy of its own. Here the rows are binned once, to a byte a cell, and kept
in blocks; a level of the trees of all models is one pass over the blocks, whose tasks sum histograms that Spark adds up by
node. Rounds, loss, leaf values and the rules of a split are those of ``GBTClassifier``: without drawn rows and columns
the trees are the same.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a block, and of a task that holds blocks.
BLOCK_ROWS, TASK_ROWS = 32_768, 250_000
#: Values that stand for a block's values of one column where it has more.
SUMMARY = 512
#: Histograms that a task holds in one pass.
HISTOGRAM_BYTES = 32 << 20

_BLOCK = "part int, seq int, label binary, cells binary"
_SPLIT = "node int, feature int, cut int, n double, total double, n_left double, total_left double"


# --- rows to blocks --------------------------------------------------------------------------

def _cells(rows: DataFrame) -> DataFrame:
    return rows.select("label", vector_to_array("features").alias("cells"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(labels, cells by row) of up to ``BLOCK_ROWS`` rows."""
    labels, cells, n = [], [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(start, BLOCK_ROWS)
            if n + part.num_rows > BLOCK_ROWS:
                yield np.concatenate(labels), np.concatenate(cells)
                labels, cells, n = [], [], 0
            labels.append(part.column(0).to_numpy(zero_copy_only=False))
            cells.append(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1))
            n += part.num_rows
    if n:
        yield np.concatenate(labels), np.concatenate(cells)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block and column: its values and how often each occurs, or ``SUMMARY`` equal shares of them."""
    for _, cells in _chunks(batches):
        for f in range(cells.shape[1]):
            values, counts = np.unique(cells[:, f], return_counts=True)
            if len(values) > SUMMARY:
                ends = np.unique(np.searchsorted(np.cumsum(counts), np.arange(1, SUMMARY + 1) * (len(cells) / SUMMARY)))
                ends = np.minimum(ends, len(values) - 1)
                ends = np.unique(np.append(ends, len(values) - 1))
                sums = np.cumsum(counts)[ends]
                values, counts = values[ends], np.diff(sums, prepend=0)
            yield pa.RecordBatch.from_pydict({"feature": pa.array([f], pa.int32()), "values": pa.array([values]), "counts": pa.array([counts.astype(float)])})


def cut_points(values: np.ndarray, counts: np.ndarray, most: int) -> list[float]:
    """At most ``most`` thresholds between sorted values: all midpoints, or those nearest to equal shares of the rows."""
    if len(values) - 1 <= most:
        return list((values[:-1] + values[1:]) / 2)
    sums, stride, target, out = np.cumsum(counts), counts.sum() / (most + 1), counts.sum() / (most + 1), []
    for i in range(1, len(values)):
        if abs(sums[i - 1] - target) < abs(sums[i] - target):
            out.append((values[i - 1] + values[i]) / 2)
            target += stride
    return out[:most]


def thresholds(rows: DataFrame, bins: int) -> tuple[list[np.ndarray], int]:
    """Thresholds per column of all rows' cells, fewer than ``bins`` of them, and the number of rows."""
    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        values, where = np.unique(np.concatenate(pdf["values"].to_list()), return_inverse=True)
        counts = np.bincount(where, weights=np.concatenate(pdf["counts"].to_list()))
        return pd.DataFrame({"feature": pdf["feature"].iloc[:1], "cuts": [cut_points(values, counts, bins - 1)], "n": [int(counts.sum())]})

    parts = _cells(rows).mapInArrow(_summaries, "feature int, values array<double>, counts array<double>")
    found = sorted(parts.groupBy("feature").applyInPandas(merged, "feature int, cuts array<double>, n long").collect())
    if not found:
        raise ValueError("no rows to learn from")
    return [np.array(r["cuts"], dtype=float) for r in found], found[0]["n"]


@dataclass
class Blocks:
    """Binned rows, kept on the executors. A cell is the number of its column's thresholds below it."""

    table: DataFrame
    cuts: list[np.ndarray]
    rows: int

    @property
    def width(self) -> int:
        return max((len(c) for c in self.cuts), default=0) + 1

    @property
    def kind(self) -> type:
        return np.uint8 if self.width <= 256 else np.uint16


@contextmanager
def blocks(rows: DataFrame, cuts: Sequence[np.ndarray], n: int) -> Iterator[Blocks]:
    """Blocks of ``n`` (label, features) rows with labels 0 and 1, for the block of code; what does not fit in memory goes to disk."""
    out = Blocks(rows, list(cuts), n)
    kind = out.kind

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId()
        for i, (labels, cells) in enumerate(_chunks(batches)):
            if not np.isin(labels, (0, 1)).all():
                raise ValueError("labels must be 0 or 1")
            table = np.stack([np.searchsorted(c, cells[:, f]) for f, c in enumerate(cuts)]).astype(kind)
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([place], pa.int32()), "seq": pa.array([i], pa.int32()),
                "label": pa.array([labels.astype(np.uint8).tobytes()], pa.binary()), "cells": pa.array([table.tobytes()], pa.binary())})

    spark = rows.sparkSession
    tasks = max(-(-n // TASK_ROWS), spark.sparkContext.defaultParallelism)
    out.table = _cells(rows).mapInArrow(binned, _BLOCK).repartition(tasks).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield out
    finally:
        out.table.unpersist()


def _read(batches: Iterator[pa.RecordBatch], kind: type) -> Iterator[tuple[tuple[int, int], np.ndarray, np.ndarray]]:
    """(place of the block, labels as -1 and 1, cells by column)."""
    for batch in batches:
        for part, seq, label, cells in zip(*(batch.column(i).to_pylist() for i in range(4))):
            sign = np.frombuffer(label, np.uint8) * 2.0 - 1
            yield (part, seq), sign, np.frombuffer(cells, kind).reshape(-1, len(sign))


# --- trees -----------------------------------------------------------------------------------

@dataclass
class Tree:
    """Nodes by number, the root first; a leaf is its own child."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    level: list[int] = field(default_factory=list)

    def add(self, value: float, level: int) -> int:
        at = len(self.value)
        for column, x in ((self.feature, 0), (self.cut, 1 << 16), (self.left, at), (self.value, value), (self.level, level)):
            column.append(x)
        return at

    def leaves(self, cells: np.ndarray) -> np.ndarray:
        """The node each column of ``cells`` ends in."""
        feature, cut, left = np.array(self.feature), np.array(self.cut), np.array(self.left)
        rows, at = np.arange(cells.shape[1]), np.zeros(cells.shape[1], dtype=np.int64)
        for _ in range(self.level[-1]):
            at = left[at] + (cells[feature[at], rows] > cut[at])
        return at

    def scores(self, cells: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaves(cells)]


def _columns_per_node(strategy: str, columns: int) -> int:
    if strategy in ("all", "auto"):
        return columns
    named = {"sqrt": math.sqrt(columns), "log2": math.log2(columns), "onethird": columns / 3}
    if strategy in named:
        return max(1, math.ceil(named[strategy]))
    return min(columns, int(strategy)) if strategy.isdigit() else max(1, math.ceil(float(strategy) * columns))


class Boosting:
    """One model of several that grow together, by the parameters of a Spark ML estimator."""

    def __init__(self, estimator: GBTClassifier, columns: int):
        self.rounds, self.step, self.depth = estimator.getMaxIter(), estimator.getStepSize(), estimator.getMaxDepth()
        self.least, self.min_gain = estimator.getMinInstancesPerNode(), estimator.getMinInfoGain()
        self.rate, self.seed = estimator.getSubsamplingRate(), estimator.getSeed() % (1 << 63)
        self.columns, self.per_node = columns, _columns_per_node(estimator.getFeatureSubsetStrategy(), columns)
        self.trees: list[Tree] = []

    def margin(self, cells: np.ndarray, trees: int | None = None) -> np.ndarray:
        out = np.zeros(cells.shape[1])
        for i, tree in enumerate(self.trees[:trees]):
            out += tree.scores(cells) * (self.step if i else 1.0)
        return out

    def targets(self, sign: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """What the last tree is fitted to: the labels, then the negative gradient of the logistic loss."""
        if len(self.trees) == 1:
            return sign
        with np.errstate(over="ignore"):
            return 4 * sign / (1 + np.exp(2 * sign * self.margin(cells, len(self.trees) - 1)))

    def draw(self, node: int) -> np.ndarray:
        """The columns a split of the node may use."""
        if self.per_node == self.columns:
            return np.arange(self.columns)
        return np.sort(np.random.default_rng((self.seed, len(self.trees), node)).permutation(self.columns)[:self.per_node])

    def grown(self, node: int, split) -> list[int]:
        """Take over the best split of a node; returns those of its children that may be split."""
        tree = self.trees[-1]
        tree.value[node] = split["total"] / split["n"] if split["n"] else 0.0
        if split["feature"] < 0:
            return []
        tree.feature[node], tree.cut[node], tree.left[node] = split["feature"], split["cut"], len(tree.value)
        level, out = tree.level[node] + 1, []
        for n, total in ((split["n_left"], split["total_left"]), (split["n"] - split["n_left"], split["total"] - split["total_left"])):
            child = tree.add(total / n, level)
            if level < self.depth and n >= 2 * self.least:
                out.append(child)
        return out


def best_split(counts: np.ndarray, totals: np.ndarray, allowed: np.ndarray, least: int, min_gain: float) -> tuple:
    """(column or -1, cut, rows, total, rows to the left, their total) of a node's histograms (column, bin)."""
    n, total = counts[0].sum(), totals[0].sum()
    left, left_total = np.cumsum(counts[allowed], axis=1)[:, :-1], np.cumsum(totals[allowed], axis=1)[:, :-1]
    right, right_total = n - left, total - left_total
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left_total ** 2 / left + right_total ** 2 / right - total ** 2 / n) / n
    gain = np.where((left >= max(least, 1)) & (right >= max(least, 1)) & (gain >= min_gain), gain, -1.0)
    if not gain.size or gain.max() <= np.finfo(float).eps:
        return -1, 0, n, total, 0.0, 0.0
    at, cut = np.unravel_index(np.argmax(gain), gain.shape)
    return int(allowed[at]), int(cut), n, total, left[at, cut], left_total[at, cut]


def _pass(data: Blocks, models: Sequence[Boosting], nodes: Sequence[tuple[int, int]]) -> list:
    """The best split of each (model, node): histograms by task, added up by node."""
    columns, width, kind = len(data.cuts), data.width, data.kind
    own: dict[int, list[int]] = {}
    for i, (m, _) in enumerate(nodes):
        own.setdefault(m, []).append(i)
    used = {m: models[m] for m in own}

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {m: np.zeros((2, columns, len(at) * width)) for m, at in own.items()}
        for place, sign, cells in _read(batches, kind):
            drawn = {}
            for m, at in own.items():
                model, tree = used[m], used[m].trees[-1]
                slot = np.full(len(tree.value), -1)
                slot[[nodes[i][1] for i in at]] = np.arange(len(at))
                slot = slot[tree.leaves(cells)]
                take = slot >= 0
                if model.rate < 1:
                    key = (model.seed, len(model.trees))
                    if key not in drawn:
                        drawn[key] = np.random.default_rng((*key, *place)).random(len(sign))
                    take &= drawn[key] < model.rate
                rows = np.flatnonzero(take)
                target, base, part = model.targets(sign, cells)[rows], slot[rows] * width, cells[:, rows]
                for f in range(columns):
                    bins = base + part[f]
                    found[m][0, f] += np.bincount(bins, minlength=len(at) * width)
                    found[m][1, f] += np.bincount(bins, target, len(at) * width)
        task = TaskContext.get().partitionId()
        for m, at in own.items():
            by_node = np.ascontiguousarray(found[m].reshape(2, columns, len(at), width).transpose(2, 0, 1, 3))
            yield pa.RecordBatch.from_pydict({
                "node": pa.array(at, pa.int32()), "task": pa.array([task] * len(at), pa.int32()),
                "sums": pa.array([x.tobytes() for x in by_node], pa.binary())})

    rules = [(models[m].draw(v), models[m].least, models[m].min_gain) for m, v in nodes]

    def decided(pdf: pd.DataFrame) -> pd.DataFrame:
        sums = np.zeros((2, columns, width))
        for s in pdf.sort_values("task")["sums"]:  # in one order, so that a fit can be repeated
            sums += np.frombuffer(s).reshape(sums.shape)
        node = int(pdf["node"].iloc[0])
        return pd.DataFrame([(node, *best_split(*sums, *rules[node]))], columns=[c.split()[0] for c in _SPLIT.split(", ")])

    sums = data.table.mapInArrow(summed, "node int, task int, sums binary")
    return sums.groupBy("node").applyInPandas(decided, _SPLIT).collect()  # one row per node


def fit_together(estimators: Sequence[GBTClassifier], data: Blocks, parallelism: int = 4) -> list[Boosting]:
    """A model per estimator, all grown level by level; passes for more nodes than a task holds run several at a time."""
    models = [Boosting(e, len(data.cuts)) for e in estimators]
    most = max(1, HISTOGRAM_BYTES // (16 * len(data.cuts) * data.width))
    for turn in range(max((m.rounds for m in models), default=0)):
        nodes = []
        for i, m in enumerate(models):
            if turn < m.rounds:
                m.trees.append(Tree())
                nodes.append((i, m.trees[-1].add(0.0, 0)))
        while nodes:
            groups = [nodes[k:k + most] for k in range(0, len(nodes), most)]
            with ThreadPoolExecutor(max_workers=parallelism) as pool:
                found = list(pool.map(lambda g: _pass(data, models, g), groups))
            nodes = []
            for group, splits in zip(groups, found):
                for split in sorted(splits, key=lambda s: s["node"]):
                    m, node = group[split["node"]]
                    nodes += [(m, child) for child in models[m].grown(node, split)]
    return models


def score_counts(models: Sequence[Boosting], data: Blocks) -> DataFrame:
    """(trial, prediction, label, n): how many rows of a block get which score, by number of the model."""
    kind = data.kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sign, cells in _read(batches, kind):
            for i, model in enumerate(models):
                with np.errstate(over="ignore"):
                    scores, where = np.unique(1 / (1 + np.exp(-2 * model.margin(cells))), return_inverse=True)
                for label in (0, 1):
                    counts = np.bincount(where[(sign > 0) == label], minlength=len(scores))
                    held = counts > 0
                    yield pa.RecordBatch.from_pydict({
                        "trial": pa.array(np.full(held.sum(), i), pa.int32()), "prediction": pa.array(scores[held]),
                        "label": pa.array(np.full(held.sum(), label), pa.int32()), "n": pa.array(counts[held], pa.int64())})

    return data.table.mapInArrow(run, "trial int, prediction double, label int, n long")
