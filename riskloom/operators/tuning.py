"""Hyper-parameter search and searches over feature sets. Every trial is one or more Spark fits."""

from __future__ import annotations

import math
import random
import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack

from pyspark.ml.feature import VectorSlicer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.operators import selection
from riskloom.operators.evaluation import auc_value, grouped_auc
from riskloom.operators.ordering import permutations, row_index
from riskloom.operators.together import Blocks, blocks, fit_together, score_counts, thresholds
from riskloom.operators.training import (
    ID, assembled, boosted_trees, cross_validate, fit, importance_table, rounds_of, scored,
)
from riskloom.session import written

# Search ranges, (kind, low, high).
SPACE = {
    "learning_rate": ("log", 0.005, 0.1), "max_depth": ("int", 6, 15), "min_child_samples": ("int", 10, 100),
    "subsample": ("real", 0.6, 1.0), "colsample_bytree": ("real", 0.5, 1.0),
}
# What each stage searches, and where the others start.
STAGES = (
    ("learning_rate", "max_depth"),
    ("subsample", "colsample_bytree", "min_child_samples"),
    ("min_gain", "subsample"),
)
STAGE_START = {"subsample": 0.9, "colsample_bytree": 0.7, "min_child_samples": 50}
# Only what the trainer has is searched: leaf counts and penalties are not among it, the least gain of a split is.
FINE_SPACE = {**SPACE, "min_gain": ("log", 1e-6, 1e-2)}


def draw(rng: random.Random, space: Mapping[str, tuple], names: Sequence[str]) -> dict[str, float]:
    out = {}
    for n in names:
        kind, low, high = space[n]
        if kind == "int":
            out[n] = rng.randint(low, high)
        elif kind == "log":
            out[n] = math.exp(rng.uniform(math.log(low), math.log(high)))
        else:
            out[n] = rng.uniform(low, high)
    return out


class Tuner:
    """Seeded random search by hold-out AUC, or by mean AUC over contiguous folds without a hold-out."""

    def __init__(self, train: DataFrame, features: Sequence[str], valid: DataFrame | None = None, n_folds: int = 5,
                 seed: int = 42, num_boost_round: int = 100, space: Mapping[str, tuple] = SPACE):
        self.train, self.valid, self.features = train, valid, list(features)
        self.n_folds, self.seed, self.rounds, self.space = n_folds, seed, num_boost_round, dict(space)
        self.trials: list[dict] = []
        self.best_params: dict | None = None
        self._rows: tuple[DataFrame, DataFrame] | None = None

    def _written(self) -> tuple[DataFrame, DataFrame]:
        """Vectors of both parts, written once for all trials."""
        if self._rows is None:
            self._rows = (written(assembled(self.train, self.features)), written(assembled(self.valid, self.features)))
        return self._rows

    def _score(self, params: Mapping[str, object]) -> float:
        usable = dict(params)
        if self.valid is not None:
            early, late = self._written()
            model = fit(boosted_trees(usable, self.rounds), early, late)
            return auc_value(scored(model, late), "prediction", "label") or 0.0
        cv = cross_validate(self.train, self.features, "contiguous", self.n_folds, params=usable, num_boost_round=self.rounds)
        return cv.folds.agg(F.avg("val_auc")).first()[0] or 0.0

    def tune(self, n_trials: int = 100, timeout: float | None = None, fixed: Mapping[str, object] | None = None,
             names: Sequence[str] | None = None) -> dict:
        """Best of the drawn parameters; the time limit is looked at between trials."""
        rng, started, names = random.Random(self.seed), time.monotonic(), list(names or self.space)
        names = [n for n in names if n not in (fixed or {})]
        for _ in range(n_trials):
            if timeout is not None and self.trials and time.monotonic() - started > timeout:
                break
            params = draw(rng, self.space, names)
            value = self._score({**(fixed or {}), **params})
            self.trials.append({"trial": len(self.trials), "value": value, "params": params})
        best = max(self.trials, key=lambda t: (t["value"], -t["trial"]))
        self.best_params = dict(best["params"])
        return self.best_params

    def halving(self, n_trials: int = 50, keep: int = 3, fixed: Mapping[str, object] | None = None,
                names: Sequence[str] | None = None, parallelism: int = 4) -> dict:
        """Best of many drawn parameters, most of which leave after a few rounds.

        All trials are fitted with a share of the rounds, together over rows that are binned once, and scored in one
        job. The best one in ``keep`` goes on with ``keep`` times the rounds, until one step has them all. Each
        trial's last score is kept; the best is one of the last step. Ties go to the earlier trial. Needs a hold-out.
        """
        if self.valid is None:
            raise ValueError("halving needs a hold-out")
        rng, names = random.Random(self.seed), [n for n in (names or self.space) if n not in (fixed or {})]
        left = [(i, draw(rng, self.space, names)) for i in range(n_trials)]
        steps = 1
        while keep ** steps < n_trials and self.rounds // keep ** steps >= 1:
            steps += 1
        self.trials, done = [], {}
        with ExitStack() as held:
            binned: dict[int, tuple[Blocks, Blocks]] = {}
            for step in range(steps):
                rounds = max(1, self.rounds // keep ** (steps - 1 - step))
                values = self._values([{**(fixed or {}), **p} for _, p in left], rounds, parallelism, binned, held)
                for (i, params), value in zip(left, values):
                    done[i] = {"trial": i, "value": value, "params": params, "step": step + 1, "rounds": rounds}
                order = sorted(range(len(left)), key=lambda k: (-values[k], left[k][0]))
                if step < steps - 1:
                    left = [left[k] for k in sorted(order[:max(1, len(left) // keep)])]
                else:
                    self.best_params = dict(left[order[0]][1])
        self.trials = [done[i] for i in range(n_trials)]
        return self.best_params

    def _values(self, several: Sequence[Mapping[str, object]], rounds: int, parallelism: int,
                binned: dict[int, tuple[Blocks, Blocks]], held: ExitStack) -> list[float]:
        """Hold-out AUC of each set of parameters after so many rounds; ``binned`` keeps the blocks of both parts by number of bins."""
        trees, values = [boosted_trees(p, rounds) for p in several], [0.0] * len(several)
        for bins in sorted({t.getMaxBins() for t in trees}):
            if bins not in binned:
                early, late = self._written()
                known = late.where(F.col("label").isNotNull()).withColumn("label", (F.col("label") == 1).cast("double"))
                cuts, n = thresholds(early, bins)
                binned[bins] = (held.enter_context(blocks(early, cuts, n)), held.enter_context(blocks(known, cuts, known.count())))
            train, valid = binned[bins]
            own = [i for i, t in enumerate(trees) if t.getMaxBins() == bins]
            counts = score_counts(fit_together([trees[i] for i in own], train, parallelism), valid)
            # One row per trial.
            for r in grouped_auc(counts, ["trial"], "prediction", "label", "n").collect():
                values[own[r["trial"]]] = r["auc"] or 0.0
        return values

    def get_best_params(self, fixed: Mapping[str, object] | None = None) -> dict:
        if self.best_params is None:
            raise ValueError("no tuning has been done yet")
        return {**(fixed or {}), "random_state": self.seed, **self.best_params}

    def trials_table(self) -> DataFrame:
        rows = [(t["trial"], float(t["value"]), str(sorted(t["params"].items()))) for t in self.trials]
        return self.train.sparkSession.createDataFrame(rows, "trial int, value double, params string")

    def summary(self) -> DataFrame:
        if not self.trials:
            raise ValueError("no tuning has been done yet")
        return trial_summary(self.trials_table())


def quick_tune(train: DataFrame, features: Sequence[str], valid: DataFrame | None = None, n_trials: int = 50,
               n_folds: int = 5, **options) -> dict:
    return Tuner(train, features, valid, n_folds, **options).tune(n_trials)


def staged_tune(train: DataFrame, features: Sequence[str], valid: DataFrame | None = None, trials_per_stage: int = 30,
                num_boost_round: int = 100, seed: int = 42) -> tuple[dict, DataFrame]:
    """Structure, then sampling, then regularisation; each stage only decides its own parameters."""
    found: dict[str, object] = {}
    log, spark = [], train.sparkSession
    tuner = Tuner(train, features, valid, seed=seed, num_boost_round=num_boost_round, space=FINE_SPACE)
    for number, names in enumerate(STAGES):
        tuner.trials = []
        fixed = {k: v for k, v in {**STAGE_START, **found}.items() if k not in names}
        found.update(tuner.tune(trials_per_stage, fixed=fixed, names=names))
        log += [(number + 1, t["trial"], float(t["value"]), {n: float(v) for n, v in t["params"].items()}) for t in tuner.trials]
    return found, spark.createDataFrame(log, "stage int, trial int, value double, params map<string,double>")


def trial_summary(trials: DataFrame) -> DataFrame:
    """From (trial, value): number of trials, best value and its earliest trial, mean, std and range."""
    best = F.min(F.struct((-F.col("value")).alias("neg"), F.col("trial"))).alias("_b")
    return trials.agg(
        F.count("value").alias("n_trials"), F.max("value").alias("best_value"), best, F.avg("value").alias("mean_value"),
        F.stddev_samp("value").alias("std_value"), F.min("value").alias("min_value"), F.max("value").alias("max_value"),
    ).withColumn("best_trial", F.col("_b.trial")).drop("_b")


# --- feature-set searches --------------------------------------------------------------------

class FeatureSearch:
    """Searches that fit models on changing feature sets over one written frame."""

    def __init__(self, train: DataFrame, valid: DataFrame, features: Sequence[str], params: Mapping[str, object] | None = None,
                 num_boost_round: int = 100):
        self.spark, self.features = train.sparkSession, list(features)
        self.params, self.rounds = dict(params or {}), num_boost_round
        self.early, self.late = written(assembled(train, features)), written(assembled(valid, features))

    def _sliced(self, rows: DataFrame, chosen: Sequence[str]) -> DataFrame:
        if list(chosen) == self.features:
            return rows
        cut = VectorSlicer(inputCol="features", outputCol="_f", indices=[self.features.index(c) for c in chosen])
        return cut.transform(rows).drop("features").withColumnRenamed("_f", "features")

    def _fit(self, chosen: Sequence[str], early: DataFrame | None = None):
        train, valid = self._sliced(early if early is not None else self.early, chosen), self._sliced(self.late, chosen)
        model = fit(boosted_trees(self.params, self.rounds), train, valid)
        return model, valid

    def importance(self, chosen: Sequence[str] | None = None) -> DataFrame:
        chosen = list(chosen or self.features)
        return importance_table(self.spark, self._fit(chosen)[0], chosen)

    def select_by_importance(self, threshold: float = 0.95, min_kept: int = selection.MIN_KEPT) -> tuple[list[str], list[str]]:
        cut = selection.importance_cut(self.importance(), threshold, min_kept)
        kept = {r["feature"] for r in cut.where(F.col("keep") == 1).collect()}
        return [f for f in self.features if f in kept], [f for f in self.features if f not in kept]

    def recursive_elimination(self, target: int | None = None, step: float = 0.1) -> tuple[list[str], DataFrame]:
        """Drop the least important share, refit, until ``target`` features (half by default) are left."""
        target = len(self.features) // 2 if target is None else target
        current, log = list(self.features), []
        while len(current) > target:
            model, valid = self._fit(current)
            auc = auc_value(scored(model, valid), "prediction", "label")
            drop = min(max(1, int(len(current) * step)), len(current) - target)
            ranked = importance_table(self.spark, model, current).orderBy(F.col("importance").desc(), "feature")
            order = [r["feature"] for r in ranked.collect()]
            gone = set(order[len(order) - drop:])
            current = [f for f in current if f not in gone]
            log.append((len(log) + 1, len(current), auc, sorted(gone)))
        return current, self.spark.createDataFrame(
            log, "round int, n_features int, auc double, removed array<string>")

    def shuffled_labels(self, seeds: Sequence[int]) -> DataFrame:
        """The training rows with a column ``label_<seed>`` of permuted labels per seed.

        Rows are put in order once, by id; a seed's permutation then tells each label the position it goes to. Only
        (position, label) pairs move per seed, and the vectors are joined once.
        """
        order = written(row_index(self.early.select(ID, "label"), [ID]))
        moved = permutations(order.select("row_pos", "label"), "row_pos", order.count(), seeds)
        labels = moved.groupBy(F.col("permuted").alias("row_pos")).agg(
            *[F.max(F.when(F.col("seed") == s, F.col("label"))).alias(f"label_{s}") for s in seeds])
        return self.early.join(order.select(ID, "row_pos").join(labels, "row_pos").drop("row_pos"), ID)

    def null_importance(self, n_iterations: int = 5, parallelism: int = 4) -> tuple[list[str], DataFrame]:
        """Features whose importance beats that of fits on shuffled labels, several of which run at a time.

        A tree model's importances are shares of 1; times training rows and trees they are on the scale of total
        gains, for which the rules are made.
        """
        rows, seeds = self.early.count(), list(range(n_iterations))
        shuffled = written(self.shuffled_labels(seeds))

        def gains(seed: int | None) -> DataFrame:
            early = None if seed is None else shuffled.withColumn("label", F.col(f"label_{seed}")).select(*self.early.columns)
            model, _ = self._fit(self.features, early)
            return importance_table(self.spark, model, self.features).withColumns({
                "importance": F.col("importance") * rows * rounds_of(model), "run": F.lit(seed).cast("int")})

        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            actual, *null = pool.map(gains, [None, *seeds])
        runs = null[0]
        for one in null[1:]:
            runs = runs.unionByName(one)
        table = selection.null_importance_rule(actual.drop("run"), runs)
        kept = {r["feature"] for r in table.where(F.col("keep") == 1).collect()}
        return [f for f in self.features if f in kept], table

    def threshold_sweep(self, thresholds: Sequence[float] = (0.90, 0.95, 0.98, 0.99),
                        min_kept: int = selection.MIN_KEPT) -> DataFrame:
        """(threshold, n_features, auc): one refit per cumulative-importance cut."""
        table, log = self.importance(), []
        for t in thresholds:
            kept = {r["feature"] for r in selection.importance_cut(table, t, min_kept).where(F.col("keep") == 1).collect()}
            chosen = [f for f in self.features if f in kept]
            model, valid = self._fit(chosen)
            log.append((float(t), len(chosen), auc_value(scored(model, valid), "prediction", "label")))
        return self.spark.createDataFrame(log, "threshold double, n_features int, auc double")


def select_features(train: DataFrame, valid: DataFrame, features: Sequence[str],
                    methods: Sequence[str] = ("correlation", "importance"), correlation_threshold: float = 0.95,
                    importance_threshold: float = 0.95, params: Mapping[str, object] | None = None,
                    num_boost_round: int = 100, min_kept: int = selection.MIN_KEPT) -> tuple[list[str], dict[str, list[str]]]:
    """Apply the named methods one after the other; returns the selected and the removed features."""
    left, removed = list(features), {}

    def drop(method: str, gone: Sequence[str]) -> None:
        removed[method] = list(gone)
        left[:] = [f for f in left if f not in set(gone)]

    if "missing" in methods:
        drop("missing", selection.remove_missing_features(train.select(*left), 0.95))
    if "single_value" in methods:
        drop("single_value", selection.remove_single_value_features(train.select(*left)))
    if "correlation" in methods:
        numeric = [f for f in selection.numeric_columns(train, ()) if f in left]
        drop("correlated", selection.remove_correlated_features(train, correlation_threshold, [f for f in left if f in numeric]))
    if "importance" in methods and left:
        search = FeatureSearch(train, valid, left, params, num_boost_round)
        drop("low_importance", search.select_by_importance(importance_threshold, min_kept)[1])
    return left, removed


def quick_feature_selection(train: DataFrame, valid: DataFrame, features: Sequence[str], **options) -> list[str]:
    return select_features(train, valid, features, ("single_value", "correlation", "importance"), **options)[0]


def selection_summary(selected: Sequence[str], removed: Mapping[str, Sequence[str]]) -> dict[str, object]:
    return {"total_selected": len(selected), "removed_by_method": {k: len(v) for k, v in removed.items()}}


