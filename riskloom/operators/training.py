"""Training, cross-validation, stacking and scoring on Spark ML estimators.

Any estimator with the ml API can fill the slot; boosted trees are the default. The training frame
is reduced to (id, label, vector, keep...) and written once, so every fit reads the same rows.
"""

from __future__ import annotations

import math
import os
import warnings
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import cached_property

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, LogisticRegression, RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.nulls import folded_sum
from riskloom.operators import folds as fold_rules
from riskloom.operators.ensemble import mean_prediction, model_aucs, optimize_weights, prediction_uncertainty
from riskloom.operators.evaluation import grouped_auc
from riskloom.session import shared_folder, written
from riskloom.sources.tables import read_settings, write_settings

ID, LABEL, TIME = "TransactionID", "isFraud", "TransactionDT"
MISSING_VALUE = -999.0

# Default parameters of the baseline, in the names users of boosted trees know.
DEFAULT_PARAMS = {
    "learning_rate": 0.05, "num_leaves": 31, "max_depth": -1, "min_child_samples": 20, "subsample": 0.8,
    "subsample_freq": 1, "colsample_bytree": 0.8, "reg_alpha": 0.1, "reg_lambda": 0.1, "random_state": 42,
}
# Parameter -> boosted-tree parameter of Spark ML. Others have no counterpart.
PARAM_NAMES = {
    "learning_rate": "stepSize", "num_boost_round": "maxIter", "max_depth": "maxDepth",
    "min_child_samples": "minInstancesPerNode", "subsample": "subsamplingRate",
    "colsample_bytree": "featureSubsetStrategy", "random_state": "seed", "min_gain": "minInfoGain",
    "max_bins": "maxBins",
}
#: Rounds without a better validation loss after which boosting ends.
PATIENCE = 50
#: Rows that a task of a fit holds. A fit keeps its rows in memory, at about 400 bytes for a dozen features.
FIT_ROWS = 250_000
SILENT = {"objective", "metric", "boosting_type", "n_jobs", "verbose", "verbosity", "subsample_freq"}
UNLIMITED_DEPTH = 5


def map_params(params: Mapping[str, object]) -> tuple[dict[str, object], list[str]]:
    """(Spark ML parameters, names without a counterpart)."""
    mapped, ignored = {}, []
    for name, value in params.items():
        target = PARAM_NAMES.get(name)
        if target is None:
            if name not in SILENT:
                ignored.append(name)
        elif target == "featureSubsetStrategy":
            mapped[target] = "all" if float(value) >= 1.0 else str(float(value))
        elif target == "maxDepth":
            # Levelwise trees: no limit is not available, and 30 is the most the library grows.
            mapped[target] = UNLIMITED_DEPTH if int(value) < 0 else min(int(value), 30)
            if mapped[target] != int(value):
                warnings.warn(f"max_depth {value} is not available; {mapped[target]} is used", stacklevel=2)
        else:
            mapped[target] = value
    return mapped, ignored


def boosted_trees(params: Mapping[str, object] | None = None, rounds: int = 100) -> GBTClassifier:
    mapped, ignored = map_params({**DEFAULT_PARAMS, **(params or {})})
    ignored = [n for n in ignored if n in (params or {})]
    if ignored:
        warnings.warn(f"parameters without a counterpart are ignored: {ignored}", stacklevel=2)
    mapped.setdefault("maxIter", rounds)
    return GBTClassifier(featuresCol="features", labelCol="label", **mapped)


def random_forest(trees: int = 50, depth: int = 8, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed)


def logistic(max_iter: int = 100, l2: float = 0.0) -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol="label", maxIter=max_iter, regParam=l2)


# --- frames ----------------------------------------------------------------------------------

def assembled(df: DataFrame, features: Sequence[str], keep: Sequence[str] = (ID,), label: str = LABEL) -> DataFrame:
    """(keep..., label, features): one vector per row, missing cells set below all real values."""
    absent = [c for c in features if c not in df.columns]
    if absent:
        raise ValueError(f"missing features: {absent}")
    cells = [F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)), F.lit(MISSING_VALUE)).alias(f"f{i}")
             for i, c in enumerate(features)]
    has_label = label in df.columns
    rows = df.select(*keep, *([F.col(label).cast("double").alias("label")] if has_label else []), *cells)
    vector = VectorAssembler(inputCols=[f"f{i}" for i in range(len(features))], outputCol="features")
    return vector.transform(rows).select(*keep, *(["label"] if has_label else []), "features")


def _use_shared_checkpoints(spark: SparkSession) -> None:
    """Boosting cuts its lineage every few rounds if a checkpoint folder is known."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.path.join(shared_folder(spark), "boosting"))


def dealt(rows: DataFrame) -> DataFrame:
    """The rows of a fit, dealt out evenly to tasks whose number follows from the rows.

    Vectors of few values are much larger in memory than in their files, and the splits of a scan follow from the bytes
    of the files: a task would get more rows the larger the table is, and all rows of a file that cannot be split.
    """
    n = -(-rows.count() // FIT_ROWS)
    return rows if n <= 1 else rows.repartition(max(n, rows.sparkSession.sparkContext.defaultParallelism))


@contextmanager
def held(rows: DataFrame) -> Iterator[DataFrame]:
    """The dealt rows of a fit, kept on the executors for the block: a fit reads its rows several times, and every
    reading would deal them out anew. What does not fit in memory goes to disk."""
    kept = dealt(rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def best_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """(round with the least loss, whether ``patience`` rounds without a better one followed), counted from 1.

    Rounds after that point do not count. Without any finite loss the last round is the best.
    """
    best, least = len(losses), math.inf
    for i, loss in enumerate(losses, start=1):
        if loss < least:
            best, least = i, loss
        elif least < math.inf and i - best >= patience:
            return best, True
    return best, False


def fit_patiently(estimator: GBTClassifier, train: DataFrame, valid: DataFrame, patience: int = PATIENCE) -> tuple[Model, Model]:
    """(model of the best round, model of all rounds fitted).

    Spark's own rule ends at the first round that gains under a hundredth. Here a block of rounds is fitted, doubled
    until the best round lies ``patience`` rounds back, and the best number of rounds is fitted once more: the
    first rounds of a longer fit are the same trees, as every round has its own seed.
    """
    _use_shared_checkpoints(train.sparkSession)
    most = estimator.getMaxIter()
    rounds = min(most, 2 * patience)
    with held(train) as rows:
        while True:
            full = estimator.copy({estimator.maxIter: rounds}).fit(rows)
            best, ended = best_round(full.evaluateEachIteration(valid), patience)
            if ended or rounds >= most:
                break
            rounds = min(most, 2 * rounds)
        return (full if best == rounds else estimator.copy({estimator.maxIter: best}).fit(rows)), full


def fit(estimator: Estimator, train: DataFrame, valid: DataFrame | None = None, patience: int = PATIENCE) -> Model:
    """Fit; boosted trees keep the rounds up to the least loss on the validation rows when there are any."""
    _use_shared_checkpoints(train.sparkSession)
    if valid is None or not isinstance(estimator, GBTClassifier):
        with held(train) as rows:
            return estimator.fit(rows)
    return fit_patiently(estimator, train, valid, patience)[0]


def scored(model: Model, rows: DataFrame, name: str = "prediction") -> DataFrame:
    """Adds the probability of label 1 and drops the vector."""
    out = model.transform(rows).withColumn("_p", vector_to_array("probability")[1])
    return out.drop("rawPrediction", "probability", "prediction", "features").withColumnRenamed("_p", name)


def rounds_of(model: Model) -> int | None:
    return model.getNumTrees if isinstance(model, GBTClassificationModel) else None


def importance_table(spark: SparkSession, model: Model, features: Sequence[str]) -> DataFrame:
    """(feature, importance) of a tree model: one row per feature."""
    values = model.featureImportances.toArray() if hasattr(model, "featureImportances") else [0.0] * len(features)
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, values)], "feature string, importance double")


# --- baseline --------------------------------------------------------------------------------

@dataclass
class Baseline:
    """One boosted model with its features, metrics, learning curve and importance."""

    params: dict[str, object] = field(default_factory=dict)
    features: list[str] = field(default_factory=list)
    model: Model | None = None
    metrics: dict[str, float] = field(default_factory=dict)
    history: dict[str, list[float]] = field(default_factory=dict)
    full_model: Model | None = None

    def _need_model(self) -> Model:
        if self.model is None:
            raise ValueError("the model has not been trained yet")
        return self.model

    def train(self, train: DataFrame, valid: DataFrame, features: Sequence[str], num_boost_round: int = 100,
              early_stopping_rounds: int = PATIENCE) -> dict:
        self.features = list(features)
        parts = assembled(train, features).withColumn("part", F.lit("train")).unionByName(
            assembled(valid, features).withColumn("part", F.lit("valid")))
        rows = written(parts)
        early, late = rows.where(F.col("part") == "train"), rows.where(F.col("part") == "valid")
        self.model, self.full_model = fit_patiently(
            boosted_trees(self.params, num_boost_round), early, late, early_stopping_rounds)
        aucs = {r["part"]: r["auc"] for r in grouped_auc(scored(self.model, rows), ["part"], "prediction", "label").collect()}
        self.history = {"train": list(self.full_model.evaluateEachIteration(early)),
                        "valid": list(self.full_model.evaluateEachIteration(late))}
        self.metrics = {"train_auc": aucs.get("train"), "val_auc": aucs.get("valid"),
                        "best_iteration": rounds_of(self.model), "num_features": len(self.features)}
        return self.metrics

    def predict(self, df: DataFrame, keep: Sequence[str] = (ID,), use_best_iteration: bool = True) -> DataFrame:
        """Scores by the rounds up to the best one, or by all rounds that were fitted."""
        model = self._need_model()
        chosen = model if use_best_iteration or self.full_model is None else self.full_model
        return scored(chosen, assembled(df, self.features, keep)).drop("label")

    def feature_importance(self, spark: SparkSession, top_n: int | None = 20) -> DataFrame:
        table = importance_table(spark, self._need_model(), self.features).orderBy(F.col("importance").desc(), "feature")
        return table.limit(top_n) if top_n else table

    def learning_curve(self, spark: SparkSession) -> DataFrame:
        rows = [(i + 1, t, v) for i, (t, v) in enumerate(zip(self.history["train"], self.history["valid"]))]
        return spark.createDataFrame(rows, "iteration int, train_loss double, valid_loss double")

    def save(self, spark: SparkSession, path: str) -> None:
        self._need_model().write().overwrite().save(f"{path}/model")
        (self.full_model or self._need_model()).write().overwrite().save(f"{path}/full_model")
        write_settings(spark, {
            "params": self.params, "features": self.features, "metrics": self.metrics, "history": self.history,
            "saved_at": datetime.now(timezone.utc).isoformat(timespec="seconds")}, f"{path}/metadata")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Baseline:
        meta = read_settings(spark, f"{path}/metadata")
        return cls(meta["params"], meta["features"], GBTClassificationModel.load(f"{path}/model"), meta["metrics"],
                   meta["history"], GBTClassificationModel.load(f"{path}/full_model"))


def train_baseline_model(train: DataFrame, valid: DataFrame, features: Sequence[str], params: dict | None = None,
                         num_boost_round: int = 100, early_stopping_rounds: int = PATIENCE) -> tuple[Baseline, dict]:
    model = Baseline(dict(params or {}))
    return model, model.train(train, valid, features, num_boost_round, early_stopping_rounds)


# --- cross-validation ------------------------------------------------------------------------

STRATEGIES = ("time_series", "stratified", "standard", "contiguous")


def fold_frame(df: DataFrame, features: Sequence[str], strategy: str = "time_series", k: int = 5,
               seed: int = 42) -> tuple[DataFrame, list]:
    """The written training frame with a position or fold column, and (train test, valid test) per fold."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy}; choose from {STRATEGIES}")
    if strategy in ("time_series", "contiguous"):
        rows = written(assembled(df, features, keep=(ID, TIME)))
        if strategy == "time_series":
            return rows, fold_rules.fold_tests(rows, fold_rules.time_series_bounds(rows.count(), k))
        fold = fold_rules.contiguous_fold(rows, k)
        return rows, [(fold != i, fold == i) for i in range(k)]
    assign = fold_rules.stratified_folds if strategy == "stratified" else fold_rules.shuffled_folds
    rows = written(assembled(df, features).join(assign(df, k, seed), ID))
    return rows, [(F.col("fold") != i, F.col("fold") == i) for i in range(k)]


@dataclass
class CrossValidation:
    """Fold models with their scores; predictions stay in tables.

    ``folds`` needs the scores of all training rows of all folds, put in order: they are made when it is first asked for.
    """

    features: list[str]
    models: list[Model]
    fold_predictions: DataFrame
    oof: DataFrame
    importance: DataFrame
    measure: Callable[[], DataFrame]

    @cached_property
    def folds(self) -> DataFrame:
        """One row per fold: AUC and rows of both parts, and the best round."""
        return self.measure()

    def predict(self, df: DataFrame) -> DataFrame:
        return mean_prediction(self.long_predictions(df))

    def predict_with_uncertainty(self, df: DataFrame) -> DataFrame:
        return prediction_uncertainty(self.long_predictions(df))

    def long_predictions(self, df: DataFrame) -> DataFrame:
        """(id, model, prediction) from every fold model; features are checked and ordered."""
        rows = assembled(df, self.features)
        if "label" in rows.columns:
            rows = rows.drop("label")
        out = None
        for i, model in enumerate(self.models):
            one = scored(model, rows).withColumn("model", F.lit(i + 1))
            out = one if out is None else out.unionByName(one)
        return out

    def summary(self) -> DataFrame:
        """Fold statistics, the AUC over out-of-fold rows and the share of rows they cover."""
        return fold_rules.fold_stability(self.folds)


def cross_validate(df: DataFrame, features: Sequence[str], strategy: str = "time_series", n_splits: int = 5,
                   estimator: Callable[[], Estimator] | None = None, num_boost_round: int = 100,
                   params: Mapping[str, object] | None = None, seed: int = 42, parallelism: int = 2,
                   early_stopping_rounds: int = PATIENCE, prepared: tuple[DataFrame, list] | None = None) -> CrossValidation:
    """Fit one model per fold, in parallel over one written frame.

    Out-of-fold predictions keep the last fold where folds overlap; rows no fold validates have none.
    ``prepared`` is the result of ``fold_frame`` for the same arguments, for several runs over the same folds.
    """
    spark = df.sparkSession
    make = estimator or (lambda: boosted_trees(params, num_boost_round))
    rows, tests = prepared or fold_frame(df, features, strategy, n_splits, seed)

    def one(test) -> Model:
        return fit(make(), rows.where(test[0]), rows.where(test[1]), early_stopping_rounds)

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        models = list(pool.map(one, tests))

    def scores(part: str) -> DataFrame:
        out = None
        for i, (model, (in_train, in_valid)) in enumerate(zip(models, tests)):
            # A row of both parts counts as a training row.
            own = rows.where(in_train) if part == "train" else rows.where(in_valid & ~F.coalesce(in_train, F.lit(False)))
            here = scored(model, own).select(ID, "label", F.lit(i + 1).alias("fold"), "prediction")
            out = here if out is None else out.unionByName(here)
        return out

    valid = written(scores("valid"))

    def measure() -> DataFrame:
        parts = scores("train").withColumn("part", F.lit("train")).unionByName(valid.withColumn("part", F.lit("valid")))
        aucs = grouped_auc(parts, ["fold", "part"], "prediction", "label").groupBy("fold").agg(
            F.max(F.when(F.col("part") == "train", F.col("auc"))).alias("train_auc"),
            F.max(F.when(F.col("part") == "valid", F.col("auc"))).alias("val_auc"),
            F.max(F.when(F.col("part") == "train", F.col("n_pos") + F.col("n_neg"))).alias("train_size"),
            F.max(F.when(F.col("part") == "valid", F.col("n_pos") + F.col("n_neg"))).alias("val_size"))
        best = F.element_at(F.array(*[F.lit(rounds_of(m)).cast("int") for m in models]), F.col("fold"))
        return aucs.withColumn("best_iteration", best)

    oof = valid.groupBy(ID).agg(F.max_by("prediction", "fold").alias("prediction"), F.max("label").alias("label"),
                                F.max("fold").alias("fold"))
    tables = None
    for i, m in enumerate(models):
        t = importance_table(spark, m, features).withColumn("fold", F.lit(i + 1))
        tables = t if tables is None else tables.unionByName(t)
    importance = tables.groupBy("feature").agg(
        F.avg("importance").alias("importance"), F.stddev_pop("importance").alias("importance_std"))
    return CrossValidation(list(features), models, valid, oof, importance, measure)


def oof_report(cv: CrossValidation, total_rows: int) -> dict[str, float]:
    """AUC over covered rows only, and the covered share."""
    row = grouped_auc(cv.oof.withColumn("_g", F.lit(0)), ["_g"], "prediction", "label").first()
    covered = row["n_pos"] + row["n_neg"] if row else 0
    return {"oof_auc": row["auc"] if row else None, "coverage": covered / total_rows if total_rows else 0.0}


def compare_strategies(df: DataFrame, features: Sequence[str], strategies: Sequence[str] = ("time_series", "stratified"),
                       n_splits: int = 5, **options) -> DataFrame:
    """One row per strategy: OOF AUC, coverage and fold stability."""
    n, out = df.count(), None
    for s in strategies:
        cv = cross_validate(df, features, s, n_splits, **options)
        report = oof_report(cv, n)
        row = cv.summary().select(F.lit(s).alias("strategy"), F.lit(report["oof_auc"]).alias("oof_auc"),
                                  F.lit(report["coverage"]).alias("coverage"), "*")
        out = row if out is None else out.unionByName(row)
    return out


@dataclass
class EnsembleCrossValidation:
    """The cross-validated members of an ensemble and their (model, auc, gain) table."""

    members: dict[str, CrossValidation]
    table: DataFrame

    def predict(self, df: DataFrame) -> DataFrame:
        """(id, one column per member, prediction): fold models averaged per member, members averaged."""
        out = None
        for name, cv in self.members.items():
            part = cv.predict(df).withColumnRenamed("prediction", name)
            out = part if out is None else out.join(part, ID)
        return out.withColumn("prediction", folded_sum([F.col(n) for n in self.members]) / len(self.members))


def ensemble_cross_validate(df: DataFrame, features: Sequence[str], configs: Mapping[str, Mapping[str, object]],
                            strategy: str = "time_series", n_splits: int = 5,
                            num_boost_round: int = 100) -> EnsembleCrossValidation:
    """Cross-validate each configuration over the same folds; the gain is that of the averaged OOF predictions."""
    wide, members, prepared = None, {}, fold_frame(df, features, strategy, n_splits)
    for name, params in configs.items():
        cv = members[name] = cross_validate(df, features, strategy, n_splits, params=params,
                                            num_boost_round=num_boost_round, prepared=prepared)
        part = cv.oof.select(ID, *(["label"] if wide is None else []), F.col("prediction").alias(name))
        wide = part if wide is None else wide.join(part, ID)
    names = list(configs)
    mean = sum((F.col(n) for n in names[1:]), F.col(names[0])) / len(names)
    aucs = model_aucs(wide.withColumn("ensemble", mean), [*names, "ensemble"], "label").select("model", "auc")
    single = aucs.where(F.col("model") != "ensemble").agg(F.max("auc")).scalar()
    table = aucs.withColumn("gain", F.when(F.col("model") == "ensemble", F.col("auc") - single))
    return EnsembleCrossValidation(members, written(table))


# --- stacking --------------------------------------------------------------------------------

class Stacking:
    """Base models with out-of-fold predictions, tuned weights and a logistic meta-learner."""

    def __init__(self) -> None:
        self.bases: dict[str, Callable[[], Estimator]] = {}
        self.features: list[str] = []
        self.cv: dict[str, CrossValidation] = {}
        self.oof: DataFrame | None = None
        self.weights: dict[str, float] | None = None
        self.meta: Model | None = None

    def add(self, name: str, estimator: Callable[[], Estimator]) -> Stacking:
        self.bases[name] = estimator
        return self

    def add_boosted_trees(self, params: Mapping[str, object] | None = None, rounds: int = 100, name: str = "boosted") -> Stacking:
        return self.add(name, lambda: boosted_trees(params, rounds))

    def fit_stacking(self, df: DataFrame, features: Sequence[str], n_folds: int = 5, stratified: bool = True) -> DataFrame:
        """(id, label, one column per base model) of out-of-fold predictions."""
        self.features = list(features)
        wide, strategy = None, "stratified" if stratified else "standard"
        prepared = fold_frame(df, features, strategy, n_folds)
        for name, make in self.bases.items():
            cv = cross_validate(df, features, strategy, n_folds, make, prepared=prepared)
            self.cv[name] = cv
            part = cv.oof.select(ID, *(["label"] if wide is None else []), F.col("prediction").alias(name))
            wide = part if wide is None else wide.join(part, ID)
        self.oof = written(wide)
        return self.oof

    def _need_oof(self) -> DataFrame:
        if self.oof is None:
            raise ValueError("call fit_stacking first")
        return self.oof

    def _meta_rows(self, wide: DataFrame) -> DataFrame:
        vector = VectorAssembler(inputCols=list(self.bases), outputCol="features")
        return vector.transform(wide)

    def optimize_weights(self) -> dict[str, float]:
        self.weights = optimize_weights(self._need_oof(), list(self.bases), "label")
        return self.weights

    def fit_meta_learner(self, estimator: Estimator | None = None) -> Model:
        with held(self._meta_rows(self._need_oof()).select("label", "features")) as rows:
            self.meta = (estimator or logistic()).fit(rows)
        return self.meta

    def method_aucs(self) -> DataFrame:
        """(method, auc) of plain average, tuned weights and meta-learner on the OOF table."""
        wide = self._combine(self._need_oof())
        columns = [c for c in ("average", "weighted", "meta") if c in wide.columns]
        return model_aucs(wide, columns, "label").select(F.col("model").alias("method"), "auc")

    def _combine(self, wide: DataFrame) -> DataFrame:
        names = list(self.bases)
        out = wide.withColumn("average", sum((F.col(n) for n in names[1:]), F.col(names[0])) / len(names))
        if self.weights:
            terms = [F.col(n) * F.lit(w) for n, w in self.weights.items()]
            out = out.withColumn("weighted", sum(terms[1:], terms[0]))
        if self.meta is not None:
            out = scored(self.meta, self._meta_rows(out), "meta")
        return out

    def predict(self, df: DataFrame) -> DataFrame:
        """(id, base models, average, weighted, meta): fold models averaged per base, then combined."""
        self._need_oof()
        wide = None
        for name, cv in self.cv.items():
            part = cv.predict(df).withColumnRenamed("prediction", name)
            wide = part if wide is None else wide.join(part, ID)
        return self._combine(wide)

    def summary(self) -> dict[str, object]:
        return {"n_models": len(self.bases), "models": list(self.bases), "has_meta_learner": self.meta is not None,
                "has_weights": self.weights is not None, **{f"{n}_weight": w for n, w in (self.weights or {}).items()}}


