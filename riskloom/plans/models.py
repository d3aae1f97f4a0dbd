"""Queries that train models.

The numbers of a model depend on the trainer, so a query returns what must hold of them: which rows are scored,
sizes, folds and labels, and 0 / 1 checks on the fitted values, which the checking SQL states from the tables.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.operators import ensemble, preprocess, training, tuning
from riskloom.operators.ordering import time_split
from riskloom.plans import fixture
from riskloom.plans.registry import register
from riskloom.plans.reports import _DOW, _HOUR, _MEMBERS, _POS, _TS_BOUNDS
from riskloom.session import shared_folder, written

FEATURES = "TransactionAmt card1 card2 card3 card5 addr1 C1 C2 D1 D2 DT_hour DT_day_of_week V1".split()
PARAMS = {"max_depth": 4, "learning_rate": 0.2, "subsample": 1.0, "colsample_bytree": 1.0, "min_child_samples": 5}
ROUNDS = 10
#: Rounds of each of the many fits of a search.
SEARCH_ROUNDS = 5
#: Least AUC of a trainer that has learnt the rule behind the label.
LEARNT = 0.8
MEMBERS = f"WITH {_POS}, {_TS_BOUNDS}, {_MEMBERS}\n--\n"


def _flag(test: Column) -> Column:
    return F.coalesce(test, F.lit(False)).cast("int")


def _share(*columns: str) -> Column:
    """1 if all columns lie between 0 and 1."""
    test = F.lit(True)
    for c in columns:
        test = test & F.col(c).between(0, 1)
    return _flag(test)


def _inside(params: Mapping[str, float], space: Mapping[str, tuple]) -> int:
    return int(all(space[n][1] <= v <= space[n][2] for n, v in params.items()))


def _frame(spark: SparkSession, sf: str) -> DataFrame:
    df = preprocess.create_time_features(fixture.transactions(spark, sf))
    return df.select("TransactionID", "TransactionDT", "isFraud", *FEATURES)


def _split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return time_split(_frame(spark, sf))


def _baseline(spark: SparkSession, sf: str) -> training.Baseline:
    train, valid = _split(spark, sf)
    return training.train_baseline_model(train, valid, FEATURES, PARAMS, ROUNDS)[0]


def _train_baseline(spark: SparkSession, sf: str) -> DataFrame:
    model = _baseline(spark, sf)
    m = model.metrics
    return model.feature_importance(spark).withColumns({
        "in_range": _share("importance"), "learnt": F.lit(int(min(m["train_auc"], m["val_auc"]) > LEARNT)),
        "rounds_kept": F.lit(int(1 <= m["best_iteration"] <= ROUNDS))})


def _score(spark: SparkSession, sf: str) -> DataFrame:
    return _baseline(spark, sf).predict(_frame(spark, sf)).withColumn("in_range", _share("prediction"))


def _roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Do the trained and the reloaded model score every row alike, by the best and by all rounds?"""
    model, rows = _baseline(spark, sf), _frame(spark, sf)
    path = os.path.join(shared_folder(spark), "models", uuid.uuid4().hex)
    model.save(spark, path)
    again = training.Baseline.load(spark, path)
    out = None
    for best in (True, False):
        pair = model.predict(rows, use_best_iteration=best).join(
            again.predict(rows, use_best_iteration=best).withColumnRenamed("prediction", "reloaded"), "TransactionID")
        part = pair.select("TransactionID", F.lit(int(best)).alias("best"), _flag(F.col("prediction") == F.col("reloaded")).alias("same"))
        out = part if out is None else out.unionByName(part)
    return out


def _cross_validated(spark: SparkSession, sf: str) -> training.CrossValidation:
    return training.cross_validate(_frame(spark, sf), FEATURES, n_splits=5, params=PARAMS, num_boost_round=ROUNDS)


def _cross_validate(spark: SparkSession, sf: str) -> DataFrame:
    return _cross_validated(spark, sf).folds.withColumns({
        "learnt": _flag((F.col("train_auc") > LEARNT) & (F.col("val_auc") > LEARNT)),
        "rounds_kept": _flag(F.col("best_iteration").between(1, ROUNDS))})


def _cv_oof(spark: SparkSession, sf: str) -> DataFrame:
    return _cross_validated(spark, sf).oof.withColumn("in_range", _share("prediction"))


def _cv_compare(spark: SparkSession, sf: str) -> DataFrame:
    out = training.compare_strategies(_frame(spark, sf), FEATURES, n_splits=5, params=PARAMS, num_boost_round=SEARCH_ROUNDS)
    return out.withColumns({
        "learnt": _flag(F.col("oof_auc") > LEARNT),
        "in_order": _flag((F.col("min_score") <= F.col("mean_score")) & (F.col("mean_score") <= F.col("max_score")))})


def _ensemble_cv(spark: SparkSession, sf: str) -> DataFrame:
    table = training.ensemble_cross_validate(
        _frame(spark, sf), FEATURES, {"deep": PARAMS, "flat": {**PARAMS, "max_depth": 3}}, n_splits=5,
        num_boost_round=SEARCH_ROUNDS).table
    single = table.where("model <> 'ensemble'").agg(F.max("auc").alias("_best"))
    return table.crossJoin(F.broadcast(single)).withColumns({  # one row by construction
        "learnt": _flag(F.col("auc") > LEARNT),
        "gain_holds": _flag(F.when(F.col("model") == "ensemble", F.abs(F.col("gain") - (F.col("auc") - F.col("_best"))) < 1e-12)
                            .otherwise(F.col("gain").isNull()))})


def _ensemble_scores(spark: SparkSession, sf: str) -> DataFrame:
    """New rows scored by a cross-validated ensemble."""
    train, valid = _split(spark, sf)
    cv = training.ensemble_cross_validate(train, FEATURES, {"deep": PARAMS, "flat": {**PARAMS, "max_depth": 3}}, n_splits=5,
                                          num_boost_round=SEARCH_ROUNDS)
    return cv.predict(valid).withColumns({
        "in_range": _share("deep", "flat", "prediction"),
        "is_mean": _flag(F.abs(F.col("prediction") - (F.col("deep") + F.col("flat")) / 2) < 1e-12)})


def _stacked(spark: SparkSession, sf: str) -> training.Stacking:
    stack = training.Stacking().add_boosted_trees(PARAMS, SEARCH_ROUNDS).add(
        "forest", lambda: training.random_forest(20, 6)).add("logistic", lambda: training.logistic(100))
    stack.fit_stacking(_frame(spark, sf), FEATURES, n_folds=5)
    return stack


def _stack_oof(spark: SparkSession, sf: str) -> DataFrame:
    return _stacked(spark, sf).oof.withColumn("in_range", _share("boosted", "forest", "logistic"))


def _meta(spark: SparkSession, sf: str) -> DataFrame:
    stack = _stacked(spark, sf)
    stack.optimize_weights()
    stack.fit_meta_learner()
    aucs = written(stack.method_aucs())
    best = ensemble.best_method(aucs)
    return aucs.crossJoin(F.broadcast(best)).withColumns({  # one row by construction
        "learnt": _flag(F.col("auc") > LEARNT),
        "best_holds": _flag(F.when(F.col("method") == F.col("best_method"), F.col("auc") == F.col("best_auc"))
                            .otherwise(F.col("auc") <= F.col("best_auc")))})


def _tune(spark: SparkSession, sf: str) -> DataFrame:
    train, valid = _split(spark, sf)
    space = {**tuning.SPACE, "max_depth": ("int", 2, 6)}
    tuner = tuning.Tuner(train, FEATURES, valid, num_boost_round=SEARCH_ROUNDS, space=space)
    tuner.tune(5)
    inside = F.element_at(F.array(*[F.lit(_inside(t["params"], space)) for t in tuner.trials]), F.col("trial") + 1)
    return tuner.trials_table().withColumns({
        "inside": inside, "in_range": _share("value"), "n_params": F.lit(min(len(t["params"]) for t in tuner.trials))})


def _staged(spark: SparkSession, sf: str) -> DataFrame:
    train, valid = _split(spark, sf)
    log = tuning.staged_tune(train, FEATURES, valid, trials_per_stage=3, num_boost_round=SEARCH_ROUNDS)[1]
    low, high = (F.create_map(*[F.lit(x) for n, r in tuning.FINE_SPACE.items() for x in (n, float(r[i]))]) for i in (1, 2))
    inside = F.forall(F.map_entries("params"), lambda e: e["value"].between(low[e["key"]], high[e["key"]]))
    return log.withColumns({
        "in_range": _share("value"), "inside": _flag(inside),
        "searched": F.array_join(F.array_sort(F.map_keys("params")), ",")})


HALVED = 50


def _halving(spark: SparkSession, sf: str) -> DataFrame:
    """Fifty drawn trials, of which most leave after one round: where each left, and whether that was in order."""
    train, valid = _split(spark, sf)
    space = {**tuning.SPACE, "max_depth": ("int", 2, 5)}
    tuner = tuning.Tuner(train, FEATURES, valid, num_boost_round=9, space=space)
    best = tuner.halving(HALVED)
    last = max(t["step"] for t in tuner.trials)
    top = max((t for t in tuner.trials if t["step"] == last), key=lambda t: (t["value"], -t["trial"]))
    rows = [(t["trial"], t["step"], t["rounds"], float(t["value"]), _inside(t["params"], space)) for t in tuner.trials]
    table = spark.createDataFrame(rows, "trial int, step int, rounds int, value double, inside int")
    return table.groupBy("step", "rounds").agg(
        F.count("*").alias("n_left"), F.min("inside").alias("inside"), F.min(_share("value")).alias("in_range")).withColumn(
        "best_is_last", F.lit(int(best == top["params"] and top["value"] > LEARNT)))


def _early_stop(spark: SparkSession, sf: str) -> DataFrame:
    """Labels without a rule: the validation loss turns at once, and the fit ends long before its thirty rounds."""
    noise = (F.pmod(F.xxhash64("TransactionID"), F.lit(7)) == 0).cast("int")
    train, valid = (d.withColumn("isFraud", noise) for d in _split(spark, sf))
    patience, most = 3, 30
    model, metrics = training.train_baseline_model(train, valid, FEATURES, {**PARAMS, "learning_rate": 1.0}, most, patience)
    fitted = training.rounds_of(model.full_model)
    curve = model.learning_curve(spark)
    low = F.min(F.struct("valid_loss", "iteration")).alias("low")
    return curve.agg(F.count("*").alias("rounds"), low).select(
        (F.col("rounds") == fitted).cast("int").alias("all_told"), F.lit(int(fitted < most)).alias("ended_early"),
        F.lit(int(metrics["best_iteration"] <= fitted - patience)).alias("patience_held"),
        (F.col("low.iteration") <= metrics["best_iteration"]).cast("int").alias("best_kept"))


def _search(spark: SparkSession, sf: str) -> tuning.FeatureSearch:
    return tuning.FeatureSearch(*_split(spark, sf), FEATURES, PARAMS, SEARCH_ROUNDS)


def _rfe(spark: SparkSession, sf: str) -> DataFrame:
    return _search(spark, sf).recursive_elimination()[1].withColumns({
        "in_range": _share("auc"), "n_removed": F.size("removed")})


def _null_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Every feature's rule worked out again from the reported importances of the fits."""
    importance, null_max = F.col("importance"), F.col("null_max")
    rule = (importance > null_max) | (importance > 2 * (F.col("null_mean") + 1)) | (
        importance - F.col("null_mean") > 2 * (F.col("null_std") + 1))
    return _search(spark, sf).null_importance(5)[1].withColumn(
        "rule_holds", _flag((F.col("keep") == rule.cast("int")) & (F.col("null_mean") <= null_max)))


CHAIN = [*FEATURES, "V2", "V3"]


def _select_chain(spark: SparkSession, sf: str) -> DataFrame:
    """What each data rule removed, and which features were left for the fitted rule."""
    train, valid = _split(spark, sf)
    extra = fixture.transactions(spark, sf).select("TransactionID", "V2", "V3")
    selected, removed = tuning.select_features(
        train.join(extra, "TransactionID"), valid.join(extra, "TransactionID"), CHAIN,
        ("missing", "single_value", "correlation", "importance"), params=PARAMS, num_boost_round=SEARCH_ROUNDS, min_kept=3)
    reached = {*selected, *removed.pop("low_importance", ())}
    fitted = [("fitted", f) for f in CHAIN if f in reached]
    rows = fitted + [(m, f) for m, fs in removed.items() for f in fs]
    return spark.createDataFrame(rows, "outcome string, feature string")


def _threshold_sweep(spark: SparkSession, sf: str) -> DataFrame:
    order = Window.orderBy("threshold")  # one row per threshold
    return _search(spark, sf).threshold_sweep(min_kept=3).withColumns({
        "in_range": _share("auc"),
        "no_fewer": _flag(F.col("n_features") >= F.coalesce(F.lag("n_features").over(order), F.lit(3)))})


def _values(column: str, values: list[str], *flags: str) -> str:
    listed = ", ".join(f"('{v}')" for v in values)
    return f"SELECT {column}, {', '.join(f'1 AS {f}' for f in flags)} FROM (VALUES {listed}) t({column})"


_TIMED = """frm AS (SELECT TransactionID, TransactionDT, {columns} FROM txn),
early AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY TransactionDT, TransactionID) - 1 AS rp FROM frm)
  WHERE rp < (SELECT CAST(floor(count(*) * (1 - 0.2::DOUBLE)) AS BIGINT) FROM txn))""".format(columns=", ".join(
    {"DT_hour": f"{_HOUR} AS DT_hour", "DT_day_of_week": f"{_DOW} AS DT_day_of_week"}.get(c, c) for c in CHAIN))


def _chain_sql() -> str:
    facts = " UNION ALL ".join(
        f"SELECT {i} AS place, '{c}' AS feature, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) > 0.95 AS gone, "
        f"coalesce(min({c}) = max({c}), TRUE) AS constant FROM early" for i, c in enumerate(CHAIN))
    pairs = " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM early WHERE isfinite({a}) AND isfinite({b})"
        for i, a in enumerate(CHAIN) for b in CHAIN[i + 1:] if not {a, b} & {"V2", "V3"})
    return f"""WITH {_TIMED}, facts AS ({facts}), pairs AS ({pairs}),
told AS (SELECT place, feature, CASE WHEN gone THEN 'missing' WHEN constant THEN 'single_value' END AS why FROM facts),
near AS (SELECT DISTINCT b FROM pairs JOIN told x ON a = x.feature AND x.why IS NULL WHERE abs(r) > 0.95)
--
SELECT coalesce(why, CASE WHEN feature IN (SELECT b FROM near) THEN 'correlated' ELSE 'fitted' END) AS outcome, feature FROM told"""


register("train_baseline", "feature:s in_range:i learnt:i rounds_kept:i", _train_baseline,
         _values("feature", FEATURES, "in_range", "learnt", "rounds_kept"))
register("score", "TransactionID:i in_range:i", _score, "SELECT TransactionID, 1 AS in_range FROM txn")
register("model_roundtrip", "TransactionID:i best:i same:i", _roundtrip,
         "SELECT TransactionID, best, 1 AS same FROM txn, range(2) t(best)")
register("cross_validate", "fold:i train_size:i val_size:i learnt:i rounds_kept:i", _cross_validate,
         f"{MEMBERS}SELECT fold, count(*) FILTER (WHERE part = 'train') AS train_size, count(*) FILTER (WHERE part = 'valid') "
         "AS val_size, 1 AS learnt, 1 AS rounds_kept FROM mem GROUP BY fold")
register("cross_validate_oof", "TransactionID:i fold:i label:i in_range:i", _cv_oof,
         f"{MEMBERS}SELECT TransactionID, max(fold) AS fold, max(isFraud) AS label, 1 AS in_range FROM mem "
         "WHERE part = 'valid' GROUP BY TransactionID")
register("cv_compare", "strategy:s coverage:d learnt:i in_order:i", _cv_compare,
         f"{MEMBERS}SELECT 'time_series' AS strategy, count(DISTINCT TransactionID) FILTER (WHERE part = 'valid') / (SELECT "
         "CAST(count(*) AS DOUBLE) FROM txn) AS coverage, 1 AS learnt, 1 AS in_order FROM mem UNION ALL "
         "SELECT 'stratified', count(DISTINCT TransactionID) / CAST(count(*) AS DOUBLE), 1, 1 FROM txn")
register("ensemble_cv", "model:s learnt:i gain_holds:i", _ensemble_cv,
         _values("model", ["deep", "flat", "ensemble"], "learnt", "gain_holds"))
register("ensemble_scores", "TransactionID:i in_range:i is_mean:i", _ensemble_scores,
         f"WITH {_POS}\n--\nSELECT TransactionID, 1 AS in_range, 1 AS is_mean FROM pos WHERE rp >= (SELECT "
         "CAST(floor(count(*) * (1 - 0.2::DOUBLE)) AS BIGINT) FROM txn)")
register("stack_oof", "TransactionID:i label:i in_range:i", _stack_oof,
         "SELECT TransactionID, isFraud AS label, 1 AS in_range FROM txn")
register("meta_learner", "method:s learnt:i best_holds:i", _meta,
         _values("method", list(ensemble.METHODS), "learnt", "best_holds"))
register("tune", "trial:i inside:i in_range:i n_params:i", _tune,
         f"SELECT i AS trial, 1 AS inside, 1 AS in_range, {len(tuning.SPACE)} AS n_params FROM range(5) t(i)")
register("halving_search", "step:i rounds:i n_left:i inside:i in_range:i best_is_last:i", _halving,
         "SELECT step, rounds, n_left, 1 AS inside, 1 AS in_range, 1 AS best_is_last FROM (VALUES (1, 1, 34), (2, 3, 11), (3, 9, 5)) "
         "t(step, rounds, n_left)")
register("early_stop", "all_told:i ended_early:i patience_held:i best_kept:i", _early_stop,
         "SELECT 1 AS all_told, 1 AS ended_early, 1 AS patience_held, 1 AS best_kept FROM (SELECT count(*) FROM txn)")
register("staged_tune", "stage:i trial:i searched:s inside:i in_range:i", _staged,
         "SELECT stage, i AS trial, searched, 1 AS inside, 1 AS in_range FROM range(3) t(i), (VALUES "
         + ", ".join(f"({n + 1}, '{','.join(sorted(names))}')" for n, names in enumerate(tuning.STAGES)) + ") s(stage, searched)")
register("rfe", "round:i n_features:i n_removed:i in_range:i", _rfe,
         f"SELECT i AS round, {len(FEATURES)} - i AS n_features, 1 AS n_removed, 1 AS in_range "
         f"FROM range(1, {len(FEATURES) - len(FEATURES) // 2 + 1}) t(i)")
register("null_importance", "feature:s n_runs:i rule_holds:i", _null_importance,
         _values("feature", FEATURES, "rule_holds").replace("feature, ", "feature, 5 AS n_runs, ", 1))
register("select_chain", "outcome:s feature:s", _select_chain, _chain_sql())
register("threshold_sweep", "threshold:d in_range:i no_fewer:i", _threshold_sweep,
         "SELECT threshold, 1 AS in_range, 1 AS no_fewer FROM (VALUES (0.9::DOUBLE), (0.95), (0.98), (0.99)) t(threshold)")
