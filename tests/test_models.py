"""Training on a planted signal: label = f(x1). Kept small, a fit costs seconds."""

import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators import ensemble, interaction, selection, training, tuning
from riskloom.operators.folds import time_series_bounds
from riskloom.operators.ordering import time_split
from riskloom.operators.pipeline import FeatureBuilder
from tests.frames import frame

FEATURES = ["x1", "x2", "x3"]
PARAMS = {"max_depth": 3, "learning_rate": 0.3, "subsample": 1.0, "colsample_bytree": 1.0, "min_child_samples": 1}


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        x1 = rng.random()
        rows.append((i, i * 10, int(x1 > 0.7), x1, rng.random(), rng.random() if rng.random() < 0.8 else None))
    df = spark.createDataFrame(rows, "TransactionID long, TransactionDT long, isFraud int, x1 double, x2 double, x3 double")
    return df.repartition(2).cache()


def test_parameters_are_mapped():
    mapped, ignored = training.map_params({"learning_rate": 0.1, "num_leaves": 31, "max_depth": -1, "colsample_bytree": 0.5,
                                           "objective": "binary"})
    assert mapped == {"stepSize": 0.1, "maxDepth": 5, "featureSubsetStrategy": "0.5"} and ignored == ["num_leaves"]


def test_parameters_without_a_counterpart_are_named(spark):
    with pytest.warns(UserWarning, match="reg_alpha"):
        training.boosted_trees({"reg_alpha": 1.0})


def test_baseline_finds_the_signal_and_reloads(spark, planted, tmp_path):
    train, valid = time_split(planted)
    with pytest.raises(ValueError):
        training.Baseline().predict(valid)
    model, metrics = training.train_baseline_model(train, valid, FEATURES, PARAMS, 3)
    assert metrics["val_auc"] > 0.9 and metrics["num_features"] == 3
    assert model.feature_importance(spark, 1).first()["feature"] == "x1"
    assert model.learning_curve(spark).count() == len(model.history["train"])
    model.save(spark, str(tmp_path / "m"))
    again = training.Baseline.load(spark, str(tmp_path / "m"))
    a = model.predict(valid).orderBy("TransactionID").collect()
    assert a == again.predict(valid).orderBy("TransactionID").collect() and len(a) == 120
    with pytest.raises(ValueError):
        model.predict(valid.drop("x2"))


def test_cross_validation_covers_only_late_rows(planted):
    cv = training.cross_validate(planted, FEATURES, n_splits=3, params=PARAMS, num_boost_round=2)
    report = training.oof_report(cv, 600)
    assert abs(report["coverage"] - 0.2) < 0.01 and report["oof_auc"] > 0.9
    assert [r["train_size"] for r in cv.folds.orderBy("fold").collect()] == [b[0] for b in time_series_bounds(600, 3)]
    scores = cv.predict_with_uncertainty(planted.limit(20)).collect()
    assert len(scores) == 20 and all(0 <= r["prediction"] <= 1 and r["uncertainty"] >= 0 for r in scores)


def test_stacking(planted):
    stack = training.Stacking().add_boosted_trees(PARAMS, 2).add("logistic", lambda: training.logistic(20))
    with pytest.raises(ValueError):
        stack.optimize_weights()
    oof = stack.fit_stacking(planted, FEATURES, n_folds=2)
    assert oof.count() == 600 and oof.where(F.col("boosted").isNull()).count() == 0
    assert abs(sum(stack.optimize_weights().values()) - 1) < 1e-9
    stack.fit_meta_learner()
    aucs = {r["method"]: r["auc"] for r in stack.method_aucs().collect()}
    assert set(aucs) == {"average", "weighted", "meta"} and min(aucs.values()) > 0.9
    assert stack.summary()["has_meta_learner"]


def test_searches(planted):
    train, valid = time_split(planted)
    search = tuning.FeatureSearch(train, valid, FEATURES, PARAMS, 2)
    left, history = search.recursive_elimination(1, 0.5)
    assert left == ["x1"] and [r["n_features"] for r in history.orderBy("round").collect()] == [2, 1]
    shuffled = search.shuffled_labels([1, 2]).toPandas()
    ones = search.early.agg(F.sum("label")).first()[0]
    assert len(shuffled) == 480 and shuffled.label_1.sum() == shuffled.label_2.sum() == ones
    assert not (shuffled.label_1 == shuffled.label_2).all() and not (shuffled.label_1 == shuffled.label).all()
    kept, table = search.null_importance(3)
    assert "x1" in kept and {r["n_runs"] for r in table.collect()} == {3}
    kept, removed = search.select_by_importance(0.99, min_kept=1)
    assert "x1" in kept and not set(kept) & set(removed)


def test_tuner_is_repeatable(planted):
    train, valid = time_split(planted)
    space = {**tuning.SPACE, "max_depth": ("int", 2, 3)}
    tuner = tuning.Tuner(train, FEATURES, valid, num_boost_round=2, space=space)
    with pytest.raises(ValueError):
        tuner.get_best_params()
    best = tuner.tune(2)
    assert tuner.summary().first()["n_trials"] == 2
    rng = random.Random(42)
    drawn = [tuning.draw(rng, space, list(space)) for _ in range(2)]
    assert best in drawn


def test_fitted_features_do_not_look_at_the_test_frame(spark):
    df = frame(spark)
    train, test = time_split(df, 0.3)
    builder = FeatureBuilder().fit(train)
    out = builder.transform(test, history=train)
    rows = out.collect()
    means = {r["card1"]: r["m"] for r in train.groupBy("card1").agg(F.avg("TransactionAmt").alias("m")).collect()}
    assert len(rows) == test.count()
    for r in rows:
        want = means.get(r["card1"]) if r["card1"] is not None else None
        assert (r["card1_mean"] is None) == (want is None)
        if want is not None:
            assert abs(r["card1_mean"] - want) < 1e-9
    # The past of the test rows reaches back into the training rows.
    assert max(r["card1_txn_count_so_far"] or 0 for r in rows) > test.where("card1 = 7").count()


def test_best_round_waits_for_the_patience():
    assert training.best_round([3.0, 2.0, 2.5, 2.4, 1.0], 2) == (2, True)
    assert training.best_round([3.0, 2.0, 2.5, 2.4, 1.0], 3) == (5, False)
    assert training.best_round([3.0, 2.0, 2.0], 5) == (2, False)
    assert training.best_round([float("nan")] * 4, 2) == (4, False) and training.best_round([], 2) == (0, False)


def test_boosting_goes_on_after_a_small_gain(planted):
    train, valid = (training.assembled(d, FEATURES) for d in time_split(planted))
    slow = training.boosted_trees({**PARAMS, "learning_rate": 0.002}, 6)
    # The library's own rule ends here at once: no round gains a hundredth.
    assert training.fit(slow, train, valid).getNumTrees == 6
    both = train.selectExpr("label", "features", "false AS held_out").unionByName(valid.selectExpr("label", "features", "true AS held_out"))
    assert slow.copy({slow.validationIndicatorCol: "held_out"}).fit(both).getNumTrees < 6


def test_boosting_is_cut_to_its_best_round(spark):
    rng = random.Random(9)
    rows = [(float(rng.random() < 0.5), rng.random(), rng.random(), rng.random()) for _ in range(300)]
    df = spark.createDataFrame([(i, i, int(r[0]), *r[1:]) for i, r in enumerate(rows)],
                               "TransactionID long, TransactionDT long, isFraud int, x1 double, x2 double, x3 double")
    train, valid = time_split(df)
    noisy = {**PARAMS, "max_depth": 5}
    model, metrics = training.train_baseline_model(train, valid, FEATURES, noisy, 12, early_stopping_rounds=3)
    fitted = model.full_model.getNumTrees
    assert metrics["best_iteration"] < fitted <= 12
    losses = model.history["valid"]
    assert metrics["best_iteration"] == training.best_round(losses, 3)[0]
    again = model.model.evaluateEachIteration(training.assembled(valid, FEATURES))
    assert again == pytest.approx(losses[:len(again)])
    late = model.predict(valid).join(model.predict(valid, use_best_iteration=False).withColumnRenamed("prediction", "all"), "TransactionID")
    assert late.where("prediction <> all").count() > 0


def test_rates_of_the_training_frame_leave_out_the_own_label(spark):
    rows = [(i, i, i % 2, f"g{i}") for i in range(8)]
    df = spark.createDataFrame(rows, "TransactionID long, TransactionDT long, isFraud int, card1 string")
    encoder = interaction.RateEncoder({"k": ("card1",)})
    own = encoder.fit_transform(df).collect()
    assert {round(r["k_fraud_rate"], 12) for r in own} == {0.5} and {r["k_count"] for r in own} == {1}
    assert encoder.transform(df).columns == encoder.fit_transform(df).columns
    assert {round(r["k_fraud_rate"], 6) for r in encoder.transform(df).collect()} == {round(5 / 11, 6), round(6 / 11, 6)}


def test_weights_of_four_models_are_searched(spark):
    rng = random.Random(2)
    rows = [(i, i % 2, rng.random(), rng.random(), rng.random(), 0.6 * (i % 2) + 0.4 * rng.random()) for i in range(200)]
    df = spark.createDataFrame(rows, "TransactionID long, isFraud int, a double, b double, c double, good double")
    weights = ensemble.optimize_weights(df, ["a", "b", "c", "good"])
    assert abs(sum(weights.values()) - 1) < 1e-9 and weights["good"] > 0.25
    assert all(abs(sum(w) - 1) < 1e-9 for w in ensemble.neighbours([1.0, 0.0, 0.0, 0.0]))


@pytest.mark.parametrize("importance, nulls, keep", [
    (50.0, [40.0, 45.0, 49.0], 1),            # above every null run
    (50.0, [0.0, 0.0, 60.0], 1),              # over twice the null mean
    (50.0, [44.0, 46.0, 51.0], 0),
    (50.0, [45.0, 45.5, 45.2, 45.1, 50.5], 0),
    (50.0, [40.0] * 30 + [51.0], 1),          # over two deviations above the null mean
])
def test_each_null_importance_rule_can_keep(spark, importance, nulls, keep):
    actual = spark.createDataFrame([("f", importance)], "feature string, importance double")
    runs = spark.createDataFrame([("f", i, v) for i, v in enumerate(nulls)], "feature string, run int, importance double")
    assert selection.null_importance_rule(actual, runs).first()["keep"] == keep


def test_null_importances_are_gains(planted):
    train, valid = time_split(planted)
    kept, table = tuning.FeatureSearch(train, valid, FEATURES, PARAMS, 2).null_importance(2)
    assert "x1" in kept
    assert table.agg(F.sum("importance")).first()[0] == pytest.approx(480 * 2)


def test_features_without_importance_come_last(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 3.0), ("d", 1.0)], "feature string, importance double")
    rows = {r["feature"]: (r["place"], r["cumulative_share"], r["keep"]) for r in selection.importance_cut(df, 0.8, 2).collect()}
    assert rows == {"c": (1, 0.6, 1), "a": (2, 0.8, 1), "d": (3, 1.0, 0), "b": (4, 1.0, 0)}


def test_fits_are_dealt_out_by_rows(planted, monkeypatch):
    """The tasks of a fit follow from its rows, not from the splits of a scan."""
    monkeypatch.setattr(training, "FIT_ROWS", 50)
    one, seen = planted.withColumn("x2", F.lit(None).cast("int")).coalesce(1), []
    monkeypatch.setattr(training.GBTClassifier, "fit", lambda self, rows, *_, own=training.GBTClassifier.fit: (
        seen.append([len(p) for p in rows.rdd.glom().collect()]), own(self, rows))[1])
    rows = training.assembled(one, FEATURES)
    training.fit(training.boosted_trees(PARAMS, 2), rows)
    training.fit(training.boosted_trees(PARAMS, 2), rows, rows)
    assert len(seen) >= 2 and all(sum(sizes) == 600 and len(sizes) == 12 and max(sizes) <= 60 for sizes in seen)
    monkeypatch.setattr(training, "FIT_ROWS", 600)
    assert training.dealt(rows) is rows


def test_a_fit_keeps_its_dealt_rows(planted, monkeypatch):
    """A trainer reads its rows several times; they are dealt out once, and let go of when the fit is over."""
    seen = []
    monkeypatch.setattr(training.LogisticRegression, "fit", lambda self, rows, *_: seen.append((rows, rows.storageLevel.useDisk)))
    training.fit(training.logistic(2), training.assembled(planted, FEATURES))
    assert seen[0][1] and not seen[0][0].storageLevel.useDisk


def test_fold_scores_of_training_rows_are_made_when_asked_for(planted, monkeypatch):
    calls = []
    monkeypatch.setattr(training, "grouped_auc", lambda *a, own=training.grouped_auc: (calls.append(a[1]), own(*a))[1])
    stack = training.Stacking().add("logistic", lambda: training.logistic(5))
    stack.fit_stacking(planted, FEATURES, n_folds=2)
    assert not calls
    rows = stack.cv["logistic"].folds.orderBy("fold").collect()
    assert len(calls) == 1 and [(r["train_size"], r["val_size"]) for r in rows] == [(300, 300)] * 2
    assert min(min(r["train_auc"], r["val_auc"]) for r in rows) > 0.9
