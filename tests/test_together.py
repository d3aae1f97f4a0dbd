"""Models grown together against Spark ML's own fits."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import together, training, tuning
from riskloom.operators.ordering import time_split

FEATURES = ["x1", "x2", "x3"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    made = []
    for i in range(1200):
        a, b = rng.randint(0, 9), rng.randint(0, 25) / 4
        made.append((i, i * 10, int(rng.random() < 0.1 + 0.08 * a * (b > 4)), float(a), b if rng.random() < 0.9 else None, rng.randint(-3, 20)))
    df = spark.createDataFrame(made, "TransactionID long, TransactionDT long, isFraud int, x1 double, x2 double, x3 int")
    return df.repartition(3).cache()


def _params(depth, least, rate=1.0, columns=1.0):
    return {"max_depth": depth, "min_child_samples": least, "learning_rate": 0.2, "subsample": rate, "colsample_bytree": columns}


def _together(rows, sets):
    vectors = training.assembled(rows, FEATURES)
    cuts, n = together.thresholds(vectors, 32)
    with together.blocks(vectors, cuts, n) as data:
        models = together.fit_together([training.boosted_trees(p, r) for p, r in sets], data)
        counts = together.score_counts(models, data).groupBy("trial", F.round("prediction", 9).alias("p"), "label").agg(F.sum("n").alias("n")).collect()
    return models, [sorted((r["p"], r["label"], r["n"]) for r in counts if r["trial"] == i) for i in range(len(sets))]


def test_trees_are_those_of_spark_ml(rows):
    """Without drawn rows and columns every score of every model is that of a fit of its own."""
    sets = [(_params(3, 1), 1), (_params(4, 20), 4), (_params(2, 50), 3)]
    vectors = training.assembled(rows, FEATURES)
    for (params, rounds), got in zip(sets, _together(rows, sets)[1]):
        one = training.scored(training.fit(training.boosted_trees(params, rounds), vectors), vectors)
        want = one.groupBy(F.round("prediction", 9).alias("p"), "label").count().collect()
        assert got == sorted((r["p"], int(r["label"]), r["count"]) for r in want)


def test_models_do_not_depend_on_their_company(rows, monkeypatch):
    """Alone, with others, or with room for one node a pass: the same trees."""
    sets = [(_params(3, 5, 0.7, 0.6), 2), (_params(4, 10, 0.9), 3)]
    both = _together(rows, sets)[1]
    assert both[1] == _together(rows, sets[1:])[1][0] and len({tuple(x) for x in both}) == 2
    monkeypatch.setattr(together, "HISTOGRAM_BYTES", 1)
    assert both == _together(rows, sets)[1]


def test_halving_reads_the_rows_once_a_level(rows, monkeypatch):
    """Passes follow from rounds and depths, not from the number of trials."""
    train, valid = time_split(rows)
    space, passes = {**tuning.SPACE, "max_depth": ("int", 2, 3)}, []
    monkeypatch.setattr(together, "_pass", lambda data, models, nodes, own=together._pass: (passes.append(len(models)), own(data, models, nodes))[1])
    unknown = valid.withColumn("isFraud", F.when(F.col("TransactionID") % 2 == 0, F.col("isFraud")))
    tuner = tuning.Tuner(train, FEATURES, unknown, num_boost_round=3, space=space)
    best = tuner.halving(10)
    assert len(passes) <= (1 + 3) * 3 and set(passes) == {10, 3}
    assert [t["rounds"] for t in tuner.trials].count(3) == 3 and best in [t["params"] for t in tuner.trials if t["step"] == 2]
    assert all(0.5 < t["value"] <= 1 for t in tuner.trials if t["step"] == 2)
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        tuning.Tuner(train.withColumn("isFraud", F.lit(3)), FEATURES, valid, num_boost_round=1).halving(2)


def test_thresholds_look_at_all_rows(spark, monkeypatch):
    monkeypatch.setattr(together, "SUMMARY", 64)
    df = spark.range(5000).selectExpr("id AS TransactionID", "0 AS isFraud", "cast(id AS double) AS x1", "cast(id % 3 AS double) AS x2",
                                      "if(id = 4321, 1.0D, 0.0D) AS x3").repartition(3)
    (many, few, rare), n = together.thresholds(training.assembled(df, FEATURES), 32)
    assert n == 5000 and list(few) == [0.5, 1.5] and list(rare) == [0.5]
    assert 28 <= len(many) <= 31 and np.abs(np.diff([0, *many, 5000]) - 5000 / 32).max() < 120
    assert together.cut_points(np.arange(64.0), np.ones(64), 3) == [15.5, 31.5, 47.5]
