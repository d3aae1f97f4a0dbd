"""Global order, quantiles, folds and scores against plain Python."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import ensemble, evaluation, folds, ordering, preprocess, profiling, quantiles, selection
from riskloom.plans import reports
from tests.frames import collected, frame, pandas_rows, same


def test_row_index_is_the_sorted_position(spark):
    rows = [(i, i % 7) for i in range(1000)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "id long, t int").repartition(5)
    got = ordering.row_index(df, ["t", "id"]).orderBy("row_pos").collect()
    assert [(r["t"], r["id"]) for r in got] == sorted((t, i) for i, t in rows)
    assert [r["row_pos"] for r in got] == list(range(1000))


def test_running_totals_with_one_dominant_value(spark):
    rows = [(5.0, 1)] * 1 + [(float(i), 2) for i in range(100, 200)]
    df = spark.createDataFrame(rows, "v double, n int").repartition(3)
    got = {r["v"]: r["n_before"] for r in ordering.running_totals(df, ["v"], ["n"]).collect()}
    assert got[5.0] == 0 and got[100.0] == 1 and got[199.0] == 1 + 2 * 99


def test_marks_and_split_match_the_sorted_order(spark):
    df = frame(spark)
    pdf = pandas_rows()
    marks = ordering.position_marks(df, [0, 10, 57, 399, 400])
    for p in (0, 10, 57, 399):
        assert marks[p] == (pdf.TransactionDT[p], pdf.TransactionID[p])
    assert 400 not in marks
    train, test = ordering.time_split(df, 0.25)
    assert sorted(r[0] for r in train.select("TransactionID").collect()) == sorted(pdf.TransactionID[:300])
    assert test.count() == 100


def test_split_keeps_undated_rows_in_the_late_part(spark):
    df = spark.createDataFrame([(i, i if i < 8 else None) for i in range(10)], "TransactionID long, TransactionDT long")
    train, test = ordering.time_split(df, 0.5)
    assert sorted(r[0] for r in train.collect()) == [0, 1, 2, 3, 4]
    assert sorted(r[0] for r in test.collect()) == [5, 6, 7, 8, 9]


@pytest.mark.parametrize("probs", [{"a": 0.0, "b": 0.5, "c": 1.0}, {"p10": 0.1, "p33": 1 / 3}])
def test_quantiles_interpolate_like_numpy(spark, probs):
    df = frame(spark)
    got = {r["card1"]: r for r in quantiles.exact_quantiles(df, ["card1"], "TransactionAmt", probs).collect()}
    pdf = pandas_rows()
    for key, values in pdf.dropna(subset=["card1"]).groupby("card1").TransactionAmt:
        for name, p in probs.items():
            assert abs(got[key][name] - np.percentile(values, p * 100)) < 1e-9


def test_quantiles_of_nothing(spark):
    df = frame(spark).where("card1 = -1")
    assert quantiles.exact_quantiles(df, ["card1"], "TransactionAmt", {"m": 0.5}).count() == 0


def test_average_rank(spark):
    df = frame(spark)
    pdf = pandas_rows().sort_values("TransactionID").reset_index(drop=True)
    got = collected(ordering.average_rank(df, "addr1", "r"))
    same(got["r"], pdf.addr1.rank())


def test_hash_sample_is_repeatable(spark):
    df = frame(spark)
    a = sorted(r[0] for r in ordering.hash_sample(df, "TransactionID", 50).select("TransactionID").collect())
    b = sorted(r[0] for r in ordering.hash_sample(df.repartition(7), "TransactionID", 50).select("TransactionID").collect())
    assert a == b and len(set(a)) == 50


# --- folds -----------------------------------------------------------------------------------

def test_time_series_bounds():
    bounds = folds.time_series_bounds(1000, 5, 0.2)
    assert [b[0] for b in bounds] == [800, 840, 880, 920, 960] and all(b[1] == 1000 for b in bounds)
    assert folds.time_series_bounds(3, 5, 0.2) == []


def test_folds_never_look_ahead(spark):
    got = folds.time_series_folds(frame(spark), keep=["TransactionID", "TransactionDT"]).toPandas()
    for _, part in got.groupby("fold"):
        train, valid = part[part.part == "train"], part[part.part == "valid"]
        assert train.TransactionDT.max() <= valid.TransactionDT.min()
        assert not set(train.TransactionID) & set(valid.TransactionID)
    sizes = got.groupby(["fold", "part"]).size()
    for i, (start, end) in enumerate(folds.time_series_bounds(400)):
        assert sizes[i + 1, "train"] == start and sizes[i + 1, "valid"] == end - start


def test_stratified_folds_spread_every_class(spark):
    df = frame(spark)
    got = folds.stratified_folds(df).join(df.select("TransactionID", "isFraud"), "TransactionID").toPandas()
    assert len(got) == 400
    counts = got.groupby(["isFraud", "fold"]).size().unstack()
    assert (counts.max(axis=1) - counts.min(axis=1) <= 1).all()


@pytest.mark.parametrize("n,k", [(10, 3), (11, 3), (12, 5)])
def test_contiguous_folds(spark, n, k):
    df = spark.createDataFrame([(i, i) for i in range(n)], "TransactionID long, TransactionDT long")
    got = [r["fold"] for r in folds.contiguous_folds(df, k).orderBy("TransactionID").collect()]
    assert got == [i for i, part in enumerate(np.array_split(range(n), k)) for _ in part]


# --- evaluation ------------------------------------------------------------------------------

def brute_auc(rows):
    pos, neg = [s for s, y in rows if y == 1], [s for s, y in rows if y == 0]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


def score_rows(n=300, seed=5):
    rng = random.Random(seed)
    return [(round(rng.random(), 1), int(rng.random() < 0.3)) for _ in range(n)]


def test_auc_with_ties_and_monotone_transform(spark):
    rows = score_rows()
    df = spark.createDataFrame(rows, "s double, isFraud int").repartition(3)
    want = brute_auc(rows)
    assert abs(evaluation.auc_value(df, "s") - want) < 1e-12
    assert abs(evaluation.auc_value(df.withColumn("s", F.exp("s")), "s") - want) < 1e-12


def test_auc_without_one_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 0), (0.2, 0)], "s double, isFraud int")
    assert evaluation.auc_value(df, "s") is None


def test_roc_curve_ends(spark):
    df = spark.createDataFrame(score_rows(), "s double, isFraud int")
    got = evaluation.roc_curve(df, "s").orderBy("threshold").collect()
    assert got[0]["fpr"] == 1.0 and got[0]["tpr"] == 1.0
    assert got[-1]["fpr"] <= 1 and len(got) == 11
    area = sum((a["fpr"] - b["fpr"]) * (a["tpr"] + b["tpr"]) / 2 for a, b in zip(got, got[1:]))
    last = got[-1]
    assert abs(area + last["fpr"] * last["tpr"] / 2 - brute_auc(score_rows())) < 1e-12


def test_threshold_metrics_without_hits(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 0)], "s double, isFraud int")
    row = evaluation.threshold_metrics(df, "s").first()
    assert (row["tp"], row["fp"], row["tn"], row["fn"]) == (0, 0, 1, 1)
    assert row["precision"] == row["recall"] == row["f1"] == 0.0


def test_rank_blend(spark):
    rows = [(i, float(i % 5), float((i * 7) % 11)) for i in range(60)]
    df = spark.createDataFrame(rows, "TransactionID long, a double, b double")
    got = collected(ensemble.rank_average(df, ["a", "b"]))
    pdf = pd.DataFrame(rows, columns=["id", "a", "b"])
    same(got["rank_blend"], (pdf.a.rank() / 60 + pdf.b.rank() / 60) / 2)


def test_blend_weights_sum_to_one(spark):
    df = spark.createDataFrame([(1, 0.2, 0.6)], "TransactionID long, a double, b double")
    assert abs(ensemble.blend_predictions(df, ["a", "b"], {"a": 3, "b": 1}).first()["blend"] - 0.3) < 1e-12
    with pytest.raises(ValueError):
        ensemble.blend_predictions(df, ["a", "b"], {"a": 1})
    for n in (2, 3, 5):
        assert all(abs(sum(w) - 1) < 1e-12 for w in ensemble.weight_candidates(n))
    assert len(ensemble.weight_candidates(2)) == 11 and len(ensemble.weight_candidates(3)) == 121


def test_weight_search_finds_the_informative_model(spark):
    rng = random.Random(9)
    rows = [(i, rng.random(), float(i % 4 == 0) * 0.5 + rng.random() * 0.4, int(i % 4 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "TransactionID long, noise double, good double, isFraud int")
    best = ensemble.optimize_weights(df, ["noise", "good"])
    assert best["good"] == 1.0 and best["noise"] == 0.0  # the earliest of the perfect ones


# --- profiling, selection, preprocessing -----------------------------------------------------

def test_rank_sum_p_value(spark):
    df = frame(spark)
    row = profiling.rank_sum_test(df, ["TransactionAmt"]).first()
    pdf = pandas_rows()
    rank = pdf.TransactionAmt.rank()
    n1, n0 = (pdf.isFraud == 1).sum(), (pdf.isFraud == 0).sum()
    assert abs(row["u"] - (rank[pdf.isFraud == 1].sum() - n1 * (n1 + 1) / 2)) < 1e-6
    assert abs(row["p_value"] - min(1.0, math.erfc(row["z"] / math.sqrt(2)))) < 1e-12
    assert row["n0"] == n0


def test_correlation_is_pairwise_complete(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 4)) * 1e3 + 1e6
    x[:, 3] = 5.0
    x[rng.random(x.shape) < 0.2] = np.nan
    pdf = pd.DataFrame(x, columns=list("abcd"))
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b double, c double, d double")
    got = {(r["feature_a"], r["feature_b"]): r["corr"] for r in selection.correlation_pairs(df).collect()}
    want = pdf.corr()
    for (i, j), r in got.items():
        if "d" in (i, j):
            assert r is None
        else:
            assert abs(r - want.loc[i, j]) < 1e-9


def test_column_filters(spark):
    df = spark.createDataFrame([(1, 1.0, None, "x", 2.0), (2, 1.0, None, "y", 4.0), (3, 1.0, 5.0, "x", 6.0)],
                               "TransactionID long, same double, rare double, t string, twice double")
    assert selection.remove_missing_features(df, 0.6) == ["rare"]
    assert selection.remove_single_value_features(df) == ["same", "rare"]
    df = df.withColumn("copy", F.col("twice") * -3)
    assert selection.remove_correlated_features(df, 0.95, ["twice", "copy"]) == ["copy"]


def test_importance_cut_floor(spark):
    df = spark.createDataFrame([(f"f{i:03d}", float(100 - i)) for i in range(80)], "feature string, importance double")
    assert selection.importance_cut(df, 0.01).agg(F.sum("keep")).first()[0] == 50
    assert selection.importance_cut(df, 0.5, min_kept=1).agg(F.sum("keep")).first()[0] < 50


def test_imputer_and_encoder_on_unseen_values(spark):
    train = spark.createDataFrame([(1, 1.0, "b"), (2, 3.0, "a"), (3, None, "a"), (4, 8.0, None)],
                                  "TransactionID long, x double, c string")
    test = spark.createDataFrame([(5, None, "z"), (6, 2.0, None)], "TransactionID long, x double, c string")
    filled = preprocess.Imputer(["x"], ["c"]).fit(train)
    assert [r["x"] for r in filled.transform(test).orderBy("TransactionID").collect()] == [3.0, 2.0]
    encoder = preprocess.LabelEncoder(["c"]).fit(filled.transform(train))
    got = [r["c"] for r in encoder.transform(filled.transform(test)).orderBy("TransactionID").collect()]
    assert got == [2, 2]  # a=0, b=1, missing=2; the unseen z shares the code of missing
    plain = preprocess.LabelEncoder(["c"]).fit(train.where("c is not null"))
    assert [r["c"] for r in plain.transform(test).orderBy("TransactionID").collect()] == [2, 2]
    with pytest.raises(ValueError):
        preprocess.Imputer([], [], "guess")


def test_permutations_are_permutations(spark):
    for n in (1, 2, 5, 37, 1000):
        moved = ordering.permutations(spark.range(n), "id", n, [3, 8]).toPandas()
        assert len(moved) == 2 * n
        for _, own in moved.groupby("seed"):
            assert sorted(own.id) == sorted(own.permuted) == list(range(n))
    a, b = (own.sort_values("id").permuted.to_numpy() for _, own in moved.groupby("seed"))
    # Neither follows the order of the positions nor the other seed.
    assert max(abs(np.corrcoef(x, y)[0, 1]) for x, y in ((a, np.arange(n)), (b, np.arange(n)), (a, b))) < 0.15
    assert ordering.permutations(spark.range(0), "id", 0, [1]).count() == 0


def test_one_hot_of_many_values_is_a_sparse_vector(spark):
    rows = [(i, f"v{i % 7}", "x" if i % 2 else "y") for i in range(20)]
    kinds = "TransactionID long, many string, few string"
    encoder = preprocess.OneHotEncoder(["many", "few"], max_values=5).fit(spark.createDataFrame(rows, kinds))
    out = encoder.transform(spark.createDataFrame([(1, "v3", "x"), (2, None, None), (3, "new", "z")], kinds))
    got = {r["TransactionID"]: (r["many_values"].size, list(r["many_values"].indices), r["few_x"], r["few_y"]) for r in out.collect()}
    assert got == {1: (7, [3], 1, 0), 2: (7, [], 0, 0), 3: (7, [], 0, 0)}
    assert set(out.columns) == {"TransactionID", "many", "few", "few_x", "few_y", "many_values"}


def test_mode_takes_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert preprocess.modes(df, ["c"]).first()["mode"] == "a"


def test_scaler_keeps_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, k double")
    rows = preprocess.StandardScaler(["x", "k"]).fit(df).transform(df).collect()
    assert sorted(r["x"] for r in rows) == [-1.0, 1.0] and {r["k"] for r in rows} == {0.0}


def test_quantile_bins_drop_repeated_edges(spark):
    values = [0.0] * 60 + [float(i) for i in range(1, 41)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = preprocess.quantile_bins(df, "v", "b").toPandas()
    want = pd.qcut(pd.Series(sorted(values)), 10, labels=False, duplicates="drop")
    assert list(got.sort_values("v").b) == list(want)


def test_downcast_types(spark):
    df = spark.createDataFrame([(1, 127, 40000, 1.5), (2, -5, 3, 1e300)], "a long, b long, c long, d double")
    assert dict(preprocess.downcast(df).dtypes) == {"a": "tinyint", "b": "smallint", "c": "int", "d": "double"}


def test_one_hot_wide_makes_no_cell_per_value(spark, monkeypatch):
    rows = [(i, 86400 * (30 if i >= 190 else 1), i if i % 19 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "TransactionID long, TransactionDT long, card1 int")
    for few in (False, True):
        own = df.where("card1 % 10 = 3 or TransactionID >= 190") if few else df
        monkeypatch.setattr(reports.fixture, "transactions", lambda *_: own)
        out = reports._one_hot_wide(spark, "")
        # A dense vector per row holds as many cells as there are values, rows times values in all.
        assert few or "array_position" not in out._jdf.queryExecution().toString()
        seen = sorted({str(r["card1"]) for r in own.collect() if r["card1"] is not None and r["TransactionDT"] < 20 * 86400})
        want = {r["TransactionID"]: (len(seen), seen.index(str(r["card1"])) if str(r["card1"]) in seen else None) for r in own.collect()}
        assert {r["TransactionID"]: (r["n_values"], r["place"]) for r in out.collect()} == want
        assert (len(seen) > 50) != few
