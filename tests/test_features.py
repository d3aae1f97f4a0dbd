"""Group statistics, interactions and temporal features against plain pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskloom.operators import aggregation, interaction, keyed, pipeline, temporal
from riskloom.operators.group_stats import GroupRequest, GroupStats, attach_group_stats
from tests.frames import SCHEMA, collected, frame, pandas_rows, random_rows, same


def test_card_statistics(spark):
    got = collected(aggregation.create_card_aggregations(frame(spark)))
    pdf = pandas_rows().sort_values("TransactionID").reset_index(drop=True)
    groups = pdf.groupby("card1")["TransactionAmt"]
    for stat in ("count", "mean", "std", "min", "max", "median", "sum"):
        same(got[f"card1_{stat}"], groups.transform(stat).where(pdf.card1.notna()))
    z = (pdf.TransactionAmt - groups.transform("mean")) / (groups.transform("std") + 1e-5)
    same(got["card1_amt_zscore"], z)
    assert pd.isna(got.loc[got.card1 == 999, "card1_std"]).all()


@pytest.mark.parametrize("small_rows", [0, 3, 10 ** 6])
def test_every_way_of_attaching_gives_the_same_rows(spark, small_rows):
    df = frame(spark)
    requests = [GroupRequest("card1", "a", ("count", "mean")), GroupRequest("addr1", "b", ("max",)),
                GroupRequest("P_emaildomain", "c", ("sum", "median"))]
    got = collected(attach_group_stats(df, "TransactionAmt", requests, small_rows=small_rows))
    pdf = pandas_rows().sort_values("TransactionID").reset_index(drop=True)
    same(got["a_count"], pdf.groupby("card1").TransactionAmt.transform("count"))
    same(got["a_mean"], pdf.groupby("card1").TransactionAmt.transform("mean"))
    same(got["b_max"], pdf.groupby("addr1").TransactionAmt.transform("max"))
    same(got["c_median"], pdf.groupby("P_emaildomain").TransactionAmt.transform("median"))
    assert len(got) == len(pdf)


def test_hot_and_cold_keys_both_arrive(spark):
    # Key 7 owns more than a thousandth of the rows, the 2,000 single keys do not.
    rows = [(i, 0, i, 1.0, "W", 7 if i % 3 == 0 else 10_000 + i, None, None, None, None, None) for i in range(3000)]
    df = frame(spark, rows)
    got = attach_group_stats(df, "TransactionAmt", [GroupRequest("card1", "g", ("count",))], small_rows=0)
    counts = {r["g_count"]: r["n"] for r in got.groupBy("g_count").agg(F.count("*").alias("n")).collect()}
    assert counts == {1000: 1000, 1: 2000}


def test_frame_without_row_id_still_attaches(spark):
    df = frame(spark).drop("TransactionID")
    got = attach_group_stats(df, "TransactionAmt", [GroupRequest("card1", "g", ("count",))], small_rows=0)
    assert got.count() == 400


def test_statistics_learnt_on_train_reach_test(spark):
    df = frame(spark)
    train, test = df.where("TransactionDT < 500000"), df.where("TransactionDT >= 500000")
    out = collected(GroupStats("TransactionAmt", [GroupRequest("card1", "g", ("mean",))]).fit(train).transform(test))
    pdf = pandas_rows()
    means = pdf[pdf.TransactionDT < 500000].groupby("card1").TransactionAmt.mean()
    same(out["g_mean"], out["card1"].map(means))


def test_absent_columns_are_skipped(spark):
    df = frame(spark).drop("card2", "addr1")
    _, names = aggregation.create_aggregation_features(df)
    assert "card1_mean" in names and not any(n.startswith(("card2", "addr1", "card12")) for n in names)


def test_feature_counts_on_the_full_schema(spark):
    from riskloom.plans import fixture

    df = fixture.joined(spark, "/root/testdata/sf0.001")
    assert len(aggregation.create_aggregation_features(df)[1]) == 71
    assert len(interaction.create_interaction_features(df)[1]) == 70
    assert len(temporal.create_temporal_features(df)[1]) == 91
    assert len(temporal.create_temporal_features(df, include_velocity=False)[1]) == 75


def test_interaction_rates(spark):
    out, names = interaction.combination_features(frame(spark), {"card1_addr1": ("card1", "addr1")})
    got = collected(out)
    pdf = pandas_rows().sort_values("TransactionID").reset_index(drop=True)
    key = pdf.card1.map(lambda v: "nan" if pd.isna(v) else str(int(v))) + "_" + pdf.addr1.map(
        lambda v: "nan" if pd.isna(v) else str(v))
    assert list(got["card1_addr1"]) == list(key)
    g = pdf.isFraud.mean()
    n, s = pdf.groupby(key).isFraud.transform("count"), pdf.groupby(key).isFraud.transform("sum")
    same(got["card1_addr1_count"], n)
    same(got["card1_addr1_fraud_rate"], (s + 10 * g) / (n + 10))
    assert names == ["card1_addr1", "card1_addr1_count", "card1_addr1_fraud_rate"]


@pytest.mark.parametrize("small_rows", [0, 10 ** 6])
def test_out_of_fold_rate_ignores_the_own_fold(spark, small_rows):
    df = frame(spark)
    out, _ = interaction.combination_features(df, {"c": ("card1",)}, mode="out_of_fold", small_rows=small_rows)
    got = collected(out.withColumn("fold", interaction._fold_of("TransactionID", 5, 42)))
    g = got.isFraud.mean()
    for r in got.itertuples():
        other = got[(got.c == r.c) & (got.fold != r.fold)]
        assert abs(r.c_fraud_rate - (other.isFraud.sum() + 10 * g) / (len(other) + 10)) < 1e-9


def test_rate_encoder_gives_unseen_keys_the_overall_rate(spark):
    df = frame(spark)
    encoder = interaction.RateEncoder({"k": ("card1",)}).fit(df.where("card1 <> 7"))
    row = encoder.transform(df.where("card1 = 7")).first()
    assert row["k_count"] == 0 and abs(row["k_fraud_rate"] - encoder.overall) < 1e-12


def test_no_target_means_no_rates(spark):
    _, names = interaction.create_interaction_features(frame(spark).drop("isFraud"))
    assert names and not any(n.endswith("_fraud_rate") for n in names)


def brute_velocity(pdf, key, width):
    out = []
    for r in pdf.itertuples():
        k = getattr(r, key)
        out.append(0 if pd.isna(k) else int(((pdf[key] == k) & (pdf.TransactionDT < r.TransactionDT)
                                             & (pdf.TransactionDT >= r.TransactionDT - width)).sum()))
    return pd.Series(out, index=pdf.index)


def test_velocity_against_brute_force(spark):
    got = collected(temporal.create_velocity_features(frame(spark))[0])
    pdf = pandas_rows()
    for key in ("card1", "P_emaildomain", "addr1", "DeviceInfo"):
        for label, width in temporal.VELOCITY_WINDOWS.items():
            want = brute_velocity(pdf, key, width)
            want.index = pdf.TransactionID
            same(got[f"{key}_velocity_{label}"], want.sort_index())
        assert (got[f"{key}_velocity_1h"] <= got[f"{key}_velocity_6h"]).all()
        assert (got[f"{key}_velocity_24h"] <= got[f"{key}_velocity_7d"]).all()


def test_time_since_and_gaps_with_ties(spark):
    df = frame(spark)
    since = collected(temporal.create_time_since_features(df)[0])
    gaps = collected(temporal.create_transaction_gap_features(df)[0])
    pdf = pandas_rows()
    for key in ("card1", "P_emaildomain", "DeviceInfo"):
        g = pdf.groupby(key).TransactionDT
        gap = g.diff() / 3600
        want = pd.DataFrame({
            "id": pdf.TransactionID, "prev": gap, "first": (pdf.TransactionDT - g.transform("first")) / 3600,
            "count": (pdf.groupby(key).cumcount() + 1).where(pdf[key].notna()),
            "mean": gap.groupby(pdf[key]).transform("mean"), "std": gap.groupby(pdf[key]).transform("std")})
        want["odd"] = ((gap > want["mean"] + 2 * want["std"]) | (gap < want["mean"] - 2 * want["std"])).astype(int)
        want = want.sort_values("id")
        same(since[f"{key}_time_since_prev"], want["prev"])
        same(since[f"{key}_time_since_first"], want["first"])
        same(since[f"{key}_txn_count_so_far"], want["count"])
        same(gaps[f"{key}_mean_gap"], want["mean"])
        same(gaps[f"{key}_std_gap"], want["std"])
        same(gaps[f"{key}_unusual_gap"], want["odd"])


def test_crowded_seconds_give_the_same_timeline(spark):
    df = frame(spark)
    order = ["name", "TransactionID"]
    plain = temporal.key_timeline(df, ["card1", "addr1"], temporal.VELOCITY_WINDOWS).orderBy(*order).collect()
    split = temporal.key_timeline(df, ["card1", "addr1"], temporal.VELOCITY_WINDOWS, crowd_limit=2).orderBy(*order).collect()
    assert [r.asDict() for r in plain] == [r.asDict() for r in split] and len(plain) > 600


def test_rfm(spark):
    got = collected(temporal.create_rfm_features(frame(spark))[0])
    pdf = pandas_rows().sort_values("TransactionID").reset_index(drop=True)
    g = pdf.groupby("card1")
    rec = (pdf.TransactionDT.max() - g.TransactionDT.transform("max")) / 3600
    freq, total = g.TransactionDT.transform("count"), g.TransactionAmt.transform("sum")
    same(got["card1_rfm_score"], 1 / (rec + 1) + freq / (freq.max() + 1) + total / (total.max() + 1))
    same(got["card1_monetary_std"], g.TransactionAmt.transform("std"))


def test_time_patterns_use_the_calendar(spark):
    df = spark.createDataFrame([(1, 0), (2, 3600 * 25), (3, 86400 * 3 + 12 * 3600)], "TransactionID long, TransactionDT long")
    got = collected(temporal.create_time_pattern_features(df)[0])
    assert list(got.DT_day_of_week) == [4, 5, 0]  # 2017-12-01 was a Friday
    assert list(got.DT_hour) == [0, 1, 12]
    assert list(got.time_of_day) == ["night", "night", "morning"]
    assert np.allclose(got.hour_sin, np.sin(2 * np.pi * got.DT_hour / 24))


def test_empty_frame(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert temporal.create_temporal_features(df)[0].count() == 0
    assert aggregation.create_aggregation_features(df)[0].count() == 0
    assert interaction.create_interaction_features(df)[0].count() == 0


def test_broadcast_limit_follows_the_session(spark):
    df = frame(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert keyed.broadcast_rows(df) == 0
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20MB")
        assert keyed.broadcast_rows(df) == 20 * 1024 * 1024 // keyed.BYTES_PER_ROW
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_random_rows_hold_a_hot_key():
    rows = random_rows()
    assert sum(r[5] == 7 for r in rows) > len(rows) / 4


def test_hot_keys_by_an_absolute_bound(spark, monkeypatch):
    """A key with 0.09 % of the rows is taken out of the shuffle once it has more rows than a task may receive."""
    monkeypatch.setattr(keyed, "TASK_ROWS", 80)
    df = spark.range(100_000).select(
        F.col("id").alias("TransactionID"), F.when(F.col("id") < 90, -1).otherwise(F.col("id") % 5000).cast("int").alias("k"))
    table = keyed.key_table(keyed.key_rows(df, {"k": F.col("k")}).groupBy("name", "key").agg(F.count("*").alias("n")))
    assert table.sizes["k"] == (5001, 100_000) and keyed.hot_bar(100_000) == 80
    assert table.table.where(F.col("n") > keyed.hot_bar(100_000)).select("key").collect() == [("-1",)]
    out = keyed.attach(df, {"k": F.col("k")}, table, {"k": {"f": "n"}}, small_rows=0)
    assert {r[0]: r[1] for r in out.groupBy("k").agg(F.max("f")).collect()} == {
        r["k"]: r["count"] for r in df.groupBy("k").count().collect()}
    monkeypatch.setattr(keyed, "MOST_HOT", 10)
    assert keyed.hot_bar(100_000) == 10_000


def test_one_budget_for_the_broadcasts_of_a_build(spark, monkeypatch):
    df = frame(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    rows = [(n, f"{n}{i}", 1, 2.0) for n, many in (("a", 10), ("b", 30), ("c", 60)) for i in range(many)]
    table = keyed.key_table(spark.createDataFrame(rows, "name string, key string, n long, v double"))
    assert sum(table.bytes.values()) == 100 * (56 + 16) + 30 * 2 + 70 * 3
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2900")
        monkeypatch.setattr(keyed, "BUDGET_TABLES", 1)
        assert keyed._small(df, table, ["c", "b", "a"], None) == ["a"]
        monkeypatch.setattr(keyed, "BUDGET_TABLES", 2)
        assert keyed._small(df, table, ["c", "b", "a"], None) == ["b", "a"]
        with keyed.broadcast_budget(df):
            taken = [keyed._small(df, table, ["a", "b"], None) for _ in range(4)]
        assert taken == [["a", "b"], ["a"], ["a"], ["a"]] and not keyed._budgets
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_only_fast_names_have_velocities(spark):
    df, order = frame(spark), ["TransactionID", "name"]
    full = temporal.key_timeline(df, ["card1", "addr1"], temporal.VELOCITY_WINDOWS).orderBy(*order).collect()
    some = temporal.key_timeline(df, ["card1", "addr1"], temporal.VELOCITY_WINDOWS, fast=["card1"]).orderBy(*order).collect()
    blank = dict.fromkeys([f"v_{w}" for w in temporal.VELOCITY_WINDOWS])
    assert [r.asDict() for r in some] == [r.asDict() if r["name"] == "card1" else {**r.asDict(), **blank} for r in full]


def test_a_build_reads_written_rows(spark):
    """What made the rows runs once, not once per statistic of the build."""
    df = frame(spark)
    own = "LogicalRDD" if "LogicalRDD" in df._jdf.queryExecution().optimizedPlan().toString() else "LocalRelation"
    builder = pipeline.FeatureBuilder()
    for out in (pipeline.build_features(df)[0], builder.fit_transform(df)):
        assert own not in out._jdf.queryExecution().optimizedPlan().toString()
        assert out.count() == df.count()


def test_look_ups_that_nobody_reads_are_not_run(spark):
    """One column of a build costs the look-ups it needs, whether keys are broadcast or take a detour."""
    df, rows, limit = frame(spark), [], spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for size, needed in ((limit, 1), ("1", 2)):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
            out = pipeline.FeatureBuilder().fit_transform(df)
            joins = [str(out.select("TransactionID", c)._jdf.queryExecution().optimizedPlan()).count("Join ") for c in ("amt_bin", "card1_mean")]
            assert joins == [0, needed]
            rows.append(collected(out.select(*[c for c in out.columns if c not in df.columns], "TransactionID")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    for c in rows[0].columns:
        same(list(rows[0][c]), list(rows[1][c]))


def test_rates_are_learnt_once_and_not_from_attached_features(spark, monkeypatch):
    df, read = frame(spark), []
    monkeypatch.setattr(interaction, "key_rows", lambda d, *a, own=interaction.key_rows: (read.append(set(d.columns)), own(d, *a))[1])
    encoder = interaction.RateEncoder({"k": ("card1", "ProductCD")})
    got = collected(encoder.fit_transform(df.withColumn("late", F.rand()), source=df).select("TransactionID", "k_count", "k_fraud_rate"))
    assert len(read) == 1 and "late" not in read[0]
    want = collected(interaction.combination_features(df, {"k": ("card1", "ProductCD")}, mode="out_of_fold")[0])
    again = interaction.RateEncoder({"k": ("card1", "ProductCD")}).fit(df)
    same(list(got.k_fraud_rate), list(want.k_fraud_rate))
    a, b = (collected(e.transform(df)) for e in (encoder, again))
    same(list(a.k_fraud_rate), list(b.k_fraud_rate))


def test_out_of_fold_rates_leave_out_the_fold(spark):
    """Against the definition: positives and rows of the other folds, missing labels left out."""
    df = frame(spark).withColumn("isFraud", F.when(F.col("TransactionID") % 5 != 0, F.col("isFraud")))
    out = interaction.combination_features(df, {"k": ("card1",)}, mode="out_of_fold")[0].withColumn("fold", interaction._fold_of("TransactionID", 5, 42))
    pdf = collected(out)
    overall = pdf.isFraud.mean()
    for _, own in pdf.groupby("k"):
        for _, r in own.iterrows():
            others = own[own.fold != r.fold].isFraud.dropna()
            assert r.k_count == len(own) and abs(r.k_fraud_rate - (others.sum() + 10 * overall) / (len(others) + 10)) < 1e-9
