"""Missingness features, sources, sinks and the submission check."""

import json
import math
import os

import pytest
from pyspark.sql import functions as F

from riskloom import session
from riskloom.functions.stats import erfc
from riskloom.operators import missing, ordering, profiling, taxonomy
from riskloom.sources import tables
from tests.frames import collected, frame


def test_families_ignore_the_engines_own_columns(spark):
    df = spark.createDataFrame(
        [(1, None, None, "a"), (2, 1.0, None, None), (3, 2.0, 4.0, "b")], "TransactionID long, D1 double, D2 double, M1 string")
    got = collected(missing.create_missing_value_features(df)[0])
    assert list(got.D_all_missing) == [1, 0, 0]
    assert list(got.total_missing_count) == [2, 2, 0]
    assert list(got.total_missing_pct) == [0.5, 0.5, 0.0]
    assert list(got.M_none_missing) == [1, 0, 1]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0)], "TransactionID long, V1 double")
    assert list(collected(missing.create_group_missing_features(df)[0]).V_missing_count) == [1, 0]
    assert missing.missing_rates(df)["V1"] == 0.5


def test_cooccurrence_needs_two_columns(spark):
    df = spark.createDataFrame([(1, "x")], "TransactionID long, DeviceType string")
    assert missing.create_cooccurrence_features(df)[1] == []


def test_high_v_missing_needs_many_columns(spark):
    names = [f"V{i}" for i in range(60)]
    df = spark.createDataFrame([tuple([None] * 43 + [1.0] * 17), tuple([1.0] * 60)], ", ".join(f"{n} double" for n in names))
    out, made = missing.create_unusual_missing_patterns(df)
    assert "high_V_missing" in made
    assert sorted(r["high_V_missing"] for r in out.collect()) == [0, 1]


def test_csv_round_trip_keeps_types(spark, tmp_path):
    path = str(tmp_path / "tx.csv")
    df = frame(spark).select("TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "ProductCD", "card1", "P_emaildomain")
    df.write.option("header", True).csv(path)
    back = tables.read_table(spark, path)
    assert dict(back.dtypes)["TransactionAmt"] == "double" and dict(back.dtypes)["ProductCD"] == "string"
    assert back.exceptAll(df).count() == 0 and back.count() == 400


def test_load_data_joins_identities(spark, tmp_path):
    tx, ident = str(tmp_path / "tx"), str(tmp_path / "id")
    frame(spark).write.parquet(tx)
    frame(spark).where("TransactionID % 2 = 0").select("TransactionID", F.lit("mobile").alias("DeviceType")).write.parquet(ident)
    train, test = tables.load_data(spark, tx, ident)
    assert test is None and train.count() == 400
    assert 0 < train.where("DeviceType is not null").count() < 400


def test_submission_is_clipped_written_and_valid(spark, tmp_path):
    scores = spark.createDataFrame([(i, i / 5 - 0.5) for i in range(10)], "TransactionID long, score double")
    path = str(tmp_path / "submission.csv")
    tables.write_submission(scores, path)
    back = tables.read_csv(spark, path, "TransactionID long, isFraud double")
    values = [r["isFraud"] for r in back.orderBy("TransactionID").collect()]
    assert min(values) == 0.0 and max(values) == 1.0
    assert tables.validate_submission(back, tables.submission_rows(scores))


@pytest.mark.parametrize("change,column", [
    ("isFraud * 3", "out_of_range"), ("if(TransactionID = 4, null, isFraud)", "n_missing")])
def test_submission_faults_are_found(spark, change, column):
    good = spark.createDataFrame([(i, 0.5) for i in range(10)], "TransactionID long, isFraud double")
    bad = good.withColumn("isFraud", F.expr(change))
    row = tables.submission_check(bad, good).first()
    assert row["is_valid"] == 0 and row[column] > 0


def test_submission_with_other_ids_or_columns(spark):
    good = spark.createDataFrame([(i, 0.5) for i in range(10)], "TransactionID long, isFraud double")
    assert not tables.validate_submission(good.where("TransactionID < 9"), good)
    assert not tables.validate_submission(good.withColumn("TransactionID", F.col("TransactionID") + 1), good)
    assert not tables.validate_submission(good.withColumn("more", F.lit(1)), good)


def test_metadata_and_settings(spark, tmp_path):
    scores = spark.createDataFrame([(1, 0.25), (2, 0.75)], "TransactionID long, score double")
    tables.write_prediction_metadata(scores, {"folds": 5}, str(tmp_path / "meta"))
    row = spark.read.json(str(tmp_path / "meta")).first()
    assert row["prediction_stats"]["mean"] == 0.5 and json.loads(row["models"]) == {"folds": 5}
    tables.write_settings(spark, {"features": ["a"]}, str(tmp_path / "settings"))
    assert tables.read_settings(spark, str(tmp_path / "settings")) == {"features": ["a"]}


def test_column_families():
    assert taxonomy.families("DeviceType") == ["D_features", "device_features"]
    assert taxonomy.families("card1") == ["card_features"]
    assert taxonomy.families("TransactionAmt") == ["other_features"]


def test_histogram_covers_all_rows(spark):
    got = profiling.histogram(frame(spark), "TransactionAmt", 20).toPandas()
    assert got.n.sum() == 400 and got.bin.max() == 19


def test_correlation_of_a_constant_is_null(spark):
    df = spark.createDataFrame([(0, 1.0, 2.0), (1, 1.0, 4.0), (0, 1.0, 2.0)], "isFraud int, k double, x double")
    got = {r["feature"]: r["corr"] for r in profiling.correlation_with_label(df, ["k", "x"]).collect()}
    assert got["k"] is None and abs(got["x"] - 1.0) < 1e-12


def test_shared_folder_comes_from_the_session(spark):
    from riskloom.session import shared_folder

    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_intermediate_tables_leave_with_their_block(spark, tmp_path):
    def tables_there():
        folder = os.path.join(session.shared_folder(spark), "riskloom")
        return set(os.listdir(folder)) if os.path.isdir(folder) else set()

    rows = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, None)], "TransactionID long, x double")
    outer = session.written(rows)
    before = tables_there()
    with session.intermediates(spark):
        ordering.row_index(session.written(rows), ["TransactionID"]).write.parquet(str(tmp_path / "result"))
        with pytest.raises(ValueError), session.intermediates(spark):
            session.written(rows)
            inside = tables_there()
            raise ValueError
        assert before < tables_there() < inside
    assert tables_there() == before and outer.count() == 3
    assert spark.read.parquet(str(tmp_path / "result")).count() == 3


def test_csv_keeps_unknown_text_columns_and_fails_on_wrong_values(spark, tmp_path):
    from riskloom.sources.tables import read_csv

    path = tmp_path / "t.csv"
    path.write_text("TransactionID,Channel,id-12,D1\n1,web,a1,0.5\n2,shop,7,\n")
    rows = [tuple(r) for r in read_csv(spark, str(path)).orderBy("TransactionID").collect()]
    assert rows == [(1, "web", "a1", 0.5), (2, "shop", "7", None)]
    path.write_text("TransactionID,D1\nx,0.5\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        read_csv(spark, str(path)).collect()


def test_every_sparse_column_has_an_indicator_unless_limited(spark):
    from riskloom.operators import missing

    df = spark.createDataFrame([(i, *([None] * 60)) for i in range(4)], "TransactionID long, " + ", ".join(f"V{i} double" for i in range(60)))
    assert len(missing.create_basic_missing_indicators(df)[1]) == 62
    assert len(missing.create_basic_missing_indicators(df, limit=50)[1]) == 52


def test_files_are_compared_in_their_own_order(spark, tmp_path):
    """Parts of any number and blocks of any size; a swapped pair is found, shuffled parts of one order are not told apart."""
    rows = [(i * 7, i / 1000) for i in range(1000)]
    df = spark.createDataFrame(rows, "TransactionID long, isFraud double")
    swapped = spark.createDataFrame(rows[:500] + [rows[501], rows[500]] + rows[502:], df.schema)
    for name, frame_, parts in (("sample", df, 1), ("same", df, 7), ("swapped", swapped, 3)):
        frame_.coalesce(1).repartitionByRange(parts, F.monotonically_increasing_id()).sortWithinPartitions(
            F.monotonically_increasing_id()).write.option("header", True).csv(f"{tmp_path}/{name}")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        assert [tuple(r) for r in tables.file_rows(spark, f"{tmp_path}/sample", df.schema).orderBy("file_pos").collect()] == [
            (*r, n) for n, r in enumerate(rows)]
        same = tables.submission_check_files(spark, f"{tmp_path}/same", f"{tmp_path}/sample").first()
        other = tables.submission_check_files(spark, f"{tmp_path}/swapped", f"{tmp_path}/sample").first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert (same["is_valid"], same["id_mismatches"]) == (1, 0) and (other["is_valid"], other["id_mismatches"]) == (0, 4)
    df.withColumnRenamed("isFraud", "score").write.option("header", True).csv(f"{tmp_path}/named")
    named = tables.submission_check_files(spark, f"{tmp_path}/named", f"{tmp_path}/sample").first()
    assert (named["same_columns"], named["is_valid"], named["n_missing"]) == (0, 0, 1000)


def test_complementary_error_function(spark):
    x = [0.0, 1e-9, 0.3, 1.0, 2.4999, 2.5, 3.0, 5.0, 10.0, 26.0, 40.0, None]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in x], "x double").select(erfc(F.col("x"))).collect()]
    for v, g in zip(x, got):
        assert g is None if v is None else g == pytest.approx(math.erfc(v), rel=1e-11, abs=0)
