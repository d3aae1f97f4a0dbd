"""Sources and sinks: transaction / identity scans, submission rows, their check, run metadata."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions.nulls import nan_to_null
from riskloom.operators.ordering import row_index

ID, LABEL = "TransactionID", "isFraud"

# Types of the known columns.
_LONG = ("TransactionID", "TransactionDT")
_INT = ("isFraud", "card1")
_TEXT = ("ProductCD", "card4", "card6", "P_emaildomain", "R_emaildomain", "DeviceType", "DeviceInfo",
         "id_12", "id_15", "id_16", "id_23", "id_27", "id_28", "id_29", "id_30", "id_31", "id_33", "id_34",
         "id_35", "id_36", "id_37", "id_38", "M1", "M2", "M3", "M4", "M5", "M6", "M7", "M8", "M9")


def column_type(name: str, found: T.DataType) -> T.DataType:
    """Type of a known column; of others the one found in the file, whole numbers as double."""
    if name in _LONG:
        return T.LongType()
    if name in _INT:
        return T.IntegerType()
    if name in _TEXT or not isinstance(found, T.NumericType):
        return T.StringType()
    return T.DoubleType()


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Scan a CSV with header. Without a schema one more scan of the file finds the types of its columns.

    A column outside the known ones is numeric only if all its values are. A value that does not fit the
    schema fails the job.
    """
    return nan_to_null(_csv(spark, path, schema))


def _csv(spark: SparkSession, path: str, schema: T.StructType | None) -> DataFrame:
    if schema is None:
        found = spark.read.option("header", True).option("inferSchema", True).option("preferDate", False).csv(path).schema
        schema = T.StructType([T.StructField(f.name, column_type(f.name, f.dataType)) for f in found])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV by file ending, otherwise Parquet (columns pruned, filters pushed down)."""
    if path.rstrip("/").endswith((".csv", ".csv.gz")):
        return read_csv(spark, path, schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return nan_to_null(reader.parquet(path))


def spread_over_cores(df: DataFrame, key: str) -> DataFrame:
    """Hash a scan with fewer splits than cores by ``key`` (few or unsplittable files); others stay as they are.

    A large table always has more splits than cores and is never shuffled here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def load_data(spark: SparkSession, transactions: str, identities: str, test_transactions: str | None = None,
              test_identities: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Left-join identity attributes to transactions, for the training and optionally the test tables."""
    train = with_identity(read_table(spark, transactions), read_table(spark, identities))
    if test_transactions is None or test_identities is None:
        return train, None
    return train, with_identity(read_table(spark, test_transactions), read_table(spark, test_identities))


def with_identity(transactions: DataFrame, identities: DataFrame) -> DataFrame:
    return transactions.join(identities, ID, "left")


# --- submission ------------------------------------------------------------------------------

def submission_rows(scores: DataFrame, score: str = "score", clip: bool = True) -> DataFrame:
    """(TransactionID, isFraud) with whole ids and scores clipped to [0, 1]; missing scores stay missing."""
    value = F.col(score).cast("double")
    if clip:
        value = F.when(value.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))
    return scores.select(F.col(ID).cast("long").alias(ID), value.alias(LABEL))


def write_submission(scores: DataFrame, path: str, score: str = "score", clip: bool = True) -> DataFrame:
    """Write the rows as CSV with header, in id order across the part files."""
    rows = submission_rows(scores, score, clip)
    rows.orderBy(ID).write.mode("overwrite").option("header", True).csv(path)
    return rows


def submission_check(submission: DataFrame, sample: DataFrame, position: str | None = None) -> DataFrame:
    """One row of checks: columns, counts, ids in the same order, range and missing values.

    ``position`` names a column that holds each row's place; without it, rows are compared in the
    order of their ids. Ids are matched by a full join on (position, id), never collected.
    """
    same_columns = [c for c in submission.columns if c != position] == [c for c in sample.columns if c != position]
    place = position or "_pos"
    left, right = submission, sample
    if position is None:
        left, right = row_index(submission, [ID], "_pos"), row_index(sample, [ID], "_pos")
    ours = left.select(F.col(place).alias("_p"), F.col(ID).alias("_i"), F.lit(1).alias("_a"))
    theirs = right.select(F.col(place).alias("_p"), F.col(ID).alias("_i"), F.lit(1).alias("_b"))
    unmatched = ours.join(theirs, ["_p", "_i"], "full").agg(
        F.count("_a").alias("n_rows"), F.count("_b").alias("n_expected"),
        F.count_if(F.col("_a").isNull() | F.col("_b").isNull()).alias("id_mismatches"))
    value = F.col(LABEL)
    cells = submission.agg(
        F.count_if((value < 0) | (value > 1)).alias("out_of_range"),
        F.count_if(value.isNull() | F.isnan(value) | F.col(ID).isNull()).alias("n_missing"))
    report = unmatched.select("*", *[cells.select(c).scalar().alias(c) for c in ("out_of_range", "n_missing")])
    valid = (F.lit(same_columns) & (F.col("n_rows") == F.col("n_expected")) & (F.col("id_mismatches") == 0)
             & (F.col("out_of_range") == 0) & (F.col("n_missing") == 0))
    return report.withColumn("same_columns", F.lit(int(same_columns))).withColumn("is_valid", valid.cast("int"))


def file_rows(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of CSV parts with headers, and ``file_pos``: each row's place in the parts read one after the other.

    Parts follow each other by name. A row's place comes from the part, the block of the part it was read in and its
    place in that block; all rows are numbered by these in one global order, and none is collected.
    """
    told = _csv(spark, path, schema).select("*", F.col("_metadata.file_path").alias("_part"), F.col("_metadata.file_block_start").alias("_block"),
                       F.monotonically_increasing_id().alias("_at"))
    return row_index(nan_to_null(told), ["_part", "_block", "_at"], "file_pos").drop("_part", "_block", "_at")


def submission_check_files(spark: SparkSession, submission: str, sample: str) -> DataFrame:
    """``submission_check`` of two CSV files or folders of parts, row by row in file order."""
    schema = T.StructType([T.StructField(ID, T.LongType()), T.StructField(LABEL, T.DoubleType())])
    columns = [spark.read.option("header", True).csv(p).columns for p in (submission, sample)]
    if columns[0] != columns[1] or columns[0] != schema.names:
        # Rows of files with other columns are compared by whatever they have of these two.
        ours, theirs = (_two_columns(spark.read.option("header", True).csv(p)) for p in (submission, sample))
        return submission_check(ours, theirs).withColumns({"same_columns": F.lit(0), "is_valid": F.lit(0)})
    return submission_check(file_rows(spark, submission, schema), file_rows(spark, sample, schema), "file_pos")


def _two_columns(df: DataFrame) -> DataFrame:
    kinds = {ID: "long", LABEL: "double"}
    return df.select(*[(F.col(c).try_cast(k) if c in df.columns else F.lit(None).cast(k)).alias(c) for c, k in kinds.items()])


def validate_submission(submission: DataFrame, sample: DataFrame, position: str | None = None) -> bool:
    return bool(submission_check(submission, sample, position).first()["is_valid"])


def prediction_stats(scores: DataFrame, score: str = "score") -> DataFrame:
    """Count, mean, population deviation and range of a score column, as one row."""
    return scores.agg(
        F.count(score).alias("count"), F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"),
        F.min(score).alias("min"), F.max(score).alias("max"))


def write_prediction_metadata(scores: DataFrame, models_info: dict, path: str, score: str = "score") -> DataFrame:
    """One JSON row: score statistics, model description as JSON text and a timestamp."""
    stats = prediction_stats(scores, score)
    row = stats.select(F.struct("*").alias("prediction_stats"), F.lit(json.dumps(models_info)).alias("models"),
                       F.current_timestamp().alias("timestamp"))
    row.write.mode("overwrite").json(path)
    return row


# --- small run settings ----------------------------------------------------------------------

def write_settings(spark: SparkSession, settings: dict, path: str) -> None:
    """Parameters, selected features or ensemble weights as one JSON text file next to a model."""
    spark.createDataFrame([(json.dumps(settings),)], "value string").write.mode("overwrite").text(path)


def read_settings(spark: SparkSession, path: str) -> dict:
    return json.loads("\n".join(r["value"] for r in spark.read.text(path).collect()))
