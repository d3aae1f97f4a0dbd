"""Queries over missingness, preprocessing, ordering, profiling, folds, selection, ensembles and evaluation."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.bins import labelled
from riskloom.operators import (
    ensemble, evaluation, folds, missing, ordering, preprocess, profiling, quantiles, selection, taxonomy,
)
from riskloom.plans import fixture
from riskloom.plans.registry import register
from riskloom.session import shared_folder
from riskloom.sources import tables

ID = "TransactionID:i"

# Column lists of the fixture, in schema order.
TXN_COLUMNS = ("TransactionID isFraud TransactionDT TransactionAmt ProductCD card1 card2 card3 card4 card5 card6 addr1 "
               "addr2 P_emaildomain R_emaildomain C1 C2 D1 D2 M1 M2 V1 V2 V3").split()
FULL_COLUMNS = [*TXN_COLUMNS, "DeviceType", "DeviceInfo", "id_30", "id_31", "id_33"]
NUMERIC = "TransactionDT TransactionAmt card1 card2 card3 card5 addr1 addr2 C1 C2 D1 D2 V1 V2 V3".split()
TEXT = "ProductCD card4 card6 P_emaildomain R_emaildomain M1 M2".split()


def _null_sum(cols) -> str:
    return "(" + " + ".join(f"CAST({c} IS NULL AS INT)" for c in cols) + ")"


# --- missingness -----------------------------------------------------------------------------



# Columns of the fixture that are empty in more than 5 % of the rows (true at every scale).
EMPTY_OFTEN = ("card2 card4 card5 card6 addr1 addr2 P_emaildomain R_emaildomain D1 D2 M1 M2 V3 DeviceType DeviceInfo "
               "id_30 id_31 id_33").split()
_GROUPS = {"V": ["V1", "V2", "V3"], "C": ["C1", "C2"], "D": ["D1", "D2", "DeviceType", "DeviceInfo"],
           "M": ["M1", "M2"], "id": ["id_30", "id_31", "id_33"]}
_CARDS = [f"card{i}" for i in range(1, 7)]

_N_ALL = len(FULL_COLUMNS)
_SQL_BASIC = ", ".join(
    [f"{_null_sum(FULL_COLUMNS)} AS total_missing_count", f"{_null_sum(FULL_COLUMNS)} / {_N_ALL}::DOUBLE AS total_missing_pct"]
    + [f"CAST({c} IS NULL AS INT) AS {c}_ismissing" for c in EMPTY_OFTEN])
_COL_BASIC = "total_missing_count:i total_missing_pct:d " + " ".join(f"{c}_ismissing:i" for c in EMPTY_OFTEN)
_SQL_GROUPS = ", ".join(
    f"{_null_sum(c)} AS {g}_missing_count, {_null_sum(c)} / {len(c)}::DOUBLE AS {g}_missing_pct, "
    f"CAST({_null_sum(c)} = {len(c)} AS INT) AS {g}_all_missing, CAST({_null_sum(c)} = 0 AS INT) AS {g}_none_missing"
    for g, c in _GROUPS.items())
_COL_GROUPS = " ".join(f"{g}_missing_count:i {g}_missing_pct:d {g}_all_missing:i {g}_none_missing:i" for g in _GROUPS)
_SQL_TOGETHER = ", ".join(
    f"CAST({_null_sum(c)} = {len(c)} AS INT) AS {g}_both_missing, CAST({_null_sum(c)} = 1 AS INT) AS {g}_one_missing, "
    f"CAST({_null_sum(c)} = 0 AS INT) AS {g}_all_present" for g, c in missing.TOGETHER.items())
_COL_TOGETHER = " ".join(f"{g}_both_missing:i {g}_one_missing:i {g}_all_present:i" for g in missing.TOGETHER)
_SQL_CARD = (f"{_null_sum(_CARDS)} AS card_missing_count, {_null_sum(_CARDS)} / 6::DOUBLE AS card_missing_pct, "
             + ", ".join(f"CAST({c} IS NULL AS INT) AS {c}_missing" for c in _CARDS))
_COL_CARD = "card_missing_count:i card_missing_pct:d " + " ".join(f"{c}_missing:i" for c in _CARDS)
_CRIT = "TransactionAmt ProductCD card1 card2".split()
_AVG_MISSING = f"(SELECT avg({_null_sum(FULL_COLUMNS)} / {_N_ALL}::DOUBLE) FROM ful)"
_SQL_UNUSUAL = (
    f"{_null_sum(_CRIT)} AS critical_missing_count, CAST({_null_sum(_CRIT)} > 0 AS INT) AS has_critical_missing, "
    "CAST(DeviceInfo IS NULL AND DeviceType IS NOT NULL AS INT) AS device_info_anomaly, "
    "CAST((P_emaildomain IS NULL) <> (R_emaildomain IS NULL) AS INT) AS email_mismatch_pattern, "
    "CAST((addr1 IS NULL) <> (addr2 IS NULL) AS INT) AS addr_mismatch_pattern, "
    f"CAST({_null_sum(FULL_COLUMNS)} / {_N_ALL}::DOUBLE > {_AVG_MISSING} * 1.5 AS INT) AS missing_above_avg, "
    f"CAST({_null_sum(FULL_COLUMNS)} / {_N_ALL}::DOUBLE < {_AVG_MISSING} * 0.5 AS INT) AS missing_below_avg")
_COL_UNUSUAL = ("critical_missing_count:i has_critical_missing:i device_info_anomaly:i email_mismatch_pattern:i "
                "addr_mismatch_pattern:i missing_above_avg:i missing_below_avg:i")
_SQL_VERSUS = (
    "avg(m) OVER (PARTITION BY ProductCD) AS ProductCD_avg_missing, m - avg(m) OVER (PARTITION BY ProductCD) AS "
    "missing_vs_product_avg, avg(m) OVER (PARTITION BY card1) AS card1_avg_missing, "
    "CASE WHEN P_emaildomain IS NOT NULL THEN avg(m) OVER (PARTITION BY P_emaildomain) END AS email_avg_missing")
_COL_VERSUS = "ProductCD_avg_missing:d missing_vs_product_avg:d card1_avg_missing:d email_avg_missing:d"
_FROM_M = f"FROM (SELECT *, {_null_sum(FULL_COLUMNS)} AS m FROM ful)"


def _missing_step(step):
    return lambda spark, sf: step(fixture.joined(spark, sf))[0]


register("missing_basic", f"{ID} {_COL_BASIC}", _missing_step(missing.create_basic_missing_indicators),
         f"SELECT TransactionID, {_SQL_BASIC} FROM ful")
register("missing_groups", f"{ID} {_COL_GROUPS}", _missing_step(missing.create_group_missing_features),
         f"SELECT TransactionID, {_SQL_GROUPS} FROM ful")
register("missing_cooccur", f"{ID} {_COL_TOGETHER}", _missing_step(missing.create_cooccurrence_features),
         f"SELECT TransactionID, {_SQL_TOGETHER} FROM ful")
register("missing_card", f"{ID} {_COL_CARD}", _missing_step(missing.create_card_missing_patterns),
         f"SELECT TransactionID, {_SQL_CARD} FROM ful")
register("missing_unusual", f"{ID} {_COL_UNUSUAL}",
         _missing_step(lambda d: missing.create_unusual_missing_patterns(missing.row_missing(d)[0])),
         f"SELECT TransactionID, {_SQL_UNUSUAL} FROM ful")
register("missing_vs_group", f"{ID} {_COL_VERSUS}",
         _missing_step(lambda d: missing.create_missing_interaction_features(missing.row_missing(d)[0])),
         f"SELECT TransactionID, {_SQL_VERSUS} {_FROM_M}")
register("missing_all", f"{ID} {_COL_BASIC} {_COL_GROUPS} {_COL_TOGETHER} {_COL_CARD} {_COL_UNUSUAL} {_COL_VERSUS}",
         _missing_step(missing.create_missing_value_features),
         f"SELECT TransactionID, {_SQL_BASIC}, {_SQL_GROUPS}, {_SQL_TOGETHER}, {_SQL_CARD}, {_SQL_UNUSUAL}, {_SQL_VERSUS} "
         f"{_FROM_M}")
register("null_counts", f"{ID} null_count:i null_percentage:d null_count_V:i null_count_C:i null_count_D:i null_count_M:i",
         lambda spark, sf: missing.null_counts(fixture.joined(spark, sf)),
         f"SELECT TransactionID, {_null_sum(FULL_COLUMNS)} AS null_count, {_null_sum(FULL_COLUMNS)} / {_N_ALL}::DOUBLE AS "
         "null_percentage, " + ", ".join(f"{_null_sum(_GROUPS[g])} AS null_count_{g}" for g in "VCDM") + " FROM ful")


# --- preprocessing ---------------------------------------------------------------------------

_HOUR = "CAST(floor((TransactionDT % 86400) / 3600) AS INT)"
_DAY = "CAST(floor(TransactionDT / 86400) AS BIGINT)"
_WEEK = "CAST(floor(TransactionDT / 604800) AS BIGINT)"
_DOW = f"({_DAY} % 7)"

register(
    "time_parts",
    f"{ID} DT_day_of_week:i DT_hour:i DT_day:i DT_week:i DT_is_weekend:i DT_is_night:i DT_is_morning:i DT_is_afternoon:i "
    "DT_is_evening:i",
    lambda spark, sf: preprocess.create_time_features(fixture.transactions(spark, sf)),
    f"""SELECT TransactionID, d AS DT_day_of_week, h AS DT_hour, {_DAY} AS DT_day, {_WEEK} AS DT_week,
  CAST(d >= 5 AS INT) AS DT_is_weekend, CAST(h < 6 AS INT) AS DT_is_night, CAST(h >= 6 AND h < 12 AS INT) AS DT_is_morning,
  CAST(h >= 12 AND h < 18 AS INT) AS DT_is_afternoon, CAST(h >= 18 AS INT) AS DT_is_evening
FROM (SELECT *, {_HOUR} AS h, {_DOW} AS d FROM txn)""")

_FILLED = "card2 card5 addr1 addr2 D1 D2 V3".split()
_TEXT_FILLED = "card4 card6 P_emaildomain R_emaildomain M1 M2".split()


def _imputed(strategy: str, text_strategy: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        df = fixture.transactions(spark, sf)
        return preprocess.Imputer(NUMERIC, TEXT, strategy, text_strategy).fit(df).transform(df)
    return run


register("impute_median", " ".join([ID, *[f"{c}:d" for c in _FILLED], *[f"{c}:s" for c in _TEXT_FILLED]]),
         _imputed("median", "missing"),
         "SELECT TransactionID, "
         + ", ".join(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM txn)) AS {c}" for c in _FILLED) + ", "
         + ", ".join(f"coalesce({c}, 'missing') AS {c}" for c in _TEXT_FILLED) + " FROM txn")
register("impute_mode", " ".join([ID, *[f"{c}:d" for c in _FILLED], *[f"{c}:s" for c in _TEXT_FILLED]]),
         _imputed("mean", "mode"),
         "SELECT TransactionID, " + ", ".join(f"coalesce({c}, (SELECT avg({c}) FROM txn)) AS {c}" for c in _FILLED) + ", "
         + ", ".join(f"coalesce({c}, (SELECT {c} FROM txn WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} "
                     f"LIMIT 1)) AS {c}" for c in _TEXT_FILLED) + " FROM txn")


def _label_encoded(spark: SparkSession, sf: str) -> DataFrame:
    df = fixture.transactions(spark, sf)
    # Fitted on the first 20 days only, so that later rows may hold unseen values.
    early = df.where(F.col("TransactionDT") < 20 * 86400)
    return preprocess.LabelEncoder([*TEXT, "card1", "card2"]).fit(early).transform(df)


def _sql_label(c: str) -> str:
    return f"""coalesce((SELECT code FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM
  (SELECT DISTINCT coalesce(CAST({c} AS VARCHAR), 'nan') AS v FROM early)) m
  WHERE m.v = coalesce(CAST(txn.{c} AS VARCHAR), 'nan')),
  (SELECT count(DISTINCT coalesce(CAST({c} AS VARCHAR), 'nan')) FROM early)) AS {c}"""


register("label_encode", " ".join([ID, *[f"{c}:i" for c in [*TEXT, "card1", "card2"]]]), _label_encoded,
         "WITH early AS (SELECT * FROM txn WHERE TransactionDT < 20 * 86400)\n--\nSELECT TransactionID, "
         + ", ".join(_sql_label(c) for c in [*TEXT, "card1", "card2"]) + " FROM txn")

_CARD4 = ("discover", "mastercard", "visa")


def _one_hot(spark: SparkSession, sf: str) -> DataFrame:
    df = fixture.transactions(spark, sf)
    return preprocess.OneHotEncoder(["card4"]).fit(df).transform(df)


register("one_hot", " ".join([ID, *[f"card4_{v}:i" for v in _CARD4]]), _one_hot,
         "SELECT TransactionID, " + ", ".join(f"CAST(coalesce(card4 = '{v}', false) AS INT) AS card4_{v}" for v in _CARD4)
         + " FROM txn")


def _one_hot_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Size of the sparse vector of card1 and the place it sets; values after the first 20 days may be unseen.

    Of a vector only what it holds is read, never a cell per value. With few values the flags say the same.
    """
    df = fixture.transactions(spark, sf)
    encoder = preprocess.OneHotEncoder(["card1"], max_values=50).fit(df.where(F.col("TransactionDT") < 20 * 86400))
    out = encoder.transform(df)
    if "card1" in encoder.wide:
        cells = F.unwrap_udt("card1_values")
        size, place = cells["size"], F.get(cells["indices"], F.lit(0))
    else:
        flags = F.array(*[F.col(f"card1_{v}") for v in encoder.values["card1"]])
        size, place = F.size(flags), F.nullif(F.array_position(flags, F.lit(1)), F.lit(0)) - 1
    return out.select("TransactionID", size.alias("n_values"), place.alias("place"))


register("one_hot_wide", f"{ID} n_values:i place:i", _one_hot_wide,
         "WITH codes AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS place FROM (SELECT DISTINCT CAST(card1 AS VARCHAR) AS v "
         "FROM txn WHERE TransactionDT < 20 * 86400 AND card1 IS NOT NULL))\n--\nSELECT TransactionID, (SELECT count(*) FROM codes) "
         "AS n_values, place FROM txn LEFT JOIN codes ON v = CAST(card1 AS VARCHAR)")

_SCALED = "TransactionAmt card2 C1 D1 V2".split()


def _scaled(spark: SparkSession, sf: str) -> DataFrame:
    df = fixture.transactions(spark, sf)
    return preprocess.StandardScaler(_SCALED).fit(df.where(F.col("TransactionDT") < 20 * 86400)).transform(df)


register("standard_scale", " ".join([ID, *[f"{c}:d" for c in _SCALED]]), _scaled,
         "WITH early AS (SELECT * FROM txn WHERE TransactionDT < 20 * 86400)\n--\nSELECT TransactionID, " + ", ".join(
             f"({c} - (SELECT avg({c}) FROM early)) / (SELECT CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END "
             f"FROM early) AS {c}" for c in _SCALED) + " FROM txn")


def _chain(spark: SparkSession, sf: str) -> DataFrame:
    """The late fifth of the rows, transformed with what the early part taught."""
    train, valid, _ = preprocess.quick_preprocess(fixture.transactions(spark, sf), fixture.identities(spark, sf))
    return valid


register(
    "preprocess_pipeline",
    f"{ID} isFraud:i TransactionDT:i TransactionAmt:d card2:d addr1:d D2:d ProductCD:i card4:i P_emaildomain:i M1:i "
    "DeviceInfo:i DT_hour:i DT_is_weekend:i",
    _chain,
    f"""WITH pos AS (SELECT *, row_number() OVER (ORDER BY TransactionDT, TransactionID) - 1 AS rp FROM ful),
early AS (SELECT * FROM pos WHERE rp < CAST(floor((SELECT count(*) FROM ful) * (1 - 0.2::DOUBLE)) AS BIGINT)),
late AS (SELECT * FROM pos WHERE rp >= CAST(floor((SELECT count(*) FROM ful) * (1 - 0.2::DOUBLE)) AS BIGINT))
--
SELECT TransactionID, isFraud, TransactionDT, TransactionAmt, """
    + ", ".join(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM early)) AS {c}" for c in ("card2", "addr1", "D2"))
    + ", " + ", ".join(
        f"""(SELECT code FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM
  (SELECT DISTINCT coalesce({c}, 'missing') AS v FROM early)) m WHERE m.v = coalesce(late.{c}, 'missing')) AS {c}"""
        for c in ("ProductCD", "card4", "P_emaildomain", "M1", "DeviceInfo"))
    + f", {_HOUR} AS DT_hour, CAST({_DOW} >= 5 AS INT) AS DT_is_weekend FROM late")

_CAST_COLUMNS = "TransactionID isFraud TransactionDT card1 TransactionAmt V1".split()
register("downcast_plan", "feature:s low:d high:d new_type:s",
         lambda spark, sf: preprocess.downcast_plan(fixture.transactions(spark, sf).select(*_CAST_COLUMNS)),
         "WITH r AS (" + " UNION ALL ".join(
             f"SELECT '{c}' AS feature, {str(c not in ('TransactionAmt', 'V1')).lower()} AS whole, "
             f"CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high FROM txn" for c in _CAST_COLUMNS)
         + """)
--
SELECT feature, low, high, CASE WHEN NOT whole THEN 'float' WHEN low > -128 AND high < 127 THEN 'tinyint'
  WHEN low > -32768 AND high < 32767 THEN 'smallint' WHEN low > -2147483648 AND high < 2147483647 THEN 'int'
  ELSE 'bigint' END AS new_type FROM r""")

_DECILES = ", ".join(f"quantile_cont(TransactionAmt, {i / 10})" for i in range(11))
_QBIN = ("CASE WHEN TransactionAmt = edges[1] THEN 0 ELSE len(list_filter(list_distinct(edges), lambda x: x < TransactionAmt)) "
         "- 1 END")

register(
    "amount_features",
    f"{ID} TransactionAmt_log:d TransactionAmt_decimal:d TransactionAmt_is_round:i TransactionAmt_bin:i",
    lambda spark, sf: preprocess.amount_features(fixture.transactions(spark, sf)),
    f"""WITH e AS (SELECT [{_DECILES}] AS edges FROM txn)
--
SELECT TransactionID, ln(1 + TransactionAmt) AS TransactionAmt_log, TransactionAmt - trunc(TransactionAmt) AS
  TransactionAmt_decimal, CAST(TransactionAmt = round_even(TransactionAmt, 0) AS INT) AS TransactionAmt_is_round,
  {_QBIN} AS TransactionAmt_bin
FROM txn, e""")

register(
    "qcut_bins", "bin:i n:i low:d high:d",
    lambda spark, sf: preprocess.quantile_bins(fixture.transactions(spark, sf), "TransactionAmt", "bin").groupBy("bin").agg(
        F.count("*").alias("n"), F.min("TransactionAmt").alias("low"), F.max("TransactionAmt").alias("high")),
    f"""WITH e AS (SELECT [{_DECILES}] AS edges FROM txn)
--
SELECT bin, count(*) AS n, min(TransactionAmt) AS low, max(TransactionAmt) AS high
FROM (SELECT TransactionAmt, {_QBIN} AS bin FROM txn, e) GROUP BY bin""")

register(
    "cut_bins", f"{ID} amt_band:s hour_open:s hour_closed:s",
    lambda spark, sf: fixture.transactions(spark, sf).select(
        "TransactionID", labelled(F.col("TransactionAmt"), (0, 20, 60, 200), ("a", "b", "c")).alias("amt_band"),
        labelled(profiling.time_part("hour"), (0, 6, 12, 18, 24), ("n", "m", "a", "e")).alias("hour_open"),
        labelled(profiling.time_part("hour"), (0, 6, 12, 18, 24), ("n", "m", "a", "e"), True).alias("hour_closed")),
    f"""SELECT TransactionID, CASE WHEN TransactionAmt <= 0 THEN NULL WHEN TransactionAmt <= 20 THEN 'a'
  WHEN TransactionAmt <= 60 THEN 'b' WHEN TransactionAmt <= 200 THEN 'c' END AS amt_band,
  CASE WHEN h = 0 THEN NULL WHEN h <= 6 THEN 'n' WHEN h <= 12 THEN 'm' WHEN h <= 18 THEN 'a' ELSE 'e' END AS hour_open,
  CASE WHEN h <= 6 THEN 'n' WHEN h <= 12 THEN 'm' WHEN h <= 18 THEN 'a' ELSE 'e' END AS hour_closed
FROM (SELECT *, {_HOUR} AS h FROM txn)""")

_COMMON = "('gmail.com', 'yahoo.com', 'hotmail.com', 'outlook.com', 'aol.com')"
register(
    "email_features", f"{ID} P_email_tld:s P_email_is_common:i R_email_tld:s R_email_is_common:i email_domains_match:i",
    lambda spark, sf: preprocess.email_features(fixture.transactions(spark, sf)),
    "SELECT TransactionID, " + ", ".join(
        f"string_split(coalesce({s}_emaildomain, 'unknown'), '.')[-1] AS {s}_email_tld, "
        f"CAST(coalesce({s}_emaildomain IN {_COMMON}, false) AS INT) AS {s}_email_is_common" for s in "PR")
    + ", CAST(coalesce(P_emaildomain = R_emaildomain, false) AS INT) AS email_domains_match FROM txn")

register(
    "device_features",
    f"{ID} DeviceInfo_device:s DeviceInfo_length:i DeviceInfo_has_SM:i DeviceInfo_has_Windows:i DeviceInfo_has_iOS:i",
    lambda spark, sf: preprocess.device_features(fixture.joined(spark, sf)),
    """SELECT TransactionID, string_split(coalesce(DeviceInfo, 'unknown'), ' ')[1] AS DeviceInfo_device,
  length(coalesce(DeviceInfo, '')) AS DeviceInfo_length,
  CAST(coalesce(DeviceInfo, '') ILIKE '%sm%' AS INT) AS DeviceInfo_has_SM,
  CAST(coalesce(DeviceInfo, '') ILIKE '%windows%' AS INT) AS DeviceInfo_has_Windows,
  CAST(coalesce(DeviceInfo, '') ILIKE '%ios%' AS INT) AS DeviceInfo_has_iOS FROM ful""")

register(
    "numeric_products", " ".join([ID, *[f"{c}:d" for c in preprocess.NUMERIC_PRODUCTS]]),
    lambda spark, sf: preprocess.product_columns(
        preprocess.create_time_features(fixture.transactions(spark, sf)).withColumn(
            "TransactionAmt_log", F.log1p("TransactionAmt")), preprocess.NUMERIC_PRODUCTS),
    f"""SELECT TransactionID, card1 * l AS card1_TransactionAmt_interaction, {_HOUR} * l AS hour_TransactionAmt_interaction,
  {_DOW} * l AS dayofweek_TransactionAmt_interaction, C1 * C2 AS C1_C2_interaction, D1 * D2 AS D1_D2_interaction
FROM (SELECT *, ln(1 + TransactionAmt) AS l FROM txn)""")

register(
    "addr_match", f"{ID} addr_match:i addr_combined:s",
    lambda spark, sf: preprocess.address_match(fixture.transactions(spark, sf)),
    """SELECT TransactionID, CAST(coalesce(addr1 = addr2, false) AS INT) AS addr_match,
  coalesce(CAST(addr1 AS VARCHAR), 'nan') || '_' || coalesce(CAST(addr2 AS VARCHAR), 'nan') AS addr_combined FROM txn""")


# --- order -----------------------------------------------------------------------------------

register(
    "row_index", "o_orderkey:i row_pos:i",
    lambda spark, sf: ordering.row_index(
        fixture.table(spark, sf, "orders").select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"]),
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_pos FROM orders")


def _split(spark: SparkSession, sf: str) -> DataFrame:
    train, test = ordering.time_split(fixture.table(spark, sf, "orders"), 0.2, "o_orderdate", "o_orderkey")
    return train.select("o_orderkey", F.lit("train").alias("part")).unionByName(
        test.select("o_orderkey", F.lit("test").alias("part")))


register(
    "time_split", "o_orderkey:i part:s", _split,
    """SELECT o_orderkey, CASE WHEN rn <= CAST(floor(n * (1 - 0.2::DOUBLE)) AS BIGINT) THEN 'train' ELSE 'test' END AS part
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn, count(*) OVER () AS n FROM orders)""")

register(
    "top_k", "feature:s importance:d",
    lambda spark, sf: ordering.top_k(fixture.importances(spark, sf), "importance", 20, "feature"),
    "SELECT * FROM imp ORDER BY importance DESC, feature LIMIT 20")

register(
    "avg_rank", f"{ID} amount_rank:d amount_rank_scaled:d",
    lambda spark, sf: ordering.average_rank(ordering.average_rank(
        fixture.transactions(spark, sf), "TransactionAmt", "amount_rank"), "TransactionAmt", "amount_rank_scaled", True),
    """SELECT TransactionID, r AS amount_rank, r / count(*) OVER () AS amount_rank_scaled FROM (SELECT TransactionID,
  rank() OVER (ORDER BY TransactionAmt) + (count(*) OVER (PARTITION BY TransactionAmt) - 1) / 2.0::DOUBLE AS r FROM txn)""")

register(
    "peak_hour", "max_at:i max_score:d min_at:i min_score:d",
    lambda spark, sf: ordering.peak(profiling.rate_by_part(fixture.transactions(spark, sf), "hour"), "hour", "fraud_rate"),
    f"""WITH r AS (SELECT {_HOUR} AS hour, avg(isFraud) * 100 AS rate FROM txn GROUP BY 1)
--
SELECT (SELECT hour FROM r ORDER BY rate DESC, hour LIMIT 1) AS max_at, max(rate) AS max_score,
  (SELECT hour FROM r ORDER BY rate, hour LIMIT 1) AS min_at, min(rate) AS min_score FROM r""")

_HASH = "CAST(concat('0x', substr(md5(concat(CAST({0} AS VARCHAR), ':{1}')), 1, 8)) AS BIGINT)"

register(
    "hash_sample", f"{ID} TransactionAmt:d",
    lambda spark, sf: ordering.hash_sample(fixture.transactions(spark, sf), "TransactionID", 500, seed=42),
    f"SELECT TransactionID, TransactionAmt FROM txn ORDER BY {_HASH.format('TransactionID', 42)}, TransactionID LIMIT 500")

register(
    "score_cdf", "p2:d n_rows:i cdf:d",
    lambda spark, sf: ordering.empirical_cdf(fixture.scores(spark, sf), "p2"),
    """SELECT p2, n AS n_rows, sum(n) OVER (ORDER BY p2) / sum(n) OVER () AS cdf
FROM (SELECT p2, count(*) AS n FROM sco GROUP BY p2)""")

register(
    "group_quantiles", "card1:i p10:d p50:d p90:d",
    lambda spark, sf: quantiles.exact_quantiles(
        fixture.transactions(spark, sf), ["card1"], "TransactionAmt", {"p10": 0.1, "p50": 0.5, "p90": 0.9}),
    """SELECT card1, quantile_cont(TransactionAmt, 0.1) AS p10, quantile_cont(TransactionAmt, 0.5) AS p50,
  quantile_cont(TransactionAmt, 0.9) AS p90 FROM txn GROUP BY card1""")


# --- sinks -----------------------------------------------------------------------------------

def _raw_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores that leave [0, 1] on both sides."""
    return fixture.scores(spark, sf).select("TransactionID", (F.col("p1") * 1.5 - 0.2).alias("score"))


register("submission_rows", f"{ID} isFraud:d", lambda spark, sf: tables.submission_rows(_raw_scores(spark, sf)),
         "SELECT TransactionID, greatest(0.0, least(1.0, p1 * 1.5 - 0.2::DOUBLE)) AS isFraud FROM sco")


def _submission_check(spark: SparkSession, sf: str) -> DataFrame:
    """A submission with some ids swapped and scores out of range, against the right one."""
    sample = fixture.scores(spark, sf).select("TransactionID", F.col("p1").alias("isFraud")).withColumn(
        "place", F.col("TransactionID"))
    i = F.col("TransactionID")
    broken = sample.select(
        F.when(i % 100 == 7, i + 1).when(i % 100 == 8, i - 1).otherwise(i).alias("TransactionID"),
        F.when(i % 50 == 3, F.lit(1.5)).when(i % 50 == 4, F.lit(None)).otherwise(F.col("isFraud")).alias("isFraud"), "place")
    return tables.submission_check(broken, sample, "place")


register(
    "submission_check", "n_rows:i n_expected:i id_mismatches:i out_of_range:i n_missing:i same_columns:i is_valid:i",
    _submission_check,
    """WITH b AS (SELECT TransactionID AS place, CASE WHEN TransactionID % 100 = 7 THEN TransactionID + 1
    WHEN TransactionID % 100 = 8 THEN TransactionID - 1 ELSE TransactionID END AS id,
  CASE WHEN TransactionID % 50 = 3 THEN 1.5 WHEN TransactionID % 50 = 4 THEN NULL ELSE p1 END AS v FROM sco)
--
SELECT count(*) AS n_rows, (SELECT count(*) FROM sco) AS n_expected,
  2 * count(*) FILTER (WHERE id <> place) AS id_mismatches, count(*) FILTER (WHERE v < 0 OR v > 1) AS out_of_range,
  count(*) FILTER (WHERE v IS NULL) AS n_missing, 1 AS same_columns, 0 AS is_valid FROM b""")

def _files_check(spark: SparkSession, sf: str) -> DataFrame:
    """The same through CSV parts: ids and scores of some neighbouring rows change places, which no order by id shows."""
    sample = fixture.scores(spark, sf).select("TransactionID", F.col("p1").alias("isFraud"))
    i = F.col("TransactionID")
    place = F.when(i % 100 == 7, i + 1).when(i % 100 == 8, i - 1).otherwise(i)
    folder = os.path.join(shared_folder(spark), "csv", uuid.uuid4().hex)
    for name, order, parts in (("sample", i, 3), ("submission", place, 5)):
        sample.repartitionByRange(parts, order).sortWithinPartitions(order).write.option("header", True).csv(f"{folder}/{name}")
    return tables.submission_check_files(spark, f"{folder}/submission", f"{folder}/sample")


register(
    "submission_check_files", "n_rows:i n_expected:i id_mismatches:i out_of_range:i n_missing:i same_columns:i is_valid:i", _files_check,
    """SELECT count(*) AS n_rows, count(*) AS n_expected, 4 * count(*) FILTER (WHERE TransactionID % 100 = 7 AND TransactionID + 1 IN
  (SELECT TransactionID FROM sco)) AS id_mismatches, 0 AS out_of_range, 0 AS n_missing, 1 AS same_columns, 0 AS is_valid FROM sco""")


def _csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Transactions and identities written as CSV, and read back and merged by ``load_data``, types found in the files."""
    folder = os.path.join(shared_folder(spark), "csv", uuid.uuid4().hex)
    paths = [f"{folder}/{name}.csv" for name in ("transactions", "identities")]
    for df, path in zip((fixture.transactions(spark, sf), fixture.identities(spark, sf)), paths):
        df.write.option("header", True).csv(path)
    return tables.load_data(spark, *paths)[0]


register("scan_csv", " ".join(f"{c}:{'i' if c in tables._LONG + tables._INT else 's' if c in tables._TEXT else 'd'}" for c in FULL_COLUMNS),
         _csv_scan, "SELECT * FROM ful")


def _settings(spark: SparkSession, sf: str) -> DataFrame:
    """Columns with a high missing rate, found, written as settings, read back, and applied to every row."""
    df = fixture.joined(spark, sf)
    path = os.path.join(shared_folder(spark), "settings", uuid.uuid4().hex)
    tables.write_settings(spark, {"dropped": selection.remove_missing_features(df, 0.3), "rate": 0.3, "kind": "missing"}, path)
    told = tables.read_settings(spark, path)
    present = [F.col(c).isNotNull().cast("int") for c in told["dropped"]]
    return df.select("TransactionID", F.lit(told["rate"]).alias("rate"), F.lit(told["kind"]).alias("kind"),
                     F.lit(len(told["dropped"])).alias("n_dropped"), sum(present, F.lit(0)).alias("present"))


_RATED = [c for c in FULL_COLUMNS if c != "TransactionID"]
register(
    "settings_round_trip", f"{ID} rate:d kind:s n_dropped:i present:i", _settings,
    "WITH r AS (SELECT c FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS c, avg(CAST({c} IS NULL AS INT)) AS rate FROM ful" for c in _RATED) + ") WHERE rate > 0.3)\n--\n"
    "SELECT TransactionID, 0.3 AS rate, 'missing' AS kind, (SELECT count(*) FROM r) AS n_dropped, " + " + ".join(
        f"CASE WHEN {c} IS NOT NULL AND '{c}' IN (SELECT c FROM r) THEN 1 ELSE 0 END" for c in _RATED) + " AS present FROM ful")


def _aligned(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of two frames with the features that both have, in the order asked for, and how many were asked for in vain."""
    df = fixture.joined(spark, sf)
    train, test = df.drop("V3", "id_33"), df.drop("C2")
    usable, absent = selection.align_features(["id_33", "V1", "C2", "C1", "TransactionAmt", "V3", "D9"], train, test)
    odd = F.col("TransactionID") % 2 == 1
    rows = train.where(odd).select("TransactionID", *usable).unionByName(test.where(~odd).select("TransactionID", *usable))
    return rows.select("TransactionID", F.lit(" ".join(usable)).alias("usable"), F.lit(len(absent)).alias("n_absent"), *usable)


register("aligned_features", f"{ID} usable:s n_absent:i V1:d C1:d TransactionAmt:d", _aligned,
         "SELECT TransactionID, 'V1 C1 TransactionAmt' AS usable, 4 AS n_absent, V1, C1, TransactionAmt FROM ful")

register("prediction_stats", "count:i mean:d std:d min:d max:d",
         lambda spark, sf: tables.prediction_stats(fixture.scores(spark, sf), "p2"),
         'SELECT count(p2) AS "count", avg(p2) AS mean, stddev_pop(p2) AS std, min(p2) AS "min", max(p2) AS "max" FROM sco')


# --- profiling -------------------------------------------------------------------------------

register("feature_taxonomy", "feature:s category:s present:i",
         lambda spark, sf: taxonomy.feature_taxonomy(fixture.joined(spark, sf)),
         " UNION ALL ".join(f"SELECT '{c}' AS feature, '{f}' AS category, count({c}) AS present FROM ful"
                            for c, f in [
             ("TransactionDT", "other_features"), ("TransactionAmt", "other_features"), ("ProductCD", "other_features"),
             *[(f"card{i}", "card_features") for i in range(1, 7)], ("addr1", "addr_features"), ("addr2", "addr_features"),
             ("P_emaildomain", "email_features"), ("R_emaildomain", "email_features"), ("C1", "C_features"),
             ("C2", "C_features"), ("D1", "D_features"), ("D2", "D_features"), ("M1", "M_features"), ("M2", "M_features"),
             ("V1", "V_features"), ("V2", "V_features"), ("V3", "V_features"), ("DeviceType", "D_features"),
             ("DeviceType", "device_features"), ("DeviceInfo", "D_features"), ("DeviceInfo", "device_features"),
             ("id_30", "id_features"), ("id_31", "id_features"), ("id_33", "id_features")]))

register(
    "coverage",
    "n_transactions:i n_identities:i n_matched:i transaction_columns:i identity_columns:i coverage_pct:d",
    lambda spark, sf: profiling.coverage(fixture.transactions(spark, sf), fixture.identities(spark, sf)),
    """SELECT (SELECT count(*) FROM txn) AS n_transactions, (SELECT count(*) FROM idt) AS n_identities,
  (SELECT count(*) FROM txn SEMI JOIN idt USING (TransactionID)) AS n_matched, 24 AS transaction_columns,
  6 AS identity_columns, 100.0 * (SELECT count(*) FROM idt) / (SELECT count(*) FROM txn) AS coverage_pct""")

register("class_balance", "isFraud:i n:i pct:d others_per_row:d",
         lambda spark, sf: profiling.class_balance(fixture.transactions(spark, sf)),
         """SELECT isFraud, n, 100.0 * n / sum(n) OVER () AS pct, (sum(n) OVER () - n) / n::DOUBLE AS others_per_row
FROM (SELECT isFraud, count(*) AS n FROM txn GROUP BY 1)""")

register("dtype_counts", "kind:s n_columns:i n_cells:i",
         lambda spark, sf: profiling.dtype_counts(fixture.joined(spark, sf)),
         f"""SELECT 'number' AS kind, {2 + len(NUMERIC)} AS n_columns,
  {' + '.join(f'count({c})' for c in ['TransactionID', 'isFraud', *NUMERIC])} AS n_cells FROM ful
UNION ALL SELECT 'text', {len(TEXT) + 5},
  {' + '.join(f'count({c})' for c in [*TEXT, 'DeviceType', 'DeviceInfo', 'id_30', 'id_31', 'id_33'])} FROM ful""")

_FAMILY = """CASE WHEN feature LIKE 'V%' THEN 'V_features' WHEN feature LIKE 'C%' THEN 'C_features'
  WHEN feature LIKE 'D%' THEN 'D_features' WHEN feature LIKE 'M%' THEN 'M_features'
  WHEN feature LIKE 'card%' THEN 'card_features' WHEN feature LIKE 'id%' THEN 'id_features'
  WHEN lower(feature) LIKE '%device%' THEN 'device_features' WHEN lower(feature) LIKE '%email%' THEN 'email_features'
  ELSE 'other' END"""
_MISSING_CTE = "mr AS (SELECT *, {0} AS category, 100.0 * missing_count / n_rows AS missing_pct FROM ({1}))".format(
    _FAMILY, " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) - count({c}) AS missing_count, count(*) AS n_rows FROM ful" for c in FULL_COLUMNS))

register(
    "missing_report", "feature:s missing_count:i missing_pct:d category:s severity:s",
    lambda spark, sf: profiling.missing_report(fixture.joined(spark, sf)),
    f"""WITH {_MISSING_CTE}
--
SELECT feature, missing_count, missing_pct, category, CASE WHEN missing_pct <= 0 THEN NULL
  WHEN missing_pct <= 10 THEN '<10% (Low)' WHEN missing_pct <= 30 THEN '10-30% (Medium)'
  WHEN missing_pct <= 50 THEN '30-50% (High)' WHEN missing_pct <= 70 THEN '50-70% (Very High)'
  ELSE '>70% (Critical)' END AS severity FROM mr""")

register(
    "missing_overview",
    "columns_with_missing:i n_columns:i missing_cells:i overall_pct:d above_50:i above_80:i",
    lambda spark, sf: profiling.missing_overview(profiling.missing_report(fixture.joined(spark, sf))),
    f"""WITH {_MISSING_CTE}
--
SELECT count(*) FILTER (WHERE missing_count > 0) AS columns_with_missing, count(*) AS n_columns,
  sum(missing_count) AS missing_cells, 100.0 * sum(missing_count) / sum(n_rows) AS overall_pct,
  count(*) FILTER (WHERE missing_pct > 50) AS above_50, count(*) FILTER (WHERE missing_pct > 80) AS above_80 FROM mr""")

register(
    "missing_group_summary", "category:s n_features:i avg_pct:d min_pct:d max_pct:d above_50:i",
    lambda spark, sf: profiling.missing_group_summary(profiling.missing_report(fixture.joined(spark, sf))),
    f"""WITH {_MISSING_CTE}
--
SELECT category, count(*) AS n_features, avg(missing_pct) AS avg_pct, min(missing_pct) AS min_pct,
  max(missing_pct) AS max_pct, count(*) FILTER (WHERE missing_pct > 50) AS above_50 FROM mr GROUP BY category""")


def _describe_sql(by: str = "") -> str:
    keys = f", {by}" if by else ""
    group = f" WHERE {{0}} IS NOT NULL GROUP BY {by}" if by else " WHERE {0} IS NOT NULL"
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature{keys}, count({c}) AS n, avg({c}) AS mean, stddev_samp({c}) AS std, min({c})::DOUBLE AS low, "
        f"max({c})::DOUBLE AS high, quantile_cont({c}::DOUBLE, 0.25) AS q25, quantile_cont({c}::DOUBLE, 0.5) AS q50, "
        f"quantile_cont({c}::DOUBLE, 0.75) AS q75 FROM txn{group.format(c)}" for c in NUMERIC)


register("describe", "feature:s n:i mean:d std:d low:d q25:d q50:d q75:d high:d",
         lambda spark, sf: profiling.describe(fixture.transactions(spark, sf), NUMERIC), _describe_sql())
register("describe_by_label", "feature:s isFraud:i n:i mean:d std:d low:d q25:d q50:d q75:d high:d",
         lambda spark, sf: profiling.describe(fixture.transactions(spark, sf), NUMERIC, by="isFraud"),
         _describe_sql("isFraud"))

_CARD_COLUMNS = [c for c in FULL_COLUMNS if c not in ("TransactionID", "isFraud", "TransactionDT", "TransactionAmt")]
_CARDINALITY_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS n_unique, 100.0 * (count(*) - count({c})) / count(*) AS missing_pct "
    "FROM ful" for c in _CARD_COLUMNS)

register(
    "cardinality", "feature:s n_unique:i missing_pct:d cardinality:s",
    lambda spark, sf: profiling.cardinality(fixture.joined(spark, sf), _CARD_COLUMNS),
    f"""SELECT *, CASE WHEN n_unique <= 5 THEN 'Very Low (≤5)' WHEN n_unique <= 20 THEN 'Low (6-20)'
  WHEN n_unique <= 50 THEN 'Medium (21-50)' WHEN n_unique <= 100 THEN 'High (51-100)' END AS cardinality
FROM ({_CARDINALITY_SQL})""")

register(
    "value_counts", "feature:s value:s n:i pct:d place:i",
    lambda spark, sf: profiling.value_counts(
        fixture.transactions(spark, sf), ["ProductCD", "card4", "card6", "P_emaildomain", "R_emaildomain"]),
    "WITH f AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS value, count(*) AS n FROM txn WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in ("ProductCD", "card4", "card6", "P_emaildomain", "R_emaildomain")) + """)
--
SELECT *, 100.0 * n / (SELECT count(*) FROM txn) AS pct FROM (SELECT *, row_number() OVER (PARTITION BY feature
  ORDER BY n DESC, value) AS place FROM f) WHERE place <= 10""")

_CORR_COLUMNS = "TransactionAmt card1 card2 card3 card5 addr1 addr2 C1 C2 D1 D2 V1 V2 V3".split()
register(
    "corr_with_label", "feature:s corr:d abs_corr:d",
    lambda spark, sf: profiling.correlation_with_label(fixture.transactions(spark, sf), _CORR_COLUMNS, top=20),
    "SELECT feature, CASE WHEN isnan(r) THEN NULL ELSE r END AS corr, CASE WHEN isnan(r) THEN NULL ELSE abs(r) END AS abs_corr "
    "FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CASE WHEN min(isFraud) FILTER (WHERE {c} IS NOT NULL) = max(isFraud) FILTER "
        f"(WHERE {c} IS NOT NULL) OR min({c}) = max({c}) THEN NULL ELSE corr({c}, isFraud) END AS r FROM txn"
        for c in _CORR_COLUMNS) + ")")

_TEST_COLUMNS = ["TransactionAmt", "card1", "C1", "D1"]
# The p value is told by Simpson's rule over the normal density from z to 12 beyond it.
register(
    "mann_whitney", "feature:s n1:i n0:i u:d z:d p_value:d",
    lambda spark, sf: profiling.rank_sum_test(fixture.transactions(spark, sf), _TEST_COLUMNS),
    "WITH l AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, isFraud AS y FROM txn WHERE {c} IS NOT NULL"
        for c in _TEST_COLUMNS) + """),
r AS (SELECT feature, y, rank() OVER (PARTITION BY feature ORDER BY v) + (count(*) OVER (PARTITION BY feature, v) - 1) / 2.0 AS
  rk FROM l),
t AS (SELECT feature, sum(n * n * n - n) AS ties FROM (SELECT feature, CAST(count(*) AS DOUBLE) AS n FROM l
  GROUP BY feature, v) GROUP BY feature),
s AS (SELECT feature, CAST(sum(y) AS DOUBLE) AS n1, CAST(sum(1 - y) AS DOUBLE) AS n0, CAST(sum(rk * y) AS DOUBLE) AS rs FROM r
  GROUP BY feature),
w AS (SELECT s.*, ties, rs - n1 * (n1 + 1) / 2 AS u, n1 + n0 AS n FROM s JOIN t USING (feature)),
z AS (SELECT feature, n1, n0, u, (greatest(u, n1 * n0 - u) - n1 * n0 / 2 - 0.5) /
  sqrt(n1 * n0 / 12 * (n + 1 - ties / (n * (n - 1)))) AS z FROM w),
p AS (SELECT feature, sum((CASE WHEN k IN (0, 12000) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END) * exp(-(z + k / 1000.0::DOUBLE) * (z + k / 1000.0::DOUBLE) / 2))
  / 3000 * sqrt(2 / pi()) AS tail FROM z, range(0, 12001) r(k) GROUP BY feature)
--
SELECT feature, n1, n0, u, z, least(1.0, tail) AS p_value FROM z JOIN p USING (feature)""")

register(
    "group_summary", "feature:s isFraud:i mean:d median:d std:d",
    lambda spark, sf: profiling.group_summary(fixture.transactions(spark, sf), _TEST_COLUMNS),
    " UNION ALL ".join(
        f"SELECT '{c}' AS feature, isFraud, avg({c}) AS mean, quantile_cont({c}::DOUBLE, 0.5) AS median, stddev_samp({c}) AS std "
        "FROM txn GROUP BY isFraud" for c in _TEST_COLUMNS))

register(
    "histogram", "isFraud:i bin:i left_edge:d n:i",
    lambda spark, sf: profiling.histogram(fixture.transactions(spark, sf), "TransactionAmt", 100, by="isFraud"),
    """WITH b AS (SELECT min(TransactionAmt) AS lo, (max(TransactionAmt) - min(TransactionAmt)) / 100 AS w FROM txn)
--
SELECT isFraud, bin, any_value(lo) + bin * any_value(w) AS left_edge, count(*) AS n FROM (SELECT isFraud, lo, w,
  least(CAST(floor((TransactionAmt - lo) / w) AS INT), 99) AS bin FROM txn, b) GROUP BY isFraud, bin""")

_PART_SQL = {
    "week": _WEEK, "hour": _HOUR, "dow": _DOW,
    "daypart": f"CASE WHEN {_HOUR} <= 6 THEN 'Night' WHEN {_HOUR} <= 12 THEN 'Morning' WHEN {_HOUR} <= 18 THEN 'Afternoon' "
               "ELSE 'Evening' END",
}
_RATES = "sum(isFraud) AS fraud_count, count(isFraud) AS total_count, avg(isFraud) * 100 AS fraud_rate"
for _part in ("week", "hour", "daypart"):
    register(f"rate_by_{_part}", f"{_part}:{'s' if _part == 'daypart' else 'i'} fraud_count:i total_count:i fraud_rate:d",
             lambda spark, sf, _p=_part: profiling.rate_by_part(fixture.transactions(spark, sf), _p),
             f"SELECT {_PART_SQL[_part]} AS {_part}, {_RATES} FROM txn GROUP BY 1")
register("rate_by_dow", "dow:i day_name:s fraud_count:i total_count:i fraud_rate:d",
         lambda spark, sf: profiling.rate_by_part(fixture.transactions(spark, sf), "dow"),
         f"""SELECT *, ['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'][CAST(dow AS INT) + 1] AS day_name FROM
(SELECT {_DOW} AS dow, {_RATES} FROM txn GROUP BY 1)""")
register("weekly_rate_ma", "week:i fraud_rate:d fraud_rate_ma:d",
         lambda spark, sf: profiling.weekly_rate_trend(fixture.transactions(spark, sf)),
         f"""SELECT week, fraud_rate, CASE WHEN count(*) OVER w = 5 THEN avg(fraud_rate) OVER w END AS fraud_rate_ma FROM
(SELECT {_WEEK} AS week, {_RATES} FROM txn GROUP BY 1) WINDOW w AS (ORDER BY week ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)""")
register("weekly_rate_summary", "n_weeks:i min_rate:d max_rate:d std_rate:d",
         lambda spark, sf: profiling.weekly_rate_summary(fixture.transactions(spark, sf)),
         f"""SELECT count(*) AS n_weeks, min(fraud_rate) AS min_rate, max(fraud_rate) AS max_rate,
  stddev_samp(fraud_rate) AS std_rate FROM (SELECT {_WEEK} AS week, {_RATES} FROM txn GROUP BY 1)""")
register("rate_heatmap", " ".join(["hour:i", *[f"r{d}:d" for d in range(7)], *[f"n{d}:i" for d in range(7)]]),
         lambda spark, sf: profiling.rate_heatmap(fixture.transactions(spark, sf)),
         f"SELECT {_HOUR} AS hour, " + ", ".join(
             f"avg(isFraud) FILTER (WHERE {_DOW} = {d}) * 100 AS r{d}, count(*) FILTER (WHERE {_DOW} = {d}) AS n{d}"
             for d in range(7)) + " FROM txn GROUP BY 1")
register("rate_by_flag", "feature:s value:i n:i rate:d",
         lambda spark, sf: profiling.rate_by_flag(
             missing.create_card_missing_patterns(fixture.transactions(spark, sf))[0], ["card2_missing", "card5_missing"]),
         " UNION ALL ".join(f"SELECT '{c}_missing' AS feature, CAST({c} IS NULL AS INT) AS value, count(*) AS n, "
                            f"avg(isFraud) AS rate FROM txn GROUP BY 2" for c in ("card2", "card5")))
register("missing_by_label", "isFraud:i bin:i left_edge:d n:i",
         lambda spark, sf: profiling.histogram(
             missing.row_missing(fixture.joined(spark, sf))[0], "total_missing_count", 29, by="isFraud", low=0, high=29),
         f"""SELECT isFraud, bin, bin AS left_edge, count(*) AS n FROM (SELECT isFraud, least(m, 28) AS bin {_FROM_M})
GROUP BY isFraud, bin""")

for _part in ("week", "hour", "dow"):
    register(f"amount_by_{_part}", f"{_part}:i mean_amt:d median_amt:d std_amt:d",
             lambda spark, sf, _p=_part: profiling.amount_by(fixture.transactions(spark, sf), _p),
             f"SELECT {_PART_SQL[_part]} AS {_part}, avg(TransactionAmt) AS mean_amt, quantile_cont(TransactionAmt, 0.5) AS "
             "median_amt, stddev_samp(TransactionAmt) AS std_amt FROM txn GROUP BY 1")
register("amount_by_week_label", "week:i isFraud:i mean_amt:d median_amt:d std_amt:d",
         lambda spark, sf: profiling.amount_by(fixture.transactions(spark, sf), "week", by_label=True),
         f"SELECT {_WEEK} AS week, isFraud, avg(TransactionAmt) AS mean_amt, quantile_cont(TransactionAmt, 0.5) AS median_amt, "
         "stddev_samp(TransactionAmt) AS std_amt FROM txn GROUP BY 1, 2")

_LATE = 20 * 86400


def _parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    df = fixture.transactions(spark, sf)
    return df.where(F.col("TransactionDT") < _LATE), df.where(F.col("TransactionDT") >= _LATE)


register(
    "time_span", "train_start:i train_end:i test_start:i test_end:i train_range:i test_range:i gap:i overlaps:i",
    lambda spark, sf: profiling.time_span(*_parts(spark, sf)),
    f"""SELECT *, train_end - train_start AS train_range, test_end - test_start AS test_range, test_start - train_end AS gap,
  CAST(test_start < train_end AS INT) AS overlaps FROM (SELECT min(TransactionDT) FILTER (WHERE TransactionDT < {_LATE}) AS
  train_start, max(TransactionDT) FILTER (WHERE TransactionDT < {_LATE}) AS train_end, min(TransactionDT) FILTER
  (WHERE TransactionDT >= {_LATE}) AS test_start, max(TransactionDT) AS test_end FROM txn)""")

# --- importance tables -----------------------------------------------------------------------


def _named(spark: SparkSession, sf: str) -> DataFrame:
    """Importances whose names start like real feature families."""
    heads = F.array(*[F.lit(h) for h in ("V", "C", "D", "M", "card", "DT_", "id_", "P_email", "x_device", "dist")])
    return fixture.table(spark, sf, "part").select(
        F.concat(F.element_at(heads, (F.col("p_partkey") % 10 + 1).cast("int")), F.col("p_partkey").cast("string")).alias("feature"),
        F.col("p_retailprice").alias("importance"))


_NAMED = """nam AS (SELECT ['V', 'C', 'D', 'M', 'card', 'DT_', 'id_', 'P_email', 'x_device', 'dist'][CAST(p_partkey % 10 + 1 AS
  INT)] || CAST(p_partkey AS VARCHAR) AS feature, p_retailprice AS importance FROM part),
fam AS (SELECT *, CASE p_group WHEN 0 THEN 'V_features' WHEN 1 THEN 'C_features' WHEN 2 THEN 'D_features' WHEN 3 THEN
  'M_features' WHEN 4 THEN 'card_features' WHEN 5 THEN 'D_features' WHEN 6 THEN 'id_features' WHEN 7 THEN 'email_features'
  WHEN 8 THEN 'device_features' ELSE 'other_features' END AS category FROM (SELECT *,
  CAST(regexp_extract(feature, '[0-9]+$', 0) AS BIGINT) % 10 AS p_group FROM nam))"""

register("importance_by_family", "category:s importance_sum:d importance_mean:d n_features:i",
         lambda spark, sf: taxonomy.importance_by_family(_named(spark, sf)),
         f"""WITH {_NAMED}
--
SELECT category, sum(importance) AS importance_sum, avg(importance) AS importance_mean, count(*) AS n_features FROM fam
GROUP BY category""")
register("top_share_by_family", "category:s n_top:i top_pct:d",
         lambda spark, sf: taxonomy.top_share_by_family(_named(spark, sf), 50),
         f"""WITH {_NAMED}
--
SELECT category, count(*) AS n_top, count(*) * 2.0 AS top_pct FROM (SELECT * FROM fam ORDER BY importance DESC, feature LIMIT 50)
GROUP BY category""")
register("selection_rate", "category:s n_total:i n_selected:i selected_pct:d",
         lambda spark, sf: taxonomy.selection_rate(
             _named(spark, sf), selection.importance_cut(_named(spark, sf), 0.5).where(F.col("keep") == 1)),
         f"""WITH {_NAMED},
cut AS (SELECT *, sum(importance) OVER (ORDER BY importance DESC, feature ROWS UNBOUNDED PRECEDING) / sum(importance) OVER ()
  AS cs, row_number() OVER (ORDER BY importance DESC, feature) AS rn FROM fam),
kept AS (SELECT *, CASE WHEN (SELECT count(*) FROM cut WHERE cs <= 0.5) >= 50 THEN cs <= 0.5 ELSE rn <= 50 END AS k FROM cut)
--
SELECT category, count(*) AS n_total, count(*) FILTER (WHERE k) AS n_selected, 100.0 * count(*) FILTER (WHERE k) / count(*) AS
  selected_pct FROM kept GROUP BY category""")
register("importance_compare", "place:i feature_a:s feature_b:s",
         lambda spark, sf: taxonomy.importance_compare(
             fixture.importances(spark, sf),
             fixture.importances(spark, sf).withColumn("importance", F.col("importance") % 100), 20),
         """SELECT a.place, feature_a, feature_b FROM (SELECT row_number() OVER (ORDER BY importance DESC, feature) AS place,
  feature AS feature_a FROM imp QUALIFY place <= 20) a JOIN (SELECT row_number() OVER (ORDER BY importance % 100 DESC, feature)
  AS place, feature AS feature_b FROM imp QUALIFY place <= 20) b ON a.place = b.place""")

register("taxonomy_export", "list_name:s feature:s",
         lambda spark, sf: profiling.taxonomy_export(fixture.joined(spark, sf)),
         f"""WITH {_MISSING_CTE}, car AS ({_CARDINALITY_SQL}),
cat AS (SELECT feature, n_unique FROM car WHERE n_unique < 100 OR feature IN ({', '.join(f"'{c}'" for c in
        [*TEXT, 'DeviceType', 'DeviceInfo', 'id_30', 'id_31', 'id_33'])}))
--
SELECT * FROM (VALUES {', '.join(f"('{f}', '{c}')" for c in FULL_COLUMNS if c not in ('TransactionID', 'isFraud')
                                for f in taxonomy.families(c))}) v(list_name, feature)
UNION ALL SELECT 'categorical_features', feature FROM cat
UNION ALL SELECT 'high_missing_features', feature FROM mr WHERE missing_pct > 50
UNION ALL SELECT 'high_cardinality_features', feature FROM cat WHERE n_unique > 50""")


# --- selection -------------------------------------------------------------------------------

def _listed(spark: SparkSession, df: DataFrame, dropped: list[str]) -> DataFrame:
    """The dropped columns as rows, with their number of present cells."""
    row = df.agg(*[F.count(F.col(c)).alias(c) for c in dropped]) if dropped else df.agg(F.lit(0).alias("none")).drop("none")
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("present")) for c in dropped])
    return row.select(F.inline(cells))


register("sel_missing", "feature:s present:i",
         lambda spark, sf: _listed(spark, (d := fixture.joined(spark, sf)), selection.remove_missing_features(d, 0.8)),
         " UNION ALL ".join(f"SELECT '{c}' AS feature, count({c}) AS present FROM ful "
                            f"HAVING (count(*) - count({c})) / count(*)::DOUBLE > 0.8" for c in FULL_COLUMNS))
register("sel_single_value", "feature:s present:i",
         lambda spark, sf: _listed(spark, (d := fixture.joined(spark, sf)), selection.remove_single_value_features(d)),
         " UNION ALL ".join(f"SELECT '{c}' AS feature, count({c}) AS present FROM ful HAVING count(DISTINCT {c}) <= 1"
                            for c in FULL_COLUMNS))

_PAIRS = [(a, b) for i, a in enumerate(_CORR_COLUMNS) for b in _CORR_COLUMNS[i + 1:]]
_PAIR_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {_CORR_COLUMNS.index(a)} AS pa, {_CORR_COLUMNS.index(b)} AS pb, CASE WHEN "
    f"min({a}) FILTER (WHERE {b} IS NOT NULL) = max({a}) FILTER (WHERE {b} IS NOT NULL) OR min({b}) FILTER (WHERE {a} IS NOT "
    f"NULL) = max({b}) FILTER (WHERE {a} IS NOT NULL) THEN NULL ELSE corr({a}, {b}) END AS corr FROM txn" for a, b in _PAIRS)

register("corr_pairs", "feature_a:s feature_b:s corr:d",
         lambda spark, sf: selection.correlation_pairs(fixture.transactions(spark, sf), _CORR_COLUMNS), _PAIR_SQL)
register("sel_correlated", "feature:s partner:s corr:d",
         lambda spark, sf: selection.correlated_features(fixture.transactions(spark, sf), 0.95, _CORR_COLUMNS),
         f"SELECT feature_b AS feature, first(feature_a ORDER BY pa) AS partner, first(corr ORDER BY pa) AS corr "
         f"FROM ({_PAIR_SQL}) WHERE abs(corr) > 0.95 GROUP BY feature_b")
register("importance_cut", "feature:s importance:d place:i cumulative_share:d keep:i",
         lambda spark, sf: selection.importance_cut(fixture.importances(spark, sf), 0.95),
         """WITH c AS (SELECT *, row_number() OVER (ORDER BY importance DESC, feature) AS place, sum(importance) OVER
  (ORDER BY importance DESC, feature ROWS UNBOUNDED PRECEDING) / sum(importance) OVER () AS cumulative_share FROM imp)
--
SELECT *, CAST(CASE WHEN (SELECT count(*) FROM c WHERE cumulative_share <= 0.95) >= 50 THEN cumulative_share <= 0.95
  ELSE place <= 50 END AS INT) AS keep FROM c""")


def _null_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Five made-up null runs per feature: the importance times a hash share."""
    base = fixture.importances(spark, sf)
    runs = None
    for i in range(5):
        one = base.select("feature", F.lit(i).alias("run"),
                          (F.col("importance") * (ordering.hash_number("feature", i) % 200) / 100.0).alias("importance"))
        runs = one if runs is None else runs.unionByName(one)
    return runs


register("null_importance_rule",
         "feature:s importance:d null_mean:d null_std:d null_max:d importance_ratio:d zscore:d keep:i",
         lambda spark, sf: selection.null_importance_rule(fixture.importances(spark, sf), _null_runs(spark, sf)),
         "WITH nr AS (" + " UNION ALL ".join(
             f"SELECT feature, importance * ({_HASH.format('feature', i)} % 200) / 100.0::DOUBLE AS v FROM imp" for i in range(5))
         + """), st AS (SELECT feature, avg(v) AS null_mean, stddev_samp(v) AS null_std, max(v) AS null_max FROM nr GROUP BY 1)
--
SELECT *, CAST(importance > null_max OR importance_ratio > 2 OR zscore > 2 AS INT) AS keep FROM (SELECT imp.*, null_mean,
  null_std, null_max, importance / (null_mean + 1) AS importance_ratio, (importance - null_mean) / (null_std + 1) AS zscore
  FROM imp JOIN st USING (feature))""")


# --- folds -----------------------------------------------------------------------------------

_POS = "pos AS (SELECT TransactionID, isFraud, row_number() OVER (ORDER BY TransactionDT, TransactionID) - 1 AS rp FROM txn)"
_TS_BOUNDS = """bnd AS (SELECT i + 1 AS fold, CAST(floor(n * (1 - 0.2::DOUBLE * (5 - i) / 5)) AS BIGINT) AS s,
  least(CAST(floor(n * (1 - 0.2::DOUBLE * (5 - i) / 5)) AS BIGINT) + CAST(floor(n * 0.2::DOUBLE) AS BIGINT), n) AS e
  FROM range(5) t(i), (SELECT count(*) AS n FROM txn))"""
_EXP_BOUNDS = """bnd AS (SELECT i + 1 AS fold, (i + 1) * (n // 6) AS s, least((i + 2) * (n // 6), n) AS e
  FROM range(5) t(i), (SELECT count(*) AS n FROM txn))"""
_MEMBERS = """mem AS (SELECT fold, TransactionID, isFraud, CASE WHEN rp < s THEN 'train' ELSE 'valid' END AS part
  FROM pos JOIN bnd ON rp < e)"""
_PLAN = """SELECT fold, count(*) FILTER (WHERE part = 'train') AS train_size, count(*) FILTER (WHERE part = 'valid') AS val_size,
  avg(isFraud) FILTER (WHERE part = 'train') * 100 AS train_rate, avg(isFraud) FILTER (WHERE part = 'valid') * 100 AS val_rate
FROM mem GROUP BY fold"""

register("ts_folds", f"{ID} fold:i part:s",
         lambda spark, sf: folds.time_series_folds(fixture.transactions(spark, sf)),
         f"WITH {_POS}, {_TS_BOUNDS}, {_MEMBERS}\n--\nSELECT TransactionID, fold, part FROM mem")
register("ts_fold_plan", "fold:i train_size:i val_size:i train_rate:d val_rate:d",
         lambda spark, sf: folds.fold_plan(fixture.transactions(spark, sf), "time_series"),
         f"WITH {_POS}, {_TS_BOUNDS}, {_MEMBERS}\n--\n{_PLAN}")
register("expanding_plan", "fold:i train_size:i val_size:i train_rate:d val_rate:d",
         lambda spark, sf: folds.fold_plan(fixture.transactions(spark, sf), "expanding"),
         f"WITH {_POS}, {_EXP_BOUNDS}, {_MEMBERS}\n--\n{_PLAN}")
register("hashed_folds", "o_orderkey:i fold:i",
         lambda spark, sf: fixture.table(spark, sf, "orders").select(
             "o_orderkey", folds.hashed_fold("o_orderkey").alias("fold")),
         f"SELECT o_orderkey, {_HASH.format('o_orderkey', 42)} % 5 AS fold FROM orders")
register("stratified_folds", f"{ID} fold:i",
         lambda spark, sf: folds.stratified_folds(fixture.transactions(spark, sf)),
         f"SELECT TransactionID, (row_number() OVER (ORDER BY isFraud, {_HASH.format('TransactionID', 42)}, TransactionID) - 1) "
         "% 5 AS fold FROM txn")
register("shuffled_folds", f"{ID} fold:i",
         lambda spark, sf: folds.shuffled_folds(fixture.transactions(spark, sf)),
         f"SELECT TransactionID, (row_number() OVER (ORDER BY {_HASH.format('TransactionID', 42)}, TransactionID) - 1) % 5 AS "
         "fold FROM txn")
register("contiguous_folds", f"{ID} fold:i",
         lambda spark, sf: folds.contiguous_folds(fixture.transactions(spark, sf), 7),
         f"""WITH {_POS}, s AS (SELECT count(*) // 7 AS q, count(*) % 7 AS r FROM txn)
--
SELECT TransactionID, CASE WHEN rp < r * (q + 1) THEN rp // (q + 1) ELSE r + (rp - r * (q + 1)) // q END AS fold FROM pos, s""")


# --- ensembles and evaluation ----------------------------------------------------------------

MODELS = ["p1", "p2", "p3"]


def _long(spark: SparkSession, sf: str) -> DataFrame:
    return quantiles.stacked(fixture.scores(spark, sf), MODELS, keep=["TransactionID"], feature="model", value="prediction")


_MEAN = "(p1 + p2 + p3) / 3"
_POP = f"sqrt((power(p1 - {_MEAN}, 2) + power(p2 - {_MEAN}, 2) + power(p3 - {_MEAN}, 2)) / 3)"
register("mean_prediction", f"{ID} prediction:d", lambda spark, sf: ensemble.mean_prediction(_long(spark, sf)),
         f"SELECT TransactionID, {_MEAN} AS prediction FROM sco")
register("uncertainty", f"{ID} prediction:d uncertainty:d", lambda spark, sf: ensemble.prediction_uncertainty(_long(spark, sf)),
         f"SELECT TransactionID, {_MEAN} AS prediction, {_POP} AS uncertainty FROM sco")
register("diversity", f"{ID} prediction:d diversity:d",
         lambda spark, sf: ensemble.predict_with_diversity(
             fixture.scores(spark, sf), MODELS, {"p1": 2.0, "p2": 1.0, "p3": 1.0}),
         f"SELECT TransactionID, p1 * 0.5 + p2 * 0.25 + p3 * 0.25 AS prediction, {_POP} AS diversity FROM sco")
register("blend", f"{ID} blend:d",
         lambda spark, sf: ensemble.blend_predictions(fixture.scores(spark, sf), MODELS, {"p1": 5.0, "p2": 3.0, "p3": 2.0}),
         "SELECT TransactionID, p1 * 0.5 + p2 * 0.3 + p3 * 0.2 AS blend FROM sco")
register("rank_blend", f"{ID} rank_blend:d",
         lambda spark, sf: ensemble.rank_average(fixture.scores(spark, sf), MODELS),
         "SELECT TransactionID, (" + " + ".join(
             f"(rank() OVER (ORDER BY {m}) + (count(*) OVER (PARTITION BY {m}) - 1) / 2.0::DOUBLE) / count(*) OVER ()" for m in MODELS)
         + ") / 3 AS rank_blend FROM sco")


def _auc_sql(source: str, score: str, label: str = "isFraud") -> str:
    return (f"(SELECT (sum(rk) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0) / "
            f"(count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y = 0))::DOUBLE FROM (SELECT {label} AS y, rank() OVER (ORDER BY "
            f"{score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0::DOUBLE AS rk FROM {source}))")


_GRID = ensemble.weight_candidates(3)
register(
    "weight_grid", "position:i w1:d w2:d w3:d auc:d",
    lambda spark, sf: ensemble.weight_grid(fixture.scores(spark, sf), MODELS),
    "WITH wts AS (SELECT * FROM (VALUES " + ", ".join(
        f"({i}, {v[0]!r}::DOUBLE, {v[1]!r}::DOUBLE, {v[2]!r}::DOUBLE)" for i, v in enumerate(_GRID)) + """) t(position, w1, w2, w3)),
b AS (SELECT position, w1, w2, w3, p1 * w1 + p2 * w2 + p3 * w3 AS s, isFraud AS y, count(*) AS n FROM sco, wts GROUP BY ALL),
g AS (SELECT position, s, any_value(w1) AS w1, any_value(w2) AS w2, any_value(w3) AS w3, sum(CASE WHEN y = 1 THEN n ELSE 0 END) AS
  p, sum(CASE WHEN y = 0 THEN n ELSE 0 END) AS q FROM b GROUP BY position, s),
c AS (SELECT *, sum(q) OVER (PARTITION BY position ORDER BY s) - q AS below FROM g)
--
SELECT position, any_value(w1) AS w1, any_value(w2) AS w2, any_value(w3) AS w3,
  CAST(sum(p * (below + q / 2.0::DOUBLE)) AS DOUBLE) / (CAST(sum(p) AS DOUBLE) * CAST(sum(q) AS DOUBLE)) AS auc FROM c GROUP BY position""")


def _best(spark: SparkSession, sf: str) -> DataFrame:
    df = ensemble.blend_predictions(ensemble.blend_predictions(
        fixture.scores(spark, sf), MODELS, None, "average"), MODELS, {"p1": 5.0, "p2": 3.0, "p3": 2.0}, "weighted")
    df = df.withColumn("meta", 1 - F.col("p1"))
    return ensemble.best_method(ensemble.model_aucs(df, list(ensemble.METHODS)).withColumnRenamed("model", "method"))


register(
    "best_method", "best_method:s best_auc:d gain:d", _best,
    f"""WITH m AS (SELECT *, p1 * (1.0::DOUBLE / 3) + p2 * (1.0::DOUBLE / 3) + p3 * (1.0::DOUBLE / 3) AS average,
  p1 * 0.5 + p2 * 0.3 + p3 * 0.2 AS weighted, 1 - p1 AS meta FROM sco),
a AS (SELECT 'average' AS method, 0 AS o, {_auc_sql('m', 'average')} AS auc UNION ALL SELECT 'weighted', 1,
  {_auc_sql('m', 'weighted')} UNION ALL SELECT 'meta', 2, {_auc_sql('m', 'meta')})
--
SELECT (SELECT method FROM a ORDER BY auc DESC, o LIMIT 1) AS best_method, max(auc) AS best_auc,
  max(auc) - max(auc) FILTER (WHERE method = 'average') AS gain FROM a""")

register("oof_corr", "feature_a:s feature_b:s corr:d",
         lambda spark, sf: selection.correlation_pairs(fixture.scores(spark, sf), MODELS),
         " UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr({a}, {b}) AS corr FROM sco"
                            for a, b in (("p1", "p2"), ("p1", "p3"), ("p2", "p3"))))
register("roc_auc", "auc:d n_pos:i n_neg:i", lambda spark, sf: evaluation.roc_auc(fixture.scores(spark, sf), "p1"),
         f"SELECT {_auc_sql('sco', 'p1')} AS auc, count(*) FILTER (WHERE isFraud = 1) AS n_pos, count(*) FILTER (WHERE "
         "isFraud = 0) AS n_neg FROM sco")
register("model_aucs", "model:s auc:d n_pos:i n_neg:i",
         lambda spark, sf: ensemble.model_aucs(fixture.scores(spark, sf), MODELS),
         " UNION ALL ".join(f"SELECT '{m}' AS model, {_auc_sql('sco', m)} AS auc, count(*) FILTER (WHERE isFraud = 1) AS n_pos, "
                            "count(*) FILTER (WHERE isFraud = 0) AS n_neg FROM sco" for m in MODELS))
register("threshold_metrics", "tp:i fp:i tn:i fn:i accuracy:d precision:d recall:d f1:d",
         lambda spark, sf: evaluation.threshold_metrics(fixture.scores(spark, sf), "p1"),
         """SELECT tp, fp, tn, fn, (tp + tn) / n::DOUBLE AS accuracy, p AS precision, r AS recall,
  CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE
  ELSE 0 END AS p, CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0 END AS r FROM (SELECT count(*) AS n,
  count(*) FILTER (WHERE p1 >= 0.5 AND isFraud = 1) AS tp, count(*) FILTER (WHERE p1 >= 0.5 AND isFraud = 0) AS fp,
  count(*) FILTER (WHERE p1 < 0.5 AND isFraud = 0) AS tn, count(*) FILTER (WHERE p1 < 0.5 AND isFraud = 1) AS fn FROM sco))""")
register("confusion", "actual:i predicted:i n:i row_share:d",
         lambda spark, sf: evaluation.confusion_matrix(fixture.scores(spark, sf), "p1"),
         """SELECT actual, predicted, n, n / sum(n) OVER (PARTITION BY actual)::DOUBLE AS row_share FROM (SELECT isFraud AS actual,
  CAST(p1 >= 0.5 AS INT) AS predicted, count(*) AS n FROM sco GROUP BY 1, 2)""")
register("roc_curve", "threshold:d fpr:d tpr:d", lambda spark, sf: evaluation.roc_curve(fixture.scores(spark, sf), "p2"),
         """SELECT p2 AS threshold, sum(q) OVER d / sum(q) OVER ()::DOUBLE AS fpr, sum(p) OVER d / sum(p) OVER ()::DOUBLE AS tpr
FROM (SELECT p2, sum(isFraud) AS p, sum(1 - isFraud) AS q FROM sco GROUP BY p2) WINDOW d AS (ORDER BY p2 DESC)""")


def _with_uncertainty(spark: SparkSession, sf: str) -> DataFrame:
    return ensemble.predict_with_diversity(fixture.scores(spark, sf), MODELS)


_UNC = f"unc AS (SELECT TransactionID, isFraud, {_MEAN} AS prediction, {_POP} AS diversity FROM sco)"
_PCT = (1, 5, 10, 25, 50, 75, 90, 95, 99)
register(
    "prediction_profile",
    "n:i mean:d std:d low:d high:d unc_mean:d unc_std:d unc_low:d unc_high:d " + " ".join(f"p{p}:d" for p in _PCT),
    lambda spark, sf: evaluation.prediction_profile(_with_uncertainty(spark, sf), "prediction", "diversity"),
    f"""WITH {_UNC}
--
SELECT count(*) AS n, avg(prediction) AS mean, stddev_pop(prediction) AS std, min(prediction) AS low, max(prediction) AS high,
  avg(diversity) AS unc_mean, stddev_pop(diversity) AS unc_std, min(diversity) AS unc_low, max(diversity) AS unc_high,
  {', '.join(f'quantile_cont(prediction, {p / 100}) AS p{p}' for p in _PCT)} FROM unc""")
register("score_by_label", "isFraud:i n:i mean:d median:d std:d",
         lambda spark, sf: evaluation.score_by_label(fixture.scores(spark, sf), "p2"),
         "SELECT isFraud, count(*) AS n, avg(p2) AS mean, quantile_cont(p2, 0.5) AS median, stddev_pop(p2) AS std FROM sco "
         "GROUP BY isFraud")
register("score_segments", "segment:s n:i pct:d", lambda spark, sf: evaluation.score_segments(fixture.scores(spark, sf), "p2"),
         """SELECT segment, n, 100.0 * n / sum(n) OVER () AS pct FROM (SELECT CASE WHEN p2 < 0.2 THEN 'Very Low' WHEN p2 < 0.4 THEN
  'Low' WHEN p2 < 0.6 THEN 'Medium' WHEN p2 < 0.8 THEN 'High' ELSE 'Very High' END AS segment, count(*) AS n FROM sco GROUP BY 1)""")
register(
    "confidence_counts",
    "n:i high_score:i low_score:i expected_positives:d high_uncertainty:i low_uncertainty:i",
    lambda spark, sf: evaluation.confidence_counts(fixture.scores(spark, sf), "p2", "p3"),
    """SELECT count(*) AS n, count(*) FILTER (WHERE p2 > 0.8) AS high_score, count(*) FILTER (WHERE p2 < 0.2) AS low_score,
  sum(p2) AS expected_positives, count(*) FILTER (WHERE p3 > (SELECT quantile_cont(p3, 0.9) FROM sco)) AS high_uncertainty,
  count(*) FILTER (WHERE p3 < (SELECT quantile_cont(p3, 0.1) FROM sco)) AS low_uncertainty FROM sco""")


def _drift(spark: SparkSession, sf: str) -> DataFrame:
    df = fixture.scores(spark, sf)
    odd = F.col("TransactionID") % 3 == 0
    return evaluation.score_drift(df.where(~odd), df.where(odd), "p1")


register(
    "score_drift", "metric:s train:d test:d difference:d is_similar:i", _drift,
    """WITH p AS (SELECT p1 AS s, TransactionID % 3 = 0 AS t FROM sco),
m AS (SELECT t, avg(s) AS mean, quantile_cont(s, 0.5) AS median, stddev_pop(s) AS std, quantile_cont(s, 0.95) AS p95,
  quantile_cont(s, 0.99) AS p99 FROM p GROUP BY t),
l AS (UNPIVOT m ON mean, median, std, p95, p99 INTO NAME metric VALUE v)
--
SELECT metric, max(v) FILTER (WHERE NOT t) AS train, max(v) FILTER (WHERE t) AS test, max(v) FILTER (WHERE t) - max(v) FILTER
  (WHERE NOT t) AS difference, CASE WHEN metric = 'mean' THEN CAST(abs(max(v) FILTER (WHERE t) - max(v) FILTER (WHERE NOT t)) <
  0.01 AS INT) END AS is_similar FROM l GROUP BY metric""")


def _gaps(spark: SparkSession, sf: str) -> DataFrame:
    long = quantiles.stacked(fixture.scores(spark, sf), MODELS, keep=["TransactionID", "isFraud"], feature="model", value="s")
    long = long.withColumn("part", F.when(F.col("TransactionID") % 5 == 0, "val").otherwise("train"))
    aucs = evaluation.grouped_auc(long, ["model", "part"], "s").groupBy("model").agg(
        F.max(F.when(F.col("part") == "train", F.col("auc"))).alias("train_auc"),
        F.max(F.when(F.col("part") == "val", F.col("auc"))).alias("val_auc"))
    return evaluation.metric_gaps(aucs, 0.94, "p1")


register(
    "metric_gaps", "model:s train_auc:d val_auc:d overfit_gap:d to_target:d gain:d", _gaps,
    "WITH tr AS (SELECT * FROM sco WHERE TransactionID % 5 <> 0), va AS (SELECT * FROM sco WHERE TransactionID % 5 = 0), a AS ("
    + " UNION ALL ".join(f"SELECT '{m}' AS model, {_auc_sql('tr', m)} AS train_auc, {_auc_sql('va', m)} AS val_auc" for m in MODELS)
    + """)
--
SELECT *, train_auc - val_auc AS overfit_gap, 0.94 - val_auc AS to_target, val_auc - (SELECT val_auc FROM a WHERE model = 'p1') AS
  gain FROM a""")


def _fold_scores(spark: SparkSession, sf: str) -> DataFrame:
    df = fixture.scores(spark, sf).withColumn("fold", folds.hashed_fold())
    return evaluation.grouped_auc(df, ["fold"], "p2").withColumnRenamed("auc", "val_auc")


register(
    "fold_stability",
    "mean_score:d std_score:d min_score:d max_score:d max_step:d score_range:d variation:d stability:d",
    lambda spark, sf: folds.fold_stability(_fold_scores(spark, sf)),
    "WITH f AS (SELECT *, " + _HASH.format("TransactionID", 42) + " % 5 AS fold FROM sco), a AS (" + " UNION ALL ".join(
        f"SELECT {i} AS fold, {_auc_sql(f'(SELECT * FROM f WHERE fold = {i})', 'p2')} AS v" for i in range(5)) + """),
s AS (SELECT v, abs(v - lag(v) OVER (ORDER BY fold)) AS step FROM a)
--
SELECT avg(v) AS mean_score, stddev_pop(v) AS std_score, min(v) AS min_score, max(v) AS max_score, max(step) AS max_step,
  max(v) - min(v) AS score_range, stddev_pop(v) / avg(v) AS variation, 1 - stddev_pop(v) / avg(v) AS stability FROM s""")


def _trials(spark: SparkSession, sf: str) -> DataFrame:
    df = fixture.scores(spark, sf).withColumn("trial", folds.hashed_fold(k=10, seed=7))
    return evaluation.grouped_auc(df, ["trial"], "p2").withColumnRenamed("auc", "value")


def _trial_summary(spark: SparkSession, sf: str) -> DataFrame:
    from riskloom.operators.tuning import trial_summary
    return trial_summary(_trials(spark, sf))


register(
    "trial_summary", "n_trials:i best_value:d best_trial:i mean_value:d std_value:d min_value:d max_value:d", _trial_summary,
    "WITH f AS (SELECT *, " + _HASH.format("TransactionID", 7) + " % 10 AS trial FROM sco), a AS (" + " UNION ALL ".join(
        f"SELECT {i} AS trial, {_auc_sql(f'(SELECT * FROM f WHERE trial = {i})', 'p2')} AS v" for i in range(10)) + """)
--
SELECT count(*) AS n_trials, max(v) AS best_value, (SELECT trial FROM a ORDER BY v DESC, trial LIMIT 1) AS best_trial,
  avg(v) AS mean_value, stddev_samp(v) AS std_value, min(v) AS min_value, max(v) AS max_value FROM a""")
