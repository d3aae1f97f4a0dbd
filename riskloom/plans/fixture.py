"""The transaction and identity views derived from the given tables.

The given tables hold neither nulls nor labels, so both come from fixed expressions over
events, customer and nation. The SQL text below states the same rows for the checking engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.sources.tables import spread_over_cores

# Fixed value: epoch second of 2024-01-01 00:00:00 UTC.
EVENT_START = 1704067200


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_over_cores(table(spark, sf_dir, "events"), "event_id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_KEY = "cast(regexp_extract(props, '[0-9]+', 0) as int)"


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = events_table(spark, sf_dir).selectExpr(
        "event_id AS id", "user_id AS u", "event_type", "value",
        "unix_timestamp(cast(ts AS timestamp)) AS second", f"{_KEY} AS k")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    return events.join(customer, events.u == customer.c_custkey).join(
        nation, customer.c_nationkey == nation.n_nationkey)


# Column -> expression over id, u, k, value, second, c_nationkey and n_regionkey.
_TRANSACTION = {
    "TransactionID": "id",
    "isFraud": "if(k % 29 = 0, 1, 0)",
    "TransactionDT": f"second - {EVENT_START}",
    "TransactionAmt": "value",
    "ProductCD": "event_type",
    "card1": "cast(u AS int)",
    "card2": "cast(if(k % 10 = 0, null, 100 + k % 25) AS double)",
    "card3": "cast(150 + k % 3 AS double)",
    "card4": "decode(k % 4, 0, 'visa', 1, 'mastercard', 2, 'discover')",
    "card5": "cast(if(u % 7 = 3, null, 100 + u % 7) AS double)",
    "card6": "case when id % 11 = 0 then null when id % 3 = 0 then 'credit' else 'debit' end",
    "addr1": "cast(if(id % 9 = 0, null, 200 + c_nationkey) AS double)",
    "addr2": "cast(if(id % 9 = 0 or id % 13 = 0, null, n_regionkey) AS double)",
    "P_emaildomain": "decode(u % 6, 0, 'gmail.com', 1, 'yahoo.com', 2, 'hotmail.com', 3, 'anonymous.com', "
                     "4, 'yahoo.co.jp')",
    "R_emaildomain": "decode(k % 5, 0, 'gmail.com', 1, 'yahoo.com', 2, 'outlook.com')",
    "C1": "cast(k % 7 AS double)",
    "C2": "cast(u % 4 AS double)",
    "D1": "cast(nullif(k % 6, 0) AS double)",
    "D2": "cast(if(id % 2 = 0, null, k % 11) AS double)",
    "M1": "decode(k % 3, 0, 'T', 1, 'F')",
    "M2": "decode(id % 3, 0, 'T', 1, 'F')",
    "V1": "value * 2",
    "V2": "cast(1 AS double)",
    "V3": "if(k = 1, value, null)",
}
# Column -> expression over event_id and k.
_IDENTITY = {
    "TransactionID": "event_id",
    "DeviceType": "case when k % 8 = 7 then null when k % 2 = 0 then 'mobile' else 'desktop' end",
    "DeviceInfo": "decode(k % 5, 0, 'SM-G930V Build/NRD90M', 1, 'Windows', 2, 'iOS Device', 3, 'MacOS')",
    "id_30": "decode(k % 4, 0, 'Windows 10', 1, 'Android 7.0', 2, 'iOS 11.2.1')",
    "id_31": "decode(k % 6, 0, 'chrome 63.0', 1, 'mobile safari 11.0', 2, 'edge 16.0', 3, 'firefox 57.0')",
    "id_33": "if(k % 3 = 0, '1920x1080', null)",
}
_SCORES = {
    "TransactionID": "event_id",
    "isFraud": "if(k % 29 = 0, 1, 0)",
    "p1": "(k % 20) / 20.0D",
    "p2": "(event_id % 97) / 97.0D",
    "p3": "(user_id % 13) / 13.0D",
}


def _selected(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {c}" for c, e in expressions.items()])


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _selected(_base(spark, sf_dir), _TRANSACTION)


def identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = events_table(spark, sf_dir).where("event_id % 4 = 0")
    return _selected(events.selectExpr("event_id", f"{_KEY} AS k"), _IDENTITY)


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).join(identities(spark, sf_dir), "TransactionID", "left")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three score columns with many ties, next to the label."""
    events = events_table(spark, sf_dir)
    return _selected(events.selectExpr("event_id", "user_id", f"{_KEY} AS k"), _SCORES)


def importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A (feature, importance) table made from part."""
    return table(spark, sf_dir, "part").select(
        F.concat_ws("_", "p_name", F.col("p_partkey").cast("string")).alias("feature"),
        F.col("p_retailprice").alias("importance"),
    )


TXN_SQL = """
base AS (
  SELECT event_id AS id, user_id AS u, event_type, value,
         CAST(floor(epoch(ts)) AS BIGINT) AS sec,
         CAST(regexp_extract(props, '[0-9]+', 0) AS INT) AS k,
         c_nationkey, n_regionkey
  FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
txn AS (
  SELECT id AS TransactionID,
    CASE WHEN k % 29 = 0 THEN 1 ELSE 0 END AS isFraud,
    sec - 1704067200 AS TransactionDT,
    value AS TransactionAmt,
    event_type AS ProductCD,
    CAST(u AS INT) AS card1,
    CAST(CASE WHEN k % 10 = 0 THEN NULL ELSE 100 + k % 25 END AS DOUBLE) AS card2,
    CAST(150 + k % 3 AS DOUBLE) AS card3,
    CASE k % 4 WHEN 0 THEN 'visa' WHEN 1 THEN 'mastercard' WHEN 2 THEN 'discover' END AS card4,
    CAST(CASE WHEN u % 7 = 3 THEN NULL ELSE 100 + u % 7 END AS DOUBLE) AS card5,
    CASE WHEN id % 11 = 0 THEN NULL WHEN id % 3 = 0 THEN 'credit' ELSE 'debit' END AS card6,
    CAST(CASE WHEN id % 9 = 0 THEN NULL ELSE 200 + c_nationkey END AS DOUBLE) AS addr1,
    CAST(CASE WHEN id % 9 = 0 OR id % 13 = 0 THEN NULL ELSE n_regionkey END AS DOUBLE) AS addr2,
    CASE u % 6 WHEN 0 THEN 'gmail.com' WHEN 1 THEN 'yahoo.com' WHEN 2 THEN 'hotmail.com'
               WHEN 3 THEN 'anonymous.com' WHEN 4 THEN 'yahoo.co.jp' END AS P_emaildomain,
    CASE k % 5 WHEN 0 THEN 'gmail.com' WHEN 1 THEN 'yahoo.com' WHEN 2 THEN 'outlook.com' END AS R_emaildomain,
    CAST(k % 7 AS DOUBLE) AS C1,
    CAST(u % 4 AS DOUBLE) AS C2,
    CAST(nullif(k % 6, 0) AS DOUBLE) AS D1,
    CAST(CASE WHEN id % 2 = 0 THEN NULL ELSE k % 11 END AS DOUBLE) AS D2,
    CASE k % 3 WHEN 0 THEN 'T' WHEN 1 THEN 'F' END AS M1,
    CASE id % 3 WHEN 0 THEN 'T' WHEN 1 THEN 'F' END AS M2,
    value * 2 AS V1, CAST(1 AS DOUBLE) AS V2,
    CASE WHEN k = 1 THEN value END AS V3
  FROM base
),
idt AS (
  SELECT id AS TransactionID,
    CASE WHEN k % 8 = 7 THEN NULL WHEN k % 2 = 0 THEN 'mobile' ELSE 'desktop' END AS DeviceType,
    CASE k % 5 WHEN 0 THEN 'SM-G930V Build/NRD90M' WHEN 1 THEN 'Windows' WHEN 2 THEN 'iOS Device'
               WHEN 3 THEN 'MacOS' END AS DeviceInfo,
    CASE k % 4 WHEN 0 THEN 'Windows 10' WHEN 1 THEN 'Android 7.0' WHEN 2 THEN 'iOS 11.2.1' END AS id_30,
    CASE k % 6 WHEN 0 THEN 'chrome 63.0' WHEN 1 THEN 'mobile safari 11.0' WHEN 2 THEN 'edge 16.0'
               WHEN 3 THEN 'firefox 57.0' END AS id_31,
    CASE WHEN k % 3 = 0 THEN '1920x1080' END AS id_33
  FROM base WHERE id % 4 = 0
),
ful AS (
  SELECT txn.*, DeviceType, DeviceInfo, id_30, id_31, id_33
  FROM txn LEFT JOIN idt ON txn.TransactionID = idt.TransactionID
),
sco AS (
  SELECT id AS TransactionID, CASE WHEN k % 29 = 0 THEN 1 ELSE 0 END AS isFraud,
    (k % 20) / 20.0::DOUBLE AS p1, (id % 97) / 97.0::DOUBLE AS p2, (u % 13) / 13.0::DOUBLE AS p3
  FROM base
),
imp AS (
  SELECT concat_ws('_', p_name, CAST(p_partkey AS VARCHAR)) AS feature, p_retailprice AS importance FROM part
)
"""
