"""Queries over scans, group statistics, interactions, temporal and missingness features."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.operators import aggregation, interaction, pipeline, temporal
from riskloom.plans import fixture
from riskloom.plans.registry import register

ID = "TransactionID:i"

register(
    "scan_transactions",
    f"{ID} isFraud:i TransactionDT:i TransactionAmt:d ProductCD:s card1:i card2:d card3:d card4:s card5:d card6:s "
    "addr1:d addr2:d P_emaildomain:s R_emaildomain:s C1:d C2:d D1:d D2:d M1:s M2:s V1:d V2:d V3:d",
    fixture.transactions, "SELECT * FROM txn")

register(
    "join_identity",
    f"{ID} TransactionAmt:d DeviceType:s DeviceInfo:s id_30:s id_31:s id_33:s",
    fixture.joined, "SELECT * FROM ful")


# --- group statistics ------------------------------------------------------------------------

def _sql_stats(key: str, prefix: str, stats: str, source: str = "ful", value: str = "TransactionAmt") -> str:
    """A plain GROUP BY on one non-null key."""
    texts = {
        "count": f"count({value})", "mean": f"avg({value})", "std": f"stddev_samp({value})", "min": f"min({value})",
        "max": f"max({value})", "median": f"quantile_cont({value}, 0.5)", "sum": f"sum({value})",
    }
    cols = ", ".join(f"{texts[s]} AS {prefix}_{s}" for s in stats.split())
    return f"(SELECT {key}, {cols} FROM {source} WHERE {key} IS NOT NULL GROUP BY {key})"


_TXT = "coalesce(CAST({0} AS VARCHAR), 'nan')"


def _sql_combo(*parts: str) -> str:
    return " || '_' || ".join(_TXT.format(p) for p in parts)


_KEYED = f"""keyed AS (SELECT *, {_sql_combo('card1', 'card2')} AS card1_card2,
  {_sql_combo('P_emaildomain', 'R_emaildomain')} AS email_combination,
  {_sql_combo('addr1', 'addr2')} AS addr_combined FROM ful)"""

# Family -> (key, prefix, stats) in the order in which the features are attached.
_AGG = {
    "card1": [("card1", "card1", "count mean std min max median sum")],
    "card_rest": [("card2", "card2", "count mean std"), ("card3", "card3", "count mean"),
                  ("card4", "card4", "count mean std"), ("card5", "card5", "count mean"),
                  ("card6", "card6", "count mean")],
    "card12": [("card1_card2", "card12", "count mean std")],
    "email": [("P_emaildomain", "P_email", "count mean std min max"), ("R_emaildomain", "R_email", "count mean std")],
    "email_combo": [("email_combination", "email_comb", "count mean")],
    "device": [("DeviceType", "DeviceType", "count mean std"), ("DeviceInfo", "DeviceInfo", "count mean std min max"),
               ("id_30", "OS", "count mean"), ("id_31", "browser", "count mean")],
    "product": [("ProductCD", "ProductCD", "count mean std min max median")],
    "address": [("addr1", "addr1", "count mean std min max"), ("addr2", "addr2", "count mean std"),
                ("addr_combined", "addr_comb", "count mean")],
}
_AGG_DERIVED = {
    "card1": {
        "card1_range": "card1_max - card1_min",
        "card1_mean_to_std_ratio": "card1_mean / (card1_std + 1e-5)",
        "card1_amt_deviation": "TransactionAmt - card1_mean",
        "card1_amt_deviation_ratio": "TransactionAmt / (card1_mean + 1)",
        "card1_amt_zscore": "(TransactionAmt - card1_mean) / (card1_std + 1e-5)",
    },
    "email": {"P_email_risk_score": "1.0 / (P_email_count + 1)", "R_email_risk_score": "1.0 / (R_email_count + 1)"},
    "device": {"DeviceInfo_risk_score": "1.0 / (DeviceInfo_count + 1)"},
    "product": {"ProductCD_amt_deviation": "TransactionAmt - ProductCD_mean",
                "ProductCD_amt_ratio": "TransactionAmt / (ProductCD_mean + 1)"},
    "address": {"addr1_risk_score": "1.0 / (addr1_count + 1)"},
}
_AGG_KEYS = {"card12": "card1_card2", "email_combo": "email_combination", "address": "addr_combined"}


def _agg_query(groups: list[str]) -> tuple[str, str]:
    """(column list, SQL text) for a union of feature groups."""
    columns, joins, derived = [ID], [], {}
    for g in groups:
        if g in _AGG_KEYS:
            columns.append(f"{_AGG_KEYS[g]}:s")
        for key, prefix, stats in _AGG[g]:
            joins.append(f"LEFT JOIN {_sql_stats(key, prefix, stats, 'keyed')} g_{prefix} ON keyed.{key} = g_{prefix}.{key}")
            columns += [f"{prefix}_{s}:{'i' if s == 'count' else 'd'}" for s in stats.split()]
        derived.update(_AGG_DERIVED.get(g, {}))
    columns += [f"{c}:d" for c in derived]
    picks = ", ".join(c.rsplit(":", 1)[0] for c in columns if c != ID and c.rsplit(":", 1)[0] not in derived)
    more = "".join(f", {e} AS {n}" for n, e in derived.items())
    sql = (f"WITH {_KEYED}\n--\nSELECT TransactionID, {picks}{more} FROM keyed " + "\n".join(joins))
    # The key of a composite is a column of keyed; qualify the names both sides share.
    for key in _AGG_KEYS.values():
        sql = sql.replace(f", {key},", f", keyed.{key},")
    return " ".join(columns), sql


def _agg_build(groups: list[str]):
    prefixes = [prefix for g in groups for _, prefix, _ in _AGG[g]]
    return lambda spark, sf: aggregation.aggregation_features(fixture.joined(spark, sf), prefixes=prefixes)[0]


for _name, _groups in (
    ("agg_card1", ["card1"]), ("agg_card_rest", ["card_rest"]), ("agg_card12", ["card12"]),
    ("agg_email", ["email"]), ("agg_email_combo", ["email_combo"]), ("agg_device", ["device"]),
    ("agg_product", ["product"]), ("agg_address", ["address"]), ("agg_all", list(_AGG)),
):
    _columns, _sql = _agg_query(_groups)
    register(_name, _columns, _agg_build(_groups), _sql)

register(
    "agg_kernel",
    f"{ID} card12:s card1_TransactionAmt_mean:d card1_TransactionAmt_std:d card1_TransactionAmt_min:d "
    "card1_TransactionAmt_max:d card1_TransactionAmt_count:i card2_TransactionAmt_mean:d card2_TransactionAmt_count:i "
    "card12_TransactionAmt_mean:d card12_TransactionAmt_count:i addr1_TransactionAmt_mean:d "
    "addr1_TransactionAmt_count:i TransactionAmt_card1_deviation:d TransactionAmt_card1_ratio:d",
    lambda spark, sf: aggregation.kernel_aggregations(fixture.transactions(spark, sf)),
    f"""WITH k12 AS (SELECT *, {_sql_combo('card1', 'card2')} AS card12 FROM txn)
--
SELECT k12.*, a.* EXCLUDE (card1), b.* EXCLUDE (card2), c.* EXCLUDE (card12), d.* EXCLUDE (addr1),
  TransactionAmt - card1_TransactionAmt_mean AS TransactionAmt_card1_deviation,
  TransactionAmt / (card1_TransactionAmt_mean + 1) AS TransactionAmt_card1_ratio
FROM k12
LEFT JOIN {_sql_stats('card1', 'card1_TransactionAmt', 'mean std min max count', 'k12')} a ON k12.card1 = a.card1
LEFT JOIN {_sql_stats('card2', 'card2_TransactionAmt', 'mean count', 'k12')} b ON k12.card2 = b.card2
LEFT JOIN {_sql_stats('card12', 'card12_TransactionAmt', 'mean count', 'k12')} c ON k12.card12 = c.card12
LEFT JOIN {_sql_stats('addr1', 'addr1_TransactionAmt', 'mean count', 'k12')} d ON k12.addr1 = d.addr1""")

register(
    "freq_encode",
    " ".join([ID, *[f"{c}_freq:i {c}_freq_log:d" for c in aggregation.FREQUENCY_COLUMNS]]),
    lambda spark, sf: aggregation.frequency_encoding(fixture.transactions(spark, sf)),
    "SELECT TransactionID, " + ", ".join(
        f"f_{c}.n AS {c}_freq, ln(1 + f_{c}.n) AS {c}_freq_log" for c in aggregation.FREQUENCY_COLUMNS)
    + " FROM txn " + " ".join(
        f"LEFT JOIN (SELECT {c}, count(*) AS n FROM txn WHERE {c} IS NOT NULL GROUP BY {c}) f_{c} ON txn.{c} = f_{c}.{c}"
        for c in aggregation.FREQUENCY_COLUMNS))


# --- interactions ----------------------------------------------------------------------------

_PAIR = ("card1", "addr1")

register(
    "combo_key", f"{ID} pair_key:s triple_key:s",
    lambda spark, sf: fixture.transactions(spark, sf).select(
        "TransactionID", interaction.combined("card2", "addr1").alias("pair_key"),
        interaction.combined("card1", "P_emaildomain", "ProductCD").alias("triple_key")),
    f"SELECT TransactionID, {_sql_combo('card2', 'addr1')} AS pair_key, "
    f"{_sql_combo('card1', 'P_emaildomain', 'ProductCD')} AS triple_key FROM txn")

register(
    "combo_count", f"{ID} card1_addr1:s card1_addr1_count:i",
    lambda spark, sf: interaction.combination_features(
        fixture.transactions(spark, sf), {"card1_addr1": _PAIR}, target=None)[0],
    f"""WITH c AS (SELECT *, {_sql_combo(*_PAIR)} AS card1_addr1 FROM txn)
--
SELECT TransactionID, card1_addr1, n AS card1_addr1_count
FROM c JOIN (SELECT card1_addr1, count(*) AS n FROM c GROUP BY card1_addr1) USING (card1_addr1)""")

register(
    "target_rate", "card1:i fraud_count:i total_count:i fraud_rate:d fraud_rate_smoothed:d",
    lambda spark, sf: interaction.target_rate(fixture.transactions(spark, sf), ["card1"], min_samples=60),
    """WITH g AS (SELECT avg(isFraud) AS gr FROM txn)
--
SELECT card1, sum(isFraud) AS fraud_count, count(isFraud) AS total_count,
  CASE WHEN count(isFraud) >= 60 THEN avg(isFraud) ELSE any_value(gr) END AS fraud_rate,
  (sum(isFraud) + 10 * any_value(gr)) / (count(isFraud) + 10) AS fraud_rate_smoothed
FROM txn, g GROUP BY card1""")


def _inter_query(families: list[str]) -> tuple[str, str]:
    columns, keys, joins, picks = [ID], [], [], []
    if "amt_product" in families:
        columns.append("amt_bin:s")
        picks.append("amt_bin")
    for f in families:
        for name, parts in interaction.FAMILIES[f].items():
            keys.append(f"{_sql_combo(*parts)} AS {name}")
            columns += [f"{name}:s", f"{name}_count:i", f"{name}_fraud_rate:d"]
            picks += [f"c.{name}", f"x_{name}.n AS {name}_count", f"x_{name}.r AS {name}_fraud_rate"]
            joins.append(
                f"JOIN (SELECT {name}, count(*) AS n, (sum(isFraud) + 10 * (SELECT gr FROM g)) / (count(isFraud) + 10) AS r "
                f"FROM c GROUP BY {name}) x_{name} ON c.{name} = x_{name}.{name}")
    sql = f"""WITH g AS (SELECT avg(isFraud) AS gr FROM ful),
banded AS (SELECT *, CASE WHEN TransactionAmt <= 0 THEN 'nan' WHEN TransactionAmt <= 50 THEN 'low'
  WHEN TransactionAmt <= 150 THEN 'medium' WHEN TransactionAmt <= 500 THEN 'high'
  WHEN TransactionAmt > 500 THEN 'very_high' ELSE 'nan' END AS amt_bin FROM ful),
c AS (SELECT *, {', '.join(keys)} FROM banded)
--
SELECT TransactionID, {', '.join(picks)} FROM c {' '.join(joins)}"""
    return " ".join(columns), sql


for _name, _families in (
    ("inter_card_addr", ["card_addr"]), ("inter_card_email", ["card_email"]),
    ("inter_device_browser", ["device_browser"]), ("inter_amt_product", ["amt_product"]),
    ("inter_card_product", ["card_product"]), ("inter_three_way", ["three_way"]),
    ("inter_all", list(interaction.FAMILIES)),
):
    _columns, _sql = _inter_query(_families)
    register(_name, _columns, lambda spark, sf, _f=tuple(_families): interaction.interaction_features(
        fixture.joined(spark, sf), _f)[0], _sql)

_FOLD_SQL = "CAST(concat('0x', substr(md5(concat(CAST({0} AS VARCHAR), ':42')), 1, 8)) AS BIGINT)"

register(
    "rate_out_of_fold", f"{ID} card1_addr1:s card1_addr1_count:i card1_addr1_fraud_rate:d",
    lambda spark, sf: interaction.combination_features(
        fixture.transactions(spark, sf), {"card1_addr1": _PAIR}, mode="out_of_fold")[0],
    f"""WITH c AS (SELECT *, {_sql_combo(*_PAIR)} AS card1_addr1,
  {_FOLD_SQL.format('TransactionID')} % 5 AS fold FROM txn),
t AS (SELECT card1_addr1, count(*) AS n, sum(isFraud) AS s FROM c GROUP BY ALL),
f AS (SELECT card1_addr1, fold, count(*) AS n, sum(isFraud) AS s FROM c GROUP BY ALL)
--
SELECT TransactionID, c.card1_addr1, t.n AS card1_addr1_count,
  (t.s - f.s + 10 * (SELECT avg(isFraud) FROM txn)) / (t.n - f.n + 10) AS card1_addr1_fraud_rate
FROM c JOIN t USING (card1_addr1) JOIN f ON c.card1_addr1 = f.card1_addr1 AND c.fold = f.fold""")


# --- temporal --------------------------------------------------------------------------------

def _since_sql(keys) -> tuple[str, str]:
    cols, picks = [ID], []
    for k in keys:
        w = f"OVER (PARTITION BY {k} ORDER BY TransactionDT, TransactionID)"
        for part, e, kind in (
            ("time_since_prev", f"(TransactionDT - lag(TransactionDT) {w}) / 3600.0::DOUBLE", "d"),
            ("time_since_first", f"(TransactionDT - min(TransactionDT) OVER (PARTITION BY {k})) / 3600.0::DOUBLE", "d"),
            ("txn_count_so_far", f"row_number() {w}", "i"),
        ):
            cols.append(f"{k}_{part}:{kind}")
            picks.append(f"CASE WHEN {k} IS NOT NULL THEN {e} END AS {k}_{part}")
    return " ".join(cols), ", ".join(picks)


def _velocity_sql(keys) -> tuple[str, str]:
    cols, picks = [ID], []
    for k in keys:
        for label, w in temporal.VELOCITY_WINDOWS.items():
            cols.append(f"{k}_velocity_{label}:i")
            picks.append(
                f"CASE WHEN {k} IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY {k} ORDER BY TransactionDT "
                f"RANGE BETWEEN {w} PRECEDING AND 1 PRECEDING) END AS {k}_velocity_{label}")
    return " ".join(cols), ", ".join(picks)


def _rfm_sql(keys, learnt: str = "ful") -> tuple[str, str]:
    cols, picks, joins = [ID], [], []
    for k in keys:
        cols += [f"{k}_recency:d", f"{k}_frequency:i", f"{k}_monetary_total:d", f"{k}_monetary_mean:d",
                 f"{k}_monetary_std:d", f"{k}_rfm_score:d"]
        picks += [f"r_{k}.rec AS {k}_recency", f"r_{k}.n AS {k}_frequency", f"r_{k}.tot AS {k}_monetary_total",
                  f"r_{k}.mn AS {k}_monetary_mean", f"r_{k}.sd AS {k}_monetary_std",
                  f"1 / (r_{k}.rec + 1) + r_{k}.n / (r_{k}.mx_n + 1) + r_{k}.tot / (r_{k}.mx_t + 1) AS {k}_rfm_score"]
        joins.append(
            f"LEFT JOIN (SELECT *, max(n) OVER () AS mx_n, max(tot) OVER () AS mx_t FROM (SELECT {k}, "
            f"((SELECT max(TransactionDT) FROM {learnt}) - max(TransactionDT)) / 3600.0::DOUBLE AS rec, count(*) AS n, "
            f"sum(TransactionAmt) AS tot, avg(TransactionAmt) AS mn, stddev_samp(TransactionAmt) AS sd "
            f"FROM {learnt} WHERE {k} IS NOT NULL GROUP BY {k})) r_{k} ON ful.{k} = r_{k}.{k}")
    return " ".join(cols), f"SELECT TransactionID, {', '.join(picks)} FROM ful {' '.join(joins)}"


def _gap_sql(keys, learnt: str = "") -> tuple[str, str]:
    cols, gaps, stats, picks = [ID], [], [], []
    for k in keys:
        cols += [f"{k}_mean_gap:d", f"{k}_std_gap:d", f"{k}_min_gap:d", f"{k}_max_gap:d", f"{k}_unusual_gap:i"]
        gaps.append(f"(TransactionDT - lag(TransactionDT) OVER (PARTITION BY {k} ORDER BY TransactionDT, TransactionID))"
                    f" / 3600.0::DOUBLE AS g_{k}")
        for label, f in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")):
            stats.append(f"{f}(g_{k}) {learnt} OVER (PARTITION BY {k}) AS {label}_{k}")
            picks.append(f"CASE WHEN {k} IS NOT NULL THEN {label}_{k} END AS {k}_{label}_gap")
        picks.append(
            f"CASE WHEN {k} IS NOT NULL AND (g_{k} > mean_{k} + 2 * std_{k} OR g_{k} < mean_{k} - 2 * std_{k}) "
            f"THEN 1 ELSE 0 END AS {k}_unusual_gap")
    sql = (f"SELECT TransactionID, {', '.join(picks)} FROM (SELECT *, {', '.join(stats)} FROM "
           f"(SELECT *, {', '.join(gaps)} FROM ful))")
    return " ".join(cols), sql


_PATTERN_COLS = (f"{ID} DT_hour:i DT_day_of_week:i is_business_hours:i is_late_night:i hour_sin:d hour_cos:d "
                 "day_sin:d day_cos:d time_of_day:s")
_PATTERN_SQL = """SELECT TransactionID, h AS DT_hour, d AS DT_day_of_week,
  CASE WHEN h >= 9 AND h < 17 THEN 1 ELSE 0 END AS is_business_hours, CASE WHEN h < 6 THEN 1 ELSE 0 END AS is_late_night,
  sin(2 * pi() * h / 24) AS hour_sin, cos(2 * pi() * h / 24) AS hour_cos,
  sin(2 * pi() * d / 7) AS day_sin, cos(2 * pi() * d / 7) AS day_cos,
  CASE WHEN h <= 6 THEN 'night' WHEN h <= 12 THEN 'morning' WHEN h <= 18 THEN 'afternoon' ELSE 'evening' END AS time_of_day
FROM (SELECT TransactionID, hour(c) AS h, isodow(c) - 1 AS d FROM
  (SELECT TransactionID, TIMESTAMP '2017-12-01 00:00:00' + to_seconds(TransactionDT) AS c FROM ful))"""

_since_cols, _since_picks = _since_sql(temporal.SINCE_KEYS)
register("time_since", _since_cols,
         lambda spark, sf: temporal.create_time_since_features(fixture.joined(spark, sf))[0],
         f"SELECT TransactionID, {_since_picks} FROM ful")

_vel_cols, _vel_picks = _velocity_sql(temporal.VELOCITY_KEYS)
register("velocity", _vel_cols,
         lambda spark, sf: temporal.create_velocity_features(fixture.joined(spark, sf))[0],
         f"SELECT TransactionID, {_vel_picks} FROM ful")

_rfm_cols, _rfm_text = _rfm_sql(temporal.RFM_KEYS)
register("rfm", _rfm_cols, lambda spark, sf: temporal.create_rfm_features(fixture.joined(spark, sf))[0], _rfm_text)

_gap_cols, _gap_text = _gap_sql(temporal.GAP_KEYS)
register("gap_stats", _gap_cols,
         lambda spark, sf: temporal.create_transaction_gap_features(fixture.joined(spark, sf))[0], _gap_text)

register("time_patterns", _PATTERN_COLS,
         lambda spark, sf: temporal.create_time_pattern_features(fixture.joined(spark, sf))[0], _PATTERN_SQL)

register(
    "temporal_all",
    " ".join(dict.fromkeys(" ".join([_since_cols, _vel_cols, _rfm_cols, _PATTERN_COLS, _gap_cols]).split())),
    lambda spark, sf: temporal.create_temporal_features(fixture.joined(spark, sf))[0],
    f"""SELECT * FROM (SELECT TransactionID, {_since_picks} FROM ful)
JOIN (SELECT TransactionID, {_vel_picks} FROM ful) USING (TransactionID)
JOIN ({_rfm_text}) USING (TransactionID)
JOIN ({_PATTERN_SQL}) USING (TransactionID)
JOIN ({_gap_text}) USING (TransactionID)""")


# --- everything ------------------------------------------------------------------------------

_FINAL = "card1_mean:d card1_median:d ProductCD_median:d addr_comb_count:i card1_addr1_ProductCD_count:i"
register(
    "features_all",
    f"{ID} total_missing_count:i {_FINAL} " + " ".join(
        c for c in " ".join([_vel_cols, _rfm_cols, _gap_cols]).split() if c != ID),
    lambda spark, sf: pipeline.build_features(fixture.joined(spark, sf))[0],
    f"""WITH {_KEYED}, m AS (SELECT TransactionID, total_missing_count FROM (SELECT TransactionID, {' + '.join(
        f'CAST({c} IS NULL AS INT)' for c in (
            'card2', 'card4', 'card5', 'card6', 'addr1', 'addr2', 'P_emaildomain', 'R_emaildomain', 'D1', 'D2', 'M1', 'M2', 'V3',
            'DeviceType', 'DeviceInfo', 'id_30', 'id_31', 'id_33'))} AS total_missing_count FROM ful)),
c AS (SELECT TransactionID, avg(TransactionAmt) OVER (PARTITION BY card1) AS card1_mean, quantile_cont(TransactionAmt, 0.5) OVER
  (PARTITION BY card1) AS card1_median, quantile_cont(TransactionAmt, 0.5) OVER (PARTITION BY ProductCD) AS ProductCD_median,
  count(*) OVER (PARTITION BY addr_combined) AS addr_comb_count, count(*) OVER (PARTITION BY
  {_sql_combo('card1', 'addr1', 'ProductCD')}) AS card1_addr1_ProductCD_count FROM keyed)
--
SELECT * FROM m JOIN c USING (TransactionID) JOIN (SELECT TransactionID, {_vel_picks} FROM ful) USING (TransactionID)
JOIN ({_rfm_text}) USING (TransactionID) JOIN ({_gap_text}) USING (TransactionID)""")

# --- learnt on the first days, for all rows --------------------------------------------------

_LEARNT_DAYS = 20
_EARLY = f"TransactionDT < {_LEARNT_DAYS * 86400}"
_MISSING_OF = ("card2", "card4", "card5", "card6", "addr1", "addr2", "P_emaildomain", "R_emaildomain", "D1", "D2", "M1", "M2", "V3",
               "DeviceType", "DeviceInfo", "id_30", "id_31", "id_33")


def _fitted(spark: SparkSession, sf: str) -> DataFrame:
    """Features of the first days and of the days after them, which know the first days' statistics and state only."""
    df = fixture.joined(spark, sf)
    early = df.where(_EARLY)
    builder = pipeline.FeatureBuilder()
    first = builder.fit_transform(early)
    return first.unionByName(builder.transform(df.where(f"NOT {_EARLY}")))


_rfm_learnt = _rfm_sql(temporal.RFM_KEYS, "early")[1]
_gap_learnt = _gap_sql(temporal.GAP_KEYS, f"FILTER (WHERE {_EARLY})")[1]
register(
    "features_fitted",
    f"{ID} total_missing_count:i missing_above_avg:i missing_below_avg:i ProductCD_avg_missing:d card1_avg_missing:d "
    "email_both_missing:i card_missing_count:i M_missing_count:i card1_mean:d card1_std:d ProductCD_max:d amt_bin:s card1_addr1:s "
    "card1_addr1_count:i card1_addr1_fraud_rate:d " + " ".join(dict.fromkeys(
        c for c in " ".join([_since_cols, _vel_cols, _rfm_cols, _PATTERN_COLS, _gap_cols]).split() if c != ID)),
    _fitted,
    f"""WITH early AS (SELECT * FROM ful WHERE {_EARLY}),
g AS (SELECT avg(isFraud) AS gr FROM early),
m AS (SELECT TransactionID, TransactionDT, ProductCD, card1, card2, card4, card5, card6, M1, M2, P_emaildomain, R_emaildomain, TransactionAmt,
  {' + '.join(f'CAST({c} IS NULL AS INT)' for c in _MISSING_OF)} AS total_missing_count FROM ful),
a AS (SELECT TransactionID, total_missing_count,
  CASE WHEN total_missing_count > 1.5 * (SELECT avg(total_missing_count) FROM m WHERE {_EARLY}) THEN 1 ELSE 0 END AS missing_above_avg,
  CASE WHEN total_missing_count < 0.5 * (SELECT avg(total_missing_count) FROM m WHERE {_EARLY}) THEN 1 ELSE 0 END AS missing_below_avg,
  avg(total_missing_count) FILTER (WHERE {_EARLY}) OVER (PARTITION BY ProductCD) AS ProductCD_avg_missing,
  avg(total_missing_count) FILTER (WHERE {_EARLY}) OVER (PARTITION BY card1) AS card1_avg_missing,
  CASE WHEN P_emaildomain IS NULL AND R_emaildomain IS NULL THEN 1 ELSE 0 END AS email_both_missing,
  {' + '.join(f'CAST({c} IS NULL AS INT)' for c in ('card2', 'card4', 'card5', 'card6'))} AS card_missing_count,
  CAST(M1 IS NULL AS INT) + CAST(M2 IS NULL AS INT) AS M_missing_count,
  avg(TransactionAmt) FILTER (WHERE {_EARLY}) OVER (PARTITION BY card1) AS card1_mean,
  stddev_samp(TransactionAmt) FILTER (WHERE {_EARLY}) OVER (PARTITION BY card1) AS card1_std,
  max(TransactionAmt) FILTER (WHERE {_EARLY}) OVER (PARTITION BY ProductCD) AS ProductCD_max,
  CASE WHEN TransactionAmt <= 0 THEN 'nan' WHEN TransactionAmt <= 50 THEN 'low' WHEN TransactionAmt <= 150 THEN 'medium'
  WHEN TransactionAmt <= 500 THEN 'high' WHEN TransactionAmt > 500 THEN 'very_high' ELSE 'nan' END AS amt_bin FROM m),
c AS (SELECT TransactionID, {_EARLY} AS own, isFraud, {_sql_combo(*_PAIR)} AS card1_addr1, {_FOLD_SQL.format('TransactionID')} % 5 AS fold FROM ful),
t AS (SELECT card1_addr1, count(*) AS n, sum(isFraud) AS s FROM c WHERE own GROUP BY ALL),
f AS (SELECT card1_addr1, fold, count(*) AS n, sum(isFraud) AS s FROM c WHERE own GROUP BY ALL),
r AS (SELECT TransactionID, c.card1_addr1, coalesce(t.n, 0) AS card1_addr1_count,
  CASE WHEN own THEN (t.s - f.s + 10 * (SELECT gr FROM g)) / (t.n - f.n + 10)
  ELSE (coalesce(t.s, 0) + 10 * (SELECT gr FROM g)) / (coalesce(t.n, 0) + 10) END AS card1_addr1_fraud_rate
  FROM c LEFT JOIN t ON t.card1_addr1 = c.card1_addr1 LEFT JOIN f ON c.card1_addr1 = f.card1_addr1 AND c.fold = f.fold)
--
SELECT * FROM a JOIN r USING (TransactionID) JOIN (SELECT TransactionID, {_since_picks} FROM ful) USING (TransactionID)
JOIN (SELECT TransactionID, {_vel_picks} FROM ful) USING (TransactionID) JOIN ({_rfm_learnt}) USING (TransactionID)
JOIN ({_PATTERN_SQL}) USING (TransactionID) JOIN ({_gap_learnt}) USING (TransactionID)""")
