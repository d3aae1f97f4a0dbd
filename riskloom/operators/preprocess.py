"""Preprocessing: time parts, imputation, encoding, scaling, downcasts and simple derived columns.

Everything that depends on data is learnt by ``fit`` on the training frame and applied by
``transform`` to any frame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import feature
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import clock
from riskloom.functions.bins import interval_index, labelled
from riskloom.functions.keys import MISSING_TEXT, combined, same
from riskloom.operators.keyed import KeyTable, attach, key_table
from riskloom.operators.ordering import running_totals, time_split
from riskloom.operators.quantiles import column_quantiles, stacked
from riskloom.session import written

NOT_FEATURES = ("TransactionID", "isFraud")
MISSING = "missing"


def create_time_features(df: DataFrame, time: str = "TransactionDT") -> DataFrame:
    """Day, hour, weekday, week, weekend flag and four left-closed day-part flags."""
    t = F.col(time)
    h, d = clock.hour(t), clock.weekday(t)
    return df.withColumns({
        "DT_day_of_week": d, "DT_hour": h, "DT_day": clock.day(t), "DT_week": clock.week(t),
        "DT_is_weekend": F.coalesce(d >= 5, F.lit(False)).cast("int"),
        "DT_is_night": clock.in_range(h, 0, 6), "DT_is_morning": clock.in_range(h, 6, 12),
        "DT_is_afternoon": clock.in_range(h, 12, 18), "DT_is_evening": clock.in_range(h, 18, 24),
    })


def feature_types(df: DataFrame, exclude: Sequence[str] = NOT_FEATURES) -> tuple[list[str], list[str]]:
    """(numeric, categorical) columns; M columns are categorical whatever their type."""
    numeric, categorical = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, T.StringType) or f.name.startswith("M"):
            categorical.append(f.name)
        elif isinstance(f.dataType, T.NumericType):
            numeric.append(f.name)
    return numeric, categorical


# --- value tables ----------------------------------------------------------------------------

def frequency_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, n) over all columns at once; values as text, missing left out."""
    cells = stacked(df, columns, kind="string").where(F.col("value").isNotNull())
    return cells.groupBy("feature", "value").agg(F.count("*").alias("n"))


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, mode): the most frequent value, the smallest one on a tie."""
    best = F.min(F.struct((-F.col("n")).alias("neg"), F.col("value")))
    return frequency_table(df, columns).groupBy("feature").agg(best.alias("b")).select(
        "feature", F.col("b.value").alias("mode"))


def value_codes(counts: DataFrame) -> KeyTable:
    """From (feature, value, n): codes 0..k-1 per feature, in ascending order of its values."""
    steps = running_totals(counts.withColumn("one", F.lit(1)), ["feature", "value"], ["one"])
    # One row per feature.
    first = steps.groupBy("feature").agg(F.min("one_before").alias("start"))
    code = (F.col("one_before") - F.col("start")).cast("int").alias("code")
    return key_table(steps.join(F.broadcast(first), "feature").select(
        F.col("feature").alias("name"), F.col("value").alias("key"), "n", code))


class Imputer:
    """Fill missing cells with a statistic of the training frame."""

    def __init__(self, numeric: Sequence[str], categorical: Sequence[str], numeric_strategy: str = "median",
                 categorical_strategy: str = MISSING):
        if numeric_strategy not in ("mean", "median", "zero"):
            raise ValueError(f"unknown numeric strategy {numeric_strategy}")
        if categorical_strategy not in ("mode", MISSING):
            raise ValueError(f"unknown categorical strategy {categorical_strategy}")
        self.numeric, self.categorical = list(numeric), list(categorical)
        self.numeric_strategy, self.categorical_strategy = numeric_strategy, categorical_strategy
        self.fill: dict[str, object] = {}

    def fit(self, df: DataFrame) -> Imputer:
        """One value per column comes back to the driver."""
        self.fill = {}
        if self.numeric and self.numeric_strategy == "zero":
            self.fill.update(dict.fromkeys(self.numeric, 0.0))
        elif self.numeric and self.numeric_strategy == "mean":
            row = df.agg(*[F.avg(F.col(f"`{c}`")).alias(c) for c in self.numeric]).first()
            self.fill.update({c: row[c] for c in self.numeric if row[c] is not None})
        elif self.numeric:
            table = column_quantiles(df, self.numeric, {"median": 0.5})
            self.fill.update({r["feature"]: r["median"] for r in table.collect()})
        if self.categorical_strategy == MISSING:
            self.fill.update(dict.fromkeys(self.categorical, MISSING))
        elif self.categorical:
            self.fill.update(dict.fromkeys(self.categorical, MISSING))
            self.fill.update({r["feature"]: r["mode"] for r in modes(df, self.categorical).collect()})
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """Whole-number columns become double only where the fill value is not whole."""
        made = {}
        for c, v in self.fill.items():
            if c not in df.columns:
                continue
            kind = df.schema[c].dataType
            if isinstance(kind, T.IntegralType) and float(v) == int(v):
                v = int(v)
            made[c] = F.coalesce(F.col(f"`{c}`"), F.lit(v))
        return df.withColumns(made) if made else df


class LabelEncoder:
    """Text categories to codes 0..n-1 in ascending order; unseen values share the code of 'missing'.

    Codes of all columns come from one ordered pass over the (feature, value) table.
    """

    def __init__(self, columns: Sequence[str], missing_text: str = MISSING_TEXT):
        self.columns = list(dict.fromkeys(columns))
        self.missing_text = missing_text
        self.codes: KeyTable | None = None
        self.other: dict[str, int] = {}

    def _text(self, df: DataFrame, c: str) -> Column:
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(self.missing_text))

    def fit(self, df: DataFrame) -> LabelEncoder:
        text = df.select(*[self._text(df, c).alias(c) for c in self.columns])
        self.codes = value_codes(frequency_table(text, self.columns))
        known = {r["name"]: r["code"] for r in self.codes.table.where(F.col("key") == MISSING).collect()}
        self.other = {c: known.get(c, self.codes.sizes.get(c, (0, 0))[0]) for c in self.columns}
        return self

    def transform(self, df: DataFrame, **options) -> DataFrame:
        here = [c for c in self.columns if c in df.columns]
        keys = {c: self._text(df, c) for c in here}
        out = attach(df, keys, self.codes, {c: {f"_code_{c}": "code"} for c in here}, **options)
        made = {c: F.coalesce(F.col(f"_code_{c}"), F.lit(self.other[c])) for c in here}
        return out.withColumns(made).select(*df.columns) if made else df


class OneHotEncoder:
    """``<column>_<value>`` flags for the values seen at fit.

    A column with over ``max_values`` values gets one sparse vector ``<column>_values`` instead, with a place per
    value in ascending order; its values stay in a table. Missing and unseen values set nothing.
    """

    def __init__(self, columns: Sequence[str], max_values: int = 1000):
        self.columns, self.max_values = list(columns), max_values
        self.values: dict[str, list[str]] = {}
        self.wide: dict[str, int] = {}
        self.codes: KeyTable | None = None

    def fit(self, df: DataFrame) -> OneHotEncoder:
        counts = written(frequency_table(df, self.columns))
        sizes = {r["feature"]: r["k"] for r in counts.groupBy("feature").agg(F.count("*").alias("k")).collect()}
        self.wide = {c: sizes[c] for c in self.columns if sizes.get(c, 0) > self.max_values}
        many = F.col("feature").isin(list(self.wide))
        rows = counts.where(~many).select("feature", "value").collect()
        self.values = {c: sorted(r["value"] for r in rows if r["feature"] == c) for c in self.columns if c not in self.wide}
        self.codes = value_codes(counts.where(many)) if self.wide else None
        return self

    def transform(self, df: DataFrame, **options) -> DataFrame:
        made = {f"{c}_{v}": F.coalesce(F.col(c).cast("string") == v, F.lit(False)).cast("int")
                for c, vs in self.values.items() for v in vs}
        out = df.withColumns(made) if made else df
        wide = {c: f"_code_{c}" for c in self.wide if c in df.columns}
        if not wide:
            return out
        out = attach(out, {c: F.col(f"`{c}`").cast("string") for c in wide}, self.codes,
                     {c: {code: "code"} for c, code in wide.items()}, **options)
        # The code after the last value is the one that the vector leaves out.
        none = {code: F.lit(self.wide[c]) for c, code in wide.items()}
        out = out.withColumns({code: F.coalesce(F.col(f"`{code}`"), n) for code, n in none.items()})
        vectors = feature.OneHotEncoder(inputCols=list(none), outputCols=[f"{c}_values" for c in wide], dropLast=True)
        return vectors.fit(df.sparkSession.range(1).select(*[n.alias(code) for code, n in none.items()])).transform(out).drop(*none)


class StandardScaler:
    """Zero mean and unit population deviation, learnt on one frame; a constant column keeps scale 1."""

    def __init__(self, columns: Sequence[str]):
        self.columns = list(columns)
        self.stats: dict[str, tuple[float, float]] = {}

    def fit(self, df: DataFrame) -> StandardScaler:
        aggs = [f(F.col(f"`{c}`")).alias(f"{tag}{i}") for i, c in enumerate(self.columns)
                for tag, f in (("m", F.avg), ("s", F.stddev_pop))]
        row = df.agg(*aggs).first()
        self.stats = {c: (row[f"m{i}"], row[f"s{i}"] or 1.0) for i, c in enumerate(self.columns)
                      if row[f"m{i}"] is not None}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        made = {c: (F.col(f"`{c}`") - m) / s for c, (m, s) in self.stats.items() if c in df.columns}
        return df.withColumns(made) if made else df


class Preprocessor:
    """Time parts, type detection, imputation, label codes and optional scaling, as one fitted chain."""

    def __init__(self, test_size: float = 0.2, time_features: bool = True, impute: bool = True,
                 encode: bool = True, normalize: bool = False, numeric_strategy: str = "median",
                 categorical_strategy: str = MISSING):
        self.test_size = test_size
        self.flags = (time_features, impute, encode, normalize)
        self.strategies = (numeric_strategy, categorical_strategy)
        self.numeric: list[str] = []
        self.categorical: list[str] = []
        self.steps: list = []

    def fit(self, df: DataFrame) -> Preprocessor:
        time_features, impute, encode, normalize = self.flags
        out = create_time_features(df) if time_features else df
        self.numeric, self.categorical = feature_types(out)
        self.steps = []
        if impute:
            self.steps.append(Imputer(self.numeric, self.categorical, *self.strategies).fit(out))
            out = self.steps[-1].transform(out)
        if encode:
            self.steps.append(LabelEncoder(self.categorical).fit(out))
            out = self.steps[-1].transform(out)
        if normalize:
            self.steps.append(StandardScaler(self.numeric).fit(out))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        out = create_time_features(df) if self.flags[0] else df
        for step in self.steps:
            out = step.transform(out)
        return out

    def time_based_split(self, df: DataFrame, test_size: float | None = None) -> tuple[DataFrame, DataFrame]:
        return time_split(df, self.test_size if test_size is None else test_size)


def quick_preprocess(transactions: DataFrame, identities: DataFrame, test_size: float = 0.2,
                     normalize: bool = False) -> tuple[DataFrame, DataFrame, list[str]]:
    """Join, split by time, fit on the early part, transform both: (train, validation, feature names)."""
    full = transactions.join(identities, "TransactionID", "left")
    early, late = time_split(full, test_size)
    chain = Preprocessor(test_size, normalize=normalize).fit(early)
    train, valid = chain.transform(early), chain.transform(late)
    return train, valid, [c for c in train.columns if c not in NOT_FEATURES]


# --- downcast --------------------------------------------------------------------------------

# Strict bounds of the smaller whole-number types and of a 32-bit float.
INT_BOUNDS = {"tinyint": (-128, 127), "smallint": (-32768, 32767), "int": (-2147483648, 2147483647)}
FLOAT_MAX = 3.4028234663852886e38


def downcast_plan(df: DataFrame) -> DataFrame:
    """(feature, low, high, new_type) for every numeric column, from one pass over the data."""
    fields = [f for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    aggs = [g(F.col(f"`{f.name}`").cast("double")).alias(f"{tag}{i}")
            for i, f in enumerate(fields) for tag, g in (("lo", F.min), ("hi", F.max))]
    rows = [F.struct(F.lit(f.name).alias("feature"), F.lit(isinstance(f.dataType, T.IntegralType)).alias("whole"),
                     F.col(f"lo{i}").alias("low"), F.col(f"hi{i}").alias("high")) for i, f in enumerate(fields)]
    table = df.agg(*aggs).select(F.inline(F.array(*rows)))
    inside = {t: (F.col("low") > a) & (F.col("high") < b) for t, (a, b) in INT_BOUNDS.items()}
    whole = F.when(inside["tinyint"], "tinyint").when(inside["smallint"], "smallint").when(
        inside["int"], "int").otherwise("bigint")
    real = F.when((F.col("low") > -FLOAT_MAX) & (F.col("high") < FLOAT_MAX), "float").otherwise("double")
    return table.select("feature", "low", "high", F.when(F.col("whole"), whole).otherwise(real).alias("new_type"))


def downcast(df: DataFrame) -> DataFrame:
    kinds = {r["feature"]: r["new_type"] for r in downcast_plan(df).collect()}
    return df.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in df.columns])


# --- derived columns -------------------------------------------------------------------------

def quantile_edges(df: DataFrame, value: str, q: int = 10) -> list[float]:
    """Distinct exact q-quantile edges of a column (at most q + 1 numbers)."""
    probs = {f"e{i}": i / q for i in range(q + 1)}
    row = column_quantiles(df, [value], probs).first()
    if row is None:
        return []
    edges: list[float] = []
    for e in row[1:]:
        if not edges or e != edges[-1]:
            edges.append(e)
    return edges


def quantile_bins(df: DataFrame, value: str, name: str, q: int = 10) -> DataFrame:
    """Equal-frequency bin number, lowest value included, repeated edges dropped."""
    edges = quantile_edges(df, value, q)
    if len(edges) < 2:
        return df.withColumn(name, F.lit(None).cast("int"))
    return df.withColumn(name, interval_index(F.col(value), edges, include_lowest=True))


def amount_features(df: DataFrame, amount: str = "TransactionAmt", q: int = 10) -> DataFrame:
    a = F.col(amount)
    out = df.withColumns({
        f"{amount}_log": F.log1p(a),
        f"{amount}_decimal": a - a.cast("long"),
        f"{amount}_is_round": F.coalesce(a == F.bround(a), F.lit(False)).cast("int"),
    })
    return quantile_bins(out, amount, f"{amount}_bin", q)


# Providers counted as common.
COMMON_PROVIDERS = ("gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "aol.com")


def email_features(df: DataFrame) -> DataFrame:
    """Top-level domain, common-provider flag per side, and whether both sides match."""
    made = {}
    for side in ("P", "R"):
        c = f"{side}_emaildomain"
        if c in df.columns:
            made[f"{side}_email_tld"] = F.element_at(F.split(F.coalesce(F.col(c), F.lit("unknown")), r"\."), -1)
            made[f"{side}_email_is_common"] = F.coalesce(F.col(c).isin(*COMMON_PROVIDERS), F.lit(False)).cast("int")
    if len(made) == 4:
        made["email_domains_match"] = same("P_emaildomain", "R_emaildomain")
    return df.withColumns(made) if made else df


# Device keywords, matched without case.
DEVICE_WORDS = ("SM", "Windows", "iOS")


def device_features(df: DataFrame, device: str = "DeviceInfo") -> DataFrame:
    """First word, text length and keyword flags of the device description."""
    if device not in df.columns:
        return df
    text = F.coalesce(F.col(device), F.lit(""))
    first = F.element_at(F.split(F.trim(F.coalesce(F.col(device), F.lit("unknown"))), r"\s+"), 1)
    return df.withColumns({
        f"{device}_device": first, f"{device}_length": F.length(text),
        **{f"{device}_has_{w}": F.contains(F.lower(text), F.lit(w.lower())).cast("int") for w in DEVICE_WORDS},
    })


def product_columns(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """New column -> (a, b): the product a * b; pairs with an absent column are skipped."""
    have = set(df.columns)
    made = {n: F.col(a) * F.col(b) for n, (a, b) in pairs.items() if {a, b} <= have}
    return df.withColumns(made) if made else df


# The default numeric products.
NUMERIC_PRODUCTS = {
    "card1_TransactionAmt_interaction": ("card1", "TransactionAmt_log"),
    "hour_TransactionAmt_interaction": ("DT_hour", "TransactionAmt_log"),
    "dayofweek_TransactionAmt_interaction": ("DT_day_of_week", "TransactionAmt_log"),
    "C1_C2_interaction": ("C1", "C2"),
    "D1_D2_interaction": ("D1", "D2"),
}


def address_match(df: DataFrame) -> DataFrame:
    return df.withColumns({"addr_match": same("addr1", "addr2"), "addr_combined": combined("addr1", "addr2")})


def hour_bins(df: DataFrame, include_lowest: bool) -> DataFrame:
    """Day-part label of DT_hour; without include_lowest hour 0 has none."""
    return df.withColumn("DT_hour_bin", labelled(
        F.col("DT_hour"), (0, 6, 12, 18, 24), ("night", "morning", "afternoon", "evening"), include_lowest))
