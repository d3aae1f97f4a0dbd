"""Interaction features: composite categories, how often each occurs and how often it is positive."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.bins import INFINITY, labelled
from riskloom.functions.keys import MISSING_TEXT, as_text, combined
from riskloom.operators.keyed import KeyTable, attach, columns_as_keys, key_rows, key_table
from riskloom.operators.ordering import hash_number
from riskloom.session import written

# Smoothing weight and default smallest group with a rate of its own.
SMOOTHING = 10
MIN_SAMPLES = 10

# Amount bands, closed on the right.
AMOUNT_EDGES = (0, 50, 150, 500, INFINITY)
AMOUNT_LABELS = ("low", "medium", "high", "very_high")

_CARDS = ("card1", "card2", "card4", "card6")

# Family -> {composite name: its parts}.
FAMILIES: dict[str, dict[str, tuple[str, ...]]] = {
    "card_addr": {f"{c}_{a}": (c, a) for c in ("card1", "card2") for a in ("addr1", "addr2")},
    "card_email": {f"{c}_{e}": (c, e) for c in _CARDS for e in ("P_emaildomain", "R_emaildomain")},
    "device_browser": {f"{d}_id_31": (d, "id_31") for d in ("DeviceType", "DeviceInfo", "id_30")},
    "amt_product": {"amt_bin_ProductCD": ("amt_bin", "ProductCD")},
    "card_product": {f"{c}_ProductCD": (c, "ProductCD") for c in _CARDS},
    "three_way": {
        "card1_addr1_ProductCD": ("card1", "addr1", "ProductCD"),
        "card1_email_ProductCD": ("card1", "P_emaildomain", "ProductCD"),
        "device_browser_ProductCD": ("DeviceType", "id_31", "ProductCD"),
    },
}


def amount_band(value: Column) -> Column:
    return F.coalesce(labelled(value, AMOUNT_EDGES, AMOUNT_LABELS), F.lit(MISSING_TEXT))


def target_rate(df: DataFrame, keys: Sequence[str], target: str = "isFraud",
                min_samples: int = MIN_SAMPLES, global_rate: Column | None = None) -> DataFrame:
    """Per group: positives, rows, rate (overall rate below ``min_samples``) and smoothed rate."""
    overall = global_rate if global_rate is not None else df.agg(F.avg(target)).scalar()
    stats = df.groupBy(*keys).agg(
        F.sum(target).alias("fraud_count"), F.count(target).alias("total_count"), F.avg(target).alias("_mean"),
    )
    return stats.select(
        *keys, "fraud_count", "total_count",
        F.when(F.col("total_count") >= min_samples, F.col("_mean")).otherwise(overall).alias("fraud_rate"),
        ((F.col("fraud_count") + SMOOTHING * overall) / (F.col("total_count") + SMOOTHING)).alias(
            "fraud_rate_smoothed"),
    )


def _smoothed(positives: Column, rows: Column, overall: Column) -> Column:
    return (positives + SMOOTHING * overall) / (rows + SMOOTHING)


def _fold_of(row_id: str, folds: int, seed: int) -> Column:
    return (hash_number(row_id, seed) % folds).cast("int")


def _composites(df: DataFrame, combos: dict[str, tuple[str, ...]]) -> tuple[DataFrame, dict[str, Column]]:
    """The frame with its parts as texts, each of which many composites share, and the composites of those."""
    texts = {c: f"_text_{c}" for p in combos.values() for c in p}
    return df.withColumns({t: as_text(c) for c, t in texts.items()}), {n: F.concat_ws("_", *[F.col(texts[c]) for c in p]) for n, p in combos.items()}


def _rate_sums(source: DataFrame, combos: dict[str, tuple[str, ...]], target: str, folds: int, own: Column) -> DataFrame:
    """(name, key, n, pos, lab): rows, positives and labels per composite, the last two as one entry per fold."""
    source, parts = _composites(source, combos)
    per_fold = lambda c: F.array(*[F.coalesce(F.sum(F.when(F.col("fold") == f, c)), F.lit(0)) for f in range(folds)])
    return key_rows(source, parts, [F.col(target), own.alias("fold")]).groupBy("name", "key").agg(
        F.count("*").alias("n"), per_fold(F.col(target)).alias("pos"), per_fold(F.when(F.col(target).isNotNull(), 1)).alias("lab"))


def _total(entries: str, folds: int) -> Column:
    return reduce(add, [F.col(entries)[f] for f in range(folds)])


def _other_folds(sums: DataFrame, folds: int, overall: Column) -> DataFrame:
    """(name, key, n, n_all, rates): the rate a row of each fold gets, from the rows of the others."""
    rates = [_smoothed(_total("pos", folds) - F.col("pos")[f], _total("lab", folds) - F.col("lab")[f], overall) for f in range(folds)]
    return sums.select("name", "key", "n", F.col("n").alias("n_all"), F.array(*rates).alias("rates"))


def combination_features(df: DataFrame, combos: dict[str, tuple[str, ...]], target: str | None = "isFraud",
                         mode: str = "in_sample", folds: int = 5, seed: int = 42,
                         row_id: str = "TransactionID", source: DataFrame | None = None,
                         sums: DataFrame | None = None, **options) -> tuple[DataFrame, list[str]]:
    """Add the composite key, ``<combo>_count`` and, with a target, ``<combo>_fraud_rate``.

    mode ``in_sample`` uses every row of the group, its own included. ``out_of_fold`` uses only the
    rows of other folds: one aggregation with sums per fold, other-fold sums = total minus own fold.
    Groups are formed from ``source``, the frame itself by default; ``sums`` are its sums per fold if they are there.
    """
    have = set(df.columns)
    combos = {n: p for n, p in combos.items() if set(p) <= have}
    if not combos:
        return df, []
    with_target = target is not None and target in have
    base = df.withColumns({n: combined(*p) for n, p in combos.items()})
    keys = columns_as_keys(base, list(combos))
    source = df if source is None else source
    parts = {n: combined(*p) for n, p in combos.items()}
    outputs = {n: {f"{n}_count": "n_all", **({f"{n}_fraud_rate": "rate"} if with_target else {})} for n in combos}
    if not with_target:
        table = key_rows(source, parts).groupBy("name", "key").agg(F.count("*").alias("n")).withColumn("n_all", F.col("n"))
    elif mode == "in_sample":
        overall = source.agg(F.avg(target)).scalar()
        stats = key_rows(source, parts, [target]).groupBy("name", "key").agg(
            F.count("*").alias("n"), F.sum(target).alias("pos"), F.count(target).alias("lab"))
        table = stats.select("name", "key", "n", F.col("n").alias("n_all"), F.coalesce(
            _smoothed(F.coalesce("pos", F.lit(0)), F.col("lab"), overall), overall).alias("rate"))
    elif mode == "out_of_fold":
        own = _fold_of(row_id, folds, seed)
        sums = _rate_sums(source, combos, target, folds, own) if sums is None else sums
        table = _other_folds(sums, folds, source.agg(F.avg(target)).scalar())
        outputs = {n: {f"{n}_count": "n_all", f"{n}_fraud_rate": "rates"} for n in combos}
        options = {**options, "told": {"rates": lambda c: F.element_at(c, own + 1)}}
    else:
        raise ValueError(f"unknown mode {mode}")
    out = attach(base, keys, key_table(table), outputs, row_id, **options)
    names = [c for n in combos for c in (n, *outputs[n])]
    return out.select(*df.columns, *names), names


def interaction_features(df: DataFrame, families: Sequence[str] = tuple(FAMILIES), target: str | None = "isFraud",
                         mode: str = "in_sample", source: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """Composite features of the chosen families; the amount band is added where it is needed."""
    names: list[str] = []
    base = df
    if "amt_product" in families and {"TransactionAmt", "ProductCD"} <= set(df.columns):
        base = base.withColumn("amt_bin", amount_band(F.col("TransactionAmt")))
        source = None if source is None else source.withColumn("amt_bin", amount_band(F.col("TransactionAmt")))
        names.append("amt_bin")
    combos = {n: p for f in families for n, p in FAMILIES[f].items()}
    out, made = combination_features(base, combos, target, mode, source=source)
    return out, names + made


def create_interaction_features(df: DataFrame, mode: str = "out_of_fold",
                                source: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """All interaction features. The default keeps a row's own label out of its rate."""
    return interaction_features(df, mode=mode, source=source)


class RateEncoder:
    """Smoothed rates and counts learnt on one frame and attached to another (train / test)."""

    def __init__(self, combos: dict[str, tuple[str, ...]], target: str = "isFraud"):
        self.combos, self.target = combos, target
        self.table: KeyTable | None = None
        self.overall: float | None = None

    def fit(self, df: DataFrame) -> RateEncoder:
        self.combos = {n: p for n, p in self.combos.items() if set(p) <= set(df.columns)}
        self.overall = df.agg(F.avg(self.target)).first()[0]
        keys = {n: combined(*p) for n, p in self.combos.items()}
        stats = key_rows(df, keys, [self.target]).groupBy("name", "key").agg(
            F.count("*").alias("n"), F.coalesce(F.sum(self.target), F.lit(0)).alias("pos"),
            F.count(self.target).alias("lab"))
        return self._learnt(stats)

    def _learnt(self, stats: DataFrame) -> RateEncoder:
        """Keep the rates of (name, key, n, pos, lab)."""
        self.table = key_table(stats.select(
            "name", "key", "n", _smoothed(F.col("pos"), F.col("lab"), F.lit(self.overall)).alias("rate")))
        return self

    def fit_transform(self, df: DataFrame, folds: int = 5, seed: int = 42, row_id: str = "TransactionID",
                      source: DataFrame | None = None, **options) -> DataFrame:
        """Learn from ``df`` and attach rates to its own rows that leave out the row's fold, its own label included.

        ``source`` has the rows of ``df`` as they were before features were attached; rates are learnt from there if it is given.
        """
        source = df if source is None else source
        self.combos = {n: p for n, p in self.combos.items() if set(p) <= set(source.columns)}
        self.overall = source.agg(F.avg(self.target)).first()[0]
        # One aggregation serves both: rates of all rows for later frames, rates of the other folds for these rows.
        sums = written(_rate_sums(source, self.combos, self.target, folds, _fold_of(row_id, folds, seed)))
        self._learnt(sums.withColumns({"pos": _total("pos", folds), "lab": _total("lab", folds)}))
        return combination_features(df, self.combos, self.target, "out_of_fold", folds, seed, row_id, source, sums, **options)[0]

    def transform(self, df: DataFrame, **options) -> DataFrame:
        """For frames other than the one learnt from, whose rows know their own label. Unseen composites get the overall rate and a count of 0."""
        base = df.withColumns({n: combined(*p) for n, p in self.combos.items()})
        outputs = {n: {f"{n}_count": "n", f"{n}_fraud_rate": "rate"} for n in self.combos}
        out = attach(base, columns_as_keys(base, list(self.combos)), self.table, outputs, **options)
        filled = {f"{n}_count": F.coalesce(F.col(f"{n}_count"), F.lit(0)) for n in self.combos}
        filled.update({f"{n}_fraud_rate": F.coalesce(F.col(f"{n}_fraud_rate"), F.lit(self.overall)) for n in self.combos})
        return out.withColumns(filled).select(*df.columns, *[c for n in self.combos for c in (n, *outputs[n])])
