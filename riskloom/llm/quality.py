"""Quality scores of documents from trusted positives and unlabelled text.

Positive-unlabelled learning: with class prior p, squared loss and a linear score f the non-negative risk

    p E_pos[(1 - f)^2] + max(0, E_all[(1 + f)^2] - p E_pos[(1 + f)^2])

depends on the data only through first and second moments of the features, over the positives and over
all text. One pass with partial sums collects these, over every document; the minimisation then runs on
tables whose size depends on the number of features alone. The prior is the share of positives among
the labelled rows that may be learnt from. A logistic curve, fitted to counts of those rows by score,
turns f into a probability.

Features are shares of byte-class couples (letter case, digits, blanks, kinds of punctuation, bytes over
127) and the repetition of words and lines, of the whole text; nothing but the text is an input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import small_batches, step, text_or_empty

THRESHOLD = 0.7
#: Score bins from which the logistic curve is fitted.
BINS = 512
#: Weight of the penalty on the coefficients, and rounds of the non-negative correction.
RIDGE, ROUNDS = 1e-4, 300

_GROUPS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".", ",;:", "!?", "|",
           "'\"()[]{}<>-")
_KINDS = len(_GROUPS) + 2  # all other ASCII, bytes over 127
_CLASS = np.full(256, len(_GROUPS), dtype=np.uint8)
for _n, _group in enumerate(_GROUPS):
    _CLASS[[ord(c) for c in _group]] = _n
_CLASS[128:] = len(_GROUPS) + 1
N_FEATURES = _KINDS * _KINDS + 7


def features(texts: list[bytes]) -> np.ndarray:
    """One row of ``N_FEATURES`` numbers per text; the last is the constant 1."""
    out = np.zeros((len(texts), N_FEATURES))
    for row, text in zip(out, texts):
        kinds = _CLASS[np.frombuffer(text, dtype=np.uint8)]
        if len(kinds) > 1:
            couples = np.bincount(kinds[:-1].astype(np.intp) * _KINDS + kinds[1:], minlength=_KINDS * _KINDS)
            row[:_KINDS * _KINDS] = np.sqrt(couples / (len(kinds) - 1))
        words, lines = text.split(), text.split(b"\n")
        if words:
            # Repetition against what a text of this length has anyway: different words grow as a power of all.
            row[-7] = len(set(words)) / len(words) ** 0.85
            row[-6] = len(set(lines)) / len(lines)
            row[-5] = min(1.0, len(text) / len(words) / 20)
            row[-4] = sum(a == b for a, b in zip(words, words[1:])) / len(words)
        row[-3] = np.log1p(len(text)) / 10
        row[-2] = np.exp(-len(text) / 200)
        row[-1] = 1.0
    return out


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the ids whose labels are never learnt from: crc32 of the id as text leaves 2 on division by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass(frozen=True)
class QualityModel:
    """A fitted scorer; small, its size depends on the number of features alone."""

    weights: np.ndarray
    slope: float
    shift: float
    prior: float

    def score(self, text: Column) -> Column:
        """Probability that a whole text is of label 1; a null text counts as empty."""
        weights, slope, shift = self.weights, self.slope, self.shift

        @F.arrow_udf("double")
        def scored(texts: pa.Array) -> pa.Array:
            out = []
            for at in range(0, len(texts), 256):
                rows = features([(t or "").encode("utf-8", "surrogatepass") for t in texts.slice(at, 256).to_pylist()])
                out.append(1.0 / (1.0 + np.exp(-np.clip(slope * (rows @ weights) + shift, -500, 500))))
            return pa.array(np.concatenate(out) if out else [], pa.float64())

        return scored(F.coalesce(text.cast("string"), F.lit("")))


def labelled_features(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                      label: str = "quality") -> DataFrame:
    """(label, x) per document, written once: x is float16 features, label null where it may not be learnt from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                rows = features([t.encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()])
                x = [r.tobytes() for r in rows.astype("<f2")]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.binary())], ["doc_id", "x"])

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & ~held_out(doc_id)).groupBy(
        F.col(doc_id).cast("long").alias("doc_id")).agg(F.min(label).cast("int").alias("label"))
    with small_batches(docs.sparkSession):
        return step(slim.mapInArrow(run, "doc_id long, x binary").join(known, "doc_id", "left").select("label", "x"))


def moments(rows: DataFrame) -> dict[str, tuple[int, np.ndarray, np.ndarray]]:
    """For 'all' rows and the 'pos' (label 1) ones: count, mean feature vector, mean outer product."""
    d = N_FEATURES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {"all": np.zeros((d, d)), "pos": np.zeros((d, d))}
        for batch in batches:
            if batch.num_rows:
                x = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<f2").reshape(-1, d).astype(float)
                positive = np.array([v == 1 for v in batch.column(0).to_pylist()])
                sums["all"] += x.T @ x
                sums["pos"] += x[positive].T @ x[positive]
        for kind, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([kind] * d), pa.array(range(d), pa.int32()), pa.array(list(total))], ["kind", "i", "row"])

    # d numbers for each of d rows and two kinds leave every task and are summed on the way.
    parts = rows.mapInArrow(run, "kind string, i int, row array<double>")
    cells = parts.select("kind", "i", F.posexplode("row").alias("j", "value")).groupBy("kind", "i", "j").agg(F.sum("value").alias("value"))
    out = {kind: np.zeros((d, d)) for kind in ("all", "pos")}
    for r in cells.collect():  # 2 d^2 numbers, whatever the data
        out[r["kind"]][r["i"], r["j"]] = r["value"]
    # The last feature is the constant 1, so its row holds the sums and its square the count.
    return {k: (int(round(m[-1, -1])), m[-1] / max(m[-1, -1], 1), m / max(m[-1, -1], 1)) for k, m in out.items()}


def minimise_risk(prior: float, pos: tuple, every: tuple, ridge: float = RIDGE, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of the linear score with the least non-negative risk."""
    (_, mean_p, square_p), (_, mean_u, square_u) = pos, every
    penalty = ridge * np.eye(len(mean_p))
    penalty[-1, -1] = 0.0
    inverse = np.linalg.pinv(square_u + penalty + 1e-9 * np.eye(len(mean_p)))
    weights = inverse @ (2 * prior * mean_p - mean_u)  # the least unbiased risk
    best, least = weights, np.inf
    for n in range(rounds):
        negative = ((1 + 2 * mean_u @ weights + weights @ square_u @ weights)
                    - prior * (1 + 2 * mean_p @ weights + weights @ square_p @ weights))
        positive = prior * (1 - 2 * mean_p @ weights + weights @ square_p @ weights)
        risk = positive + max(0.0, negative) + weights @ penalty @ weights
        if risk < least:
            best, least = weights, risk
        up = mean_u + square_u @ weights - prior * (mean_p + square_p @ weights)
        step = prior * (square_p @ weights - mean_p) + up + penalty @ weights if negative >= 0 else -up
        weights = weights - 0.5 / (1 + 0.05 * n) * inverse @ step
    return best


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        prior: float | None = None) -> QualityModel:
    """Learn a scorer from all texts and the labels of rows that are not held out.

    Of repeated labels of an id the smallest counts; labels other than 0 and 1, null ids and ids without
    a document are left out. Without positives every text scores the prior (0.5 if nothing is labelled).
    Without negatives the score is (1 + f) / 2 kept between 0 and 1 by a steep logistic curve.
    """
    rows = labelled_features(docs, labels, doc_id, text, label)
    at = moments(rows)
    counts = {r["label"]: r["n"] for r in rows.where("label is not null").groupBy("label").agg(F.count("*").alias("n")).collect()}
    ones, zeros = counts.get(1, 0), counts.get(0, 0)
    share = prior if prior is not None else (ones / (ones + zeros) if ones + zeros else 0.5)
    if not ones or not at["all"][0]:
        odds = min(max(share, 1e-3), 1 - 1e-3)
        return QualityModel(np.zeros(N_FEATURES), 0.0, float(np.log(odds / (1 - odds))), share)
    weights = minimise_risk(share, at["pos"], at["all"])
    if not zeros:
        return QualityModel(weights, 4.0, 0.0, share)

    @F.arrow_udf("int")
    def binned(x: pa.Array) -> pa.Array:
        f = np.frombuffer(b"".join(x.to_pylist()), "<f2").reshape(-1, N_FEATURES).astype(float) @ weights
        return pa.array(np.clip((f + 3) / 6 * BINS, 0, BINS - 1).astype(np.int32))

    bins = rows.where("label is not null").groupBy(binned("x").alias("bin"), "label").agg(F.count("*").alias("n")).collect()
    f = np.array([(r["bin"] + 0.5) / BINS * 6 - 3 for r in bins])
    slope, shift = logistic_curve(f, np.array([r["label"] for r in bins]), np.array([r["n"] for r in bins], dtype=float))
    return QualityModel(weights, slope, shift, share)


def logistic_curve(f: np.ndarray, y: np.ndarray, n: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope (never negative) and shift of P(y = 1 | f) from weighted points, slightly damped."""
    x = np.stack([f, np.ones_like(f)], axis=1)
    w, damp = np.array([1.0, 0.0]), np.diag([1e-2, 1e-4])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        slope = x.T @ (n * (p - y)) + damp @ w
        w = w - np.linalg.solve((x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + damp, slope)
        w = np.clip(w, [0.0, -60.0], [60.0, 60.0])
    return float(w[0]), float(w[1])
