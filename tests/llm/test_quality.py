import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from riskloom.llm import packing, quality
from tests.conftest import SF
from tests.llm.frames import awkward, empty, sentence

LABELS = "doc_id long, quality int, toxic int"


def corpus(spark, n=600):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        text = sentence(rng, rng.randint(20, 60)) + "."
        rows.append((i, text if good else text.upper().replace(" ", "!! ")))
        if rng.random() < 0.5:
            labels.append((i, int(good), 0))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, LABELS), labels


def test_held_out_accuracy(spark):
    docs, table, labels = corpus(spark)
    model = quality.fit(docs, table)
    score = {r["doc_id"]: r["s"] for r in docs.select("doc_id", model.score(F.col("text")).alias("s")).collect()}
    held = [(score[i] >= 0.7) == q for i, q, _ in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 40 and np.mean(held) > 0.97
    assert 0.7 < model.prior < 0.9 and all(0 <= s <= 1 for s in score.values())


def test_held_out_labels_are_not_read(spark):
    docs, table, _ = corpus(spark, 200)
    turned = table.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit(docs, table), quality.fit(docs, turned)
    assert np.allclose(a.weights, b.weights, atol=1e-6) and a.prior == b.prior


def test_accuracy_on_the_tables(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    rows = docs.join(labels, "doc_id").where(quality.held_out()).select("quality", model.score(F.col("text")).alias("s")).collect()
    assert np.mean([(r["s"] >= quality.THRESHOLD) == r["quality"] for r in rows]) > 0.8


def test_both_labels_are_told_apart_on_the_tables(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    rows = docs.join(labels, "doc_id").where(quality.held_out()).select("quality", model.score(F.col("text")).alias("s")).collect()
    label, score = np.array([r["quality"] for r in rows]), np.array([r["s"] for r in rows])
    good, bad = score[label == 1], score[label == 0]
    assert len(bad) >= 10 and np.mean(good[:, None] > bad) > 0.97
    assert np.mean(good >= quality.THRESHOLD) > 0.95 and np.mean(bad < quality.THRESHOLD) > 0.9


@pytest.mark.parametrize("labels", [[], [(5, 1, 0)], [(None, 1, None), (5, None, 0), (5, 1, 0), (5, 0, 0), (8, 7, 1), (9, 1, 0), (99, 0, 0)]])
def test_awkward_rows(spark, labels):
    docs, table = awkward(spark), spark.createDataFrame(labels, LABELS)
    rows = docs.select(quality.fit(docs, table).score(F.col("text")).alias("s")).collect()
    assert len(rows) == docs.count() and all(0 <= r["s"] <= 1 for r in rows)
    model = quality.fit(empty(spark), table)
    assert empty(spark).select(model.score(F.col("text"))).count() == 0


def test_risk_never_falls_below_the_closed_form_start():
    rng = np.random.default_rng(0)
    pos, rest = rng.normal(1, 1, (200, 4)), rng.normal(-1, 1, (100, 4))
    pos[:, -1] = rest[:, -1] = 1
    every = np.concatenate((pos, rest))
    moments = lambda x: (len(x), x.mean(0), x.T @ x / len(x))
    w = quality.minimise_risk(2 / 3, moments(pos), moments(every))
    assert np.mean(pos @ w > 0) > 0.9 and np.mean(rest @ w < 0) > 0.9


def test_a_task_passes_few_texts_at_a_time(spark, monkeypatch):
    """Whole texts come to Python in small batches, also on a table of one file; the setting holds for the step alone."""
    seen, name = [], "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    for module in (quality, packing):
        monkeypatch.setattr(module, "step", lambda rows, own=module.step: (seen.append(spark.conf.get(name)), own(rows))[1])
    docs = spark.range(10).selectExpr("id as doc_id", "concat('some text ', id) as text")
    labels = spark.range(10).selectExpr("id as doc_id", "id % 2 as quality")
    quality.labelled_features(docs, labels).collect()
    packing.cut_pieces(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert seen == ["1024", "1024"] and spark.conf.get(name) == before
