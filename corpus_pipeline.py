"""From raw documents to packed training sequences, in stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written and read again as the next
stage's ``docs``. All stages but the last return the columns of ``documents``. Null texts count as empty and are scored,
grouped and packed as such; null values of other columns stay. Null ids stay null, order after all others and have no label. Rows
that repeat an id with another text are documents of their own, rows that repeat id and text leave one at
the second stage. Ties are decided by content. An empty table gives no rows at every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import mixing, packing, quality, simhash, substrings
from riskloom.llm.common import small_batches, step, table

TOKENIZER = "word_bpe_49k.json"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    with small_batches(spark):  # written, as batches of whole texts are bounded while a job runs and not for a plan
        return step(docs.where(model.score(F.col("text")) >= quality.THRESHOLD))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, by fingerprints of three-word shingles within two bits."""
    return simhash.keep_first(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand earlier; those of which nothing is left go."""
    return substrings.without_repeats(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs, mixing.mix(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed sequences: doc_id, piece, start, length, ids, sequence_id, offset."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources to target weights", source_mixing),
    ("best-fit packing", best_fit_packing),
]

#: Scores and fingerprints of the first stages cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = step(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
