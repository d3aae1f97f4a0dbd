"""Mixing sources to target weights: exact token budgets, met by documents in a hash-random order.

Each document gets a random key from its id. Inside a source, documents are ordered by that key in
ranges of its leading digits, and ranges in blocks. Prefix sums of sizes over the blocks, over the ranges
of a block and inside each range give every document its place, and each source is cut exactly at its
budget. A budget beyond the source's size takes whole epochs first. No source is ever ordered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import WORD, step
from riskloom.operators.ordering import row_index

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Leading hex digits of the key that name a range: 65,536 ranges of a source.
RANGE_DIGITS = 4


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column, seed: str = "") -> Column:
    """A fixed pseudo-random text of 32 hex digits for a document id."""
    return F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def row_identity(doc_id: Column, source: Column, text: Column) -> Column:
    """A text of 32 hex digits for what a row is to the mix: its id, source and text, each of which may be null."""
    marked = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))
    return F.md5(F.concat_ws("\n", F.md5(marked(doc_id)), F.md5(marked(source)), F.md5(marked(text))))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in code-point order, null last, have ``weights`` in turn. The targets share the sum of all
    sizes by weight; one that would pass ``max_epochs`` times its source's size stops there and its excess
    is shared by weight among the rest, until none is above. All sums are of whole numbers, so every
    engine and every run gets the same targets.
    """
    keyed = sizes.select("source", "source_size", F.col("source").isNull().cast("int").alias("_last"),
                         F.coalesce("source", F.lit("")).alias("_name"))
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    ranked = row_index(keyed, ["_last", "_name"], "_at")
    weighed = step(ranked.select(
        "source", "source_size", F.element_at(cycle, (F.col("_at") % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * max_epochs).alias("limit")))
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    # A source is at its limit when limit * share <= weight * rest; more of them are with every round.
    rest, share, known = total, 0, None

    def reached() -> Column:
        wide = lambda c: c.cast("decimal(19,0)")
        return wide(F.col("limit")) * wide(F.lit(share)) <= wide(F.col("weight")) * wide(F.lit(rest))

    while True:
        full = reached() if share else F.lit(False)
        n, fixed, loose = weighed.agg(
            F.sum(full.cast("long")), F.coalesce(F.sum(F.when(full, F.col("limit"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0))).first()
        if n == known or not loose:
            break
        known, rest, share = n, total - fixed, loose
    even = F.col("weight").cast("double") * F.lit(float(rest)) / F.lit(float(share or 1))
    full = reached() if share else F.lit(True)
    return weighed.select("source", "source_size", F.when(full, F.col("limit").cast("double")).otherwise(even).alias("target"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = "") -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, row) per row of ``docs``.

    size is the number of words of the text, 0 for null; taken the words of the document in the mix: its
    size for every epoch, and for the document at the cut its leading words up to the budget, the target
    rounded down. Null sources are one source, the last; null ids are allowed. Ties in the key, repeated ids
    among them, follow by size and then by ``row_identity``, which is the column row; rows alike in all are alike in
    the result whatever their order.
    An empty table gives no rows. Other columns are not read.
    """
    key = random_key(F.col(doc_id), seed)
    sized = step(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), key.alias("key"),
        row_identity(F.col(doc_id), F.col(source), F.col(text)).alias("row")))
    head = F.substring("key", 1, RANGE_DIGITS).alias("range")
    ranges = step(sized.groupBy("source", head).agg(F.sum("size").alias("range_size")))
    goal = targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, max_epochs)
    # Neither window has more than 256 rows of a source in one task: blocks of a source, ranges of a block.
    block = F.substring("range", 1, RANGE_DIGITS // 2).alias("block")
    blocks = ranges.groupBy("source", block).agg(F.sum("range_size").alias("block_size"))
    blocks_before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = blocks.select("source", "block", F.coalesce(F.sum("block_size").over(blocks_before), F.lit(0)).alias("begin"))
    begins = begins.join(goal, begins["source"].eqNullSafe(goal["source"])).drop(goal["source"])
    ranges_before = Window.partitionBy("source", "block").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    summed = ranges.withColumn("block", block).withColumn(
        "ahead", F.coalesce(F.sum("range_size").over(ranges_before), F.lit(0)))
    starts = summed.join(begins, summed["source"].eqNullSafe(begins["source"]) & (summed["block"] == begins["block"])).select(
        summed["source"], "range", "source_size", "target", (F.col("begin") + F.col("ahead")).alias("start"))
    inside = Window.partitionBy("source", "range").orderBy("key", "size", "row").rowsBetween(Window.unboundedPreceding, -1)
    local = sized.withColumn("range", head).withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    both = local.join(starts, local["source"].eqNullSafe(starts["source"]) & (local["range"] == starts["range"])).select(
        "doc_id", local["source"], "size", "source_size", "target", "row", (F.col("start") + F.col("inner")).alias("place"))
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    last = F.least(F.greatest(budget - epochs * F.col("source_size") - F.col("place"), F.lit(0)), F.col("size"))
    return both.select("doc_id", "source", "size", "source_size", "target", (epochs * F.col("size") + last).alias("taken"), "row")


def mixed_documents(docs: DataFrame, plan: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    source: str = "source") -> DataFrame:
    """The rows of ``docs`` as often as ``plan`` (from ``mix``) takes them, with the columns of ``docs``.

    The document at the cut ends after its last word that is taken; a column n_chars follows the text.
    Each row of ``docs`` meets one row of the plan, also where ids are null or repeated: rows alike in id, source and
    text are numbered on both sides. The plan's rows with taken = 0 leave.
    """
    # Rows alike differ in taken only at the cut, so a row has at most three ranges of numbers.
    alike = plan.groupBy(F.col("row").alias("_mix_row"), F.col("size").alias("_mix_size"), F.col("taken").alias("_mix_taken")).agg(
        F.count("*").alias("_mix_n"))
    upto = Window.partitionBy("_mix_row").orderBy(F.col("_mix_taken").desc())
    ranges = alike.withColumn("_mix_last", F.sum("_mix_n").over(upto)).where("_mix_taken > 0")
    others = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    numbered = docs.withColumn("_mix_key", row_identity(F.col(doc_id), F.col(source), F.col(text))).withColumn(
        "_mix_at", F.row_number().over(Window.partitionBy("_mix_key").orderBy(others)))
    whole = F.floor(F.col("_mix_taken") / F.col("_mix_size")).cast("int")
    part = (F.col("_mix_taken") % F.col("_mix_size")).cast("int")
    copies = F.concat(F.when(whole > 0, F.array_repeat(F.lit(-1), whole)).otherwise(F.array().cast("array<int>")),
                      F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")))
    mine = (F.col("_mix_key") == F.col("_mix_row")) & (F.col("_mix_at") <= F.col("_mix_last")) & (
        F.col("_mix_at") > F.col("_mix_last") - F.col("_mix_n"))
    rows = numbered.join(ranges, mine).withColumn("_mix_words", F.explode(copies))
    leading = F.concat_ws("", F.slice(F.regexp_extract_all(F.col(text), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)),
                                      1, F.greatest("_mix_words", F.lit(0))))
    rows = rows.withColumn(text, F.when(F.col("_mix_words") > 0, leading).otherwise(F.col(text)))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(F.col("_mix_words") > 0, F.length(text)).otherwise(F.col("n_chars")))
    return rows.select(*docs.columns)
