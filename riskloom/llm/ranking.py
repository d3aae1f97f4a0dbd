"""Ranked lexical search: tiles of items times tiles of documents as dense products, with exact integer scores.

Texts are read once per block of items. A document becomes its number of terms and the counts of those terms
that an item of the block asks for; document frequencies and totals are sums over that table. Items are put
into tiles, each with a vocabulary of its own, so that tiles are dense. A tile of items (rows of weights) times
a tile of documents (columns of impacts) is one product of float64 matrices. Weights and impacts are whole
numbers; an item whose weights could bring a sum to 2^53 is spread over several rows, so every product is exact
and rows are added as 64-bit integers. Of each tile all scores go on that reach the twentieth, ties included.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import step, text_or_empty
from riskloom.operators.ordering import running_totals

TOP = 20
#: Different terms of the items of one block, an item's own terms at least; what is broadcast grows with it alone.
BLOCK_TERMS = 1 << 18
#: Items and documents of a tile, and the weights of one row: impacts are below 10^6, so a sum stays below 2^53.
ITEMS, DOCS = 64, 1024
ROW_WEIGHT = (1 << 53) // 10**6 - 1
#: Tasks whose best documents are ranked together before all are.
_TASKS = 256
#: Bytes of words: ASCII letters and digits in lower case and all bytes beyond ASCII; the rest parts words.
_TERM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TERM).split()


def _bytes(value: pa.Scalar) -> bytes:
    return memoryview(value.as_buffer()).tobytes()


def item_terms(items: DataFrame) -> DataFrame:
    """(qid, terms array<struct<term, n>>) of items (qid, text)."""
    pairs = pa.list_(pa.struct([("term", pa.binary()), ("n", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[{"term": t, "n": n} for t, n in Counter(terms(_bytes(x))).items()] for x in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(found, pairs)], ["qid", "terms"])

    return items.select("qid", "text").mapInArrow(run, "qid long, terms array<struct<term:binary,n:long>>")


def _counts(docs: DataFrame, vocabulary) -> DataFrame:
    """(doc_id, n, ids, tfs): a document's number of terms, and the terms of the vocabulary in it with their counts."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("ids", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = vocabulary.value
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sizes, own, tfs, ends = [], [], [], [0]
                for x in batch.column(1):
                    words = terms(_bytes(x))
                    sizes.append(len(words))
                    for word, n in Counter(words).items():
                        if (t := ids.get(word)) is not None:
                            own.append(t)
                            tfs.append(n)
                    ends.append(len(own))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, k))
                         for v, k in ((own, pa.int32()), (tfs, pa.int64()))]
                yield pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), *lists], schema=schema)

    return docs.mapInArrow(run, "doc_id long, n long, ids array<int>, tfs array<long>").where("n > 0")


def weights_of(df: np.ndarray, n_docs: int) -> list[int]:
    return [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()]


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def item_rows(asked: list[tuple[int, int]], most: int = ROW_WEIGHT) -> list[list[tuple[int, int]]]:
    """An item's (term, weight) pairs in rows whose weights add up to ``most`` at most."""
    rows, room = [], 0
    for term, weight in asked:
        while weight:
            if not room:
                rows.append([])
                room = most
            part = min(weight, room)
            rows[-1].append((term, part))
            weight, room = weight - part, room - part
    return rows


class Tile:
    """Some items over the compact vocabulary of their terms: a dense matrix of weights."""

    def __init__(self, items: list[tuple[int, list[tuple[int, int]]]], most: int = ROW_WEIGHT):
        rows, self.qids, firsts = [], [], []
        for qid, asked in items:
            own = item_rows(asked, most)
            if own:
                self.qids.append(qid)
                firsts.append(len(rows))
                rows += own
        self.firsts = np.array(firsts, dtype=np.int64)
        self.terms = np.unique(np.array([t for r in rows for t, _ in r], dtype=np.int64))
        self.weights = np.zeros((len(rows), len(self.terms)))
        for n, row in enumerate(rows):
            at = np.searchsorted(self.terms, [t for t, _ in row])
            np.add.at(self.weights[n], at, [w for _, w in row])

    def scores(self, ids: np.ndarray, column: np.ndarray, values: np.ndarray, n_docs: int) -> np.ndarray:
        """Scores of the items (rows) for documents (columns); entry i says that document column[i] has ids[i]."""
        at = np.minimum(np.searchsorted(self.terms, ids), len(self.terms) - 1)
        own = self.terms[at] == ids
        dense = np.zeros((len(self.terms), n_docs))
        dense[at[own], column[own]] = values[own]
        return np.add.reduceat((self.weights @ dense).astype(np.int64), self.firsts, axis=0)


class Best:
    """The best documents so far of the items of a tile."""

    def __init__(self, top: int):
        self.top = top
        self.rows = np.zeros((0, 4), dtype=np.int64)  # item, minus score, id is null, id

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        least = np.ones(len(scores), dtype=np.int64)
        if scores.shape[1] > self.top:
            least = np.maximum(least, np.partition(scores, -self.top, axis=1)[:, -self.top])
        if len(self.rows):
            item, size = np.unique(self.rows[:, 0], return_counts=True)
            last = -self.rows[np.cumsum(size) - 1, 1]
            full = size == self.top
            least[item[full]] = np.maximum(least[item[full]], last[full])
        item, doc = np.nonzero(scores >= least[:, None])
        if not len(item):
            return
        rows = np.concatenate((self.rows, np.stack((item, -scores[item, doc], nulls[doc].astype(np.int64), ids[doc]), axis=1)))
        rows = rows[np.lexsort(rows.T[::-1])]
        first = np.concatenate(([0], np.flatnonzero(np.diff(rows[:, 0])) + 1))
        place = np.arange(len(rows)) - np.repeat(first, np.diff(np.concatenate((first, [len(rows)]))))
        self.rows = rows[place < self.top]


def _ranked(counts: DataFrame, tiles, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(qid, doc_id, score, slot): the best documents of every task for each item."""
    schema = pa.schema([("qid", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64()), ("slot", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = tiles.value
        best = [Best(top) for _ in made]
        for whole in batches:
            for at in range(0, whole.num_rows, DOCS):
                batch = whole.slice(at, DOCS)
                nulls = batch.column(0).is_null().to_numpy(zero_copy_only=False)
                names = batch.column(0).fill_null(0).to_numpy()
                m = np.array([75 + 25 * n * n_docs // n_terms for n in batch.column(1).to_pylist()], dtype=np.int64)
                column = np.repeat(np.arange(len(m)), batch.column(2).value_lengths().to_numpy())
                ids, tfs = batch.column(2).flatten().to_numpy(), batch.column(3).flatten().to_numpy()
                if not len(ids):
                    continue
                values = impacts(tfs, m[column])
                for tile, own in zip(made, best):
                    own.add(tile.scores(ids, column, values, len(m)), names, nulls)
        slot = TaskContext.get().partitionId() // _TASKS
        for tile, own in zip(made, best):
            item, score, null, name = own.rows.T
            if len(item):
                yield pa.record_batch([
                    pa.array(np.array(tile.qids, dtype=np.int64)[item]), pa.array(name, mask=null == 1), pa.array(-score),
                    pa.array(np.full(len(item), slot, dtype=np.int32))], schema=schema)

    return counts.mapInArrow(run, "qid long, doc_id long, score long, slot int")


def _block(spark, docs: DataFrame, asked: DataFrame, top: int) -> DataFrame | None:
    """(qid, doc_id, score, slot) for the items (qid, terms) of one block, or None if there is nothing to find."""
    items = [(r["qid"], [(bytes(t["term"]), t["n"]) for t in r["terms"]]) for r in asked.orderBy("qid").collect()]
    ids: dict[bytes, int] = {}
    for _, own in items:
        for term, _ in own:
            ids.setdefault(term, len(ids))
    if not ids:
        return None
    vocabulary = spark.sparkContext.broadcast(ids)
    counts = step(_counts(docs, vocabulary))
    total = counts.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    if not total["docs"]:
        return None
    df = np.zeros(len(ids), dtype=np.int64)
    # One row per term of the block, at most BLOCK_TERMS and one item's.
    for r in counts.select(F.explode("ids").alias("t")).groupBy("t").count().collect():
        df[r["t"]] = r["count"]
    weight = weights_of(df, total["docs"])
    # A term that no document holds scores nowhere.
    scored = [(qid, [(ids[t], weight[ids[t]] * n) for t, n in own if df[ids[t]]]) for qid, own in items]
    tiles = [Tile(scored[at:at + ITEMS]) for at in range(0, len(scored), ITEMS)]
    shared = spark.sparkContext.broadcast([t for t in tiles if t.qids])
    return step(_ranked(counts, shared, total["docs"], total["terms"], top))


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item with a score above 0, best first.

    Equal scores rank by ascending doc_id, null ids last; rows of one id and score have ranks in a row. Every row
    of ``items`` is an item, also if it repeats another or its id is null. Null and empty texts have no terms: as
    documents they count nowhere, as items they have no rows. Empty tables give no rows; other columns are not
    read. Texts are read once for every ``block_terms`` different terms of items; the terms of one item fit a task.
    """
    spark = docs.sparkSession
    named = step(items.select(F.monotonically_increasing_id().alias("qid"), F.col(item_id).alias("item_id"),
                              text_or_empty(item_text).alias("text")))
    asked = step(running_totals(item_terms(named).withColumn("size", F.size("terms")), ["qid"], ["size"]))
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    block = F.floor(F.col("size_before") / block_terms)
    blocks = sorted(r[0] for r in asked.where("size > 0").select(block).distinct().collect())
    found = [b for n in blocks if (b := _block(spark, slim, asked.where((block == n) & (F.col("size") > 0)), top)) is not None]
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    if not found:
        best = spark.createDataFrame([], "qid long, doc_id long, score long, rank int")
    else:
        best = found[0]
        for other in found[1:]:
            best = best.unionByName(other)
        for keys in (["qid", "slot"], ["qid"]):
            best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return best.join(named.select("qid", "item_id"), "qid").select("item_id", "rank", "doc_id", "score")
