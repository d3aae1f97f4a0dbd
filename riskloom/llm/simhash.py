"""Near-duplicate documents by SimHash, found through a byte-position inverted index with count filtering.

Fingerprints that differ in at most two bits share at least six of their eight positional bytes. Lists of single
positional bytes would hold a 256th of all fingerprints each, so the index has a list for every four of the eight
positions and every value of these bytes: 70 postings per fingerprint, in lists of a 2^32nd. A pair that shares b
positional bytes shares C(b, 4) lists. The lists that each pair shares are tallied, pairs with the guaranteed
C(6, 4) = 15 are retained and verified bit by bit. A fingerprint in a long list is not paired: all values within two
bits of it are looked up.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import components, small_batches, step, text_or_empty
from riskloom.session import removed, slice_count

SEED = 42
SHINGLE = 3
MAX_BITS = 2
#: Fingerprints of one list beyond which its partners are looked up by value, about as many rows as pairs would be.
LONG_LIST = 64
#: Fingerprints of a task that makes postings, at most, and the least that are worth a task of their own.
POSTED_ROWS, LEAST_ROWS = 100_000, 2_000
#: Positions of a list, and the lists that a pair with the guaranteed shared bytes shares.
_POSITIONS = 4
_LISTS = math.comb(8 - MAX_BITS, _POSITIONS)
_CHUNK = 1 << 16


def shingles(text: str, shingle: int = SHINGLE) -> np.ndarray:
    """Hashes of the word shingles of a text in order; a shorter text is one shingle, one without words has none."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, dtype="<u8")
    joined, width = b" ".join(words), min(shingle, len(words))
    stops = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], stops[:-1] + 1))[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops[width - 1:].tolist())),
                       dtype="<u8", count=len(starts))


def simhash(text: str, shingle: int = SHINGLE) -> int:
    """64-bit fingerprint of the word shingles of a text as a signed number; zero without words."""
    hashes = shingles(text, shingle)
    if not len(hashes):
        return 0
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at:at + _CHUNK].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * votes > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint long) per row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([simhash(t.as_py(), shingle) for t in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["doc_id", "fingerprint"])

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    return slim.mapInArrow(run, "doc_id long, fingerprint long")


def postings(prints: DataFrame) -> DataFrame:
    """An index entry (slot, key) per fingerprint and choice of four byte positions: the choice, and the bytes."""
    entries = []
    for slot, chosen in enumerate(combinations(range(8), _POSITIONS)):
        key = F.lit(0)
        for n, position in enumerate(chosen):
            byte = F.shiftrightunsigned("fingerprint", 8 * position).bitwiseAND(F.lit(255))
            key = key + F.shiftleft(byte.cast("long"), 8 * n)
        entries.append(F.struct(F.lit(slot).alias("slot"), key.alias("key")))
    return prints.select("fingerprint", F.inline(F.array(*entries)))


def links(prints: DataFrame, long_list: int = LONG_LIST) -> DataFrame:
    """(a, b): fingerprints that differ in at least one and at most two bits, a < b.

    ``prints`` holds each fingerprint once. Pairs of lists of up to ``long_list`` entries are tallied. For
    fingerprints in a longer list the values within two bits are enumerated and looked up, 2,080 of them whatever
    the length of the list; a pair none of whose lists is long has its whole tally.
    """
    # A fingerprint is narrow and becomes 70 postings, so tasks follow from rows and not from bytes read.
    rows = prints.count()
    tasks = max(-(-rows // POSTED_ROWS), min(slice_count(prints.sparkSession), -(-rows // LEAST_ROWS)), 1)
    index = postings(prints.select("fingerprint").repartition(tasks, "fingerprint"))
    sizes = index.groupBy("slot", "key").agg(F.count("*").alias("n"))
    # By shuffle, all of them: a plan takes the postings to be as few as the fingerprints and would broadcast them.
    listed = step(index.hint("merge").join(sizes.where("n > 1"), ["slot", "key"]))
    short, crowded = listed.where(F.col("n") <= long_list), listed.where(F.col("n") > long_list)
    left = short.select("slot", "key", F.col("fingerprint").alias("a"))
    right = short.select("slot", "key", F.col("fingerprint").alias("b"))
    tally = left.hint("merge").join(right, ["slot", "key"]).where("a < b").groupBy("a", "b").agg(F.count("*").alias("lists"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS
    met = tally.where(F.col("lists") >= _LISTS).where(near).select("a", "b")
    if not crowded.isEmpty():
        one = [1 << i for i in range(64)]
        masks = [m - (1 << 64) if m >> 63 else m for m in one + [x | y for x, y in combinations(one, 2)]]
        asked = crowded.select(F.col("fingerprint").alias("a")).distinct().select(
            "a", F.explode(F.lit(masks)).alias("mask")).select("a", F.col("a").bitwiseXOR(F.col("mask")).alias("b"))
        # The values asked for, too, are taken to be as few as the fingerprints that ask.
        found = asked.hint("merge").join(prints.select(F.col("fingerprint").alias("b")), "b")
        met = met.unionByName(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    return met.distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    long_list: int = LONG_LIST, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint long, component_id) per row of ``docs``.

    Documents link when their fingerprints differ in at most two bits; component_id is the smallest
    doc_id reachable by links, the document itself included. Equal fingerprints stand for each other and
    are compared once. Null and empty texts have fingerprint zero and link like any other. Repeated rows
    give repeated rows. Rows with a null doc_id link like others but never name a component; it is null
    if no row of it has an id. An empty table gives no rows; other columns are not read.
    """
    with small_batches(docs.sparkSession):
        prints = step(fingerprints(docs, doc_id, text, shingle))
    distinct = step(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("lowest")))
    classes = components(links(distinct, long_list))
    told = step(distinct.hint("merge").join(classes, distinct.fingerprint == classes.node, "left").select(
        "fingerprint", "lowest", F.coalesce("component", "fingerprint").alias("class")))
    named = told.hint("merge").join(told.groupBy("class").agg(F.min("lowest").alias("component_id")), "class")
    return prints.hint("merge").join(named.select("fingerprint", "component_id"), "fingerprint").select(
        "doc_id", "fingerprint", "component_id")


def hex_digits(fingerprint: str = "fingerprint") -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def _clean(text: Column) -> Column:
    """The words that shingles are made of: ASCII letters in lower case, one space between words."""
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.trim(F.regexp_replace(lower, r"[\x20\x09-\x0D]+", " "))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row of each group of near-duplicates, the one with the smallest id, with all columns of ``docs``.

    Groups are those of ``near_duplicates`` over texts: null, empty and blank texts are one group; rows with a null
    id follow those with one, and different texts that repeat an id are different documents. Among rows of one id the
    choice depends on their content alone. An empty table gives no rows. Columns of any name stay as they are.
    """
    names = [F.col(f"`{c}`") for c in docs.columns]
    own = next(n for n in (f"_row{k}" for k in range(len(docs.columns) + 1)) if n not in docs.columns)
    rows = docs.withColumn(own, F.md5(F.to_json(F.struct(*names))))
    clean = _clean(text_or_empty(text))
    slim = rows.select(F.col(f"`{doc_id}`").alias("id"), F.col(own).alias("row"), F.md5(clean).alias("key"))
    texts = docs.select(clean.alias("text")).groupBy(F.md5("text").alias("key")).agg(F.first("text").alias("text"))
    texts = step(texts.withColumn("gid", F.monotonically_increasing_id()))
    classes = near_duplicates(texts, "gid", "text", shingle=shingle).select(
        F.col("doc_id").alias("gid"), F.col("component_id").alias("component"))
    named = texts.select("key", "gid").hint("merge").join(classes, "gid").select("key", "component")
    order = F.struct(F.col("id").isNull(), F.col("id"), F.col("row"))
    first = slim.hint("merge").join(named, "key").groupBy("component").agg(F.min(order).alias("first"))
    first = step(first.select(F.col("first.row").alias(own)))
    removed(texts)  # a copy of all texts, which ``first`` was the last to read
    kept = rows.join(first, own)
    return kept.dropDuplicates([own]).select(*names)
