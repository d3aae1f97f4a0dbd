"""Removal of passages that stand in an earlier document, or further up in the same one.

Windows of 20 words are compared, all of them, without making a row of each. Every window has an anchor,
the 6-word gram in it with the least hash; equal windows have equal anchors. A document's windows with one
anchor form a segment of at most 34 words. Anchors seen once are done with. Equal segments of an anchor
are represented by the earliest; all windows of the others are removed. If an anchor has different
segments, these are dealt to shards by anchor, each shard is put into a compressed FM-index, and the
segments stream through it by backward search, which reports the windows that stand earlier.

An anchor with very many different segments is not sent to one shard: its windows are dealt out one by
one by their own hash, and the earliest of each is found with partial minima.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import small_batches, step, text_or_empty
from riskloom.llm.fm_index import repeated_windows

WIDTH = 20
GRAM = 6
#: Words of one shard, and different segments of an anchor beyond which its windows are dealt out singly.
SHARD_WORDS, CROWD = 250_000, 8_000
_NO_ID = (1 << 63) - 1
_PIECE = 1 << 18

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_rng = np.random.default_rng(20)
_BYTE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
# Odd multipliers and their inverses modulo 2^64.
_P, _Q = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 .. n of a multiplier and of its inverse."""
    if base not in _powers or len(_powers[base][0]) <= n:
        size = max(n, _PIECE) + 1
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        _powers[base] = tuple(both)
    up, down = _powers[base]
    return up[:n + 1], down[:n + 1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[start:end] for every span, whatever its place."""
    up, down = _power(base, len(values))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * up[:len(values)], dtype=np.uint64)))
    return _mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a text, computed in pieces that end at a blank."""
    out, at = [], 0
    while at < len(text):
        end = at + _PIECE
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        piece = np.frombuffer(text, dtype=np.uint8, count=min(end, len(text)) - at, offset=at)
        blank = np.concatenate(([True], _SPACE[piece], [True]))
        edges = np.flatnonzero(blank[1:] != blank[:-1])
        out.append(_spans(_BYTE[piece], edges[::2], edges[1::2], _P))
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def segments(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, segment digest, first window and number of windows of each segment of a document."""
    n = len(words)
    if n < WIDTH:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none.astype(np.uint64), none, none
    at = np.arange(n - GRAM + 1)
    grams = _spans(words, at, at + GRAM, _Q)
    views = np.lib.stride_tricks.sliding_window_view(grams, WIDTH - GRAM + 1)
    anchor = views.argmin(axis=1) + np.arange(n - WIDTH + 1)
    first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    count = np.diff(np.concatenate((first, [len(anchor)])))
    return grams[anchor[first]], _spans(words, first, first + count + WIDTH - 1, _Q), first, count


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def numbered(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc (the id, nulls last), uid (a hash of the text) and text: what names and orders documents here."""
    own = text_or_empty(text)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID)).alias("doc"),
                       F.xxhash64(own).alias("uid"), own.alias("text"))


def _all_segments(rows: DataFrame) -> DataFrame:
    """doc, uid, and the hash, digest and place (first window * 32 + windows) of every segment, as lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, digests, places = [], [], []
            for text in batch.column(2):
                found = segments(word_hashes(memoryview(text.as_buffer()).tobytes()))
                hashes.append(found[0].view(np.int64))
                digests.append(found[1].view(np.int64))
                places.append(found[2] * 32 + found[3])
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (hashes, digests, places)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *lists],
                                             ["doc", "uid", "hash", "digest", "place"])

    kinds = "doc long, uid long, hash array<long>, digest array<long>, place array<long>"
    return rows.select("doc", "uid", "text").mapInArrow(run, kinds)


def _contents(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Add ``words`` (8 bytes a word) to segments ``wanted``: doc, uid, and a list of (place, hash, digest, crowded)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                cut = []
                for text, own in zip(batch.column(2), batch.column(3)):
                    words = word_hashes(memoryview(text.as_buffer()).tobytes())
                    places = own.values.field(0).to_pylist()
                    cut += [words[p >> 5:(p >> 5) + (p & 31) + WIDTH - 1].tobytes() for p in places]
                segs, of = batch.column(3).flatten(), pc.list_parent_indices(batch.column(3))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(of), batch.column(1).take(of), *segs.flatten(), pa.array(cut, pa.binary())],
                    ["doc", "uid", "place", "hash", "digest", "crowded", "words"])

    one = rows.select("doc", "uid", "text").join(wanted, ["doc", "uid"])
    return one.mapInArrow(run, "doc long, uid long, place long, hash long, digest long, crowded boolean, words binary")


def _by_index(segs: DataFrame, shard_words: int) -> DataFrame:
    """(hash, digest, gone): per segment a bit mask of the windows that stand earlier in its shard."""
    total = segs.agg(F.sum(F.octet_length("words") / 8)).first()[0] or 0
    shards = max(1, round(total / shard_words))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        # Rows that repeat id and text bring their segments more than once.
        frame = frame.drop_duplicates(["hash", "digest"]).sort_values(["doc", "uid", "place"])
        gone = repeated_windows([np.frombuffer(w, dtype=np.uint64) for w in frame["words"]], WIDTH)
        return pd.DataFrame({"hash": frame["hash"], "digest": frame["digest"], "gone": gone})

    shard = F.pmod(F.xxhash64("hash"), F.lit(shards))
    return segs.withColumn("shard", shard).groupBy("shard").applyInPandas(run, "hash long, digest long, gone long")


def _singly(segs: DataFrame) -> DataFrame:
    """The same for anchors with very many segments: the earliest of each window with partial minima."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = [np.frombuffer(w, dtype=np.uint64) for w in batch.column(5).to_pylist()]
            lengths = np.array([len(w) for w in lists])
            windows = lengths - WIDTH + 1
            of = np.repeat(np.arange(len(lists)), windows)
            bit = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
            at = (np.cumsum(lengths) - lengths)[of] + bit
            doc, uid, place, key, digest = (batch.column(c).to_numpy()[of] for c in range(5))
            yield pa.RecordBatch.from_arrays(
                [_signed(_spans(np.concatenate(lists), at, at + WIDTH, _Q)), pa.array(doc), pa.array(uid),
                 pa.array((place >> 5) + bit), pa.array(key), pa.array(digest), pa.array(bit, pa.int32())],
                ["window", "doc", "uid", "start", "hash", "digest", "bit"])

    one = step(segs.select("doc", "uid", "place", "hash", "digest", "words").mapInArrow(
        run, "window long, doc long, uid long, start long, hash long, digest long, bit int"))
    own = F.struct("doc", "uid", "start")
    low = one.groupBy("window").agg(F.min(own).alias("low"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = one.join(low, "window").where(F.col("low") < own)
    return later.groupBy("hash", "digest").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("gone"))


def removals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_words: int = SHARD_WORDS,
             crowd: int = CROWD) -> DataFrame:
    """(doc, uid, cuts): per document with repeated windows a list of (first window, bit mask of the removed)."""
    rows = numbered(docs, doc_id, text)
    with small_batches(docs.sparkSession):
        lists = step(_all_segments(rows))
    every = lists.select("doc", "uid", F.inline(F.arrays_zip("hash", "digest", "place")))
    again = step(every.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"))
    occurrences = step(every.join(again, "hash"))
    origin = F.min(F.struct("doc", "uid", "place")).alias("origin")
    different = step(occurrences.groupBy("hash", "digest").agg(origin))
    several = different.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
    wanted = different.join(several, "hash").select(
        "origin.doc", "origin.uid", F.struct("origin.place", "hash", "digest", (F.col("n") > crowd).alias("crowded")).alias("s"))
    with small_batches(docs.sparkSession):
        contents = step(_contents(rows, wanted.groupBy("doc", "uid").agg(F.collect_list("s").alias("own"))))
    masks = _by_index(contents.where("not crowded"), shard_words)
    crowded = contents.where("crowded")
    if not crowded.isEmpty():
        masks = masks.unionByName(_singly(crowded))
    masks = step(masks.where("gone <> 0"))
    # Written, so that both sides of the next join are shuffled for it and a frequent segment can be split.
    told = step(different.join(masks, ["hash", "digest"], "left").select(
        "hash", "digest", "origin", F.coalesce("gone", F.lit(0)).alias("gone")))
    whole = F.expr("shiftleft(1L, cast(place & 31 as int)) - 1")
    first = F.struct("doc", "uid", "place") == F.col("origin")
    cut = F.struct(F.shiftright("place", 5).alias("first"), F.when(first, F.col("gone")).otherwise(whole).alias("mask"))
    cuts = occurrences.join(told, ["hash", "digest"]).select("doc", "uid", cut.alias("cut")).where("cut.mask <> 0")
    # Repeated rows share doc and uid, and so their cuts; a list is bounded by the length of its document.
    return step(cuts.groupBy("doc", "uid").agg(F.collect_set("cut").alias("cuts")))


def covered(n_words: int, cuts) -> np.ndarray:
    """True for each word under a removed window."""
    edges = np.zeros(n_words + 1, dtype=np.int64)
    for cut in cuts:
        bits = int(cut["mask"])
        starts = int(cut["first"]) + np.array([b for b in range(bits.bit_length()) if bits >> b & 1])
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + WIDTH, -1)
    return np.cumsum(edges)[:n_words] > 0


def _kept(words: list[bytes], cuts) -> list[bytes]:
    if cuts is None:
        return words
    return [w for w, away in zip(words, covered(len(words), cuts).tolist()) if not away]


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_words: int = SHARD_WORDS,
                   crowd: int = CROWD) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) per row of ``docs``; kept words are joined by one blank.

    A word is removed if a window of 20 words that covers it starts earlier with the same words: in a
    document with a smaller id, or further up in its own. Windows are judged on the input. Documents of
    one id are ordered by a hash of their texts; rows that repeat id and text are one document, removed
    from alike. Null ids come last. A null or empty text has no words. An empty table gives no rows; other
    columns are not read.
    """
    rows = numbered(docs, doc_id, text)
    cuts = removals(docs, doc_id, text, shard_words, crowd)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                total, left, kept = [], [], []
                for own, cut in zip(batch.column(1), batch.column(2).to_pylist()):
                    words = memoryview(own.as_buffer()).tobytes().split()
                    total.append(len(words))
                    words = _kept(words, cut)
                    left.append(len(words))
                    kept.append(b" ".join(words))
                gone = pa.array(np.array(total, np.int64) - np.array(left, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(total, pa.int64()), gone, pa.array(kept, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "n_removed", "kept_text"])

    return rows.join(cuts, ["doc", "uid"], "left").select("doc_id", "text", "cuts").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_text string")


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_words: int = SHARD_WORDS,
                    crowd: int = CROWD) -> DataFrame:
    """The rows and columns of ``docs`` with repeated passages cut out of the text.

    A text from which nothing goes stays as it is; in others the kept words are joined by one blank, and a
    column n_chars follows. Documents of which no word is left go, unless they had none to begin with.
    """
    cuts = removals(docs, doc_id, text, shard_words, crowd).select(
        F.col("doc").alias("_cut_doc"), F.col("uid").alias("_cut_uid"), F.col("cuts").alias("_cuts"))

    @F.arrow_udf("string")
    def kept(texts: pa.Array, cut: pa.Array) -> pa.Array:
        return pa.array([b" ".join(_kept(t.encode("utf-8", "surrogatepass").split(), c.as_py())).decode("utf-8", "surrogatepass")
                         for t, c in zip(texts.to_pylist(), cut)], pa.string())

    doc = F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID))
    rows = docs.join(cuts, (doc == F.col("_cut_doc")) & (F.xxhash64(text_or_empty(text)) == F.col("_cut_uid")), "left")
    cut, same = rows.where("_cuts is not null"), rows.where("_cuts is null").select(*docs.columns)
    cut = cut.withColumn(text, kept(F.col(text), F.col("_cuts"))).where(F.length(text) > 0)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    with small_batches(docs.sparkSession):
        cut = step(cut.select(*docs.columns))
    return same.unionByName(cut)
