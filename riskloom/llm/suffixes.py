"""Removal of byte strings that stand anywhere else, in another document or in the same one.

All strings of 200 bytes, the windows, are compared without making a row of each. A window's anchor is the
120-byte gram in it with the least hash, the first of equals; equal windows have equal anchors. Neighbouring
windows with one anchor form a segment. Anchors that stand once are done with, and segments that stand twice are
repeated whole. What is left are segments that stand once, under an anchor with other segments: these are dealt
to shards by anchor. A shard builds the Burrows-Wheeler transform and the common prefixes of its segments column
by column (``column_bwt``), the anchor written as three symbols, and reads the repeated windows from the common
prefixes. Shards are bounded, so the sequences a round reads and writes stay in the task's memory, and
a shard lost with its executor is built again from its shuffle.

An anchor with very many different segments is not sent to one shard: its windows are dealt out one by one by
their own hash and counted.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.column_bwt import Collection
from riskloom.llm.common import step, text_or_empty

WIDTH, GRAM = 200, 120
#: Bytes of one shard, strings of one collection, and different segments of an anchor beyond which windows are dealt out singly.
SHARD_BYTES, STRINGS, CROWD = 4_000_000, 600, 8_000
_SIDE = WIDTH - GRAM
#: Windows of one piece of a long text; a place in a piece takes 20 bits.
_PIECE, _AT = 1 << 18, np.uint64((1 << 20) - 1)
_NO_ID = (1 << 63) - 1
#: The order of anchors: symbols 1 to 250 twice after a byte that no text holds; 0 in a text becomes another such byte.
_MARK, _BASE, _ZERO = 0xFF, 250, bytes([0xFE, *range(1, 256)])

_rng = np.random.default_rng(12)
_BYTE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
_P = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_UP, _DOWN = (_powers(b, _PIECE + WIDTH + 1) for b in (_P, pow(_P, -1, 1 << 64)))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _sums(piece: np.ndarray) -> np.ndarray:
    out = np.zeros(len(piece) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[piece] * _UP[:len(piece)], out=out[1:])
    return out


def _spans(sums: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes [first, end) of a piece, whatever their place."""
    return _mixed((sums[end] - sums[first]) * _DOWN[first] + (end - first).astype(np.uint64))


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbouring keys, from minima running forwards and backwards through blocks."""
    blocks = np.full((-(-len(keys) // width), width), np.iinfo(np.uint64).max, dtype=np.uint64)
    blocks.ravel()[:len(keys)] = keys
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(keys) - width + 1
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def segments(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, digest and place of each segment of a text: first window << 14 | windows << 7 | bytes before the anchor."""
    found: list[list[np.ndarray]] = [[np.empty(0, np.uint64)], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]]
    whole = np.frombuffer(text, dtype=np.uint8)
    for begin in range(0, len(text) - WIDTH + 1, _PIECE):
        piece = whole[begin:begin + _PIECE + WIDTH - 1]
        sums = _sums(piece)
        at = np.arange(len(piece) - GRAM + 1)
        grams = _spans(sums, at, at + GRAM)
        anchor = (_least((grams & ~_AT) | at.astype(np.uint64), _SIDE + 1) & _AT).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        count = np.diff(np.concatenate((first, [len(anchor)])))
        own = anchor[first]
        found[0].append(grams[own])
        found[1].append(_spans(sums, first, first + count + WIDTH - 1))
        found[2].append((begin + first) << 14 | count << 7 | (own - first))
    return tuple(np.concatenate(x) for x in found)


def numbered(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, doc (the id, a number for null), uid (a hash of the text) and text."""
    own, name = text_or_empty(text), F.col(doc_id).cast("long")
    return docs.select(name.alias("doc_id"), F.coalesce(name, F.lit(_NO_ID)).alias("doc"), F.xxhash64(own).alias("uid"),
                       own.alias("text"))


def _bytes(value: pa.Scalar) -> bytes:
    return memoryview(value.as_buffer()).tobytes()


def _all_segments(rows: DataFrame) -> DataFrame:
    """doc, uid, and the hash, digest and place of every segment, as lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                found = [segments(_bytes(x)) for x in batch.column(2)]
                ends = pa.array(np.cumsum([0] + [len(f[0]) for f in found]), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([f[k] for f in found]).view(np.int64)))
                         for k in range(3)]
                yield pa.record_batch([batch.column(0), batch.column(1), *lists], ["doc", "uid", "hash", "digest", "place"])

    kinds = "doc long, uid long, hash array<long>, digest array<long>, place array<long>"
    return rows.select("doc", "uid", "text").mapInArrow(run, kinds).where(F.size("hash") > 0)


def _contents(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Add ``content`` (a segment's bytes) to the segments ``own`` of ``wanted``: doc, uid, and a list of them."""
    kinds = "place long, hash long, digest long, single boolean, crowded boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, own in zip(batch.column(0), batch.column(1)):
                text, own = _bytes(text), own.values
                place = own.field(0).to_pylist()
                cut = [text[p >> 14:(p >> 14) + (p >> 7 & 127) + WIDTH - 1] for p in place]
                yield pa.record_batch([*own.flatten(), pa.array(cut, pa.binary())],
                                      ["place", "hash", "digest", "single", "crowded", "content"])

    one = rows.select("doc", "uid", "text").dropDuplicates(["doc", "uid"]).join(wanted, ["doc", "uid"])
    return one.select("text", "own").mapInArrow(run, kinds + ", content binary")


def _trimmed(group: list[tuple[bytes, int, int, bool]]) -> list[tuple[int, bytes, bytes, int] | None]:
    """Per segment (content, windows, bytes before the anchor, single) what is left of it: (first window, left, right, windows).

    A window with d bytes before the anchor holds the a bytes before it and the 80 - b behind it if a <= d <= b. For
    four ranges of d, these bytes must stand in another segment of the group as well.
    """
    quarter, seen, keys = _SIDE // 4, Counter(), []
    for content, count, off, _ in group:
        left, right, own = content[:off], content[off + GRAM:], {}
        for a in range(0, _SIDE, quarter):
            if off >= a and off - count + 1 <= a + quarter:
                behind = _SIDE - a - quarter
                own[a] = (left[off - a:], right[:behind])
        keys.append(own)
        seen.update((a, k) for a, k in own.items())
    out: list = []
    for (content, count, off, _), own in zip(group, keys):
        ranges = [a for a, k in own.items() if seen[a, k] > 1]
        if not ranges:
            out.append(None)
            continue
        high, low = min(off, max(ranges) + quarter), max(off - count + 1, min(ranges))
        out.append((off - high, content[off - high:off], content[off + GRAM:off + WIDTH - low], high - low + 1))
    return out


def repeated_windows(groups: list[list[tuple[bytes, int, int, bool]]], strings: int = STRINGS) -> list[list[list[int]]]:
    """Per group of segments under one anchor, and per segment, the windows that stand in another segment of the group.

    A segment is (content, windows, bytes before the anchor, single); for those that are not single the list is empty.
    """
    out: list[list[list[int]]] = [[[] for _ in g] for g in groups]
    texts: list[bytes] = []
    names: list[tuple[int, int, int]] = []
    order = 0

    def build() -> None:
        for (g, s, first), found in zip(names, Collection(texts).repeated(_SIDE + 3)):
            if groups[g][s][3]:
                out[g][s] = [first + int(x) for x in found]
        texts.clear()
        names.clear()

    for g, group in enumerate(groups):
        parts = _trimmed(group)
        if not any(p and s[3] for p, s in zip(parts, group)):
            continue
        code = bytes((_MARK, 1 + order // _BASE, 1 + order % _BASE))
        for s, part in enumerate(parts):
            if part:
                first, left, right, _ = part
                texts.append(left.translate(_ZERO) + code + right.translate(_ZERO))
                names.append((g, s, first))
        order += 1
        if len(texts) >= strings or order == _BASE * _BASE:
            build()
            order = 0
    if texts:
        build()
    return out


def _halves(windows: list[int]) -> tuple[int, int]:
    """Window numbers as two masks of 63 bits."""
    return sum(1 << w for w in windows if w < 63), sum(1 << w - 63 for w in windows if w >= 63)


def _by_transform(segs: DataFrame, shard_bytes: int, strings: int) -> DataFrame:
    """(hash, digest, low, high): per single segment two bit masks of the windows that stand elsewhere in its shard."""
    total = segs.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    shards = max(1, round(total / shard_bytes))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["hash", "digest"])
        groups, rows = [], []
        for _, part in frame.groupby("hash", sort=False):
            groups.append([(c, int(p) >> 7 & 127, int(p) & 127, bool(s))
                           for c, p, s in zip(part["content"], part["place"], part["single"])])
            rows.append(list(zip(part["hash"], part["digest"])))
        found = [(*row, *_halves(w)) for own, per in zip(rows, repeated_windows(groups, strings)) for row, w in zip(own, per) if w]
        return pd.DataFrame(found, columns=["hash", "digest", "low", "high"]).astype("int64")

    shard = F.pmod(F.xxhash64("hash"), F.lit(shards))
    return segs.withColumn("shard", shard).groupBy("shard").applyInPandas(run, "hash long, digest long, low long, high long")


def _singly(segs: DataFrame) -> DataFrame:
    """The same for anchors with very many segments: windows are counted by their own hash."""
    kinds = "window long, hash long, digest long, single boolean, bit int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                window, size = [], []
                for content in batch.column(3):
                    piece = np.frombuffer(_bytes(content), dtype=np.uint8)
                    n = np.arange(len(piece) - WIDTH + 1)
                    window.append(_spans(_sums(piece), n, n + WIDTH).view(np.int64))
                    size.append(len(n))
                take = np.repeat(np.arange(len(size)), size)
                bit = np.concatenate([np.arange(n) for n in size]) if size else np.empty(0)
                yield pa.record_batch(
                    [pa.array(np.concatenate(window) if window else np.empty(0, np.int64)),
                     *[batch.column(k).take(pa.array(take)) for k in range(3)], pa.array(bit.astype(np.int32))],
                    ["window", "hash", "digest", "single", "bit"])

    one = step(segs.select("hash", "digest", "single", "content").mapInArrow(run, kinds))
    twice = one.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    return one.join(twice, "window").where("single").groupBy("hash", "digest").agg(
        F.expr("coalesce(bit_or(if(bit < 63, shiftleft(1L, bit), 0L)), 0L)").alias("low"),
        F.expr("coalesce(bit_or(if(bit >= 63, shiftleft(1L, bit - 63), 0L)), 0L)").alias("high"))


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES,
            strings: int = STRINGS, crowd: int = CROWD) -> DataFrame:
    """(doc, uid, cuts): per document with repeated windows a list of (first window, windows, two bit masks or null for all)."""
    rows = numbered(docs, doc_id, text)
    lists = step(_all_segments(rows))
    every = lists.select("doc", "uid", F.inline(F.arrays_zip("hash", "digest", "place")))
    again = step(every.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"))
    occurrences = step(every.join(again, "hash"))
    origin = F.min(F.struct("doc", "uid", "place")).alias("origin")
    different = step(occurrences.groupBy("hash", "digest").agg(F.count("*").alias("n"), origin))
    # Groups of one segment, and those in which every segment stands twice, have nothing left to decide.
    undecided = different.groupBy("hash").agg(F.count("*").alias("segments"), F.min("n").alias("least")).where(
        "segments > 1 and least = 1").select("hash", "segments")
    wanted = different.join(undecided, "hash").select("origin.doc", "origin.uid", F.struct(
        "origin.place", "hash", "digest", (F.col("n") == 1).alias("single"), (F.col("segments") > crowd).alias("crowded")).alias("s"))
    contents = step(_contents(rows, wanted.groupBy("doc", "uid").agg(F.collect_list("s").alias("own"))))
    masks = _by_transform(contents.where("not crowded"), shard_bytes, strings)
    crowded = contents.where("crowded")
    if not crowded.isEmpty():
        masks = masks.unionByName(_singly(crowded))
    masks = step(masks)
    # Written, so that both sides of the next join are shuffled for it and a frequent segment can be split.
    told = step(different.join(masks, ["hash", "digest"], "left").where("n > 1 or low is not null").select(
        "hash", "digest", F.when(F.col("n") == 1, F.col("low")).alias("low"), F.when(F.col("n") == 1, F.col("high")).alias("high")))
    cut = F.struct(F.expr("place >> 14").alias("first"), F.expr("place >> 7 & 127").alias("count"), "low", "high").alias("cut")
    cuts = occurrences.join(told, ["hash", "digest"]).select("doc", "uid", cut)
    # Repeated rows share doc and uid, and so their cuts; a list is bounded by the length of its document.
    return step(cuts.groupBy("doc", "uid").agg(F.collect_set("cut").alias("cuts")))


def covered(n_bytes: int, cuts: list) -> np.ndarray:
    """True for each byte under a repeated window."""
    edges = np.zeros(n_bytes + 1, dtype=np.int64)
    for cut in cuts:
        if cut["low"] is None:
            edges[cut["first"]] += 1
            edges[cut["first"] + cut["count"] + WIDTH - 1] -= 1
        else:
            bits = cut["low"] | cut["high"] << 63
            at = cut["first"] + np.array([b for b in range(bits.bit_length()) if bits >> b & 1], dtype=np.int64)
            np.add.at(edges, at, 1)
            np.add.at(edges, at + WIDTH, -1)
    return np.cumsum(edges)[:n_bytes] > 0


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES,
                   strings: int = STRINGS, crowd: int = CROWD) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary) per row of ``docs``; kept bytes follow each other directly.

    A byte of a text in UTF-8 is removed if a string of 200 bytes that covers it also starts at any other place of
    any text; all places lose it. Strings are judged on the input and lie in one text. ``n_spans`` counts maximal
    removed runs. Rows that repeat id and text, or text alone, are texts of their own, and so lose what they share.
    Null ids stay null. Null, empty and shorter texts lose nothing; a null text has no bytes. An empty table
    gives no rows; other columns are not read. Cuts can part a character, so what is kept is binary.
    """
    rows = numbered(docs, doc_id, text)
    cuts = repeats(docs, doc_id, text, shard_bytes, strings, crowd)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                        ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                columns: list[list] = [[], [], [], []]
                for own, cut in zip(batch.column(1), batch.column(2).to_pylist()):
                    text, spans, kept = _bytes(own), 0, None
                    if cut:
                        gone = covered(len(text), cut)
                        spans = int(np.count_nonzero(np.diff(gone.view(np.int8), prepend=0) == 1))
                        kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
                    kept = text if kept is None else kept
                    for column, value in zip(columns, (len(text), len(text) - len(kept), spans, kept)):
                        column.append(value)
                yield pa.record_batch([batch.column(0), *[pa.array(c, f.type) for c, f in zip(columns, list(schema)[1:])]], schema=schema)

    return rows.join(cuts, ["doc", "uid"], "left").select("doc_id", "text", "cuts").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
