"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs: lines, and inside long lines runs of words that end where a word's hash
says so, so that a cut depends on the words around it and not on its distance from the start. Each
paragraph's 64-bit digest goes into three cells of a sketch; a cell holds a count, the xor of its digests
and the xor of their checks. The sketches of two texts subtract cell by cell: paragraphs of both cancel
out, and peeling cells with a single digest recovers the differing ones. If that gets stuck, the two are
sketched again with more cells. What was recovered gives the likeness: the shared share of all
different paragraphs.
"""

from __future__ import annotations

import base64
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.common import text_or_empty
from riskloom.session import slice_count

#: Words of a paragraph on average where no line break ends it.
RUN = 6
#: Cells of the fingerprint, a multiple of HASHES, and how many times as many are taken when peeling fails.
CELLS, GROWTH = 24, 4
HASHES = 3
_GOLDEN, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def paragraphs(text: str) -> np.ndarray:
    """Digests of the different paragraphs of a text, sorted; white space between words does not count."""
    digest = xxhash.xxh64_intdigest
    found = set()
    for line in text.encode("utf-8", "surrogatepass").split(b"\n"):
        words = line.split()
        start, size = 0, len(words)
        if size > RUN:
            for n in [n for n, w in enumerate(words, 1) if zlib.crc32(w) % RUN == 0]:
                found.add(digest(b" ".join(words[start:n])))
                start = n
        if start < size:
            found.add(digest(b" ".join(words[start:])))
    return np.sort(np.fromiter(found, dtype=np.uint64, count=len(found)))


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + np.uint64(salt) * _GOLDEN) * _MIX
        x ^= x >> np.uint64(29)
        x *= _GOLDEN
        return x ^ (x >> np.uint64(32))


def _places(keys: np.ndarray, cells: int, salt: int) -> list[np.ndarray]:
    """The cells of each digest, one in each third of the sketch."""
    third = cells // HASHES
    return [(_mixed(keys, 3 * salt + n + 1) % np.uint64(third)).astype(np.intp) + n * third for n in range(HASHES)]


class Sketches:
    """Sketches of many documents side by side: ``base`` is where the cells of a digest's document begin."""

    def __init__(self, documents: int, cells: int, salt: int):
        self.cells, self.salt = cells, salt
        self.count = np.zeros(documents * cells, dtype=np.int64)
        self.keys = np.zeros(documents * cells, dtype=np.uint64)
        self.checks = np.zeros(documents * cells, dtype=np.uint64)

    def add(self, keys: np.ndarray, document: np.ndarray, sign: int | np.ndarray) -> None:
        check = _mixed(keys, 77)
        for place in _places(keys, self.cells, self.salt):
            at = place + document * self.cells
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.keys, at, keys)
            np.bitwise_xor.at(self.checks, at, check)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(digest, document, side +1 or -1) of all that can be recovered; what is left stays in the cells."""
        found, third, idle, n = [], self.cells // HASHES, 0, 0
        count = self.count.reshape(-1, self.cells)
        while idle < HASHES:
            # One third at a time: there a digest of a document has one cell, so none is taken twice.
            document, at = np.nonzero(np.abs(count[:, n * third:(n + 1) * third]) == 1)
            at += document * self.cells + n * third
            good = self.checks[at] == _mixed(self.keys[at], 77)
            document, at = document[good], at[good]
            idle = 0 if len(at) else idle + 1
            n = (n + 1) % HASHES
            if len(at):
                keys, side = self.keys[at], self.count[at]
                found.append((keys, document, side))
                self.add(keys, document, -side)
        if not found:
            return np.empty(0, np.uint64), np.empty(0, np.intp), np.empty(0, np.int64)
        return tuple(np.concatenate(part) for part in zip(*found))

    def open_documents(self) -> np.ndarray:
        """Documents whose sketch did not come out empty."""
        return np.flatnonzero(((self.count != 0) | (self.keys != 0)).reshape(-1, self.cells).any(axis=1))


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(s) for s in sets]
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), np.repeat(np.arange(len(sets)), sizes)


def differences(left: list[np.ndarray], right: list[np.ndarray], cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """Per couple of digest sets: how many are in the left one only, and in the right one only.

    Sketches of ``cells`` cells first; couples that cannot be peeled are sketched again with ``GROWTH`` times as many,
    under new hashes, until all came out.
    """
    only_left, only_right = np.zeros(len(left), dtype=np.int64), np.zeros(len(left), dtype=np.int64)
    todo, salt = np.arange(len(left)), 0
    while len(todo):
        sketch = Sketches(len(todo), cells, salt)
        for sets, sign in ((left, 1), (right, -1)):
            keys, document = _flat([sets[i] for i in todo])
            sketch.add(keys, document, sign)
        _, document, side = sketch.peel()
        stuck = sketch.open_documents()
        done = np.setdiff1d(np.arange(len(todo)), stuck)
        for out, sign in ((only_left, 1), (only_right, -1)):
            out[todo[done]] = np.bincount(document[side == sign], minlength=len(todo))[done]
        todo, cells, salt = todo[stuck], GROWTH * cells, salt + 1
    return only_left, only_right


def likeness(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Shared share of the different paragraphs of each couple; 1 if neither has any."""
    a, b = differences(left, right)
    sizes = np.array([len(s) for s in left], dtype=np.int64)
    both, every = sizes - a, sizes + b
    return np.where(every > 0, both / np.maximum(every, 1), 1.0)


def encoded(sets: list[np.ndarray], cells: int = CELLS) -> list[str]:
    """Each set's sketch as text: the number of digests, then counts, digests and checks of the cells."""
    sketch = Sketches(len(sets), cells, 0)
    sketch.add(*_flat(sets), 1)
    out = []
    for n, keys in enumerate(sets):
        own = slice(n * cells, (n + 1) * cells)
        raw = struct.pack("<I", len(keys)) + sketch.count[own].astype("<u4").tobytes() + sketch.keys[own].astype(
            "<u8").tobytes() + sketch.checks[own].astype("<u2").tobytes()
        out.append(base64.b64encode(raw).decode())
    return out


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", slices: int | None = None) -> DataFrame:
    """(slice, doc_id, text, real) in partitions sorted so that each real row is followed by its next document.

    Next means descending doc_id, nulls last, and the first document after the last. Ids are dealt into
    slices by range; the first rows of a slice are also the last ones, not real, of the slice before, so
    that texts are shuffled once. Rows with one id follow in the order of their texts.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    count = slices or 2 * slice_count(spark)
    # Cuts between slices need not be exact: `count` of them at most, whatever the data.
    shares = [n / count for n in range(1, count)]
    cuts = sorted(set(rows.stat.approxQuantile("doc_id", shares, min(0.01, 0.25 / count)))) if shares else []
    bounds = F.array(*[F.lit(int(c)) for c in cuts]).cast("array<bigint>")
    # Slice 0 holds the largest ids; nulls follow the smallest in the last slice.
    place = F.when(F.col("doc_id").isNull(), F.lit(len(cuts))).otherwise(
        F.size(F.filter(bounds, lambda c: c >= F.col("doc_id")))).alias("slice")
    # One row per slice: its largest id, with which its first rows are known, and whether it has nulls only.
    heads = rows.select(place, "doc_id").groupBy("slice").agg(F.max("doc_id").alias("head")).orderBy("slice").collect()
    if not heads:
        return rows.select(F.lit(0).alias("slice"), "doc_id", "text", F.lit(True).alias("real"))
    before = {h["slice"]: heads[i - 1]["slice"] for i, h in enumerate(heads)}
    sent = F.create_map(*[x for h in heads for x in (F.lit(h["slice"]), F.struct(
        F.lit(h["head"]).cast("long").alias("head"), F.lit(before[h["slice"]]).alias("to")))])
    dealt = rows.withColumn("slice", place).withColumn("own", F.element_at(sent, F.col("slice")))
    real = F.array(F.struct(F.col("slice"), F.lit(True).alias("real")))
    halo = F.array(F.struct(F.col("own.to").alias("slice"), F.lit(False).alias("real")))
    first = F.col("own.head").eqNullSafe(F.col("doc_id"))
    out = dealt.select("doc_id", "text", F.inline(F.when(first, F.concat(real, halo)).otherwise(real)))
    return out.select("slice", "doc_id", "text", "real").repartition(count, "slice").sortWithinPartitions(
        "slice", F.desc("real"), F.col("doc_id").desc_nulls_last(), "text")


def fingerprint(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 3) code points replaced by the first as many of the next
    document (see ``with_next``), or all if that is shorter. A null text is empty; the only document is its
    own next one. Repeated rows are documents of their own. An empty table gives no rows; other columns are
    not read.
    """

    def told(rows: list[tuple[int | None, str, str]]) -> pd.DataFrame:
        edited = []
        for _, own, after in rows:
            cut = len(own) // 3
            edited.append(own[:len(own) - cut] + after[:cut])
        mine = [paragraphs(own) for _, own, _ in rows]
        theirs = [paragraphs(e) for e in edited]
        last = paragraphs(rows[-1][2])
        following = [mine[n + 1] if n + 1 < len(rows) and rows[n + 1][1] == rows[n][2] else paragraphs(rows[n][2])
                     for n in range(len(rows) - 1)] + [last]
        return pd.DataFrame({
            "doc_id": pd.array([r[0] for r in rows], dtype="Int64"), "n_chars": [len(r[1]) for r in rows],
            "edited_text": edited, "fingerprint": encoded(mine), "edited_fingerprint": encoded(theirs),
            "near_edited": likeness(mine, theirs), "near_next": likeness(mine, following)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, size, held = [], 0, None
        for batch in batches:
            for place, name, own, real in zip(batch["slice"], batch["doc_id"], batch["text"], batch["real"]):
                name = None if pd.isna(name) else int(name)
                if held is not None and held[0] == place and held[3]:
                    rows.append((held[1], held[2], own))
                    size += len(own)
                held = (place, name, own, real)
                if len(rows) >= 256 or size > 1 << 20:
                    yield told(rows)
                    rows, size = [], 0
        if rows:
            yield told(rows)

    return with_next(docs, doc_id, text).mapInPandas(
        run, "doc_id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")
