"""Runs of repeating words: found by splitting texts at rare words, then comparing words a lag apart.

A run is a maximal stretch of words with smallest period q, at least ``MIN_LENGTH`` words and ``MIN_PERIODS``
periods long. Each of its words occurs in it ``MIN_PERIODS`` times or more, so a word that occurs less often
within a segment is in none of the segment's runs and splits it. Counts are taken anew in the parts until
nothing splits; the largest part keeps the counts of the whole less those of the rest, so that a text of n words
takes n log n steps whatever it holds. Segments that are left are scanned lag by lag. A run of period q holds a
multiple of q from which a gram of words recurs q words further on; only these places are looked at, n / q of
them, and places where it does are extended word by word.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import text_or_empty

MIN_LENGTH, MIN_PERIODS = 24, 3
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_ROWS = 64


def segments(words: list, shortest: int = MIN_LENGTH, times: int = MIN_PERIODS) -> list[tuple[int, int]]:
    """(first, end) of the parts of ``words`` that no word with fewer than ``times`` places in its part is left in."""
    counts = Counter(words)
    common = np.fromiter((counts[w] >= times for w in words), dtype=bool, count=len(words))
    edges = np.flatnonzero(np.diff(np.concatenate(([False], common, [False])).view(np.int8))).tolist()
    todo = [(a, b, None, None) for a, b in zip(edges[::2], edges[1::2]) if b - a >= shortest]
    places: dict = {}
    for a, b, *_ in todo:
        for at in range(a, b):
            places.setdefault(words[at], []).append(at)
    whole = []
    while todo:
        first, end, counts, doubtful = todo.pop()
        if counts is None:
            counts = Counter(words[first:end])
            doubtful = counts
        cuts = []
        for word in doubtful:
            if 0 < counts[word] < times:
                own = places[word]
                cuts += own[bisect_left(own, first):bisect_left(own, end)]
        if not cuts:
            whole.append((first, end))
            continue
        cuts.sort()
        parts = list(zip([first] + [c + 1 for c in cuts], cuts + [end]))
        a, b = max(parts, key=lambda p: p[1] - p[0])
        todo += [(x, y, None, None) for x, y in parts if y - x >= shortest and x != a]
        if b - a >= shortest:
            rest = words[first:a] + words[b:end]
            counts.subtract(rest)
            todo.append((a, b, counts, set(rest)))
    return sorted(whole)


def _same(x: np.ndarray, i: int, lag: int, step: int) -> int:
    """How many places from i on, forwards (step 1) or before it, backwards (-1), hold the word ``lag`` places on."""
    done, many, most = 0, 64, len(x) - lag - i if step == 1 else i
    while done < most:
        many = min(2 * many, most - done)
        a = i + done if step == 1 else i - done - many
        differ = x[a:a + many] != x[a + lag:a + lag + many]
        if differ.any():
            return done + int((differ if step == 1 else differ[::-1]).argmax())
        done += many
    return done


def scan(x: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of the numbers ``x``."""
    width = max(1, min_length - 2 * (min_length // min_periods))
    if len(x) < max(min_length, width + 1):
        return []
    mixed = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    grams = np.zeros(len(x) - width + 1, dtype=np.uint64)
    for k in range(width):
        grams = grams * np.uint64(0xD6E8FEB86659FD93) + mixed[k:k + len(grams)]
    found: list[tuple[int, int, int]] = []
    by_length: list[tuple[int, int, int]] = []
    for lag in range(1, len(x) // min_periods + 1):
        hits = np.flatnonzero(grams[:-lag:lag] == grams[lag::lag]) * lag
        if not len(hits):
            continue
        for start, length, period in by_length:
            if length < lag + width:
                break
            if lag % period == 0:  # a lag of several periods of a run that is known
                hits = hits[(hits < start) | (hits + lag + width > start + length)]
        end = -1
        for i in hits.tolist():
            if i < end:
                continue
            start, end = i - _same(x, i, lag, -1), i + _same(x, i, lag, 1)
            length = end - start + lag
            if end > i and length >= max(min_length, min_periods * lag):
                found.append((start, length, lag))
                by_length = sorted(found, key=lambda r: -r[1])
    return sorted(found, key=lambda r: (r[0], r[2]))


def runs_of(words: list, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a text's words, by start, then period."""
    found = []
    for first, end in segments(words, min_length, min_periods):
        ids: dict = {}
        x = np.fromiter((ids.setdefault(w, len(ids)) for w in words[first:end]), dtype=np.int64, count=end - first)
        found += [(first + s, n, q) for s, n, q in scan(x, min_length, min_periods)]
    return found


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [w for w, gone in zip(words, (np.cumsum(edges) > 0).tolist()) if not gone]


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
                  min_periods: int = MIN_PERIODS) -> DataFrame:
    """(doc_id, n_words, runs, strongest, collapsed) per row of ``docs``.

    ``runs`` holds (start, length, period) in words, by start, then period; ``strongest`` is the one with the
    most periods (ties: smallest start, then period), null if there is none; ``collapsed`` is the text's words
    joined by one space without those a run repeats. Rows are looked at one by one: repeated rows and rows that
    repeat an id give a row each, null ids stay null. Null, empty and blank texts have no words, no runs and an
    empty collapsed text. An empty table gives no rows; other columns are not read.
    """
    if min_periods < 2 or min_length < 1:
        raise ValueError("a run has at least two periods and one word")
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("strongest", _RUN),
                        ("collapsed", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = _RUN.names if hasattr(_RUN, "names") else [f.name for f in _RUN]
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                columns: list[list] = [[], [], [], []]
                for own in batch.column(1):
                    words = memoryview(own.as_buffer()).tobytes().split()
                    runs = runs_of(words, min_length, min_periods)
                    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
                    row = (len(words), [dict(zip(names, r)) for r in runs], best and dict(zip(names, best)),
                           b" ".join(collapsed(words, runs)))
                    for column, value in zip(columns, row):
                        column.append(value)
                n, runs, best, left = columns
                yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(runs, schema.field(2).type),
                                       pa.array(best, _RUN), pa.array(left, pa.binary()).cast(pa.string())], schema=schema)

    one = "struct<start:long,length:long,period:long>"
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text")).mapInArrow(
        run, f"doc_id long, n_words long, runs array<{one}>, strongest {one}, collapsed string")


def with_repeating_tails(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text): every tenth document, by the checksum of its id, repeats a passage up to its end.

    With h the checksum of the decimal id, g = h div 10, n words, a = g mod n and p = 1 + (n - a) div (3 + g mod 8),
    each word i >= a of a document with h mod 10 = 0 becomes word a + (i - a) mod p. All other documents, those
    without words and those without an id stay as they are.
    """

    @F.arrow_udf("string")
    def edited(texts: pa.Array, sums: pa.Array) -> pa.Array:
        out = []
        for own, h in zip(texts, sums.to_pylist()):
            words, g = memoryview(own.as_buffer()).tobytes().split(), h // 10
            if words:
                a = g % len(words)
                p = 1 + (len(words) - a) // (3 + g % 8)
                cycle = words[a:a + p]
                words[a:] = (cycle * (-(-(len(words) - a) // len(cycle))))[:len(words) - a]
            out.append(b" ".join(words))
        return pa.array(out, pa.binary()).cast(pa.string())

    own, h = text_or_empty(text), F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), own.alias("text"), h.alias("sum"))
    picked = F.coalesce(F.col("sum") % 10 == 0, F.lit(False))
    # The function is asked about picked rows only: others pass an empty text, and keep their own.
    asked = edited(F.when(picked, F.col("text")).otherwise(F.lit("")), F.coalesce("sum", F.lit(0)))
    return rows.select("doc_id", F.when(picked, asked).otherwise(F.col("text")).alias("text"))
