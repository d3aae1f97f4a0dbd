"""Packing of tokenised documents into fixed-length training sequences, planned on a histogram of lengths.

Best-fit decreasing is run over counts: there are at most ``budget`` different lengths, so the plan's
work and size depend on the budget and not on the number of documents. Equal bins are kept as ranges of
sequence numbers. The plan lists, for each length, which ranks go to which range of sequences at which
offset. A piece learns its rank among the pieces of its length from its place in a written table: a
local count plus the counts of earlier slices. No group of equal lengths is ever sorted or gathered.
"""

from __future__ import annotations

import json
import re
import unicodedata
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import small_batches, step, text_or_empty

BUDGET = 2048
SEPARATOR = 0
#: Words that one of the two generations of a task's memory holds.
WORDS_KEPT = 200_000
#: Documents, and their characters, that are looked up together.
_DOCS, _CHARS = 1024, 1 << 21
#: Bytes that a byte-level tokenizer shows as themselves; the others are shown as U+0100 and on, in their order.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]


class TwoGenerations(dict):
    """Found values by key. A full generation becomes the old one, in which what is asked for again is found."""

    def __init__(self, most: int):
        self.most, self.old = most, {}

    def turn(self) -> None:
        """To be called between two uses: what was not asked for during a whole generation is forgotten."""
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()

    def found(self, keys: list) -> list:
        """The value of each key, None for those that neither generation holds; those of the old one move to the new."""
        out = list(map(self.get, keys))
        for n, value in enumerate(out):
            if value is None and (value := self.old.get(keys[n])) is not None:
                out[n] = self[keys[n]] = value
        return out


class WordIds:
    """Ids of whole texts by a lower-casing tokenizer that drops white space, one look-up per word.

    White space ends a token of such a tokenizer and leaves no trace, so the ids of a text are the ids of
    its words in a row, and a word that was met before need not be encoded again. A word of a text with
    characters up to U+00FF only is normalised already once it is lower-cased; it is split by the pattern in the tokenizer's
    own file and its parts go to the tokenizer's model, those of many words at once. All other texts, and those that spell
    an added token of the tokenizer, go through the tokenizer as they are. Ids are little-endian unsigned 32-bit.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.words = TwoGenerations(WORDS_KEPT)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"].lower() for t in spec.get("added_tokens") or []]
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        suffix = spec["model"].get("end_of_word_suffix")
        self.simple = steps == ["NFC", "Replace", "Lowercase"] and [c["type"] for c in cuts] == ["Split", "ByteLevel"] and bool(suffix)
        if self.simple:
            self.cut = re.compile(self._narrow(cuts[0]["pattern"]["Regex"]))
            # The model alone, for parts that blanks keep apart; its last token of each part has the suffix.
            self.model = Tokenizer(self.tokenizer.model)
            self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
            self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
            # A blank stands between parts only.
            hidden = [b for b in range(256) if b not in set(_SHOWN)]
            self.shown = np.arange(256, dtype="<u2")
            self.shown[hidden] = range(256, 256 + len(hidden))
            self.shown[32] = 32

    @staticmethod
    def _narrow(pattern: str) -> str:
        """The pattern with letters and numbers spelt out for characters up to U+00FF."""
        for kind in "LN":
            own = "".join(re.escape(chr(c)) for c in range(256) if unicodedata.category(chr(c))[0] == kind)
            pattern = pattern.replace(f"[\\p{{{kind}}}]", f"[{own}]").replace(f"\\p{{{kind}}}", own)
        return pattern

    def part_ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all parts in a row, and where each part's begin and the last ends."""
        shown = self.shown[np.frombuffer(" ".join(parts).encode(), dtype=np.uint8)].tobytes().decode("utf-16-le")
        ids = np.asarray(self.model.encode_batch_fast([shown], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) == len(parts):
            return ids, np.concatenate(([0], ends))
        return _joined([np.array([t.id for t in self.tokenizer.model.tokenize(own)], dtype="<u4").tobytes()
                        for own in shown.split(" ")])

    def new_words(self, words: list[str]) -> list[bytes]:
        """Blanks end a part, so the parts of all words are found at once; a word ends where its characters do."""
        parts = self.cut.findall(" ".join(words))
        if "".join(parts) == "".join(words):
            last = np.searchsorted(_ends(parts)[1:], _ends(words)[1:]) + 1
        else:
            cut = [self.cut.findall(w) for w in words]
            parts, last = [p for own in cut for p in own], _ends(cut)[1:]
        coded = pa.array(parts, pa.large_string()).dictionary_encode()
        ids, ends = _copied(*self.part_ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), coded.indices.to_numpy())
        data, stops = ids.tobytes(), [0, *(4 * ends[last]).tolist()]
        return [data[a:b] for a, b in zip(stops, stops[1:])]

    def whole(self, text: str) -> bytes:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def lowered(self, text: str) -> str | None:
        """A text whose words can be looked up, in lower case; None if it has to go through the tokenizer."""
        try:
            plain = text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        # U+001C to U+001F end a word for Arrow and not for the tokenizer.
        if not self.simple or len(plain.translate(None, b"\x1c\x1d\x1e\x1f")) < len(text):
            return None
        lower = text.lower()
        return None if any(a in lower for a in self.added) else lower

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. Each word of the texts is looked up once, and its ids are copied to where it stands."""
        self.words.turn()
        lower = [self.lowered(t) for t in texts]
        split = pc.utf8_split_whitespace(pa.array(lower, pa.large_string()))
        coded = split.flatten().dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.words[""] = b""  # left by white space at either end of a text
        found = self.words.found(names)
        unknown = [n for n, value in enumerate(found) if value is None]
        if unknown:
            words = [names[n] for n in unknown]
            for n, word, value in zip(unknown, words, self.new_words(words)):
                found[n] = self.words[word] = value
        ids, ends = _copied(*_joined(found), coded.indices.to_numpy())
        out, places = ids.tobytes(), (4 * ends[split.offsets.to_numpy()]).tolist()
        return [self.whole(t) if s is None else out[a:b] for t, s, a, b in zip(texts, lower, places, places[1:])]

    def __call__(self, text: str) -> bytes:
        return self.many([text])[0]


def _ends(values: list) -> np.ndarray:
    """Where each of the values begins if they stand in a row, and where the last ends."""
    return np.concatenate(([0], np.cumsum(np.fromiter(map(len, values), np.int64, len(values)))))


def _joined(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all values in a row, and their ``_ends``."""
    return np.frombuffer(b"".join(values), dtype="<u4"), _ends(values) // 4


def _copied(ids: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the values that ``codes`` names, in a row, and their ends."""
    count = np.diff(ends)[codes]
    out = np.concatenate(([0], np.cumsum(count)))
    return ids[np.repeat(ends[codes] - out[:-1], count) + np.arange(out[-1])], out


def _together(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of up to ``_DOCS`` texts with ``_CHARS`` characters, or of one longer text."""
    first = held = 0
    for n, size in enumerate(sizes):
        if n > first and (n - first == _DOCS or held + size > _CHARS):
            yield first, n
            first, held = n, 0
        held += size
    if len(sizes) > first:
        yield first, len(sizes)


def cut_pieces(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text",
               budget: int = BUDGET, separator: int = SEPARATOR) -> DataFrame:
    """Tokenise whole texts, end each with ``separator`` and cut those over ``budget`` into pieces.

    Returns, written once: doc_id, piece (from 0), start (ids of the document before it), length, ids
    (binary, little-endian unsigned 32-bit), and slice and rank: the place among equal lengths inside the
    slice. A null or empty text is its separator alone. Repeated rows give repeated pieces.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                        ("length", pa.int64()), ("ids", pa.binary()), ("slice", pa.int32()), ("rank", pa.int64())])
    end = np.asarray([separator], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_ids, place, ranks = WordIds(tokenizer_path), TaskContext.get().partitionId(), [0] * (budget + 1)
        for whole in batches:
            for first, last in _together(pc.utf8_length(whole.column(1)).to_pylist()):
                batch = whole.slice(first, last - first)
                rows = []
                for name, ids in zip(batch.column(0).to_pylist(), word_ids.many(batch.column(1).to_pylist())):
                    ids += end
                    for n, begin in enumerate(range(0, len(ids), 4 * budget)):
                        piece = ids[begin:begin + 4 * budget]
                        length = len(piece) // 4
                        rows.append((name, n, begin // 4, length, piece, place, ranks[length]))
                        ranks[length] += 1
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("text"))
    with small_batches(docs.sparkSession):
        return step(slim.mapInArrow(
            run, "doc_id long, piece int, start long, length long, ids binary, slice int, rank long"))


def plan_sequences(counts: dict[int, int], budget: int = BUDGET) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Best-fit decreasing over counts of lengths.

    Returns (length, first rank, number of ranks, first sequence, pieces a sequence takes, offset) rows
    and the number of sequences. Rank q of a row goes to sequence ``first + (q - first rank) // pieces``
    at ``offset + (q - first rank) % pieces * length``. Each length splits at most one range of equal
    bins and opens at most two, so there are at most three ranges per length.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> ranges [first, last) of sequences
    sizes: list[int] = []  # the keys of room in order
    plan, opened = [], 0

    def put(left: int, first: int, last: int) -> None:
        if left and last > first:
            if left not in room:
                room[left] = []
                insort(sizes, left)
            room[left].append((first, last))

    for length in sorted(counts, reverse=True):
        if not 0 < length <= budget:
            raise ValueError(f"a piece of {length} ids does not fit {budget}")
        rank, todo = 0, counts[length]

        def fill(left: int, first: int, last: int) -> None:
            """Put pieces into the sequences of one range until it or the pieces run out."""
            nonlocal rank, todo
            each = left // length
            whole = min(last - first, todo // each)
            if whole:
                plan.append((length, rank, whole * each, first, each, budget - left))
                put(left - each * length, first, first + whole)
                rank, todo, first = rank + whole * each, todo - whole * each, first + whole
            if todo and first < last:
                plan.append((length, rank, todo, first, todo, budget - left))
                put(left - todo * length, first, first + 1)
                rank, todo, first = rank + todo, 0, first + 1
            put(left, first, last)

        while todo and (at := bisect_left(sizes, length)) < len(sizes):
            left = sizes.pop(at)
            ranges = room.pop(left)
            for first, last in ranges:
                if todo:
                    fill(left, first, last)
                else:
                    put(left, first, last)
        if todo:
            more = -(-todo // (budget // length))
            first, opened = opened, opened + more
            fill(budget, first, opened)
    return plan, opened


def place_pieces(pieces: DataFrame, budget: int = BUDGET) -> DataFrame:
    """Add sequence_id and offset to ``pieces`` (length, slice, rank and any other columns).

    Sequences are gapless from offset 0 and hold at most ``budget`` ids. ``pieces`` must be a written
    table, as ``cut_pieces`` returns it. An empty table gives no rows.
    """
    per_slice = pieces.groupBy("length", "slice").agg(F.count("*").alias("_n"))
    # One row per length, at most `budget` of them, whatever the number of documents.
    counts = {r["length"]: r["n"] for r in per_slice.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    rows, _ = plan_sequences(counts, budget)
    names = ("length", "_first", "_many", "_sequence", "_each", "_offset")
    plan = pieces.sparkSession.createDataFrame(rows, T.StructType([T.StructField(n, T.LongType()) for n in names]))
    earlier = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    begins = per_slice.select("length", "slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    ranked = pieces.join(begins, ["length", "slice"]).withColumn("_q", F.col("rank") + F.col("_before"))
    # The plan's size depends on the budget alone: some rows for each of `budget` lengths.
    placed = ranked.join(F.broadcast(plan), (ranked["length"] == plan["length"]) & (F.col("_q") >= F.col("_first"))
                         & (F.col("_q") < F.col("_first") + F.col("_many")))
    step = F.col("_q") - F.col("_first")
    return placed.select(
        *[pieces[c] for c in pieces.columns if c not in ("slice", "rank")],
        (F.col("_sequence") + F.floor(step / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + step % F.col("_each") * pieces["length"]).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text",
         budget: int = BUDGET) -> DataFrame:
    """Documents to placed pieces: doc_id, piece, start, length, ids, sequence_id, offset.

    Null doc_ids are kept as null; columns other than the two named ones are not read.
    """
    return place_pieces(cut_pieces(docs, tokenizer_path, doc_id, text, budget), budget)
