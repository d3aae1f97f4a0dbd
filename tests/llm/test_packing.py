import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskloom.llm import packing
from tests.llm.frames import awkward, empty, planted

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("budget", [5, 10, 64, 2048])
def test_plan_places_every_rank_once_and_without_gaps(budget):
    rng = random.Random(budget)
    for _ in range(40):
        counts = Counter(min(budget, 1 + int(rng.expovariate(3 / budget))) for _ in range(rng.randint(1, 800)))
        plan, opened = packing.plan_sequences(dict(counts), budget)
        taken, bins = defaultdict(list), defaultdict(list)
        for length, first, many, sequence, each, offset in plan:
            for q in range(first, first + many):
                taken[length].append(q)
                bins[sequence + (q - first) // each].append((offset + (q - first) % each * length, length))
        assert all(sorted(taken[x]) == list(range(n)) for x, n in counts.items())
        assert len(bins) == opened
        for content in bins.values():
            at = 0
            for offset, length in sorted(content):
                assert offset == at
                at += length
            assert at <= budget
        # Best-fit decreasing needs at most 11/9 of the best packing and 6/9 more.
        assert opened <= 11 / 9 * -(-sum(x * n for x, n in counts.items()) // budget) * 1.2 + 2


def test_plan_size_does_not_grow_with_the_documents():
    few = packing.plan_sequences({x: 3 for x in range(1, 2049)})[0]
    many = packing.plan_sequences({x: 3_000_000 for x in range(1, 2049)})[0]
    assert len(many) <= 3 * 2048 and len(many) < 3 * len(few)


def test_word_look_ups_equal_whole_texts():
    reader = packing.WordIds(PATH)
    texts = ["a<|endoftext|>b  c", "e\u0301 \u0301x", "x\u00a0y\u3000z\x1c w", "İstanbul ΑΣ", "don't we'll 's \x85 ½² µ", "ABC Éà!! (x)\t\n12 3", "", "\x00a\x1fb"]
    for text in texts:
        assert np.frombuffer(reader(text), "<u4").tolist() == reader.tokenizer.encode(text, add_special_tokens=False).ids


def test_added_tokens_have_the_ids_of_the_untouched_tokenizer():
    reader, plain = packing.WordIds(PATH), Tokenizer.from_file(PATH)
    assert np.frombuffer(reader("a<|endoftext|>b"), "<u4").tolist() == [320, 49407, 321]
    for text in ["<|startoftext|> x <|endoftext|>", "<|ENDOFTEXT|> y", "a <|endoftext|", "c<|endoftext|><|endoftext|>d", "\u4e00<|endoftext|>"]:
        assert np.frombuffer(reader(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("make", [awkward, planted])
def test_pieces_hold_the_ids_of_the_texts(spark, make):
    docs = make(spark)
    tokenizer = packing.WordIds(PATH).tokenizer
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), 256)):
            want[r["doc_id"], piece, start, tuple(ids[start:start + 256])] += 1
    got, bins = Counter(), defaultdict(list)
    for r in packing.pack(docs, PATH, budget=256).collect():
        ids = tuple(np.frombuffer(r["ids"], "<u4").tolist())
        assert len(ids) == r["length"]
        got[r["doc_id"], r["piece"], r["start"], ids] += 1
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == want
    for content in bins.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= 256


def test_empty_table(spark):
    assert packing.pack(empty(spark), PATH).count() == 0


def test_parts_of_many_new_words_are_found_at_once():
    """A call looks for the parts of its new words once, however many they are."""
    reader, calls = packing.WordIds(PATH), []

    class Counted:
        def findall(self, text, cut=reader.cut):
            calls.append(text)
            return cut.findall(text)

    reader.cut = Counted()
    texts = [" ".join(f"w{'abcdefghij'[n % 10]}{n}, né{n}!'s" for n in range(k, k + 200)) + " " for k in range(0, 2000, 100)]
    got = reader.many(texts)
    assert len(calls) == 1
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == reader.tokenizer.encode(text, add_special_tokens=False).ids
    # What is known is not looked for again, and is the same.
    assert reader.many(texts) == got and len(calls) == 1


def test_words_are_the_same_after_both_generations_were_full(monkeypatch):
    monkeypatch.setattr(packing, "WORDS_KEPT", 50)
    reader = packing.WordIds(PATH)
    for n in (0, 1, 2, 0, 1, 40, 0):
        text = " \t".join(f"word{k}x{k * n}" for k in range(n, n + 80)) + "\n"
        assert np.frombuffer(reader(text), "<u4").tolist() == reader.tokenizer.encode(text, add_special_tokens=False).ids
