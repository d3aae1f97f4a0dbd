import random
from collections import Counter

import numpy as np
import pytest

from riskloom.llm import substrings
from riskloom.llm.fm_index import repeated_windows
from tests.llm.frames import awkward, empty, planted


def brute(rows):
    """(doc_id, n_words, n_removed, kept_text); rows of one id and text are one document."""
    import re

    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    first = {}
    for i, t in rows:
        words, key = split(t), (i is None, i or 0, t)
        for p in range(len(words) - 19):
            w = tuple(words[p:p + 20])
            first[w] = min(first.get(w, (*key, p)), (*key, p))
    out = Counter()
    for i, t in rows:
        words, key = split(t), (i is None, i or 0, t)
        gone = {q for p in range(len(words) - 19) if first[tuple(words[p:p + 20])] < (*key, p) for q in range(p, p + 20)}
        out[i, len(words), len(gone), " ".join(w for p, w in enumerate(words) if p not in gone)] += 1
    return out


@pytest.mark.parametrize("make, shard_words, crowd", [
    (planted, 600_000, 8_000), (planted, 300, 8_000), (planted, 600_000, 2), (planted, 600_000, 0), (awkward, 600_000, 8_000), (awkward, 50, 0)])
def test_equals_brute_force(spark, make, shard_words, crowd):
    docs = make(spark)
    if make is awkward:  # texts of one id follow in an order of their own
        docs = docs.where("doc_id is null or doc_id <> 7")
    got = Counter(tuple(r) for r in substrings.remove_repeats(docs, shard_words=shard_words, crowd=crowd).collect())
    assert got == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_documents_keep_their_columns(spark):
    docs = planted(spark)
    out = substrings.without_repeats(docs)
    assert out.columns == docs.columns
    want = {r["doc_id"]: r for r in substrings.remove_repeats(docs).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in out.collect():
        w = want.pop(r["doc_id"])
        assert r["text"] == (w["kept_text"] if w["n_removed"] else texts[r["doc_id"]]) and r["n_chars"] == len(r["text"])
    assert all(w["n_words"] == w["n_removed"] for w in want.values())


def test_awkward_rows_and_empty_table(spark):
    docs = awkward(spark)
    assert substrings.without_repeats(docs).columns == docs.columns
    assert substrings.remove_repeats(docs).count() == docs.count()
    assert substrings.remove_repeats(empty(spark)).count() == 0 and substrings.without_repeats(empty(spark)).count() == 0


def test_index_finds_earlier_windows():
    rng = random.Random(1)
    for _ in range(60):
        base = [[rng.randrange(4) for _ in range(34)] for _ in range(3)]
        seqs = []
        for _ in range(rng.randint(1, 25)):
            a = rng.randint(0, 8)
            s = rng.choice(base)[a:a + rng.randint(20, 34 - a)]
            if rng.random() < 0.5:
                s[rng.randrange(len(s))] = rng.randrange(4)
            seqs.append(np.array(s, dtype=np.uint64))
        seen, want = set(), []
        for s in seqs:
            mask = 0
            for j in range(len(s) - 19):
                mask |= (tuple(s[j:j + 20]) in seen) << j
                seen.add(tuple(s[j:j + 20]))
            want.append(mask)
        assert repeated_windows(seqs, 20) == want


def test_word_hashes_do_not_depend_on_place(monkeypatch):
    text = " ".join(f"word{i % 50} é{i % 7}" for i in range(3000)).encode()
    whole = substrings.word_hashes(text)
    assert len(set(whole.tolist())) == 57 and (whole[:100] == whole[700:800]).all()
    monkeypatch.setattr(substrings, "_PIECE", 64)
    assert (substrings.word_hashes(text) == whole).all()
