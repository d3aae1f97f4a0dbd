import random

import numpy as np
import pytest

from riskloom.llm import fingerprints as fp
from tests.llm.frames import awkward, empty, planted, sentence


def jaccard(a, b):
    a, b = set(fp.paragraphs(a).tolist()), set(fp.paragraphs(b).tolist())
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("make, slices", [(awkward, 1), (awkward, 5), (planted, 1), (planted, 7), (planted, 40)])
def test_equals_the_definition(spark, monkeypatch, make, slices):
    monkeypatch.setattr(fp.with_next, "__defaults__", ("doc_id", "text", slices))
    docs = make(spark)
    rows = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    want = []
    for n, (i, text) in enumerate(rows):
        after = rows[(n + 1) % len(rows)][1]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + after[:cut]
        want.append((i, len(text), edited, round(jaccard(text, edited), 9), round(jaccard(text, after), 9)))
    got = fp.fingerprint(docs).collect()
    told = [(r["doc_id"], r["n_chars"], r["edited_text"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in got]
    assert sorted(told, key=str) == sorted(want, key=str)
    prints = {}
    texts = {(i, len(t)): t for i, t in rows}
    for r in got:
        prints.setdefault(texts[r["doc_id"], r["n_chars"]], set()).add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values())


def test_empty_table_and_single_document(spark):
    assert fp.fingerprint(empty(spark)).count() == 0
    one = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    assert [r["edited_text"] for r in fp.fingerprint(one).collect()] == ["abcdab"]


def test_peeling_recovers_large_differences():
    rng = np.random.default_rng(0)
    left = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (0, 1, 5, 300, 20_000, 50)]
    right = [s[: len(s) // 2] for s in left[:-1]] + [np.unique(rng.integers(0, 2**63, 400, dtype=np.uint64))]
    a, b = fp.differences(left, right)
    assert a.tolist() == [len(s) - len(s) // 2 for s in left[:-1]] + [50] and b.tolist() == [0] * 5 + [400]


def test_an_edit_keeps_most_paragraphs():
    rng = random.Random(4)
    text = sentence(rng, 400)
    words = text.split()
    words.insert(100, "inserted")
    assert jaccard(text, " ".join(words)) > 0.9 and jaccard(text, sentence(rng, 400)) < 0.05
