import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from riskloom.llm import ranking
from tests.llm.frames import DOCS, awkward, empty, planted, sentence

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=20):
    counts = [(i, Counter(split(t)), len(split(t))) for i, t in docs if split(t)]
    n_docs, n_terms = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = Counter()
    for item, text in items:
        found = []
        for i, c, n in counts:
            m = 75 + 25 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                        for t in split(text) if c[t])
            if score:
                found.append((-score, i is None, i or 0))
        for rank, (score, null, i) in enumerate(sorted(found)[:top], 1):
            out[item, rank, None if null else i, -score] += 1
    return out


def asked(spark, docs):
    rng = random.Random(1)
    texts = [t for (t,) in docs.select("text").collect() if t]
    items = [(k, " ".join(rng.sample(t.split(), min(6, len(t.split()))))) for k, t in enumerate(rng.sample(texts, min(12, len(texts))))]
    items += [(None, "one two WORDS Words"), (3, None), (4, ""), (5, "?!"), (6, "unheardof"), (7, "a " * 40), (7, "a " * 40), (8, "ünï CÖDÉ 一二三")]
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as qid", "'x' as doc_id", "2 as terms", "3 as size"), items


@pytest.mark.parametrize("make, top, block_terms", [(awkward, 20, 1 << 18), (planted, 20, 1 << 18), (planted, 3, 10), (awkward, 2, 1)])
def test_equals_brute_force(spark, make, top, block_terms):
    docs = make(spark)
    items, rows = asked(spark, docs)
    got = Counter(tuple(r) for r in ranking.search(docs, items, top=top, block_terms=block_terms).collect())
    assert got == brute([tuple(r) for r in docs.select("doc_id", "text").collect()], rows, top)


def test_ties_beyond_a_tile_rank_by_id(spark, monkeypatch):
    monkeypatch.setattr(ranking, "DOCS", 16)
    rng = random.Random(3)
    ids = list(range(300))
    rng.shuffle(ids)
    docs = spark.createDataFrame([(i, "same words here" if i % 3 else sentence(rng, 30), "en", "s", 0) for i in ids], DOCS)
    items = spark.createDataFrame([(1, "same here"), (2, "words")], "item_id long, text string")
    got = [tuple(r) for r in ranking.search(docs, items).orderBy("item_id", "rank").collect()]
    first = [i for i in range(300) if i % 3][:20]
    assert [r[:3] for r in got] == [(k, n + 1, i) for k in (1, 2) for n, i in enumerate(first)]


def test_large_weights_stay_exact():
    rng = random.Random(5)
    for most in (10, 1000, ranking.ROW_WEIGHT):
        items = [(k, [(t, rng.randint(1, 3 * min(most, 10**9))) for t in rng.sample(range(40), rng.randint(0, 12))]) for k in range(9)]
        tile = ranking.Tile(items, most)
        assert (tile.weights.sum(axis=1) <= most).all()
        ids = np.array([t for d in range(7) for t in range(40) if (t * d) % 3 == 0])
        column = np.array([d for d in range(7) for t in range(40) if (t * d) % 3 == 0])
        values = np.array([rng.randint(1, 999_999) for _ in ids])
        told = {(t, d): int(v) for t, d, v in zip(ids, column, values)}
        want = [[sum(w * told.get((t, d), 0) for t, w in own) for d in range(7)] for _, own in items if own]
        assert tile.scores(ids, column, values, 7).tolist() == want


def test_empty_tables(spark):
    docs = planted(spark)
    items, _ = asked(spark, docs)
    assert ranking.search(empty(spark), items).count() == 0 and ranking.search(docs, items.where("false")).count() == 0
    assert ranking.search(docs.where("doc_id < 0"), items.where("item_id = 5")).count() == 0
