import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import pytest

from riskloom.llm import queries, runs
from tests.llm.frames import DOCS, awkward, empty, planted, sentence


def brute_runs(words, min_length=24, min_periods=3):
    found, seen = [], set()
    for q in range(1, len(words) // min_periods + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_length, min_periods * q) and (i, j) not in {(a, b - q) for a, b in seen}:
                seen.add((i, j + q))
                found.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(words):
    found = brute_runs(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return tuple(found), best, " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("min_length, min_periods", [(24, 3), (10, 2), (6, 3), (20, 5), (1, 2)])
def test_runs_equal_brute_force(min_length, min_periods):
    rng = random.Random(min_length)
    for _ in range(250):
        words = []
        while len(words) < rng.randint(0, 200):
            base = [rng.randrange(rng.choice([1, 2, 3, 8])) for _ in range(rng.randint(1, 30))]
            words += base * rng.randint(1, 8) + [rng.randrange(1000) for _ in range(rng.choice([0, 0, 7]))]
        assert runs.runs_of(words, min_length, min_periods) == brute_runs(words, min_length, min_periods)


def test_segments_are_stable_and_lose_no_run():
    rng = random.Random(6)
    for _ in range(200):
        words = [rng.randrange(rng.choice([3, 9, 30])) for _ in range(rng.randint(0, 300))]
        parts = runs.segments(words, 5, 3)
        for a, b in parts:
            assert b - a >= 5 and min(Counter(words[a:b]).values()) >= 3
        inside = [(s, n) for s, n, _ in brute_runs(words, 5, 3)]
        assert all(any(a <= s and s + n <= b for a, b in parts) for s, n in inside)


def test_long_texts_take_no_square_of_their_length():
    words = [str(i % 40) for i in range(150_000)]
    assert runs.runs_of(words) == [(0, 150_000, 40)]
    assert runs.runs_of(["a"] * 200_000) == [(0, 200_000, 1)]
    # A split takes a few words at a time from the ends.
    nested = [w for k in range(3000) for w in [str(k)] * 2] + ["z"] * 30 + [w for k in reversed(range(3000)) for w in [str(k)]]
    assert runs.runs_of(nested) == [(6000, 30, 1)]


def repeating(spark):
    rng = random.Random(9)
    texts = []
    for _ in range(60):
        base = sentence(rng, rng.randint(1, 12))
        texts.append(sentence(rng, rng.randint(0, 20)) + " " + "\n".join([base] * rng.randint(1, 30)) + "\t" + sentence(rng, rng.randint(0, 20)))
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCS)


@pytest.mark.parametrize("make", [awkward, planted, repeating])
def test_rows_equal_brute_force(spark, make):
    docs = make(spark)
    want = Counter()
    for i, t in docs.select("doc_id", "text").collect():
        found, best, left = brute(split(t))
        want[i, len(split(t)), found, best, left] += 1
    got = Counter((r[0], r[1], tuple(map(tuple, r[2])), r[3] and tuple(r[3]), r[4]) for r in runs.periodic_runs(docs).collect())
    assert got == want


def tail(i, words):
    h = zlib.crc32(str(i).encode())
    g, n = h // 10, len(words)
    if i is None or h % 10 or not n:
        return words
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return words[:a] + [words[a + (k - a) % p] for k in range(a, n)]


def test_query_over_edited_documents(spark, tmp_path):
    import hashlib

    rng = random.Random(4)
    rows = [tuple(r)[:5] for r in awkward(spark).collect()] + [(i, sentence(rng, 60 + i), "en", "b", 0) for i in range(30, 150)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    want = Counter()
    for i, t, *_ in rows:
        found, best, left = brute(tail(i, split(t)))
        s, n, q = best or (None, None, None)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in found)
        want[i, len(found), s, n, q, best and 1000 * n // q, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, left))] += 1
    got = queries.periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert Counter(tuple(r) for r in got.collect()) == want and sum(1 for r in want if r[1]) > 5


def test_empty_table(spark):
    assert runs.periodic_runs(empty(spark)).count() == 0 and runs.with_repeating_tails(empty(spark)).count() == 0
