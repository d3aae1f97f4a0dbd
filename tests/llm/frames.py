"""Small tables for the corpus operators: the awkward rows, and random documents with planted copies."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns of the operators' own intermediate tables, which a user's table may have as well.
EXTRA = "n int, key string, slice int, rank int, length int, component_id int, fingerprint int, hash int, size int, place int"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 6))) for _ in range(n))


def awkward(spark, seed: int = 3):
    """Nulls in any column, empty, blank and long texts, ties, repeated rows, clashing columns."""
    rng = random.Random(seed)
    common, passage = sentence(rng, 70), sentence(rng, 55)
    texts = [None, "", "  \n\t ", "one", "two words", common, common, common + " more", passage + " " + sentence(rng, 30),
             sentence(rng, 12) + " " + passage, "x " * 500, sentence(rng, 6000), sentence(rng, 25) + "\n" + passage + "\n" + passage,
             "Ünï cödé\u00a0\u2003z\x1cw 一二三 😀 e\u0301", "The " + common]
    rows = [(i, t, "en" if i % 3 else None, [None, "b", "a", "\U0001F600", "ñ"][i % 5], None if t is None else len(t))
            for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, common, None, None, 1), (None, None, None, None, None), (7, "other text of id 7", "en", "b", 3)]
    return spark.createDataFrame(rows, DOCS).selectExpr("*", *[f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in EXTRA.split(", ")])


def empty(spark):
    return awkward(spark).where("false")


def planted(spark, n: int = 120, seed: int = 5):
    """Random documents with exact copies, near copies and shared passages; ids from 10 on, not in order."""
    rng = random.Random(seed)
    shared = [sentence(rng, rng.randint(25, 80)) for _ in range(4)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.2 and texts:
            texts.append(rng.choice(texts))
        elif kind < 0.35 and texts:
            words = rng.choice(texts).split(" ")
            words[rng.randrange(len(words))] = "changed"
            texts.append(" ".join(words))
        elif kind < 0.7:
            texts.append(sentence(rng, rng.randint(0, 40)) + " " + rng.choice(shared) + "\n" + sentence(rng, rng.randint(0, 40)))
        else:
            texts.append(sentence(rng, rng.randint(1, 150)))
    ids = list(range(10, 10 + n))
    rng.shuffle(ids)
    return spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t)) for i, t in zip(ids, texts)], DOCS)
