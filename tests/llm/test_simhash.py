import math
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from riskloom.llm import common, simhash
from tests.llm.frames import awkward, empty, planted


def brute_print(text):
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in
             [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]]
    if not words:
        return 0
    grams = [words] if len(words) < 3 else [words[i:i + 3] for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def classes(prints, ids):
    label = {}
    for a, i in zip(prints, ids):
        label[a] = min(float("inf") if i is None else i, label.get(a, float("inf")))
    distinct = list(label)
    for _ in distinct:
        old = dict(label)
        for a in distinct:
            label[a] = min(label[b] for b in distinct if ((a ^ b) & (2**64 - 1)).bit_count() <= 2)
        if label == old:
            break
    return {a: None if i == float("inf") else i for a, i in label.items()}


@pytest.mark.parametrize("make", [awkward, planted])
def test_equals_brute_force(spark, make):
    docs = make(spark)
    rows = docs.select("doc_id", "text").collect()
    prints = [brute_print(r["text"]) for r in rows]
    label = classes(prints, [r["doc_id"] for r in rows])
    want = Counter((r["doc_id"], p, label.get(p)) for r, p in zip(rows, prints))
    assert Counter(tuple(r) for r in simhash.near_duplicates(docs).collect()) == want


@pytest.mark.parametrize("long_list", [4, 64, 2048])
def test_links_of_crowded_fingerprints(spark, long_list):
    rng = random.Random(2)
    values = {rng.getrandbits(64) for _ in range(50)}
    for base in list(values)[:3]:
        for _ in range(60):
            values.add(base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    values = [int(np.array(v, np.uint64).view(np.int64)) for v in values]
    df = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    got = {(r["a"], r["b"]) for r in simhash.links(df, long_list).collect()}
    assert got == {(a, b) for a in values for b in values if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}


def test_keep_first_and_empty_table(spark):
    docs = planted(spark)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    found = simhash.near_duplicates(docs).collect()
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({r["component_id"] for r in found})
    assert simhash.near_duplicates(empty(spark)).count() == 0 and simhash.keep_first(empty(spark)).count() == 0
    assert simhash.keep_first(awkward(spark)).where("doc_id = 5").count() == 1


def groups_of(rows):
    """A number per row, the same for rows whose fingerprints are linked."""
    prints = [brute_print(r["text"]) for r in rows]
    label = classes(prints, range(len(rows)))
    return [label[p] for p in prints]


def test_lists_of_a_pair_tell_its_shared_bytes(spark):
    rng = random.Random(7)
    rows = []
    for _ in range(200):
        a = rng.getrandbits(64)
        rows.append((a, a ^ sum(rng.randint(1, 255) << 8 * p for p in rng.sample(range(8), rng.randint(0, 8)))))
    signed = lambda v: int(np.array(v, np.uint64).view(np.int64))
    lists = {v: set() for pair in rows for v in pair}
    table = spark.createDataFrame([(signed(v),) for v in lists], "fingerprint long")
    for r in simhash.postings(table).collect():
        lists[r["fingerprint"] & (2**64 - 1)].add((r["slot"], r["key"]))
    for a, b in rows:
        same = sum((a >> 8 * p) & 255 == (b >> 8 * p) & 255 for p in range(8))
        assert len(lists[a]) == 70 and len(lists[a] & lists[b]) == math.comb(same, 4)


def test_kept_rows_have_their_columns_whatever_their_names(spark):
    docs = planted(spark).selectExpr("*", "'mine' as _row0", "1 as row", "2 as id", "3 as key", "4 as gid", "5 as component")
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and kept.where("_row0 = 'mine' and row = 1 and id = 2 and key = 3 and gid = 4").count() == kept.count()
    rows = docs.collect()
    best = {}
    for r, group in zip(rows, groups_of(rows)):
        best[group] = min(best.get(group, r["doc_id"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(best.values())


def test_no_table_that_grows_with_the_documents_is_broadcast(spark, monkeypatch):
    plans, own = [], simhash.step

    def kept(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return own(df)

    monkeypatch.setattr(simhash, "step", kept)
    monkeypatch.setattr(common, "step", kept)
    docs = spark.createDataFrame([(i, f"a{i % 9} b c{i % 4} d") for i in range(40)], "doc_id long, text string")
    found = simhash.near_duplicates(docs)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert found.count() == 40
    joins = [p for p in plans if "Join" in p]
    assert len(joins) >= 3 and not [p for p in joins if "BroadcastHashJoin" in p]
