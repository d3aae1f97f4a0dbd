import hashlib
import re
from collections import Counter, defaultdict

import pytest

from riskloom.llm import mixing
from tests.llm.frames import DOCS, awkward, empty, planted


def brute(rows):
    """(doc_id, size, source_size, target, taken) by the definition."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append((hashlib.md5((str(r["doc_id"]) if r["doc_id"] is not None else "null").encode()).hexdigest(), size(r["text"]), r["doc_id"]))
    names = sorted([s for s in by if s is not None], key=lambda s: s.encode("utf-32-be")) + [None] * (None in by)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total = {s: sum(x[1] for x in by[s]) for s in names}
    target, free = {}, set(names)
    while True:
        rest = sum(total.values()) - sum(target.values())
        over = [s for s in free if 3 * total[s] * sum(weight[x] for x in free) <= weight[s] * rest]
        if not over:
            break
        for s in over:
            target[s] = 3 * total[s]
            free.discard(s)
    for s in free:
        target[s] = weight[s] * rest / sum(weight[x] for x in free)
    out = []
    for s in names:
        budget, place = int(target[s]), 0
        epochs = budget // total[s] if total[s] else 0
        for _, n, i in sorted(by[s], key=lambda x: x[:2]):
            out.append((i, n, total[s], float(target[s]), epochs * n + min(max(budget - epochs * total[s] - place, 0), n)))
            place += n
    return sorted(out, key=str)


@pytest.mark.parametrize("make", [awkward, planted])
def test_equals_the_definition(spark, make):
    docs = make(spark)
    got = sorted([tuple(r) for r in mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken").collect()], key=str)
    want = brute(docs.select("doc_id", "text", "source").collect())
    assert [(a, b, c, e) for a, b, c, _, e in got] == [(a, b, c, e) for a, b, c, _, e in want]
    assert all(abs(a[3] - b[3]) < 1e-9 * max(1, b[3]) for a, b in zip(got, want))


def test_mixed_rows_hold_the_taken_words(spark):
    docs = planted(spark)
    plan = mixing.mix(docs)
    out = mixing.mixed_documents(docs, plan)
    assert out.columns == docs.columns
    words = out.groupBy("doc_id").agg({"text": "collect_list"}).collect()
    taken = {r["doc_id"]: r["taken"] for r in plan.collect() if r["taken"]}
    assert {r[0]: sum(len(t.split()) for t in r[1]) for r in words} == taken
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect())


def test_empty_table_and_native_plan(spark):
    assert mixing.mix(empty(spark)).count() == 0
    plan = mixing.mix(planted(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rows_without_an_id_or_with_a_repeated_one_meet_their_own_plan(spark):
    rows = [(None, f"w{i} " * (i + 1), "en", "s", 0) for i in range(30)] + [(None, "twice the same", "en", "s", 0)] * 3
    rows += [(i // 2, f"x{i} " * (i % 7 + 1), "en", "t" if i % 3 else None, 0) for i in range(40)]
    docs = spark.createDataFrame(rows, DOCS)
    plan = mixing.mix(docs)
    out = Counter()
    for r in mixing.mixed_documents(docs, plan).collect():
        out[r["doc_id"], r["source"]] += len(r["text"].split())
    want = Counter()
    for r in plan.collect():
        want[r["doc_id"], r["source"]] += r["taken"]
    assert out == +want
    sizes = Counter(r["size"] for r in plan.collect())
    assert sizes == Counter(len(r[1].split()) for r in rows)
