import math

import numpy as np
import pytest

from riskloom.llm import vectors

KIND = "vec_id long, embedding array<float>, label int, gid int, copies int"


def brute(rows, threshold=0.9):
    def fine(i, v):
        return i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    ok = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if fine(i, v)]
    near = [[len(a) == len(b) and n != m and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold
             for m, (_, b) in enumerate(ok)] for n, (_, a) in enumerate(ok)]
    label = [i for i, _ in ok]
    for _ in ok:
        label = [min([label[n]] + [label[m] for m in range(len(ok)) if near[n][m]]) for n in range(len(ok))]
    out = [(i, sum(near[n]), label[n], i == label[n]) for n, (i, _) in enumerate(ok)]
    return sorted(out + [(i, 0, i, i is not None) for i, v in rows if not fine(i, v)], key=str)


def data(seed=0, n=260):
    rng = np.random.default_rng(seed)
    rows = [rng.standard_normal(16).tolist() for _ in range(n)]
    base = rng.standard_normal(16)
    for _ in range(60):  # near copies of one vector, more than a window of the test holds
        rows.append((base + 0.08 * rng.standard_normal(16)).tolist())
    for i in range(30):
        rows.append((np.array(rows[i]) * 3 + 0.1 * rng.standard_normal(16)).tolist())
    order = rng.permutation(len(rows))
    return [(int(i), rows[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize("window, block", [(16, 24), (256, 512)])
def test_equals_brute_force(spark, monkeypatch, window, block):
    monkeypatch.setattr(vectors.link_counts, "__defaults__", (block,))
    odd = [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [float("nan")] + [1.0] * 15), (1004, [None] + [1.0] * 15),
           (1005, [float("inf")] * 16), (1006, [1.0, 2.0]), (1007, [2.0, 4.0]), (1008, [1.0, 2.0]), (1009, [3e38] * 16),
           (1010, [1e38] * 16), (None, [1.0, 2.0]), (None, None)]
    rows = data() + odd
    df = spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], KIND)
    got = vectors.near_duplicates(df, window=window).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(rows)


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0])]
    df = spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], KIND)
    assert sorted(tuple(r) for r in vectors.near_duplicates(df).collect()) == [(1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (3, 0, 3, True)]
    assert vectors.near_duplicates(df.where("false")).count() == 0


def test_passes_follow_from_the_number_of_vectors():
    assert vectors.passes_for(60) == 1 < vectors.passes_for(10_000) < vectors.passes_for(10**8)


def test_passes_follow_from_the_spread_around_the_mean():
    rng = np.random.default_rng(3)
    n, pairs, dims, window = 12_000, 300, 64, 16
    common = rng.standard_normal(dims)
    common /= np.linalg.norm(common)
    own = rng.standard_normal((n, dims))
    x = np.sqrt(0.7) * common + np.sqrt(0.3) * own / np.linalg.norm(own, axis=1)[:, None]
    x /= np.linalg.norm(x, axis=1)[:, None]
    side = rng.standard_normal((pairs, dims))
    side -= (side * x[:pairs]).sum(axis=1)[:, None] * x[:pairs]
    side /= np.linalg.norm(side, axis=1)[:, None]
    x[pairs:2 * pairs] = 0.905 * x[:pairs] + np.sqrt(1 - 0.905**2) * side
    y = x - x.mean(axis=0)
    values, counts = np.unique(np.floor((y * y).sum(axis=1) * 200) / 200, return_counts=True)

    def met(passes):
        found = np.zeros(pairs, bool)
        for k in range(passes):
            bits = (y @ np.random.default_rng([0, k, dims]).standard_normal((dims, vectors.BITS)) > 0) @ (1 << np.arange(vectors.BITS - 1, -1, -1))
            place = np.argsort(np.argsort(bits, kind="stable")) // window
            found |= np.abs(place[:pairs] - place[pairs:2 * pairs]) <= 1
        return found.mean()

    assert met(vectors.passes_for(n, window=window)) < 0.99
    assert met(vectors.passes_for(n, window=window, spread=dict(zip(values.tolist(), counts.tolist())))) >= 0.998
    assert vectors.passes_for(n, spread={0.05: 10}) == 1
