import random

import numpy as np
import pytest

from riskloom.operators import blocks, ensemble, ordering, selection


@pytest.mark.parametrize("buckets", [1, 3, 1024])
def test_blocks_add_up_over_buckets_and_keys(spark, monkeypatch, buckets):
    monkeypatch.setattr(blocks, "BUCKETS", buckets)
    rng = np.random.default_rng(1)
    rows = [(k, t % buckets, rng.integers(0, 1 << 40, 5)) for t in range(9) for k in range(4)]
    df = spark.createDataFrame([(k, b, x.tobytes()) for k, b, x in rows], "key int, bucket int, data binary").repartition(5)
    got = {r["key"]: np.frombuffer(r["data"], np.int64).tolist() for r in blocks.tree_sum(df, ["key"], "int64").collect()}
    assert got == {k: sum(x for key, _, x in rows if key == k).tolist() for k in range(4)}


@pytest.mark.parametrize("block", [1, 2, 64])
def test_correlation_over_blocks_equals_pandas(spark, monkeypatch, block):
    monkeypatch.setattr(selection, "BLOCK", block)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 5))
    x[:, 3] = x[:, 0] * 2 + 0.01 * x[:, 1]
    x[:, 4] = 1.0
    x[rng.random((500, 5)) < 0.2] = np.nan
    df = spark.createDataFrame([tuple(None if v != v else float(v) for v in r) for r in x], ", ".join(f"c{i} double" for i in range(5)))
    want = df.toPandas().corr(min_periods=2)
    pairs = {(r["feature_a"], r["feature_b"]): r["corr"] for r in selection.correlation_pairs(df.repartition(7)).collect()}
    assert set(pairs) == {(f"c{i}", f"c{j}") for i in range(5) for j in range(i + 1, 5)}
    for (a, b), v in pairs.items():
        assert v is None if "c4" in (a, b) else v == pytest.approx(want[a][b], abs=1e-12)


def test_running_totals_take_slices_from_their_rows(spark, monkeypatch):
    monkeypatch.setattr(ordering, "SLICE_ROWS", 50)
    monkeypatch.setattr(ordering, "LEAST_ROWS", 10)
    rng = random.Random(2)
    rows = [(i, rng.choice([None, 1, 2, 5]), rng.random(), f"t{i}") for i in rng.sample(range(5000), 1000)]
    out = ordering.running_totals(spark.createDataFrame(rows, "a int, n int, x double, t string"), ["a"], ["n", "x"])
    assert out.columns == ["a", "n", "x", "t", "n_before", "x_before"]
    # Twenty slices of fifty rows, five times the shuffle's width.
    totals, sums = 0, 0.0
    got = sorted(map(tuple, out.collect()))
    for (i, n, x, t, nb, xb), want in zip(got, sorted(rows)):
        assert (i, n, x, t) == want and nb == totals and xb == pytest.approx(sums)
        totals, sums = totals + (n or 0), sums + x


def auc(pos, neg):
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("cells", [4, 4096])
def test_weight_grid_is_exact_at_any_number_of_cells(spark, monkeypatch, cells):
    monkeypatch.setattr(ensemble, "CELLS", cells)
    rng = random.Random(5)
    rows = [(rng.choice([0, 0, 1, None]), round(rng.random(), 2), rng.choice([0.1, 0.5, None]), rng.random() * 4 - 2) for _ in range(400)]
    df = spark.createDataFrame(rows, "y int, p1 double, p2 double, p3 double")
    grid = ensemble.weight_candidates(3)[:40] + [(0.0, 0.0, 0.0), (-1.0, 0.5, 2.0)]
    got = {r["position"]: r for r in ensemble.weight_grid(df, ["p1", "p2", "p3"], "y", grid=grid).collect()}
    best = {r["position"]: r["auc"] for r in ensemble.weight_grid(df, ["p1", "p2", "p3"], "y", grid=grid, best_only=True).collect()}
    full = [r for r in rows if None not in r]
    for k, w in enumerate(grid):
        scores = [(r[0], r[1] * w[0] + r[2] * w[1] + r[3] * w[2]) for r in full]
        want = auc([s for y, s in scores if y == 1], [s for y, s in scores if y == 0])
        assert got[k]["auc"] == pytest.approx(want, abs=1e-12) and (got[k]["w1"], got[k]["w2"], got[k]["w3"]) == grid[k]
    top = max(r["auc"] for r in got.values())
    assert max(best.values()) == top and all(best[k] == got[k]["auc"] for k in best)
    assert all(k in best for k in got if got[k]["auc"] == top)
    # Finer cells leave fewer vectors that may be the best.
    assert cells == 4 or len(best) < len(grid)


def test_weight_grid_without_a_class(spark):
    df = spark.createDataFrame([(1, 0.5, 0.2, 0.1), (1, 0.1, 0.3, 0.3)], "isFraud int, p1 double, p2 double, p3 double")
    for frame in (df, df.where("false")):
        assert {r["auc"] for r in ensemble.weight_grid(frame, ["p1", "p2", "p3"]).collect()} == {None}
        assert ensemble.optimize_weights(frame, ["p1", "p2", "p3"]) == pytest.approx(dict.fromkeys(["p1", "p2", "p3"], 1 / 3))

