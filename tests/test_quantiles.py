import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.operators import quantiles

PROBS = {"p0": 0.0, "p1": 0.01, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}


def frame(spark, n=3000):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        rows.append((rng.choice([None, 0, 1, 2]), rng.gauss(0, 1), float(rng.randint(0, 5)) if rng.random() < 0.7 else None,
                     None, 7, rng.choice([-0.0, 0.0, math.inf, -math.inf, 1e300, 1e-300])))
    return spark.createDataFrame(rows, "g int, a double, b double, c double, d int, e double"), rows


def want(values, p):
    v = sorted(values)
    spot = p * (len(v) - 1)
    low, high = v[math.floor(spot)], v[math.ceil(spot)]
    return low + (high - low) * (spot - math.floor(spot))


def check(found, rows, by):
    told = {(r["feature"], r["g"] if by else None): r for r in found.collect()}
    groups = [0, 1, 2] if by else [None]
    expected = 0
    for g in groups:
        for i, c in enumerate("abcde", 1):
            values = [r[i] for r in rows if (not by or r[0] == g) and r[i] is not None]
            if not values:
                assert (c, g) not in told
                continue
            expected += 1
            for name, p in PROBS.items():
                got, exact = told[c, g][name], want(values, p)
                assert got == exact or (got != got and exact != exact), (c, g, name, got, exact)
    assert len(told) == expected


@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("accuracy", [10_000, 50])
def test_brackets_give_exact_quantiles(spark, monkeypatch, by, accuracy):
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    df, rows = frame(spark)
    check(quantiles.column_quantiles(df, list("abcde"), PROBS, by), rows, by)


def test_a_bracket_that_misses_is_opened(spark, monkeypatch):
    real = quantiles._Bracket.__init__

    def wrong(self, group, slot, p, n, low, high, least, most):
        real(self, group, slot, p, n, 1e6, 2e6, least, most)

    monkeypatch.setattr(quantiles._Bracket, "__init__", wrong)
    df, rows = frame(spark, 400)
    check(quantiles.column_quantiles(df, list("abcde"), PROBS), rows, [])


def test_many_groups_take_the_long_form(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "BRACKETS", 10)
    df, rows = frame(spark, 500)
    basics = {"n": F.count, "mean": F.avg}
    found = quantiles.column_quantiles(df, list("abcde"), PROBS, ["g"], basics)
    assert found.columns == ["feature", "g", "n", "mean", *PROBS]
    check(found, rows, ["g"])


def test_basics_come_from_the_same_scan(spark):
    df, rows = frame(spark, 300)
    got = {r["feature"]: r for r in quantiles.column_quantiles(df, ["a", "c", "d"], {"m": 0.5}, (), {"n": F.count, "s": F.stddev_samp}).collect()}
    assert set(got) == {"a", "d"} and got["a"]["n"] == 300 and got["d"]["m"] == 7.0
    assert got["a"]["s"] == pytest.approx(np.std([r[1] for r in rows], ddof=1))
    assert quantiles.column_quantiles(df, [], {"m": 0.5}).count() == 0
    assert quantiles.column_quantiles(df.where("false"), ["a"], {"m": 0.5}).count() == 0
    assert quantiles.column_quantiles(df.where("false"), ["a"], {"m": 0.5}, ["g"]).count() == 0


def test_only_brackets_are_put_in_order(spark, monkeypatch):
    seen = []
    real = quantiles.running_totals
    monkeypatch.setattr(quantiles, "running_totals", lambda df, *a: seen.append(df.agg(F.sum("n")).first()[0]) or real(df, *a))
    df = spark.range(50_000).select(F.rand(1).alias("x"), (F.col("id") % 3).alias("y"))
    found = quantiles.column_quantiles(df, ["x", "y"], {"q": 0.3}).orderBy("feature").collect()
    exact = np.quantile([r[0] for r in df.select("x").collect()], 0.3)
    assert found[0]["q"] == pytest.approx(exact, rel=1e-12) and found[1]["q"] == 0.0
    assert seen and seen[0] <= 0.002 * 50_000
