"""Bounds of alpha against a plain bootstrap of items, quantiles against numpy, calibration rows only."""

import random

import numpy as np
from pyspark.sql import functions as F

from annolytics.operators import agreement as A, cadence


def alpha(items):
    n, k = np.array([i[0] for i in items], float), np.array([i[1] for i in items], float)
    N, K = n.sum(), k.sum()
    de = 2 * K * (N - K) / (N * (N - 1))
    return 1.0 if de == 0 else 1 - (2 * k * (n - k) / (n - 1)).sum() / N / de


def test_alpha_interval_against_items(spark):
    rnd = random.Random(1)
    items = [(n := rnd.randint(2, 4), sum(rnd.random() < (0.8 if i % 3 else 0.2) for _ in range(n))) for i in range(60)]
    rows = [("g", i, float(n), float(k)) for i, (n, k) in enumerate(items)] + [("h", 1, 2.0, 2.0), ("h", 2, 3.0, 3.0), ("s", 1, 1.0, 1.0)]
    got = {r.g: r for r in A.alpha_interval(spark.createDataFrame(rows, "g string, item int, n double, k double"), ("g",)).collect()}
    draws = sorted(alpha(rnd.choices(items, k=len(items))) for _ in range(4000))
    assert abs(got["g"].alpha - alpha(items)) < 1e-6 and got["g"].n_items == 60
    assert abs(got["g"].ci_lower - draws[100]) < 0.05 and abs(got["g"].ci_upper - draws[3899]) < 0.05
    assert tuple(got["h"][1:]) == (2, 1.0, 1.0, 1.0) and "s" not in got
    again = A.alpha_interval(spark.createDataFrame(rows[::-1], "g string, item int, n double, k double").repartition(7), ("g",))
    assert {r.g: r for r in again.collect()} == got


def test_quantiles_against_numpy(spark):
    rnd = random.Random(2)
    data = [("a", rnd.randint(0, 10**9)) for _ in range(700)] + [("b", rnd.choice([5, 7, 7, 7, 100_000])) for _ in range(333)] + [("c", 3), ("d", None), ("e", -4), ("e", 9)]
    df = spark.createDataFrame(data, "k string, v long")
    parts = (0.0, 0.25, 0.5, 0.75, 0.9, 1.0)
    got = {r.k: r for r in cadence.quantiles(df, ("k",), "v", parts).collect()}
    assert set(got) == {"a", "b", "c", "e"}
    for k in got:
        x = [v for q, v in data if q == k and v is not None]
        assert np.allclose(got[k].q, np.quantile(x, parts)) and got[k].n == len(x) and abs(got[k]["mean"] - np.mean(x)) < 1e-6
    assert np.allclose(cadence.quantiles(df, (), "v", (0.5,)).first().q, np.median([v for _, v in data if v is not None]))
    assert cadence.quantiles(df.where(F.lit(False)), ("k",), "v", parts).count() == 0


def test_roc_auc_and_running_sums(spark):
    from annolytics.operators.consolidate import running_before
    from annolytics.operators.evaluator import roc_auc

    rnd = random.Random(5)
    data = [(round(rnd.random(), 2), rnd.random() < 0.4) for _ in range(400)]
    pos, neg = [s for s, y in data if y], [s for s, y in data if not y]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
    assert abs(roc_auc(spark.createDataFrame(data, "s double, y boolean"), "s", "y").first()[0] - want) < 1e-6
    assert roc_auc(spark.createDataFrame([(0.5, True)], "s double, y boolean"), "s", "y").first()[0] is None
    r = running_before(spark.range(100).select((F.col("id") * 7 % 100).alias("o"), F.lit(2).alias("v")), "o", "v", "b")
    assert all(x.b == 2 * x.o for x in r.collect())
