"""k-NN mutual information against a NumPy brute force of the estimator."""

import numpy as np
import pandas as pd
import pytest

from tabstack.operators.knn_info import EDGE, knn_mutual_information, knn_mutual_information_numeric


def psi(n):
    return -0.5772156649015329 + sum(1.0 / j for j in range(1, int(n)))


def brute(x, y, k):
    ok = ~np.isnan(x)
    x, y = x[ok], y[ok]
    size = {c: int((y == c).sum()) for c in set(y)}
    keep = np.array([size[c] > 1 for c in y], dtype=bool)
    x, y = x[keep], y[keep]
    n = len(x)
    if not n:
        return 0, 0.0
    total = 0.0
    for i in range(n):
        near = np.sort(np.abs(x[y == y[i]] - x[i]))      # the row itself first
        ki = min(k, size[y[i]] - 1)
        r = near[ki]
        if r == 0:
            ki = int((near == 0).sum())
        inner = max(0.0, r - EDGE * (abs(x[i]) + r))
        m = int(((x >= x[i] - inner) & (x <= x[i] + inner)).sum())
        total += psi(ki) - psi(size[y[i]]) - psi(m)
    return n, max(0.0, psi(n) + total / n)


def table(rows=700):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 4, rows)
    f = {"near": y + rng.normal(0, 0.4, rows), "noise": rng.normal(0, 1, rows), "tied": np.floor(y / 2 + rng.integers(0, 3, rows)).astype(float),
         "hot": np.where(rng.random(rows) < 0.4, 5.0, rng.normal(5, 2, rows)), "same": np.ones(rows),
         "cents": np.round(rng.normal(1000, 3, rows) + y, 2), "gaps": np.where(rng.random(rows) < 0.3, np.nan, y * 1.0)}
    y[:1], y[1:3] = 9, 8        # a class of one row and one of two
    return pd.DataFrame(f | {"y": y})


@pytest.mark.parametrize("k,block_rows", [(3, 20_000), (3, 11), (5, 64), (1, 3)])
def test_equals_brute_force(spark, k, block_rows):
    p = table()
    cols = [c for c in p.columns if c != "y"]
    got = {r.feature: (r.n, r.mi) for r in knn_mutual_information(spark.createDataFrame(p).repartition(7), cols, "y", k, block_rows).collect()}
    assert set(got) == set(cols)
    for c in cols:
        n, mi = brute(p[c].to_numpy(), p["y"].to_numpy(), k)
        assert got[c][0] == n and abs(got[c][1] - mi) < 1e-9, c


def test_order_and_level(spark):
    """Nothing to learn is about 0; a feature that tells the class is about its entropy."""
    p = table(3000)
    p["copy"] = p["y"].astype(float)
    got = {r.feature: r.mi for r in knn_mutual_information(spark.createDataFrame(p), ["near", "noise", "copy"], "y").collect()}
    share = p["y"].value_counts(normalize=True).to_numpy()
    assert got["noise"] < 0.05 < got["near"] < got["copy"]
    assert abs(got["copy"] + (share * np.log(share)).sum()) < 0.02


def test_empty_null_and_repeated(spark):
    schema = "a double, b double, y int"
    got = knn_mutual_information(spark.createDataFrame([], schema), ["a", "b"], "y").collect()
    assert sorted((r.feature, r.n, r.mi) for r in got) == [("a", 0, 0.0), ("b", 0, 0.0)]
    rows = [(None, 1.0, 1), (float("nan"), 1.0, 1), (2.0, -0.0, None), (float("inf"), 1.0, 2), (3.0, 0.0, 2), (3.0, -0.0, 2)] + [(1.0, 2.0, 3)] * 4
    got = {r.feature: (r.n, r.mi) for r in knn_mutual_information(spark.createDataFrame(rows, schema), ["a", "b"], "y").collect()}
    x = pd.DataFrame(rows, columns=["a", "b", "y"]).replace(float("inf"), np.nan).dropna(subset="y")
    for c in "ab":
        n, mi = brute(x[c].to_numpy(), x["y"].to_numpy(), 3)
        assert got[c][0] == n and abs(got[c][1] - mi) < 1e-9


def brute_numeric(x, y, k):
    ok = np.isfinite(x) & np.isfinite(y)
    x, y = x[ok], y[ok]
    n = len(x)
    if n < 2:
        return n, 0.0
    x, y = (v / (v.std() or 1.0) for v in (x, y))
    total = 0.0
    for i in range(n):
        near = np.sort(np.maximum(np.abs(x - x[i]), np.abs(y - y[i])))
        ki = min(k, n - 1)
        r = near[ki]
        if r == 0:
            ki = int((near == 0).sum())
        total += psi(ki)
        for v in (x, y):
            inner = max(0.0, r - EDGE * (abs(v[i]) + r))
            total -= psi(((v >= v[i] - inner) & (v <= v[i] + inner)).sum())
    return n, max(0.0, psi(n) + total / n)


@pytest.mark.parametrize("k,cell_points,visitors", [(3, 512, 4096), (3, 8, 5), (5, 32, 64)])
def test_numeric_equals_brute_force(spark, k, cell_points, visitors):
    p = table(600)
    rng = np.random.default_rng(8)
    p["t"] = p["near"] * 2 + rng.normal(0, 0.3, len(p))
    p.loc[rng.random(len(p)) < 0.3, "t"] = 4.99         # a floor that a third of the rows share
    p["flat"], p["far"] = 2.0, np.where(np.arange(len(p)) < 5, 1e6, p["noise"])
    cols = ["near", "noise", "tied", "hot", "flat", "far", "gaps"]
    got = {r.feature: (r.n, r.mi) for r in knn_mutual_information_numeric(
        spark.createDataFrame(p).repartition(5), cols, "t", k, cell_points, visitors).collect()}
    assert set(got) == set(cols)
    for c in cols:
        n, mi = brute_numeric(p[c].to_numpy(), p["t"].to_numpy(), k)
        assert got[c][0] == (n if n > 1 else 0) and abs(got[c][1] - mi) < 1e-9, (c, got[c], mi)


def test_numeric_empty_and_single(spark):
    schema = "a double, t double"
    for rows in ([], [(1.0, 2.0)], [(None, 1.0), (1.0, None), (float("nan"), 1.0)]):
        got = knn_mutual_information_numeric(spark.createDataFrame(rows, schema), ["a"], "t").collect()
        assert [(r.feature, r.mi) for r in got] == [("a", 0.0)]
