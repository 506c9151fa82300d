"""Brute-force checks for k-NN (several blocks), AUC with ties (several
buckets), blends and candidate scoring, stratified sampling."""

import hashlib
import itertools

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tabstack.operators import blend as B
from tabstack.operators.metrics import auc, r2_rmse
from tabstack.operators.neighbours import knn_candidates
from tabstack.operators.sampling import stratified_sample
from tabstack.plans import fixtures as FX

from testdata_paths import SF001, SF01


def test_knn_blocked_equals_bruteforce(spark):
    v = FX.vec(spark, SF001)
    ref = v.where(F.col("split") == "train")
    got = knn_candidates(v, ref, "vec_id", "embedding", 7, "fold", block_rows=60).toPandas()
    pdf = v.toPandas()
    R = pdf[pdf.split == "train"]
    Rv = np.stack(R.embedding.to_numpy()).astype(np.float64)
    for _, q in pdf.iterrows():
        d = np.sqrt(((Rv - np.asarray(q.embedding, dtype=np.float64)) ** 2).sum(axis=1))
        ok = np.ones(len(R), bool) if pd.isna(q.fold) else (R.fold.to_numpy() != q.fold)
        cand = sorted(zip(d[ok], R.vec_id.to_numpy()[ok]))[:7]
        g = got[got.q_id == q.vec_id].sort_values(["dist", "n_id"])
        assert list(g.n_id) == [c[1] for c in cand]


def test_auc_with_ties_bruteforce(spark):
    rng = np.random.default_rng(0)
    s = np.round(rng.normal(size=600), 1)  # many ties
    y = (rng.random(600) < 1 / (1 + np.exp(-s))).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"s": s, "y": y}))
    got = auc(df, "s", "y", n_buckets=16).collect()[0]["auc"]
    pos, neg = s[y == 1], s[y == 0]
    exp = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert abs(got - exp) < 1e-12


def test_r2_matches_numpy(spark):
    p = FX.acct_pred(spark, SF001).where(F.col("fold").isNotNull()).select("rate", "m0_rate").toPandas()
    df = spark.createDataFrame(p)
    got = r2_rmse(df, "m0_rate", "rate").collect()[0]
    sse = ((p.rate - p.m0_rate) ** 2).sum()
    assert abs(got.r2 - (1 - sse / ((p.rate - p.rate.mean()) ** 2).sum())) < 1e-12


def test_convex_and_ridge_blends(spark):
    p = FX.acct_pred(spark, SF01).where(F.col("fold").isNotNull())
    cols = [f"m{m}_rate" for m in range(3)]
    st = B.gram_state(p, cols, "rate")
    w = B.blend_convex_reg(st)
    pdf = p.select("rate", *cols).toPandas()
    P, y = pdf[cols].to_numpy(), pdf.rate.to_numpy()

    def r2(wv):
        e = y - P @ wv
        return 1 - (e @ e) / ((y - y.mean()) @ (y - y.mean()))
    assert abs(B.r2_at(st, w) - r2(w)) < 1e-9
    for a in range(21):  # no simplex grid point beats the solution
        for b in range(21 - a):
            assert r2(np.array([a, b, 20 - a - b]) / 20) <= r2(w) + 1e-9
    b0, beta = B.blend_ridge_reg(st, 1.0)
    Pc, yc = P - P.mean(0), y - y.mean()
    exp = np.linalg.solve(Pc.T @ Pc + np.eye(3), Pc.T @ yc)
    assert np.allclose(beta, exp, atol=1e-8)
    assert abs(b0 - (y.mean() - P.mean(0) @ exp)) < 1e-8


def test_candidate_hits_match_numpy(spark):
    p = FX.acct_pred(spark, SF001).where(F.col("fold").isNotNull())
    probs = [FX.pred_cols(m) for m in range(5)]
    grid = B.simplex_grid(5, 4)
    assert len(grid) == 70
    got = {r["cand"]: r["hits"] for r in B.candidate_hits(p, probs, "tier", grid).collect()}
    pdf = p.toPandas()
    X = np.stack([pdf[c].to_numpy() for c in itertools.chain(*probs)], 1).reshape(len(pdf), 5, 5)
    for i, w in enumerate(grid):
        acc = sum(w[m] * X[:, m, :] for m in range(5))
        assert got[i] == int((acc.argmax(1) == pdf.tier.to_numpy()).sum())
    assert len(B.simplex_grid(5, 10)) == 1001


def test_stratified_sample_exact_with_fallback(spark):
    a = FX.acct(spark, SF01).select("row_id", "tier")
    got = stratified_sample(a, "tier", 50, safety=0.2).toPandas()  # tiny safety forces the fallback
    pdf = a.toPandas()
    pdf["h"] = [hashlib.md5(f"42|{r}".encode()).hexdigest() for r in pdf.row_id]
    exp = pdf.sort_values("h").groupby("tier").head(50)
    assert sorted(got.row_id) == sorted(exp.row_id)


def test_logloss_blend_is_the_least(spark):
    """Against mixture-weight steps in NumPy, with models of no use and a corner."""
    rng = np.random.default_rng(5)
    n, C, M = 1500, 4, 6
    y = rng.integers(0, C, n)
    P = rng.dirichlet(np.ones(C), size=(M, n))
    for m, share in enumerate((0.5, 0.35, 0.2, 0.0, 0.0, 0.45)):
        P[m][np.arange(n), y] += share * rng.random(n)
    P[4] = P[0]                                          # a twin: weights are not unique, the loss is
    P /= P.sum(axis=2, keepdims=True)
    cols = [[f"m{m}_{k}" for k in range(C)] for m in range(M)]
    p = pd.DataFrame({cols[m][k]: P[m, :, k] for m in range(M) for k in range(C)} | {"y": y})
    df = spark.createDataFrame(p).repartition(6)
    w, loss, gap = B.blend_logloss_cls(df, cols, "y")
    q = P[:, np.arange(n), y]
    v = np.ones(M) / M
    for _ in range(20_000):
        v = v * (q / (v @ q)).mean(axis=1)
    assert abs(w.sum() - 1) < 1e-12 and (w >= 0).all() and gap < 1e-6
    assert abs(loss + np.log(w @ q).mean()) < 1e-12 and loss <= -np.log(v @ q).mean() + 1e-9
    corner = B.blend_logloss_cls(df, [cols[5], cols[3]], "y")[0]
    one = B.blend_logloss_cls(df, [cols[0]], "y")
    assert 0.9 < corner[0] <= 1 and one[0].tolist() == [1.0]


def test_logloss_blend_without_rows_and_with_nulls(spark):
    schema = "a0 double, a1 double, b0 double, b1 double, y int"
    cols = [["a0", "a1"], ["b0", "b1"]]
    w, loss, _ = B.blend_logloss_cls(spark.createDataFrame([], schema), cols, "y")
    assert w.tolist() == [0.5, 0.5] and np.isnan(loss)
    rows = [(0.9, 0.1, 0.5, 0.5, 0), (0.2, 0.8, 0.5, 0.5, 1), (None, 0.1, 0.5, 0.5, 0), (0.1, 0.9, 0.5, 0.5, None), (0.0, 1.0, 0.5, 0.5, 7)]
    w, loss, _ = B.blend_logloss_cls(spark.createDataFrame(rows, schema), cols, "y")
    assert w[0] > 0.999 and abs(loss + np.log([0.9, 0.8]).mean()) < 1e-6
