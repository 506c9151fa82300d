"""Closed-form linear models from sufficient statistics.

One aggregation gives, per fold, the Gram matrix X'X, X'y, y'y and n of the
design [1, x1..xp].  The model that must not see fold f is solved from
``total - part(f)`` on the driver (a (p+1)x(p+1) system), so K out-of-fold
models cost one scan.  Predictions are a projection with the per-fold
coefficients as literals.  Used for the linear baseline, ridge blending and
stepwise selection.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gram_by(df: DataFrame, features: Sequence[str], target: str, by: str | None = None,
            weight: str | None = None) -> dict:
    """{group: (G, Xy, yy, n)} with G over [1, features]; one aggregate.
    The group count is bounded by the caller (folds: K)."""
    xs = [F.lit(1.0)] + [F.col(f).cast("double") for f in features]
    y = F.col(target).cast("double")
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    p = len(xs)
    aggs = []
    for i in range(p):
        for j in range(i, p):
            aggs.append(F.sum(w * xs[i] * xs[j]).alias(f"g_{i}_{j}"))
        aggs.append(F.sum(w * xs[i] * y).alias(f"xy_{i}"))
    aggs += [F.sum(w * y * y).alias("yy"), F.count(F.lit(1)).alias("n")]
    g = df.groupBy(F.col(by).alias("_g") if by else F.lit(0).alias("_g")).agg(*aggs)
    out = {}
    for r in g.collect():  # one row per group (K folds)
        G = np.zeros((p, p))
        for i in range(p):
            for j in range(i, p):
                G[i, j] = G[j, i] = r[f"g_{i}_{j}"] or 0.0
        xy = np.array([r[f"xy_{i}"] or 0.0 for i in range(p)])
        out[r["_g"]] = (G, xy, float(r["yy"] or 0.0), int(r["n"]))
    return out


def solve_ridge(G: np.ndarray, xy: np.ndarray, alpha: float = 0.0,
                penalise_intercept: bool = False) -> np.ndarray:
    """Normal equations (G + alpha*I') b = X'y, intercept unpenalised."""
    P = np.eye(G.shape[0]) * alpha
    if not penalise_intercept:
        P[0, 0] = 0.0
    return np.linalg.lstsq(G + P, xy, rcond=None)[0]


def ols_oof_coefficients(df: DataFrame, features: Sequence[str], target: str, fold: str,
                         alpha: float = 0.0) -> tuple[dict, np.ndarray]:
    """Per-fold out-of-fold coefficients and the mean over folds (used for
    rows without a fold: mean of K linear predictions = prediction with the
    mean coefficients)."""
    parts = gram_by(df.where(F.col(fold).isNotNull()), features, target, by=fold)
    Gt = sum(v[0] for v in parts.values())
    xyt = sum(v[1] for v in parts.values())
    coefs = {f: solve_ridge(Gt - G, xyt - xy, alpha) for f, (G, xy, _, _) in parts.items()}
    mean = np.mean(np.stack([coefs[f] for f in sorted(coefs)]), axis=0)
    return coefs, mean


def linear_prediction(features: Sequence[str], coefs: dict, mean: np.ndarray,
                      fold: str) -> Column:
    """sum_i b_i(fold) * x_i, with the mean coefficients where fold is NULL."""
    def coef(i):
        e = F.when(F.col(fold).isNull(), F.lit(float(mean[i])))
        for f, b in sorted(coefs.items()):
            e = e.when(F.col(fold) == f, F.lit(float(b[i])))
        return e
    out = coef(0)
    for i, f in enumerate(features, start=1):
        out = out + coef(i) * F.col(f).cast("double")
    return out
