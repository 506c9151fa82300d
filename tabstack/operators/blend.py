"""Blending model predictions.

* Fixed weights are a projection.
* Regression blends (convex or ridge) need only the Gram sums of the
  predictions (:func:`tabstack.operators.aggregates.gram_sums`): ONE scan, then
  an M x M problem on the driver.
* Classification blends judged by accuracy are piecewise constant in the
  weights, so they are scored on a candidate table: the (bounded, broadcast)
  candidates are evaluated for every row inside ``mapInArrow`` batches and
  hits are summed per candidate -- one scan per refinement round instead of
  one scan per trial.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabstack.operators.aggregates import gram_sums
from tabstack.operators._util import one_row

SCORE_CELLS = 8_000_000  # cells scored at once in a task (64 MB)


# ------------------------------------------------------------ projections

def blend_columns(prob_cols: Sequence[Sequence[str]], weights: Sequence[float] | None = None,
                  normalise: bool = True) -> list[Column]:
    """Per class: sum_m w_m * p_{m,k}, left to right; then divide by the row sum."""
    M = len(prob_cols)
    w = list(weights) if weights is not None else [1.0 / M] * M
    C = len(prob_cols[0])
    out = []
    for k in range(C):
        acc = F.lit(float(w[0])) * F.col(prob_cols[0][k])
        for m in range(1, M):
            acc = acc + F.lit(float(w[m])) * F.col(prob_cols[m][k])
        out.append(acc)
    if not normalise:
        return out
    tot = out[0]
    for k in range(1, C):
        tot = tot + out[k]
    return [c / tot for c in out]


def blend_scalar(cols: Sequence[str], weights: Sequence[float] | None = None) -> Column:
    M = len(cols)
    w = list(weights) if weights is not None else [1.0 / M] * M
    acc = F.lit(float(w[0])) * F.col(cols[0])
    for m in range(1, M):
        acc = acc + F.lit(float(w[m])) * F.col(cols[m])
    return acc


# ------------------------------------------------------- regression blends

def gram_state(df: DataFrame, preds: Sequence[str], target: str) -> dict:
    """Gram sums as numpy: PP (M x M), Py, sums of p, y, yy, n."""
    r = one_row(gram_sums(df, preds, target))
    M = len(preds)
    PP = np.zeros((M, M))
    for i in range(M):
        for j in range(i, M):
            PP[i, j] = PP[j, i] = r[f"s{i}_{j}"]
    return {"PP": PP, "Py": np.array([r[f"s{i}y"] for i in range(M)]),
            "P": np.array([r[f"s{i}"] for i in range(M)]),
            "y": r["sy"], "yy": r["syy"], "n": r["n"], "preds": list(preds)}


def r2_at(state: dict, w: np.ndarray, intercept: float = 0.0) -> float:
    """R^2 of y ~ intercept + P w from the Gram sums (no scan)."""
    n, y, yy = state["n"], state["y"], state["yy"]
    PP, Py, P = state["PP"], state["Py"], state["P"]
    sse = yy - 2 * (w @ Py) - 2 * intercept * y + w @ PP @ w + 2 * intercept * (w @ P) + n * intercept ** 2
    sst = yy - y * y / n
    return float(1.0 - sse / sst)


def blend_convex_reg(state: dict) -> np.ndarray:
    """Simplex weights maximising R^2 (= minimising SSE, a convex QP).
    Exact by active-set enumeration over supports (M <= ~12)."""
    PP, Py = state["PP"], state["Py"]
    M = len(Py)
    best, best_w = -np.inf, np.ones(M) / M
    for size in range(1, M + 1):
        for S in itertools.combinations(range(M), size):
            S = list(S)
            A = PP[np.ix_(S, S)]
            # KKT: [2A 1; 1' 0] [w; lam] = [2Py; 1]
            K = np.zeros((size + 1, size + 1))
            K[:size, :size] = 2 * A
            K[:size, size] = 1.0
            K[size, :size] = 1.0
            rhs = np.concatenate([2 * Py[S], [1.0]])
            try:
                sol = np.linalg.solve(K, rhs)
            except np.linalg.LinAlgError:
                continue
            wS = sol[:size]
            if np.any(wS < -1e-12):
                continue
            w = np.zeros(M)
            w[S] = np.clip(wS, 0, None)
            w = w / w.sum()
            sc = r2_at(state, w)
            if sc > best + 1e-15:
                best, best_w = sc, w
    return best_w


def blend_ridge_reg(state: dict, alpha: float = 1.0) -> tuple[float, np.ndarray]:
    """Ridge with unpenalised intercept (textbook / scikit-learn Ridge):
    centre the sums, solve (PcPc + alpha I) b = Pc y."""
    n = state["n"]
    pm, ym = state["P"] / n, state["y"] / n
    A = state["PP"] - n * np.outer(pm, pm)
    b = state["Py"] - n * pm * ym
    beta = np.linalg.solve(A + alpha * np.eye(len(b)), b)
    return float(ym - pm @ beta), beta


# --------------------------------------------------- candidate-table blends

def simplex_grid(M: int, steps: int = 10) -> np.ndarray:
    """All compositions of ``steps`` into M parts, / steps (C(steps+M-1, M-1))."""
    out = []
    for cut in itertools.combinations(range(steps + M - 1), M - 1):
        parts, prev = [], -1
        for c in cut:
            parts.append(c - prev - 1)
            prev = c
        parts.append(steps + M - 1 - prev - 1)
        out.append(parts)
    return np.array(out, dtype=np.float64) / steps


def candidate_hits(df: DataFrame, prob_cols: Sequence[Sequence[str]], label: str,
                   candidates: np.ndarray, batch_rows: int | None = None) -> DataFrame:
    """(cand, hits, n): for every candidate weight vector, how many rows the
    weighted blend classifies correctly (argmax, ties -> lowest class).

    Runs in ``mapInArrow``: each task folds its rows into per-candidate
    counts, so the output is (#tasks x #candidates) rows, summed by one small
    aggregate.  The blend is accumulated model by model, left to right, so it
    is bit-identical to the SQL expression ``w0*p0 + w1*p1 + ...``.
    """
    K, M = candidates.shape
    C = len(prob_cols[0])
    # rows x candidates x classes doubles at a time, whatever the candidates
    batch_rows = batch_rows or max(1, SCORE_CELLS // (K * C))
    cols = [c for mc in prob_cols for c in mc]
    bc = df.sparkSession.sparkContext.broadcast(candidates)

    def score(batches):
        W = bc.value
        hits = np.zeros(W.shape[0], dtype=np.int64)
        n = 0
        for rb in batches:
            if rb.num_rows == 0:
                continue
            X = np.column_stack([rb.column(c).to_numpy(zero_copy_only=False).astype(np.float64)
                                 for c in cols]).reshape(rb.num_rows, M, C)
            y = rb.column(label).to_numpy(zero_copy_only=False).astype(np.int64)
            for s in range(0, rb.num_rows, batch_rows):
                Xb, yb = X[s:s + batch_rows], y[s:s + batch_rows]
                acc = W[:, 0][None, :, None] * Xb[:, 0, :][:, None, :]
                for m in range(1, M):
                    acc = acc + W[:, m][None, :, None] * Xb[:, m, :][:, None, :]
                pred = acc.argmax(axis=2)  # first max on ties
                hits += (pred == yb[:, None]).sum(axis=0)
            n += rb.num_rows
        yield pa.RecordBatch.from_pydict({"cand": np.arange(W.shape[0], dtype=np.int64),
                                          "hits": hits, "n": np.full(W.shape[0], n, dtype=np.int64)})

    part = df.select(*cols, F.col(label).cast("int").alias(label)).mapInArrow(
        score, "cand long, hits long, n long")
    return part.groupBy("cand").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n"))


def candidate_table(spark, candidates: np.ndarray, names: Sequence[str]) -> DataFrame:
    rows = [(int(i), *map(float, w)) for i, w in enumerate(candidates)]
    return spark.createDataFrame(rows, ["cand", *[f"w_{n}" for n in names]])


def simplex_qp(H: np.ndarray, c: np.ndarray, start: np.ndarray) -> np.ndarray:
    """min c.v + v.H.v / 2 over v >= 0, sum v = 1, by an active set from a
    feasible ``start`` (H positive semidefinite; M x M on the driver)."""
    M = len(c)
    H = H + 1e-12 * max(1.0, np.trace(H) / M) * np.eye(M)
    v = start.copy()
    free = v > 0
    for _ in range(20 * M + 20):
        F_ = np.flatnonzero(free)
        K = np.zeros((len(F_) + 1, len(F_) + 1))
        K[:-1, :-1], K[:-1, -1], K[-1, :-1] = H[np.ix_(F_, F_)], -1.0, 1.0
        sol = np.linalg.lstsq(K, np.concatenate([-c[F_], [1.0]]), rcond=None)[0]
        want = np.zeros(M)
        want[F_] = sol[:-1]
        if np.all(want >= -1e-15):
            v = np.clip(want, 0, None)
            slack = H @ v + c - sol[-1]
            slack[F_] = 0.0
            if slack.min() >= -1e-13 * max(1.0, np.abs(c).max()):
                break
            free[int(slack.argmin())] = True
            continue
        falling = F_[want[F_] < v[F_]]
        ratio = np.where(want[falling] < 0, v[falling] / (v[falling] - want[falling]), np.inf)
        at = int(ratio.argmin())
        v = v + min(1.0, float(ratio[at])) * (want - v)
        v[falling[at]] = 0.0
        v = np.clip(v, 0, None)
        free[falling[at]] = False
    return v / v.sum()


def true_class_probs(df: DataFrame, prob_cols: Sequence[Sequence[str]], label: str, eps: float = 1e-12) -> DataFrame:
    """q0..q{M-1}: each model's probability of the row's class, at least ``eps``.
    Rows without a label of the classes, or with a null or NaN probability of it, go."""
    q = []
    for m, cols in enumerate(prob_cols):
        own = F.coalesce(*[F.when(F.col(label) == k, F.col(c).cast("double")) for k, c in enumerate(cols)])
        q.append(F.when(own.isNotNull() & ~F.isnan(own), F.greatest(own, F.lit(eps))).alias(f"q{m}"))
    return df.select(*q).dropna()


def blend_logloss_cls(df: DataFrame, prob_cols: Sequence[Sequence[str]], label: str, tol: float = 1e-9,
                      max_steps: int = 40) -> tuple[np.ndarray, float, float]:
    """(weights, log-loss, gap): simplex weights that minimise the mean log-loss
    of the blended probabilities, a convex problem, for any number of models.

    Newton steps: one aggregate over the rows yields gradient and Hessian, the
    quadratic model on the simplex is solved exactly, one more aggregate tries
    ten step lengths.  For weights on the simplex ``gap = max_m mean(q_m / blend)
    - 1`` bounds how far the loss lies above the least one; the steps end at
    ``tol``.  Equal weights, NaN and NaN where no row has a label."""
    M = len(prob_cols)
    q = true_class_probs(df, prob_cols, label).persist()
    cols = [F.col(f"q{m}") for m in range(M)]

    def blend(w):
        return sum((F.lit(float(x)) * c for x, c in zip(w[1:], cols[1:])), F.lit(float(w[0])) * cols[0])

    w, loss, gap = np.ones(M) / M, float("nan"), float("nan")
    try:
        for step in range(max_steps):
            s = blend(w)
            ratio = [c / s for c in cols]
            sums = [F.avg(-F.ln(s)).alias("loss")] + [F.avg(r).alias(f"g{i}") for i, r in enumerate(ratio)]
            sums += [F.avg(ratio[i] * ratio[j]).alias(f"h{i}_{j}") for i in range(M) for j in range(i, M)]
            r = one_row(q.agg(*sums))
            if r["loss"] is None:
                break
            g, H = -np.array([r[f"g{i}"] for i in range(M)]), np.zeros((M, M))
            for i in range(M):
                for j in range(i, M):
                    H[i, j] = H[j, i] = r[f"h{i}_{j}"]
            loss, gap = float(r["loss"]), float(max(0.0, (-g).max() - 1.0))
            if gap <= tol:
                break
            to = simplex_qp(H, g - H @ w, w)
            tries = [0.5 ** t for t in range(10)]
            row = one_row(q.agg(*[F.avg(-F.ln(blend(w + t * (to - w)))).alias(f"l{i}") for i, t in enumerate(tries)]))
            i = min(range(len(tries)), key=lambda j: row[f"l{j}"])
            if not row[f"l{i}"] < loss:
                break       # no step lowers the loss in doubles
            w = np.clip(w + tries[i] * (to - w), 0, None)
            w = w / w.sum()
    finally:
        q.unpersist()
    return w, loss, gap


def blend_convex_cls(df: DataFrame, prob_cols: Sequence[Sequence[str]], label: str,
                     rounds: int = 3, n_random: int = 256, n_start: int = 1024, seed: int = 42,
                     start: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Simplex weights maximising accuracy: ``start`` (say, the weights of the
    least log-loss), equal weights, corners and ``n_start`` seeded Dirichlet
    draws for any number of models, then refine around the winner with shrinking
    perturbations (one scan per round)."""
    M = len(prob_cols)
    rng = np.random.default_rng(seed)
    cands = np.vstack([np.ones((1, M)) / M, np.eye(M), rng.dirichlet(np.ones(M), size=n_start)])
    if start is not None:
        cands = np.vstack([start[None, :], cands])
    best_w, best_acc = None, -1.0
    scale = 0.05
    for _ in range(rounds):
        h = {r["cand"]: (r["hits"], r["n"]) for r in candidate_hits(df, prob_cols, label, cands).collect()}
        # ties -> the earliest candidate (equal weights and corners come first)
        i = max(range(len(cands)), key=lambda j: (h[j][0], -j))
        acc = h[i][0] / h[i][1]
        if acc > best_acc:
            best_acc, best_w = acc, cands[i]
        noise = rng.normal(0, scale, size=(n_random, M))
        cands = np.clip(best_w[None, :] + noise, 0, None)
        cands = np.vstack([best_w[None, :], cands / cands.sum(axis=1, keepdims=True)])
        scale /= 2
    return best_w, best_acc


def blend_ridge_cls(df: DataFrame, prob_cols: Sequence[Sequence[str]], label: str,
                    alpha: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """One ridge per class on all M*C probabilities against the one-hot
    label; every class shares ONE Gram aggregate (the targets differ only in
    the X'y sums)."""
    feats = [c for mc in prob_cols for c in mc]
    C = len(prob_cols[0])
    d = df.withColumns({f"_y{k}": (F.col(label) == k).cast("double") for k in range(C)})
    # X'X once; X'y for every class in the same scan
    xs = [F.lit(1.0)] + [F.col(f).cast("double") for f in feats]
    p = len(xs)
    aggs = [F.sum(xs[i] * xs[j]).alias(f"g_{i}_{j}") for i in range(p) for j in range(i, p)]
    aggs += [F.sum(xs[i] * F.col(f"_y{k}")).alias(f"xy_{k}_{i}") for k in range(C) for i in range(p)]
    r = one_row(d.agg(*aggs))
    G = np.zeros((p, p))
    for i in range(p):
        for j in range(i, p):
            G[i, j] = G[j, i] = r[f"g_{i}_{j}"]
    n = G[0, 0]
    mean = G[0, 1:] / n
    A = G[1:, 1:] - n * np.outer(mean, mean)
    coefs, icpts = [], []
    for k in range(C):
        xy = np.array([r[f"xy_{k}_{i}"] for i in range(p)])
        ym = xy[0] / n
        b = xy[1:] - n * mean * ym
        beta = np.linalg.solve(A + alpha * np.eye(len(b)), b)
        coefs.append(beta)
        icpts.append(ym - mean @ beta)
    return np.array(icpts), np.array(coefs)
