"""The histogram tree grower against NumPy twins, and its learners' promises."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabstack.operators import grower as G


def table(spark, n=500, seed=3, parts=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = 2 * x[:, 0] - x[:, 1] + np.sin(3 * x[:, 2]) + rng.normal(size=n) * 0.5
    rows = [(int(i), float(a), float(b), None if i % 17 == 0 else float(c), float(t), int(i % 3), int(abs(t) > 1.5)) for i, ((a, b, c), t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "row_id long, a double, b double, c double, y double, fold int, cls int").repartition(parts)
    return df, rows


FEATS = ["a", "b", "c"]


def codes(binner, rows):
    return binner.codes(np.array([[np.nan if v is None else v for v in r[1:4]] for r in rows]))


def twin_extra(bins, y, depth, tries, seed, t, classes):
    """One extremely randomised tree by plain recursion over rows: node -> value; nodes are numbered level by level."""
    target = (y[:, None] == np.arange(classes)).astype(float) if classes else y[:, None]
    node, next_id, value = {0: np.arange(len(y))}, 1, {0: target.mean(axis=0)}
    for _ in range(depth):
        made = {}
        for k in sorted(node):
            rows = node[k]
            if len(rows) < 2:
                continue
            rng = np.random.default_rng([seed, t, k])
            best, tried = None, 0
            loss = lambda r: -(target[r].sum(axis=0) ** 2).sum() / len(r)
            for f in rng.permutation(bins.shape[1]).tolist():
                lo, hi = bins[rows, f].min(), bins[rows, f].max()
                if lo == hi or tried == tries:
                    continue
                tried += 1
                cut = int(rng.integers(lo, hi))
                left, right = rows[bins[rows, f] <= cut], rows[bins[rows, f] > cut]
                gain = loss(rows) - loss(left) - loss(right)
                if best is None or gain > best[0]:
                    best = (gain, left, right)
            if best and best[0] > 1e-9:
                for part in best[1:]:
                    made[next_id] = part
                    value[next_id] = target[part].mean(axis=0)
                    for r in part:
                        leaf[r] = next_id
                    next_id += 1
        node = made
    return value


leaf: dict = {}


@pytest.mark.parametrize("classes", [0, 2])
def test_extra_trees_equal_a_numpy_twin(spark, classes):
    df, rows = table(spark)
    label = "cls" if classes else "y"
    binner = G.fit_binner(df, FEATS, 16)
    model = G.extra_trees(df, FEATS, label, trees=3, depth=4, classes=classes, tries=2, binner=binner, seed=7)[-1]
    bins = codes(binner, rows)
    # the grower sums multiples of a unit: so does the twin
    y = np.array([r[6] if classes else r[4] for r in rows], float)
    unit = 2.0 ** math.ceil(math.log2(np.abs(y).max())) / (1 << G.UNIT_BITS)
    y = y if classes else np.rint(y / unit) * unit
    for t, tree in enumerate(model.trees):
        leaf.clear()
        leaf.update({i: 0 for i in range(len(rows))})
        value = twin_extra(bins, y, 4, 2, 7, t, classes)
        assert tree.leaves(bins).tolist() == [leaf[i] for i in range(len(rows))]
        got = np.array([tree.value[leaf[i]] for i in range(len(rows))])
        want = np.array([value[leaf[i]] if classes else value[leaf[i]][0] for i in range(len(rows))])
        assert np.allclose(got, want, atol=1e-9)
    again = G.extra_trees(df.repartition(7), FEATS, label, trees=3, depth=4, classes=classes, tries=2, binner=binner, seed=7)[-1]
    assert [t.__dict__ for t in again.trees] == [t.__dict__ for t in model.trees]      # whatever the tasks


def test_boosted_stump_equals_brute_force(spark):
    df, rows = table(spark)
    binner = G.fit_binner(df, FEATS, 16)
    model = G.boost(df, FEATS, "y", [G.Squared()], rounds=1, depth=1, rate=1.0, binner=binner, splitter=G.BestCut(min_hessian=1, reg=0))[-1, 0]
    bins, y = codes(binner, rows), np.array([r[4] for r in rows])
    best = min(((lambda m: ((y[m] - y[m].mean()) ** 2).sum() + ((y[~m] - y[~m].mean()) ** 2).sum())(bins[:, f] <= c), f, c)
               for f in range(3) for c in range(binner.n_bins - 1) if 0 < (bins[:, f] <= c).sum() < len(y))
    left = bins[:, best[1]] <= best[2]
    want = np.where(left, y[left].mean(), y[~left].mean())
    assert np.allclose(model.score(bins), want, atol=1e-4)
    got = G.score_with(df, {"pred": model}, ["row_id"]).collect()
    assert np.allclose([r.pred for r in sorted(got, key=lambda r: r.row_id)], want, atol=1e-4)


def test_signs_are_never_violated(spark):
    df, rows = table(spark, 800)
    signs = (1, -1, 0)
    free = G.boost(df, FEATS, "y", [G.Squared()], rounds=12, depth=3, bins=32)[-1, 0]
    held = G.boost(df, FEATS, "y", [G.Squared()], rounds=12, depth=3, bins=32, splitter=G.BestCut(signs=signs))[-1, 0]
    wrong = G.boost(df, FEATS, "y", [G.Squared()], rounds=12, depth=3, bins=32, splitter=G.BestCut(signs=(-1, 1, 0)))[-1, 0]
    bins, y = codes(held.binner, rows), np.array([r[4] for r in rows])
    for model, s in ((held, signs), (wrong, (-1, 1, 0))):
        for f, sign in enumerate(s):
            grid = np.repeat(bins[:200], held.binner.n_bins, axis=0)
            grid[:, f] = np.tile(np.arange(held.binner.n_bins), 200)
            steps = np.diff(model.score(grid).reshape(200, -1), axis=1)
            if sign:
                assert (sign * steps >= -1e-12).all()
    mse = lambda m: float(((m.score(bins) - y) ** 2).mean())
    assert mse(held) < 1.35 * mse(free) < 0.5 * float(y.var()) and mse(wrong) > 2 * mse(held)


def test_quantiles_cover(spark):
    rng = np.random.default_rng(0)
    n = 6000
    x = rng.uniform(0, 4, n)
    y = x + rng.normal(size=n) * (0.5 + x / 4)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "row_id long, x double, y double").repartition(3)
    train, held = df.where("row_id % 2 = 0"), df.where("row_id % 2 = 1")
    qs = (0.1, 0.5, 0.9)
    models = G.boost(train, ["x"], "y", [G.Pinball(q, 0.5) for q in qs], rounds=18, depth=2, rate=0.3, bins=32,
                     splitter=G.BestCut(min_hessian=20, reg=0))
    scored = G.score_with(held, {f"q{j}": models[-1, j] for j in range(3)}, ["row_id", "y"])
    row = scored.agg(*[F.avg((F.col("y") <= F.col(f"q{j}")).cast("int")).alias(f"c{j}") for j in range(3)]).first()
    assert all(abs(row[f"c{j}"] - q) < 0.025 for j, q in enumerate(qs))


def test_own_target_never_reaches_a_prediction(spark):
    df, _ = table(spark, 300)
    moved = df.withColumn("y", F.when(F.col("fold") == 1, F.col("y") * 50 + 7).otherwise(F.col("y")))
    binner = G.fit_binner(df, FEATS, 16)

    def scored(d, kind):
        if kind == "boost":
            models = {k: m for (k, _), m in G.boost(d, FEATS, "y", [G.Squared()], rounds=3, depth=2, fold="fold", folds=(0, 1, 2), binner=binner).items()}
        else:
            models = G.extra_trees(d, FEATS, "y", trees=2, depth=3, fold="fold", folds=(0, 1, 2), binner=binner)
        return {r.row_id: (r.fold, r.pred) for r in G.out_of_fold(d, models, "row_id", "fold").collect()}
    for kind in ("boost", "extra"):
        a, b = scored(df, kind), scored(moved, kind)
        inside = np.array([abs(a[i][1] - b[i][1]) for i in a if a[i][0] == 1])
        outside = np.array([abs(a[i][1] - b[i][1]) for i in a if a[i][0] != 1])
        assert inside.max() < 1e-3 < outside.max()


def test_edge_data(spark):
    rows = [(1, None, 1.0, None, None, 0, 0), (2, float("nan"), 1.0, 2.0, float("nan"), 0, 0), (3, 1.0, 1.0, 2.0, 5.0, None, 0)]
    df = spark.createDataFrame(rows, "row_id long, a double, b double, c double, y double, fold int, cls int")
    model = G.boost(df, FEATS, "y", [G.Squared()], rounds=2, depth=2)[-1, 0]
    assert [r.pred for r in G.score_with(df, {"pred": model}, ["row_id"]).collect()] == [5.0] * 3
    empty = df.limit(0)
    for m in (G.boost(empty, FEATS, "y", [G.Squared()], rounds=2, depth=2)[-1, 0], G.extra_trees(empty, FEATS, "cls", trees=2, depth=2, classes=2)[-1]):
        got = [r.pred for r in G.score_with(df, {"pred": m}, ["row_id"]).collect()]
        assert len(got) == 3 and all(v in (0.0, [0.0, 0.0]) for v in got)
        assert G.score_with(empty, {"pred": m}, ["row_id"]).count() == 0
