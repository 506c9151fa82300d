"""Learners and out-of-fold prediction with ``pyspark.ml``.

Boosting libraries of the reference are re-aimed at distributed Spark
learners; equality of predictions is not a goal, the OOF discipline is:
every train row is scored by the model that did not see its fold, rows
without a fold (test) get the mean of the K fold models.

The assembled training frame is persisted once before the K-model loop and
the OOF table is checkpointed (lineage cut) when written.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Estimator
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, IsotonicRegression, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabstack.functions.expr import exp_shift, log_shift, round_to_class
from tabstack.operators._util import one_row
from tabstack.operators.aggregates import medians
from tabstack.operators.folds import assign_folds_stratified
from tabstack.session import cut_lineage

FEATURES_COL = "features"
VALID_COL = "_valid"        # rows that tell a boosted learner when to stop
ROWS_A_PART = 500_000       # at most so many rows of a training frame in a partition


def assemble(df: DataFrame, features: Sequence[str], out: str = FEATURES_COL) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep").transform(df)


def fill_missing(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``features`` with the median of their known values (0 without any) where
    null or NaN: ``pyspark.ml`` learners refuse such vectors.  A frame without
    gaps costs one aggregate."""
    gap = {c: F.col(c).isNull() | F.isnan(F.col(c).cast("double")) for c in features}
    n = one_row(df.agg(*[F.count_if(g).alias(c) for c, g in gap.items()]))
    short = [c for c in features if n[c]]
    fills = medians(df, short) if short else {}
    return df.withColumns({c: F.when(gap[c], F.lit(float(fills[c] or 0.0))).otherwise(F.col(c).cast("double")) for c in short})


def few_parts(df: DataFrame) -> DataFrame:
    """``df`` for repeated fits, in as many partitions as the cluster has cores
    or as ``ROWS_A_PART`` asks for, whichever are more.

    A fit is hundreds of stages, each with a task per partition, and a task
    costs the driver its start and kilobytes of report whatever its rows: with
    the partitions that a shuffle left, both grow faster than the input."""
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_A_PART))
    return df.coalesce(parts)


# ---------------------------------------------------------------- learners

def gbt_reg(seed: int = 42, max_iter: int = 30, depth: int = 4, loss: str = "squared", **kw) -> Estimator:
    return GBTRegressor(featuresCol=FEATURES_COL, maxIter=max_iter, maxDepth=depth, seed=seed,
                        lossType=loss, stepSize=0.1, **kw)


def gbt_binary(seed: int = 42, max_iter: int = 30, depth: int = 4, **kw) -> Estimator:
    return GBTClassifier(featuresCol=FEATURES_COL, maxIter=max_iter, maxDepth=depth, seed=seed,
                         stepSize=0.1, **kw)


def rf_reg(seed: int = 42, trees: int = 50, depth: int = 6, **kw) -> Estimator:
    return RandomForestRegressor(featuresCol=FEATURES_COL, numTrees=trees, maxDepth=depth, seed=seed, **kw)


def rf_cls(seed: int = 42, trees: int = 50, depth: int = 6, **kw) -> Estimator:
    return RandomForestClassifier(featuresCol=FEATURES_COL, numTrees=trees, maxDepth=depth, seed=seed, **kw)


def mlp_cls(n_features: int, n_classes: int = 5, hidden=(64, 32), seed: int = 42, max_iter: int = 100) -> Estimator:
    return MultilayerPerceptronClassifier(featuresCol=FEATURES_COL, layers=[n_features, *hidden, n_classes],
                                          seed=seed, maxIter=max_iter)


def linear_reg(reg: float = 0.0) -> Estimator:
    return LinearRegression(featuresCol=FEATURES_COL, regParam=reg, solver="normal")


def logistic_multi(reg: float = 0.0) -> Estimator:
    return LogisticRegression(featuresCol=FEATURES_COL, family="multinomial", regParam=reg, maxIter=100)


# ------------------------------------------------------------- OOF engine

def _score(d: DataFrame, models: dict, fold: str, kind: str, n_classes: int = 1) -> DataFrame:
    """``d`` scored by all fold models in one pass: a row with a fold gets the
    values of the model that did not see it, a row without one the mean of all.
    The models are chained on the same rows, so nothing is unioned or shuffled."""
    for f, model in models.items():
        m = model.copy().setPredictionCol(f"_pred_{f}")
        if kind == "cls":
            m = m.setProbabilityCol(f"_prob_{f}").setRawPredictionCol(f"_raw_{f}")
        d = m.transform(d)

    def value(f, k):
        if kind == "reg":
            return F.col(f"_pred_{f}").cast("double")
        # a training fold may lack the highest classes: their probability is 0
        return F.coalesce(F.get(F.col(f"_arr_{f}"), F.lit(k)), F.lit(0.0))

    if kind == "cls":
        d = d.withColumns({f"_arr_{f}": vector_to_array(f"_prob_{f}") for f in models})
    out = {}
    for k, name in enumerate(["pred"] if kind == "reg" else [f"p{k}" for k in range(n_classes)]):
        every = [value(f, k) for f in models]
        mean = sum(every[1:], every[0]) / len(every)
        own = F.coalesce(*[F.when(F.col(fold) == f, v) for f, v in zip(models, every)])
        out[name] = F.when(F.col(fold).isNull(), mean).otherwise(own)
    return d.withColumns(out)


def oof_predict(df: DataFrame, make_estimator: Callable[[int], Estimator], features: Sequence[str],
                label: str, fold: str = "fold", kind: str = "reg", n_classes: int = 5,
                key: str = "row_id", checkpoint: bool = True, fitted: dict | None = None,
                valid_share: float = 0.0) -> DataFrame:
    """(key, fold, pred | p0..p{C-1}) for every row: train rows out of fold,
    rows with a NULL fold averaged over the K fold models.  ``fitted`` receives
    the fold models.

    With ``valid_share`` a boosted learner stops early: that share of its own
    training rows (by a hash of the key, so never rows of the fold it will
    score) tells when another tree no longer helps."""
    d = assemble(few_parts(df.select(key, fold, label, *features)), features)
    if valid_share:
        d = d.withColumn(VALID_COL, F.pmod(F.xxhash64(F.lit("valid"), F.col(key)), F.lit(10_000)) < int(valid_share * 10_000))
    d = d.persist(StorageLevel.MEMORY_AND_DISK)
    folds = sorted(r[0] for r in d.select(fold).where(F.col(fold).isNotNull()).distinct().collect())
    models = fit_folds(d, make_estimator, label, fold, folds, valid=VALID_COL if valid_share else None)
    if fitted is not None:
        fitted.update(models)
    vals = ["pred"] if kind == "reg" else [f"p{k}" for k in range(n_classes)]
    out = _score(d, models, fold, kind, n_classes).select(key, fold, *vals)
    out = cut_lineage(out) if checkpoint else out
    if checkpoint:
        d.unpersist()
    return out


def parallel(fn: Callable, items, workers: int | None = None) -> list:
    """Run independent model fits as concurrent Spark jobs (driver threads;
    the scheduler interleaves their tasks)."""
    from concurrent.futures import ThreadPoolExecutor
    items = list(items)
    with ThreadPoolExecutor(max_workers=workers or max(1, len(items))) as ex:
        return list(ex.map(fn, items))


def fit_folds(d: DataFrame, make_estimator: Callable[[int], Estimator], label: str, fold: str,
              folds: Sequence[int], parallelism: int | None = None, valid: str | None = None) -> dict:
    """Fit the K fold models (each on the other folds) as concurrent Spark
    jobs -- they share the persisted input and are independent, like
    ``CrossValidator(parallelism=...)``."""
    from concurrent.futures import ThreadPoolExecutor

    def fit(f):
        est = make_estimator(f).setLabelCol(label)
        est = est.setValidationIndicatorCol(valid) if valid else est
        return f, est.fit(d.where(F.col(fold).isNotNull() & (F.col(fold) != f)))

    with ThreadPoolExecutor(max_workers=parallelism or len(folds)) as ex:
        return dict(ex.map(fit, folds))


def binary_ovr_probs(df: DataFrame, features: Sequence[str], label: str, fold: str, n_classes: int = 5,
                     key: str = "row_id", seed: int = 42, max_iter: int = 20) -> DataFrame:
    """Multiclass boosted trees: GBTClassifier is binary only, so one binary
    model per class (one-vs-rest) and the K positive-class probabilities are
    row-normalised."""
    base = df.select(key, fold, label, *features)

    def one_class(k):
        d = base.withColumn("_yk", (F.col(label) == k).cast("double"))
        return oof_predict(d, lambda f: gbt_binary(seed + k, max_iter), features, "_yk", fold, kind="cls",
                           n_classes=2, key=key).select(key, fold, F.col("p1").alias(f"q{k}"))

    parts = None
    for o in parallel(one_class, range(n_classes)):  # the K binary problems are independent jobs
        parts = o if parts is None else parts.join(o.drop(fold), key)
    tot = sum((F.col(f"q{k}") for k in range(1, n_classes)), F.col("q0"))
    out = parts.select(key, fold, *[(F.col(f"q{k}") / tot).alias(f"p{k}") for k in range(n_classes)])
    return cut_lineage(out)


def nested_stack_cls(df: DataFrame, bases: Mapping[str, Callable[[int], Estimator]], features: Sequence[str],
                     label: str, fold: str = "fold", inner: int = 3, n_classes: int = 5, key: str = "row_id",
                     C: float = 1.0, parallelism: int = 8) -> DataFrame:
    """(key, fold, p0..p{C-1}): a stack of classifiers under a multinomial
    logistic model with penalty ``1 / C``, its cross-validation nested.

    For every outer fold the bases are cross-fitted over ``inner`` parts of the
    other folds; the meta model learns from those out-of-part probabilities and
    scores the fold with bases refitted on all its training rows.  Rows without
    a fold are scored by the stack over all labelled rows.  ``bases`` maps a
    name to a maker of estimators (argument: a seed).

    The inner parts are exact strata of (fold, class), so one assignment serves
    all outer folds and a row's own label never reaches what scores it.  The
    base fits are independent jobs on one persisted frame; a row is scored only
    by the base models that its place asks for."""
    train = F.col(fold).isNotNull() & F.col(label).isNotNull()
    d = df.select(key, fold, F.col(label).cast("double").alias(label), *features) \
        .withColumn("_stratum", F.concat_ws("|", F.col(fold), F.col(label)))
    d = assign_folds_stratified(d, key, inner, "_stratum", only_where=train, fold_col="_inner").drop("_stratum")
    d = few_parts(cut_lineage(assemble(d, features).drop(*features))).persist(StorageLevel.MEMORY_AND_DISK)
    outer = sorted(r[0] for r in d.where(train).select(fold).distinct().collect()) + [None]
    names, parts = list(bases), d.rdd.getNumPartitions()

    def rows_of(o):
        return train if o is None else train & (F.col(fold) != o)

    def fit(job):
        o, name, j = job
        rows = d.where(rows_of(o) if j is None else rows_of(o) & (F.col("_inner") != j))
        seed = 42 + 100 * names.index(name) + (0 if j is None else j + 1)
        return job, bases[name](seed).setLabelCol(label).fit(rows)

    jobs = [(o, name, j) for o in outer for name in names for j in [*range(inner), None]]
    fitted = dict(parallel(fit, jobs, parallelism))

    def scored(o, rows, j):
        """``rows`` with the probabilities of the bases of part ``j`` (None: of all training rows) as one vector."""
        meta = []
        for name in names:
            m = fitted[o, name, j].copy().setPredictionCol(f"_{name}_c").setProbabilityCol(f"_{name}").setRawPredictionCol(f"_{name}_r")
            rows = m.transform(rows).withColumn(f"_{name}", vector_to_array(f"_{name}")).drop(f"_{name}_c", f"_{name}_r")
            # a training part may lack the highest classes: their probability is 0
            meta += [F.coalesce(F.get(F.col(f"_{name}"), F.lit(k)), F.lit(0.0)) for k in range(n_classes)]
        return rows.select(key, fold, label, array_to_vector(F.array(*meta)).alias("_meta"))

    def score(o):
        rest = F.col(fold).isNull() if o is None else F.col(fold) == o
        pieces = [scored(o, d.where(rows_of(o) & (F.col("_inner") == j)), j) for j in range(inner)] + [scored(o, d.where(rest), None)]
        # written: the meta model takes hundreds of jobs, and each would carry the base models of its frame's lineage
        s = cut_lineage(reduce(lambda x, y: x.unionByName(y), pieces).coalesce(parts))
        learn = s.where(rows_of(o))
        n = learn.count()
        top = LogisticRegression(featuresCol="_meta", labelCol=label, family="multinomial", regParam=1.0 / (C * n),
                                 standardization=False, maxIter=2000, probabilityCol="_p").fit(learn)
        p = top.transform(s.where(rest)).withColumn("_p", vector_to_array("_p"))
        return cut_lineage(p.select(key, fold, *[F.coalesce(F.get("_p", F.lit(k)), F.lit(0.0)).alias(f"p{k}") for k in range(n_classes)]))

    done = parallel(score, outer, parallelism)
    d.unpersist()
    return reduce(lambda a, b: a.unionByName(b), done)


def ordinal_regression(df: DataFrame, features: Sequence[str], label: str, fold: str,
                       key: str = "row_id", n_classes: int = 5) -> DataFrame:
    """Class regressed as a number; keep the float and the rounded class."""
    o = oof_predict(df, lambda f: gbt_reg(42 + f), features, label, fold, "reg", key=key)
    return o.withColumn("cls", round_to_class("pred", n_classes))


def log_target_regression(df: DataFrame, features: Sequence[str], label: str, fold: str,
                          key: str = "row_id", shift: float = 4.98) -> DataFrame:
    d = df.withColumn("_ly", log_shift(label, shift))
    o = oof_predict(d, lambda f: gbt_reg(42 + f), features, "_ly", fold, "reg", key=key)
    return o.withColumn("pred", exp_shift("pred", shift))


def two_regime_mixture(df: DataFrame, features: Sequence[str], rate: str, tier: str, fold: str,
                       key: str = "row_id", top: int = 4) -> DataFrame:
    """P(tier = top) * subprime + (1 - P) * prime; the two regressors are fit
    on their own regimes (filters), the gate on all rows."""
    gate = oof_predict(df.withColumn("_g", (F.col(tier) == top).cast("double")),
                       lambda f: gbt_binary(42 + f, 20), features, "_g", fold, "cls", 2, key)
    # the regime models score every row: fit on the regime, predict all
    sub = _fit_subset_predict_all(df, features, rate, fold, F.col(tier) == top, key)
    prime = _fit_subset_predict_all(df, features, rate, fold, F.col(tier) != top, key)
    j = gate.select(key, fold, F.col("p1").alias("p_top")).join(sub.withColumnRenamed("pred", "sub"), key) \
        .join(prime.withColumnRenamed("pred", "prime"), key)
    return j.select(key, fold, "p_top", "sub", "prime",
                    (F.col("p_top") * F.col("sub") + (1 - F.col("p_top")) * F.col("prime")).alias("pred"))


def _fit_subset_predict_all(df, features, label, fold, subset, key, seed=42):
    """Per fold: fit on train rows of other folds inside ``subset``; score the
    fold's rows (all of them); rows without fold get the fold-model mean."""
    d = assemble(few_parts(df.select(key, fold, label, *features, subset.alias("_in"))), features)
    d = d.persist(StorageLevel.MEMORY_AND_DISK)
    folds = sorted(r[0] for r in d.select(fold).where(F.col(fold).isNotNull()).distinct().collect())
    models = fit_folds(d.where(F.col("_in")), lambda f: gbt_reg(seed + f, 20), label, fold, folds)
    out = cut_lineage(_score(d, models, fold, "reg").select(key, "pred"))
    d.unpersist()
    return out


def two_stage_class(df: DataFrame, features: Sequence[str], tier: str, fold: str,
                    key: str = "row_id", top: int = 4) -> DataFrame:
    """Binary gate p_top x (top)-class model on the other rows:
    p_k = (1 - p_top) * q_k, p_top = gate."""
    gate = oof_predict(df.withColumn("_g", (F.col(tier) == top).cast("double")),
                       lambda f: gbt_binary(42 + f, 20), features, "_g", fold, "cls", 2, key)
    # the lower-class model is fit on rows below ``top`` only (fold column
    # NULL elsewhere): those rows are scored out of fold, the rest by the
    # mean of the fold models, none of which saw them
    low = df.withColumn("_w", F.when(F.col(tier) != top, F.col(fold)))
    q = oof_predict(low, lambda f: rf_cls(42 + f, 30, 5), features, tier, "_w", "cls", top, key)
    j = gate.select(key, fold, F.col("p1").alias("pt")).join(q.drop("_w"), key)
    return j.select(key, fold, *[((1 - F.col("pt")) * F.col(f"p{k}")).alias(f"p{k}") for k in range(top)],
                    F.col("pt").alias(f"p{top}"))


def floor_two_stage(df: DataFrame, features: Sequence[str], rate: str, fold: str, key: str = "row_id",
                    floor: float = 4.99, floor_cut: float = 5.0, hard: bool = False) -> DataFrame:
    """P(rate <= cut) * floor + (1 - P) * regression fit on non-floor rows
    (hard variant: snap to the floor when P > 0.5)."""
    gate = oof_predict(df.withColumn("_f", (F.col(rate) <= floor_cut).cast("double")),
                       lambda f: gbt_binary(42 + f, 20), features, "_f", fold, "cls", 2, key)
    reg = _fit_subset_predict_all(df, features, rate, fold, F.col(rate) > floor_cut, key)
    j = gate.select(key, fold, F.col("p1").alias("p_floor")).join(reg, key)
    soft = F.col("p_floor") * F.lit(floor) + (1 - F.col("p_floor")) * F.col("pred")
    hard_e = F.when(F.col("p_floor") > 0.5, F.lit(floor)).otherwise(F.col("pred"))
    return j.select(key, fold, "p_floor", F.col("pred").alias("reg"), (hard_e if hard else soft).alias("pred"))


def seed_average(preds: DataFrame, key: str = "row_id", values: Sequence[str] = ("pred",),
                 seed_col: str = "seed") -> DataFrame:
    """Mean over seeds per row (one aggregate)."""
    return preds.groupBy(key).agg(*[F.avg(v).alias(v) for v in values],
                                  F.count_distinct(seed_col).alias("n_seeds"))


def bagged(df: DataFrame, bags: dict, label: str, fold: str, kind: str = "reg", key: str = "row_id") -> DataFrame:
    """One model per column subset (feature bag), averaged."""
    def one_bag(item):
        s, feats = item
        return oof_predict(df, lambda f: gbt_reg(1000 * s + f, 20), feats, label, fold, kind,
                           key=key).withColumn("seed", F.lit(s))

    parts = None
    for o in parallel(one_bag, bags.items()):
        parts = o if parts is None else parts.unionByName(o)
    return seed_average(parts, key)


def isotonic_calibrate(df: DataFrame, score: str, label: str, increasing: bool = True) -> DataFrame:
    """Monotone re-aim: isotonic regression of the label on a score."""
    d = assemble(df, [score], "iso_features")
    m = IsotonicRegression(featuresCol="iso_features", labelCol=label, isotonic=increasing).fit(d)
    return m.transform(d).withColumnRenamed("prediction", "calibrated").drop("iso_features")


def feature_importance(df: DataFrame, features: Sequence[str], label: str, kind: str = "reg",
                       seed: int = 42) -> list[tuple[str, float]]:
    d = assemble(fill_missing(df, features), features)
    est = rf_reg(seed, 50, 6) if kind == "reg" else rf_cls(seed, 50, 6)
    m = est.setLabelCol(label).fit(d)
    imp = np.asarray(m.featureImportances.toArray())
    return sorted(zip(features, imp.tolist()), key=lambda t: -t[1])
