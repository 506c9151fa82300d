"""End-to-end run on the applicant stand-in (``acct``), the shape of the
reference's main scripts:

features -> missing flags + structural zeros + train medians -> stratified
folds -> leave-fold-out target statistics (mean / P(top) / std) -> OOF base
learners for both tasks (class probabilities feed the rate task) -> convex
rate blend from one Gram aggregate -> pseudo-labels from the most
confident test rows, on which everything is fitted anew (ROUNDS times,
``operators/generations.py``) -> prediction table from the store's latest
version -> contract check (raises on any violation).

Returns the prediction table and a CV summary, a row per generation, on real
rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabstack.functions import expr as E
from tabstack.operators import blend as B
from tabstack.operators import metrics as MT
from tabstack.operators import models as ML
from tabstack.operators.encode import apply_target_stats, fit_target_stats
from tabstack.operators.generations import Generation, run_generations
from tabstack.operators.impute import apply_imputer, fit_imputer, missing_columns, missing_flags
from tabstack.plans import fixtures as FX
from tabstack.plans.flagship import acct_features
from tabstack.session import cut_lineage, scratch_path
from tabstack.sources import sinks as SK
from tabstack.sources.store import latest_versions, read_oof

STRUCTURAL_ZERO = ["mortgage_balance"]
MEDIAN = ["property_value", "total_value"]
BASE = ["balance", "n_orders", "late30", "late60", "late90", "delinquency", "log_total_value",
        "mortgage_ltv", "value_per_order", "mortgage_balance", "property_value"]
# rounds of retraining, and how many predictions of what confidence become labels (a forest of depth 6 is seldom surer)
ROUNDS, PSEUDO_N, PSEUDO_MIN = 1, 5_000, 0.75


_RUNS: dict = {}


def run(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Once per session and input folder (its OOF tables are checkpointed,
    so both outputs read written data)."""
    key = (id(spark._jsparkSession), sf_dir)
    if key not in _RUNS:
        _RUNS[key] = _run(spark, sf_dir)
    return _RUNS[key]


PROBS = [f"p{k}" for k in range(5)]
# what a generation puts into the out-of-fold store
STORED = {("tier", "rf"): PROBS, ("rate", "gbt"): ["r_gbt"], ("rate", "rf"): ["r_rf"], ("rate", "blend"): ["rate_pred"]}
LEARNED = [*PROBS, "exp_tier", "r_gbt", "r_rf", "rate_pred"]


def fit_bases(a: DataFrame, flags: list[str]) -> tuple[DataFrame, dict[str, float]]:
    """All base learners on the rows with a fold: target statistics, class
    probabilities, two rate learners that see them, and their convex blend
    (weights from real rows)."""
    learns = F.col("fold").isNotNull()
    st = fit_target_stats(a.where(learns), ["nation", "segment"], "rate", fold="fold", m=20.0,
                          stats=("mean", "p", "std"), binary=(F.col("tier") == 4).cast("int"))
    stats = [f"{k}_{s}" for k in ("nation", "segment") for s in ("te", "te_p", "te_std")]
    # each table that the learners read more than once is written: else every count, assembly and join builds all before it again
    a = cut_lineage(apply_target_stats(a.drop(*stats, *LEARNED), st))
    feats = BASE + stats + [f"{c}_was_missing" for c in flags]
    # task A: class probabilities out of fold
    pa = ML.oof_predict(a, lambda f: ML.rf_cls(42 + f, 40, 6), feats, "tier", "fold", "cls")
    a = cut_lineage(a.join(pa.drop("fold"), "row_id").withColumn("exp_tier", E.expected_class(F.array(*PROBS))))
    feats_b = feats + PROBS + ["exp_tier"]
    # task B: two regressors out of fold, blended with convex weights
    makers = {"r_gbt": lambda f: ML.gbt_reg(42 + f, 20), "r_rf": lambda f: ML.rf_reg(42 + f, 40)}
    r1, r2 = ML.parallel(lambda m: ML.oof_predict(a, m[1], feats_b, "rate", "fold", "reg").withColumnRenamed("pred", m[0]), makers.items())
    a = cut_lineage(a.join(r1.drop("fold"), "row_id").join(r2.drop("fold"), "row_id"))
    w = B.blend_convex_reg(B.gram_state(a.where(learns & (F.col("is_pseudo") == 0)), ["r_gbt", "r_rf"], "rate"))
    return a.withColumn("rate_pred", B.blend_scalar(["r_gbt", "r_rf"], list(w))), {"w_gbt": float(w[0]), "w_rf": float(w[1])}


def _scores(g: Generation) -> DataFrame:
    """One row: the generation's scores on real out-of-fold rows, and how many rows it learned from."""
    learned = g.scored.where(F.col("fold").isNotNull())
    oof = learned.where("is_pseudo = 0")
    acc = MT.accuracy(oof, E.argmax_class(F.array(*PROBS)), "tier").withColumn("_k", F.lit(1))
    r2 = MT.r2_rmse(oof, "rate_pred", "rate").withColumn("_k", F.lit(1))
    n = learned.agg(F.sum(1 - F.col("is_pseudo")).alias("n_real"), F.sum("is_pseudo").alias("n_pseudo")).withColumn("_k", F.lit(1))
    return acc.drop("n").join(r2.drop("n"), "_k").join(n, "_k").select(
        F.lit(g.version).alias("version"), "n_real", "n_pseudo", "accuracy", "r2", "rmse", MT.combined(F.col("accuracy"), F.col("r2")).alias("combined"),
        *[F.lit(v).alias(k) for k, v in g.notes.items()])


def _run(spark: SparkSession, sf_dir: str, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    a = FX.acct_folds(spark, sf_dir)
    tr = F.col("split") == "train"
    flags = missing_columns(a.where(tr), a.where(~tr), cols=STRUCTURAL_ZERO + MEDIAN)
    a = missing_flags(a, flags)
    a = apply_imputer(a, fit_imputer(a.where(tr), zero=STRUCTURAL_ZERO, median=MEDIAN))
    a = cut_lineage(acct_features(a))
    store = scratch_path(spark, "oof-store")
    found = run_generations(a, lambda t: fit_bases(t, flags), store, STORED, PROBS, "rate_pred", rounds=rounds, n=PSEUDO_N, threshold=PSEUDO_MIN)
    cv = reduce(DataFrame.unionByName, [_scores(g) for g in found])
    # the prediction table comes from the store's latest version of each model
    latest = latest_versions(read_oof(spark, store))
    real_test = a.where(F.col("fold").isNull()).select("row_id")
    classes = latest.where("task = 'tier'").select("row_id", *[F.col("pred")[k].alias(p) for k, p in enumerate(PROBS)])
    rates = latest.where("task = 'rate' AND model = 'blend'").select("row_id", F.col("pred")[0].alias("rate_pred"))
    sub = SK.submission(real_test.join(classes, "row_id").join(rates, "row_id"), "row_id", PROBS, "rate_pred")
    SK.assert_valid(SK.validate(sub))
    return sub, cv
