"""End-to-end flow on the ``acct`` fixture (the minimum slice):

source -> feature projection (safe ratios, weighted severity, log money) ->
stratified folds -> leave-fold-out target encoding (nation -> rate) ->
out-of-fold linear model (one Gram aggregate for all folds) -> per-fold R^2
-> mean and population std over folds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabstack.functions import expr as E
from tabstack.operators.encode import apply_target_stats, fit_target_stats
from tabstack.operators.linear import linear_prediction, ols_oof_coefficients
from tabstack.operators.metrics import r2_rmse
from tabstack.plans import fixtures as FX

# fixed values: late-payment severity weights 1/3/9 (30/60/90 days)
DELINQUENCY_WEIGHTS = {"late30": 1, "late60": 3, "late90": 9}
FEATURES = ["nation_te", "delinquency", "log_total_value", "mortgage_ltv", "value_per_order"]


def acct_features(df: DataFrame) -> DataFrame:
    """Feature block on ``acct`` in ONE projection."""
    return df.withColumns({
        "delinquency": E.weighted_sum(DELINQUENCY_WEIGHTS),
        "any_delinquency": (E.row_sum_nullzero(["late30", "late60", "late90"]) > 0).cast("int"),
        "severe_delinquency": E.flag("late90", ">", 0),
        "log_total_value": E.log1p_pos("total_value"),
        "mortgage_ltv": E.safe_div("mortgage_balance", "property_value"),
        "value_per_order": E.safe_div("total_value", "n_orders"),
    })


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = acct_features(FX.acct_folds(spark, sf_dir))
    train = a.where(F.col("split") == "train")
    te = fit_target_stats(train, ["nation"], "rate", fold="fold", m=20.0, names=["nation"])
    enc = apply_target_stats(a, te)
    coefs, mean = ols_oof_coefficients(enc, FEATURES, "rate", fold="fold")
    pred = enc.withColumn("pred", linear_prediction(FEATURES, coefs, mean, "fold"))
    per_fold = r2_rmse(pred.where(F.col("fold").isNotNull()), "pred", "rate", by=["fold"])
    w = Window.partitionBy()  # over the K-row per-fold table only
    return per_fold.select(
        F.col("fold").cast("int").alias("fold"), "n", "r2", "rmse",
        F.avg("r2").over(w).alias("r2_mean"), F.stddev_pop("r2").over(w).alias("r2_std"))
