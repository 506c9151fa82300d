"""OOF invariants (each row once, out of fold) and the driver contract."""

import numpy as np

from pyspark.sql import functions as F

from tabstack.operators import models as ML
from tabstack.operators.linear import linear_prediction, ols_oof_coefficients
from tabstack.plans import fixtures as FX
from tabstack.plans.flagship import acct_features

from testdata_paths import SF001


def test_oof_linear_equals_closed_form(spark):
    """pyspark.ml OLS fit on the other folds == closed-form coefficients from
    (total - own fold) Gram sums: proves each row was scored out of fold."""
    a = acct_features(FX.acct_folds(spark, SF001))
    feats = ["balance", "delinquency", "log_total_value"]
    oof = ML.oof_predict(a, lambda f: ML.linear_reg(), feats, "rate", "fold", "reg").toPandas().set_index("row_id")
    coefs, mean = ols_oof_coefficients(a, feats, "rate", "fold")
    cf = a.select("row_id", linear_prediction(feats, coefs, mean, "fold").alias("p")).toPandas().set_index("row_id")
    assert len(oof) == a.count() and oof.index.is_unique
    assert np.allclose(oof.loc[cf.index, "pred"], cf.p, atol=1e-6)


def test_entry_contract(spark):
    import __spark_entry__ as ent
    df = ent.entry(spark)
    rows = df.collect()
    assert len(rows) == 5 and set(df.columns) >= {"fold", "r2", "r2_mean", "r2_std"}
    q, o = ent.queries(), ent.oracle_sql()
    assert len(q) >= 100 and set(o) <= set(q)


def test_validate_contract(spark):
    from tabstack.sources.sinks import validate
    df = spark.createDataFrame([(1, 0, 4.99), (1, 5, 36.0), (-2, 2, 7.125)], "Id int, RiskTier int, InterestRate double")
    r = validate(df).collect()[0]
    assert (r.duplicate_ids, r.bad_ids, r.bad_tiers, r.rate_out_of_range, r.rate_not_2dp) == (1, 1, 1, 1, 1)


def test_own_label_never_reaches_a_prediction(spark):
    """Changing one row's labels leaves its own out-of-fold values unchanged."""
    from pyspark.sql import functions as F

    from tabstack.operators import models as ML
    from tabstack.plans.q_folds_models import FEATS, _model_frame
    from testdata_paths import SF001
    d = _model_frame(spark, SF001).cache()
    rid = d.where(F.col("fold") == 2).orderBy("row_id").first()["row_id"]
    own = F.col("row_id") == rid
    bumped = d.withColumn("rate", F.when(own, F.col("rate") + 50.0).otherwise(F.col("rate"))) \
              .withColumn("tier", F.when(own, (F.col("tier") + 2) % 5).otherwise(F.col("tier")))
    runs = [lambda x: ML.oof_predict(x, lambda f: ML.rf_reg(42 + f, 5), FEATS, "rate"),
            lambda x: ML.oof_predict(x, lambda f: ML.rf_cls(42 + f, 5), FEATS, "tier", kind="cls"),
            lambda x: ML.log_target_regression(x, FEATS, "rate", "fold")]
    for run in runs:
        a, b = (run(x).where(own).first() for x in (d, bumped))
        assert a == b
    scored = ML.oof_predict(d, lambda f: ML.rf_cls(42 + f, 5), FEATS, "tier", kind="cls").collect()
    assert len(scored) == d.count() and all(abs(sum(r[f"p{k}"] for k in range(5)) - 1) < 1e-9 for r in scored)


def test_early_stopping_keeps_fewer_trees_and_no_leak(spark):
    from tabstack.operators import models as ML
    d = spark.range(600).select(F.col("id").alias("row_id"), (F.col("id") % 5).cast("int").alias("fold"), ((F.col("id") * 37) % 101 / 101.0).alias("x"))
    d = d.withColumn("y", F.col("x") + F.pmod(F.xxhash64("row_id"), F.lit(1000)) / 200.0)
    moved = d.withColumn("y", F.when(F.col("fold") == 3, 99.0).otherwise(F.col("y")))

    def run(t):
        fitted = {}
        out = ML.oof_predict(t, lambda f: ML.gbt_reg(f, 30, 3), ["x"], "y", fitted=fitted, valid_share=0.25)
        return {r.row_id: r.pred for r in out.where("fold = 3").collect()}, {f: m.getNumTrees for f, m in fitted.items()}
    a, trees = run(d)
    assert all(0 < n < 30 for n in trees.values())
    b, _ = run(moved)
    assert a == b
