"""Nested classification stack: no leak of a row's own label, every row once,
a meta model that beats chance and keeps up with its best base."""

import numpy as np
from pyspark.sql import functions as F

from tabstack.functions import expr as E
from tabstack.operators import models as ML
from tabstack.plans.q_folds_models import FEATS, _model_frame

from testdata_paths import SF001

BASES = {"trees": lambda s: ML.rf_cls(s, 5, 4), "soft": lambda s: ML.logistic_multi(0.01)}
PS = [f"p{k}" for k in range(5)]


def test_rows_probabilities_and_accuracy(spark):
    d = _model_frame(spark, SF001).cache()
    got = ML.nested_stack_cls(d, BASES, FEATS, "tier", inner=2).cache()
    assert got.count() == d.count() == got.select("row_id").distinct().count()
    p = np.array([[r[c] for c in PS] for r in got.select(*PS).collect()])
    assert np.allclose(p.sum(axis=1), 1) and (p >= 0).all()

    def accuracy(probs):
        j = probs.where(F.col("fold").isNotNull()).join(d.select("row_id", "tier"), "row_id")
        return j.agg(F.avg((E.argmax_class(F.array(*PS)) == F.col("tier")).cast("double"))).first()[0]

    single = [accuracy(ML.oof_predict(d, lambda f: make(42), FEATS, "tier", kind="cls")) for make in BASES.values()]
    assert accuracy(got) >= max(single) - 0.1


def test_own_label_never_reaches_the_stack(spark):
    d = _model_frame(spark, SF001).cache()
    row = d.where("fold = 1").orderBy("row_id").first()["row_id"]
    bumped = d.withColumn("tier", F.when(F.col("row_id") == row, (F.col("tier") + 2) % 5).otherwise(F.col("tier")))
    a, b = (ML.nested_stack_cls(x, BASES, FEATS, "tier", inner=2).where(F.col("row_id") == row).first() for x in (d, bumped))
    assert np.allclose([a[c] for c in PS], [b[c] for c in PS], atol=1e-9)
