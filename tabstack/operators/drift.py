"""Train/test drift (adversarial validation)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabstack.operators import models as ML
from tabstack.operators.aggregates import unpivot
from tabstack.operators.folds import assign_folds_hash
from tabstack.operators.metrics import auc


def adversarial_auc(df: DataFrame, features: Sequence[str], is_test: str, key: str,
                    k: int = 5, seed: int = 42) -> tuple[DataFrame, list[tuple[str, float]]]:
    """Label rows by split, score them out of fold with a forest, and report
    the AUC (0.5 = no drift) and fold-averaged feature importances."""
    d = assign_folds_hash(df.select(key, is_test, *features), key, k, seed)
    models: dict = {}
    oof = ML.oof_predict(d, lambda f: ML.rf_cls(seed + f, 30, 5), features, is_test, "fold", "cls",
                         n_classes=2, key=key, fitted=models)
    scored = oof.join(d.select(key, is_test), key)
    a = auc(scored, "p1", is_test)
    imps = {}
    for m in models.values():
        for name, v in zip(features, m.featureImportances.toArray()):
            imps[name] = imps.get(name, 0.0) + float(v) / len(models)
    return a, sorted(imps.items(), key=lambda t: -t[1])


def univariate_auc(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """AUC of every feature used alone as a score of ``label`` (exact, with
    ties) -- one grouped computation over the unpivoted features."""
    long = unpivot(df, features, ids=[label], cast="double").where(F.col("value").isNotNull())
    return auc(long, "value", label, by=["column"]).withColumnRenamed("column", "feature")


def prune_suspects(scores: DataFrame, auc_col: str = "auc", top: int = 20,
                   threshold: float = 0.52) -> DataFrame:
    """If the strongest drift signal reaches ``threshold``, mark the ``top``
    features with the largest |AUC - 0.5| as dropped."""
    from pyspark.sql import Window
    d = scores.withColumn("drift", F.abs(F.col(auc_col) - 0.5))
    w = Window.orderBy(F.desc("drift"), "feature")  # small per-feature table
    d = d.withColumn("_r", F.row_number().over(w))
    worst = F.max(F.greatest(F.col(auc_col), 1 - F.col(auc_col))).over(Window.partitionBy())
    return d.withColumn("dropped", ((worst >= threshold) & (F.col("_r") <= top)).cast("int")).drop("_r")
