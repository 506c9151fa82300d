"""Pseudo-labelling: confident test predictions become extra train rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabstack.functions.expr import argmax_class, clip
from tabstack.operators.sampling import topk_confidence


def pseudo_label(test_probs: DataFrame, prob_cols: Sequence[str], rate_col: str | None,
                 n: int, threshold: float, key: str = "row_id",
                 rate_range: tuple[float, float] = (4.99, 35.99)) -> DataFrame:
    """(key, tier, rate, conf) for the n most confident test rows with
    max probability >= threshold; tier = argmax, rate clipped."""
    p = F.array(*[F.col(c) for c in prob_cols])
    d = test_probs.withColumns({"conf": F.array_max(p), "tier": argmax_class(p)})
    top = topk_confidence(d, "conf", n, threshold, key=key)
    cols = [F.col(key), F.col("tier"), F.col("conf")]
    if rate_col:
        cols.append(clip(rate_col, *rate_range).alias("rate"))
    return top.select(*cols)


def append_pseudo(train: DataFrame, pseudo: DataFrame, features: DataFrame, key: str = "row_id") -> DataFrame:
    """Real train rows + pseudo rows (features joined by key), with
    ``is_pseudo``."""
    pr = pseudo.drop("conf").join(features, on=key, how="inner")
    return train.withColumn("is_pseudo", F.lit(0)).unionByName(
        pr.withColumn("is_pseudo", F.lit(1)), allowMissingColumns=True)


def pad_pseudo(oof: Column, test_pred: Column, is_pseudo: Column) -> Column:
    """Pseudo rows have no OOF prediction of their own: use the test-time one."""
    return F.when(is_pseudo == 1, F.coalesce(oof, test_pred)).otherwise(oof)
