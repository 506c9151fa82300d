"""Metrics as aggregates, optionally per group (fold, model, ...).

All metrics are one or two aggregation passes; nothing is collected but the
small result table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabstack.functions.expr import clip_prob
from tabstack.operators._util import bounded_broadcast, null_safe_join


def _grp(by):
    return list(by) if by else []


def _with_group(df: DataFrame, by):
    """Ungrouped metrics use a constant group so every path is a keyed join."""
    by = _grp(by)
    if by:
        return df, by, []
    return df.withColumn("_all", F.lit(0)), ["_all"], ["_all"]


def accuracy(df: DataFrame, pred: str | Column, label: str, by: Sequence[str] | None = None,
             name: str = "accuracy") -> DataFrame:
    p = F.col(pred) if isinstance(pred, str) else pred
    return df.groupBy(*_grp(by)).agg(
        F.avg((p.cast("int") == F.col(label).cast("int")).cast("double")).alias(name),
        F.count(F.lit(1)).alias("n"))


def r2_rmse(df: DataFrame, pred: str | Column, label: str, by: Sequence[str] | None = None) -> DataFrame:
    """1 - SSE/SST and RMSE; SST around the group mean from a first pass (the
    small per-group mean table is broadcast back) to avoid cancellation."""
    p = F.col(pred) if isinstance(pred, str) else pred
    df, by, drop = _with_group(df, by)
    d = df.select(*by, p.cast("double").alias("_p"), F.col(label).cast("double").alias("_y"))
    means = d.groupBy(*by).agg(F.avg("_y").alias("_ym"))
    j = null_safe_join(d, bounded_broadcast(means), by)
    r = j.groupBy(*by).agg(
        F.sum((F.col("_y") - F.col("_p")) ** 2).alias("_sse"),
        F.sum((F.col("_y") - F.col("_ym")) ** 2).alias("_sst"),
        F.count(F.lit(1)).alias("n"))
    return r.select(*by, (F.lit(1.0) - F.col("_sse") / F.col("_sst")).alias("r2"),
                    F.sqrt(F.col("_sse") / F.col("n")).alias("rmse"), "n").drop(*drop)


def logloss(df: DataFrame, probs: Sequence[str], label: str, by: Sequence[str] | None = None,
            eps: float = 1e-12) -> DataFrame:
    """mean(-ln clip(p_y)); clipping keeps Spark's ln(0)=NULL out."""
    p = F.array(*[F.col(c).cast("double") for c in probs])
    py = F.element_at(p, F.col(label).cast("int") + 1)
    return df.groupBy(*_grp(by)).agg(F.avg(-F.ln(clip_prob(py, eps))).alias("logloss"),
                                     F.count(F.lit(1)).alias("n"))


def _edges_below(edges: Column, x: Column) -> Column:
    """How many of the sorted ``edges`` lie strictly below ``x``, in about 2 sqrt(n) comparisons."""
    step = F.greatest(F.floor(F.sqrt(F.size(edges))).cast("int"), F.lit(1))
    starts = F.transform(F.sequence(F.lit(0), F.floor((F.size(edges) - 1) / step).cast("int")), lambda k: k * step)
    group = F.greatest(F.size(F.filter(starts, lambda k: F.get(edges, k) < x)) - 1, F.lit(0)) * step
    return F.when(F.size(edges) > 0, group + F.size(F.filter(F.slice(edges, group + 1, step), lambda e: e < x))).otherwise(0)


def auc(df: DataFrame, score: str, label: str, by: Sequence[str] | None = None,
        rows_per_bucket: int = 200_000, n_buckets: int | None = None) -> DataFrame:
    """Exact ROC AUC with ties (Mann-Whitney with mid-ranks).

    Rows are reduced to (score -> positives, negatives); the running count of
    negatives below each score is taken inside quantile buckets of the score
    and shifted by bucket offsets from a tiny table, so no window spans all
    distinct scores in one task.  The buckets are as many as the distinct
    scores ask for (unless ``n_buckets`` fixes them); a row finds its bucket by binary search.
    """
    df, by, drop = _with_group(df, by)
    y = F.col(label).cast("int")
    s = df.groupBy(*by, F.col(score).cast("double").alias("_s")).agg(
        F.sum(y).alias("_pos"), F.sum(1 - y).alias("_neg"))
    s = s.persist(StorageLevel.MEMORY_AND_DISK)
    n_buckets = n_buckets or max(2, -(-s.count() // rows_per_bucket))
    edges_df = s.groupBy(*by).agg(F.percentile_approx(
        "_s", [i / n_buckets for i in range(1, n_buckets)], 10000).alias("_e"))
    s = null_safe_join(s, bounded_broadcast(edges_df), by)
    s = s.withColumn("_bk", _edges_below(F.col("_e"), F.col("_s"))).drop("_e")
    bk = s.groupBy(*by, "_bk").agg(F.sum("_neg").alias("_bneg"))
    w_off = Window.partitionBy(*by).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    bk = bk.select(*by, "_bk", F.coalesce(F.sum("_bneg").over(w_off), F.lit(0)).alias("_off"))
    s = null_safe_join(s, bounded_broadcast(bk), [*by, "_bk"])
    w_in = Window.partitionBy(*by, "_bk").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("_below", F.col("_off") + F.coalesce(F.sum("_neg").over(w_in), F.lit(0)))
    r = s.groupBy(*by).agg(
        F.sum(F.col("_pos") * (F.col("_below") + 0.5 * F.col("_neg"))).alias("_u"),
        F.sum("_pos").alias("_np"), F.sum("_neg").alias("_nn"))
    return r.select(*by, (F.col("_u") / (F.col("_np") * F.col("_nn"))).alias("auc"),
                    (F.col("_np") + F.col("_nn")).alias("n")).drop(*drop)


def combined(acc: Column, r2: Column) -> Column:
    """Leaderboard score 0.5 * accuracy + 0.5 * R^2."""
    return F.lit(0.5) * acc + F.lit(0.5) * r2
