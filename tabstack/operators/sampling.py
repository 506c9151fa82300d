"""Top-k, sampling and rank combination."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabstack.operators._util import bounded_broadcast, null_safe_join


def topk_confidence(df: DataFrame, conf: str | Column, n: int, threshold: float,
                    key: str = "row_id") -> DataFrame:
    """Rows with confidence >= threshold, the n most confident (ties -> key).
    ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject: each task keeps
    its own top n, only n rows per task reach the final merge."""
    c = F.col(conf) if isinstance(conf, str) else conf
    d = df.withColumn("_conf", c)
    return d.where(F.col("_conf") >= threshold).orderBy(F.desc("_conf"), F.asc(key)).limit(n)


def hash_uniform(key: str, seed: int = 42) -> Column:
    """md5-derived integer in [0, 2^32) (first 8 hex digits)."""
    h = F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("long")


def stratified_sample(df: DataFrame, stratum: str, k: int, key: str = "row_id",
                      seed: int = 42, safety: float = 1.5) -> DataFrame:
    """Exactly the k rows with the smallest md5(seed|key) in each stratum
    (all rows of smaller strata).

    A window over a whole stratum would sort a hot stratum in one task.
    Instead each stratum gets a hash threshold sized to keep about
    ``safety * k`` rows (a narrow filter), and the exact cut runs on the
    survivors.  The threshold is a prefix of the same order, so every row
    that could be among the k smallest survives; strata with too few
    survivors are redone with the full stratum.
    """
    h = F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))
    d = df.withColumns({"_h": h, "_u": F.conv(F.substring(h, 1, 8), 16, 10).cast("long")})
    counts = d.groupBy(stratum).agg(F.count(F.lit(1)).alias("_cnt"))
    frac = F.least(F.lit(1.0), (F.lit(safety * k) + F.lit(32.0)) / F.col("_cnt"))
    thr = counts.select(stratum, "_cnt", F.ceil(frac * F.lit(float(2 ** 32))).cast("long").alias("_thr"))
    thr = bounded_broadcast(thr)
    cand = null_safe_join(d, thr, [stratum]).where(F.col("_u") < F.col("_thr"))
    w = Window.partitionBy(stratum).orderBy("_h", key)
    ranked = cand.withColumn("_rn", F.row_number().over(w))
    surv = ranked.groupBy(stratum).agg(F.count(F.lit(1)).alias("_s"), F.first("_cnt").alias("_cnt"))
    # strata with too few survivors (rare; none in most runs) are redone whole
    surv = null_safe_join(counts, surv.drop("_cnt"), [stratum])
    short = bounded_broadcast(surv.where((F.coalesce("_s", F.lit(0)) < k) & (F.coalesce("_s", F.lit(0)) < F.col("_cnt"))).select(stratum))
    out = null_safe_join(ranked.where(F.col("_rn") <= k).select(*df.columns), short, [stratum], "left_anti")
    full = null_safe_join(d, short, [stratum], "left_semi").withColumn("_rn", F.row_number().over(w))
    return out.unionByName(full.where(F.col("_rn") <= k).select(*df.columns))


def feature_bags(features: Sequence[str], share: float = 0.7, seeds: Sequence[int] = (0, 1, 2)) -> dict[int, list[str]]:
    """Seeded random column subsets (driver-side list of names)."""
    out = {}
    m = max(1, int(round(share * len(features))))
    for s in seeds:
        rng = np.random.default_rng(s)
        idx = sorted(rng.choice(len(features), size=m, replace=False))
        out[s] = [features[i] for i in idx]
    return out


def rank_borda(scores: DataFrame, item: str, score_cols: Sequence[str], top: int | None = None,
               higher_is_better: Mapping[str, bool] | None = None) -> DataFrame:
    """Borda count over several rankings of a small item table: rank per
    score (1 = best, ties share the lowest rank), sum, order by the sum."""
    hib = dict(higher_is_better or {})
    d = scores
    for s in score_cols:
        o = F.desc(s) if hib.get(s, True) else F.asc(s)
        d = d.withColumn(f"_r_{s}", F.rank().over(Window.orderBy(o)))
    tot = None
    for s in score_cols:
        tot = F.col(f"_r_{s}") if tot is None else tot + F.col(f"_r_{s}")
    d = d.withColumn("borda", tot.cast("long")).drop(*[f"_r_{s}" for s in score_cols])
    d = d.withColumn("borda_rank", F.row_number().over(Window.orderBy("borda", item)))
    return d.where(F.col("borda_rank") <= top) if top else d


