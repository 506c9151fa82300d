"""Feature selection signals, all as aggregates over an UNPIVOTed feature
table (one scan for every feature), plus the small driver-side decisions
over the p-row score table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabstack.operators._util import bounded_broadcast, null_safe_join
from tabstack.operators.aggregates import unpivot


def binned_long(df: DataFrame, features: Sequence[str], label: str, bins: int = 10) -> DataFrame:
    """(feature, bin, label) with equal-width bins from one min/max aggregate."""
    long = unpivot(df, features, ids=[label], cast="double").where(F.col("value").isNotNull())
    mm = long.groupBy("column").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    long = long.join(bounded_broadcast(mm), "column")
    w = (F.col("_hi") - F.col("_lo")) / bins
    b = F.when(w > 0, F.least(F.floor((F.col("value") - F.col("_lo")) / w), F.lit(bins - 1))).otherwise(0)
    return long.select(F.col("column").alias("feature"), b.cast("int").alias("bin"), F.col(label).alias("y"))


def mutual_information(df: DataFrame, features: Sequence[str], label: str, bins: int = 10) -> DataFrame:
    """Plug-in MI (nats) of each binned feature with a discrete label:
    sum p(x,y) ln(p(x,y) / (p(x) p(y))) from ONE grouped count."""
    c = binned_long(df, features, label, bins).groupBy("feature", "bin", "y").agg(F.count(F.lit(1)).alias("nxy"))
    c = c.withColumns({
        "nx": F.sum("nxy").over(Window.partitionBy("feature", "bin")),
        "ny": F.sum("nxy").over(Window.partitionBy("feature", "y")),
        "n": F.sum("nxy").over(Window.partitionBy("feature"))})
    term = (F.col("nxy") / F.col("n")) * F.ln(F.col("nxy") * F.col("n") / (F.col("nx") * F.col("ny")))
    return c.groupBy("feature").agg(F.sum(term).alias("mi"))


def chi2_table(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pearson chi-square of the (a, b) contingency table.

    Uses sum (O - E)^2 / E = N * sum_{O > 0} O^2 / (n_a n_b) - N, so only the
    non-empty cells are needed (no level grid is ever built)."""
    c = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("o"))
    c = null_safe_join(c, c.groupBy(a).agg(F.sum("o").alias("na")), [a])
    c = null_safe_join(c, c.groupBy(b).agg(F.sum("o").alias("nb")), [b])
    n = F.sum("o")
    return c.agg((n * F.sum(F.col("o") * F.col("o") / (F.col("na") * F.col("nb"))) - n).alias("chi2"),
                 ((F.count_distinct(a) - 1) * (F.count_distinct(b) - 1)).cast("long").alias("dof"))


def anova_f(df: DataFrame, features: Sequence[str], group: str) -> DataFrame:
    """One-way ANOVA F of every feature across ``group`` (between / within
    mean squares).  Values are shifted by the feature's mean and the sums of
    squares come from the streaming variance, so a large offset of a feature
    cancels nowhere."""
    long = unpivot(df, features, ids=[group], cast="double").where(F.col("value").isNotNull())
    means = long.groupBy("column").agg(F.avg("value").alias("shift"))  # a row per feature
    long = long.join(bounded_broadcast(means), "column").withColumn("value", F.col("value") - F.col("shift"))
    g = long.groupBy("column", group).agg(F.count(F.lit(1)).alias("ng"), F.avg("value").alias("mg"),
                                          F.var_pop("value").alias("vg"))
    w = Window.partitionBy("column")
    g = g.withColumns({"N": F.sum("ng").over(w), "k": F.count(F.lit(1)).over(w),
                       "m": F.sum(F.col("ng") * F.col("mg")).over(w) / F.sum("ng").over(w)})
    ssb = F.sum(F.col("ng") * (F.col("mg") - F.col("m")) ** 2)
    ssw = F.sum(F.col("ng") * F.col("vg"))
    r = g.groupBy("column").agg(ssb.alias("ssb"), ssw.alias("ssw"), F.first("N").alias("N"), F.first("k").alias("k"))
    return r.select(F.col("column").alias("feature"),
                    ((F.col("ssb") / (F.col("k") - 1)) / (F.col("ssw") / (F.col("N") - F.col("k")))).alias("f"))


def consensus(scores: DataFrame, item: str, signals: Sequence[str], threshold: float = 0.05) -> DataFrame:
    """Divide each signal by its max over items; keep the max of the
    normalised signals; flag items below ``threshold`` on every signal."""
    w = Window.partitionBy()  # over the small per-feature score table
    d = scores
    for s in signals:
        mx = F.max(s).over(w)
        d = d.withColumn(f"{s}_n", F.when(mx > 0, F.col(s) / mx).otherwise(F.col(s)))
    d = d.withColumn("max_signal", F.greatest(*[F.col(f"{s}_n") for s in signals]))
    return d.withColumn("dropped", (F.col("max_signal") < threshold).cast("int"))


def corr_prune_losers(corr: Sequence[tuple[str, str, float]], order: Sequence[str],
                      signal: Mapping[str, float], threshold: float = 0.95) -> list[str]:
    """For every pair (a before b in ``order``) with |corr| > threshold the
    weaker member loses (b on a tie); the result is the set of losers."""
    pos = {c: i for i, c in enumerate(order)}
    losers = []
    for a, b, r in corr:
        if r is None or abs(r) <= threshold:
            continue
        a, b = (a, b) if pos[a] < pos[b] else (b, a)
        loser = b if signal[a] >= signal[b] else a
        if loser not in losers:
            losers.append(loser)
    return losers


def stepwise_forward(gram: dict, names: Sequence[str], criterion: str = "aic", max_steps: int | None = None):
    """Forward selection by AIC/BIC of linear fits, all from one Gram matrix
    (G over [1, x...], X'y, y'y, n): each candidate costs a small solve."""
    G, xy, yy, n = gram
    chosen: list[int] = []
    path = []
    best_ic = None
    pen = 2.0 if criterion == "aic" else float(np.log(n))
    for _ in range(max_steps or len(names)):
        cand = []
        for j in range(len(names)):
            if j in chosen:
                continue
            idx = [0] + [c + 1 for c in chosen + [j]]
            A, b = G[np.ix_(idx, idx)], xy[idx]
            beta = np.linalg.lstsq(A, b, rcond=None)[0]
            rss = float(yy - 2 * beta @ b + beta @ A @ beta)
            ic = n * np.log(max(rss, 1e-300) / n) + pen * len(idx)
            cand.append((ic, j, rss))
        if not cand:
            break
        ic, j, rss = min(cand)
        if best_ic is not None and ic >= best_ic:
            break
        best_ic = ic
        chosen.append(j)
        path.append((len(chosen), names[j], rss, float(ic)))
    return path


def permuted(df: DataFrame, cols: Sequence[str], key: str, seed: int = 42, rows_per_bucket: int = 50_000, suffix: str = "_permuted") -> DataFrame:
    """``df`` with each of ``cols`` permuted in a column beside it, without a
    global sort and in one pass for all: rows are ordered by a seeded hash inside
    hash buckets and each takes the cells of the next row; a bucket's last row
    takes those of the first of the next bucket.  So from two rows on no row
    keeps its own cell, and a bucket has about ``rows_per_bucket`` rows whatever
    the size of the table."""
    buckets = max(1, -(-df.count() // rows_per_bucket))
    h = F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))
    d = df.withColumns({"_ph": h, "_pb": F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(buckets))})
    cells = F.struct(*[F.col(c) for c in cols])  # a struct: a NULL cell is a value, too
    firsts = d.groupBy("_pb").agg(F.min_by(cells, F.col("_ph")).alias("_first"))  # a row per bucket
    around = Window.orderBy("_pb")
    after = F.coalesce(F.lead("_first").over(around), F.first("_first").over(around))
    d = d.join(bounded_broadcast(firsts.select("_pb", after.alias("_after"))), "_pb")
    nxt = F.lead(cells).over(Window.partitionBy("_pb").orderBy("_ph"))
    d = d.withColumn("_next", F.coalesce(nxt, F.col("_after")))
    return d.select(*df.columns, *[F.col("_next")[c].alias(f"{c}{suffix}") for c in cols])


def permutation_shift(df: DataFrame, col: str, key: str, seed: int = 42, rows_per_bucket: int = 50_000) -> DataFrame:
    """``df`` with one column permuted (see :func:`permuted`)."""
    d = permuted(df, [col], key, seed, rows_per_bucket, "_permuted")
    return d.withColumn(col, F.col(f"{col}_permuted")).select(*df.columns)
