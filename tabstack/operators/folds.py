"""Fold assignment and cross-validation summaries.

Folds are a column, never index lists.  They are derived from
``md5('<seed>|<key>')`` so they are reproducible under task retries and
identical in DuckDB (the oracle).

Exact stratified balance needs a rank per stratum.  A window over a whole
stratum would send a third of the data (one hot class) through one task, so
rows are first split into hash-prefix buckets inside each stratum: a tiny
``(stratum, bucket) -> count`` table gives every bucket its offset, and rows
are ranked only inside their bucket.  The ranks equal a global ``row_number``
ordered by the hash, because the bucket is a prefix of the hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabstack.operators._util import bounded_broadcast, null_safe_join


def fold_hash_key(key: str, seed: int = 42) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))


def assign_folds_stratified(df: DataFrame, key: str, k: int = 5, stratify: str | None = None,
                            seed: int = 42, only_where: Column | None = None,
                            fold_col: str = "fold", prefix_len: int = 3) -> DataFrame:
    """Shuffled, exactly balanced (stratified) K folds.

    Inside each stratum rows are ordered by md5(seed|key); the i-th row
    (0-based) gets fold ``i % k``.  Rows failing ``only_where`` get NULL.
    ``prefix_len`` hex digits of the hash form 16**prefix_len buckets per
    stratum; raise it with the data size so a bucket fits one task.
    """
    strat = [stratify] if stratify else []
    elig = only_where if only_where is not None else F.lit(True)
    d = df.withColumns({"_fh": fold_hash_key(key, seed), "_fe": elig})
    d = d.withColumn("_fb", F.substring("_fh", 1, prefix_len))
    sel = d.filter(F.col("_fe"))
    counts = sel.groupBy(*strat, "_fb").agg(F.count(F.lit(1)).alias("_n"))
    w_off = (Window.partitionBy(*strat) if strat else Window.partitionBy(F.lit(0))) \
        .orderBy("_fb").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*strat, "_fb",
                            F.coalesce(F.sum("_n").over(w_off), F.lit(0)).alias("_off"))
    # the offsets table has at most n_strata * 16**prefix_len rows: it is
    # persisted (the full-data count runs once) and broadcast after its size
    # is checked; a NULL stratum is a stratum of its own
    offsets = bounded_broadcast(offsets)
    w_rank = Window.partitionBy(*strat, "_fb").orderBy("_fh", key)
    ranked = sel.withColumn("_rn", F.row_number().over(w_rank))
    ranked = null_safe_join(ranked, offsets, [*strat, "_fb"])
    ranked = ranked.withColumn(fold_col, ((F.col("_off") + F.col("_rn") - 1) % k).cast("int"))
    out_cols = [c for c in df.columns if c != fold_col] + [fold_col]
    rest = d.filter(~F.col("_fe")).withColumn(fold_col, F.lit(None).cast("int"))
    return ranked.select(*out_cols).unionByName(rest.select(*out_cols))


def assign_folds_hash(df: DataFrame, key: str, k: int = 5, seed: int = 42,
                      fold_col: str = "fold") -> DataFrame:
    """Plain (unstratified) K-fold: first 8 hex digits of the hash mod k.
    A narrow projection: no shuffle at all."""
    h = F.conv(F.substring(fold_hash_key(key, seed), 1, 8), 16, 10).cast("long")
    return df.withColumn(fold_col, (h % k).cast("int"))


def assign_folds_mixed(df: DataFrame, key: str, k: int, label: str, is_pseudo: str,
                       seed: int = 42, fold_col: str = "fold") -> DataFrame:
    """Folds over real + pseudo-labelled rows, stratified by (pseudo?, label),
    so every fold gets its share of both kinds.  Metrics then filter to real
    rows."""
    d = df.withColumn("_strat", F.concat_ws("|", F.col(is_pseudo).cast("string"),
                                            F.col(label).cast("string")))
    out = assign_folds_stratified(d, key=key, k=k, stratify="_strat", seed=seed,
                                  fold_col=fold_col)
    return out.drop("_strat")


def cv_summary(per_fold: DataFrame, metric_cols: list[str], by: list[str] | None = None) -> DataFrame:
    """Mean and population std of per-fold metrics (``np.std`` semantics)."""
    aggs = []
    for m in metric_cols:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    return per_fold.groupBy(*(by or [])).agg(*aggs)
