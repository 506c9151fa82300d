"""Categorical encoders and scalers: ``fit`` is a handful of aggregates that
give a small state (literals or a lookup table), ``transform`` is a projection
plus a size-checked broadcast join.

Target statistics are leakage-safe without K passes: ONE aggregation by
(key, fold) gives per-fold sums, the per-key total is a window over that small
table, and the out-of-fold statistic of fold f is ``total - part(f)``.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import chain

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabstack.functions.expr import bucketize
from tabstack.operators._util import bounded_broadcast, one_row

FULL = -1  # fold id of the full-train statistics (used by rows without a fold)


# ------------------------------------------------------------------ ordinal

def ordinal_encode(x, mapping: Mapping[str, int], unknown: int | None = 1) -> Column:
    """Fixed string -> rank map; values outside the map get ``unknown``."""
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    x = F.col(x) if isinstance(x, str) else x
    v = F.element_at(m, x)
    v = F.when(x.isNull(), F.lit(None)).otherwise(v)  # element_at(map, NULL) is NULL anyway
    return F.coalesce(v, F.lit(unknown)) if unknown is not None else v


def ordinal_coverage(df: DataFrame, col: str, mapping: Mapping[str, int]) -> float:
    """Share of non-null values that the map covers (one aggregate)."""
    r = one_row(df.agg(F.avg(F.col(col).isin(list(mapping)).cast("double")).alias("cov")))
    return float(r["cov"] or 0.0)


# ------------------------------------------------------------ levels / one-hot

def fit_levels(df: DataFrame, cols: Sequence[str], max_levels: int = 8) -> dict[str, list]:
    """Distinct non-null levels of each column with at most ``max_levels``
    levels (exact ``count_distinct`` first, so the collected sets are bounded)."""
    counts = one_row(df.agg(*[F.count_distinct(c).alias(c) for c in cols]))
    small = [c for c in cols if counts[c] <= max_levels]
    if not small:
        return {}
    sets = one_row(df.agg(*[F.collect_set(c).alias(c) for c in small]))
    return {c: sorted(sets[c]) for c in small}


def onehot_columns(levels: Mapping[str, Sequence], prefix_sep: str = "_") -> dict[str, Column]:
    """Dummy columns on the given levels; NULL -> all zeros."""
    out = {}
    for c, lv in levels.items():
        for v in lv:
            out[f"{c}{prefix_sep}{v}"] = (F.col(c) == F.lit(v)).cast("int")
            out[f"{c}{prefix_sep}{v}"] = F.coalesce(out[f"{c}{prefix_sep}{v}"], F.lit(0))
    return out


def onehot_encode(df: DataFrame, levels: Mapping[str, Sequence], drop: bool = True) -> DataFrame:
    out = df.withColumns(onehot_columns(levels))
    return out.drop(*levels.keys()) if drop else out


# -------------------------------------------------------------------- label

def fit_label_codes(df: DataFrame, col: str) -> DataFrame:
    """Sorted integer codes 0..n-1 over the distinct values of ``col``.

    Distinct values are range-partitioned and sorted across tasks, then
    numbered by per-partition counts + offsets, so no single task or the
    driver ever holds all levels.
    """
    from tabstack.session import cut_lineage
    from tabstack.sources.tables import with_row_id
    distinct = df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)
    # the range-partitioned, sorted levels are checkpointed so their
    # partitioning is fixed before positions are counted
    coded = with_row_id(cut_lineage(distinct), "_code")
    return coded.select(col, F.col("_code").alias(f"{col}_code"))


def label_encode(df: DataFrame, col: str, codes: DataFrame, out: str | None = None,
                 unknown: int = -1) -> DataFrame:
    out = out or f"{col}_code"
    j = df.join(bounded_broadcast(codes), on=col, how="left")
    return j.withColumn(out, F.coalesce(F.col(f"{col}_code"), F.lit(unknown)).cast("long")) \
        .drop(*([f"{col}_code"] if out != f"{col}_code" else []))


# ---------------------------------------------------------- target statistics

@dataclass
class TargetStats:
    """Fitted target statistics: one lookup table per key set.

    Each table has the key columns, ``_lf`` (fold id; -1 = full train) and
    the statistic columns.  ``priors`` holds the global values used for
    unseen keys.
    """
    key_sets: list[list[str]]
    names: list[str]
    tables: dict[str, DataFrame]
    priors: dict[str, float]
    stats: tuple[str, ...]
    m: float
    fold: str | None
    suffix: dict[str, str] = field(default_factory=dict)
    fold_priors: dict | None = None  # fold -> (mean prior, p prior) when prior="oof"


STAT_SUFFIX = {"mean": "te", "p": "te_p", "std": "te_std", "n": "te_n", "se": "te_se"}


def fit_target_stats(train: DataFrame, key_sets: Sequence[Sequence[str] | str], target: str,
                     fold: str | None = "fold", m: float = 20.0,
                     stats: Sequence[str] = ("mean",), binary: Column | str | None = None,
                     names: Sequence[str] | None = None,
                     suffix: Mapping[str, str] | None = None, prior: str = "all") -> TargetStats:
    """Smoothed target statistics per key set, leave-fold-out for rows with a
    fold and full-train for the rest.

    * mean: (S + m*mu) / (n + m), mu = mean of all train rows (as the
      reference: the prior includes the held-out fold)
    * p:    same on the 0/1 ``binary`` column (e.g. tier == 4)
    * std:  unsmoothed sample std of the target, global std when n < 2
    * n, se: count and std / sqrt(n + m) (noise scale for the v2 encoder)

    All key sets are aggregated in ONE scan with GROUPING SETS; partial
    aggregation absorbs hot keys before the shuffle.

    ``prior="oof"`` takes the smoothing prior of a fold's rows from the other
    folds only (per-fold means from one K-row aggregate), so no statistic of
    a row depends on its own label.
    """
    key_sets = [[k] if isinstance(k, str) else list(k) for k in key_sets]
    names = list(names) if names else ["__".join(k) for k in key_sets]
    y = F.col(target).cast("double")
    b = (F.col(binary) if isinstance(binary, str) else binary) if binary is not None else F.lit(0)
    # centring shift for the second-moment sums: the mean keeps them small and
    # does not depend on the order of rows (a one-column pass)
    shift = float(train.agg(F.avg(y)).first()[0] or 0.0)
    all_keys = sorted({k for ks in key_sets for k in ks})
    fcol = F.col(fold) if fold else F.lit(FULL)
    base = train.select(*all_keys, fcol.cast("int").alias("_f"),
                        y.alias("_y"), (y - F.lit(shift)).alias("_c"), b.cast("double").alias("_b"))
    # rows without a target carry no information: they are not counted
    sums = [F.count("_y").alias("_n"), F.sum("_y").alias("_s"), F.sum("_c").alias("_c1"),
            F.sum(F.col("_c") * F.col("_c")).alias("_c2"),
            F.sum(F.when(F.col("_y").isNotNull(), F.col("_b"))).alias("_sb")]
    if len(key_sets) == 1:
        agg = base.groupBy(*key_sets[0], "_f").agg(*sums, F.lit(0).alias("_gid"))
        gids = {0: key_sets[0]}
    else:
        agg = base.groupingSets([[*ks, "_f"] for ks in key_sets], *all_keys, "_f") \
            .agg(*sums, F.grouping_id().alias("_gid"))
        gids = {}
        for ks in key_sets:
            # grouping_id bit i is 1 when column i (in all_keys + _f order) is aggregated away
            bits = 0
            order = all_keys + ["_f"]
            for i, c in enumerate(order):
                if c not in ks and c != "_f":
                    bits |= 1 << (len(order) - 1 - i)
            gids[bits] = ks
    # the (key set, key, fold) sums are O(distinct keys x K) rows: keep them so
    # every key set is cut from the SAME scan instead of re-running it
    agg = agg.persist(StorageLevel.MEMORY_AND_DISK)
    # global and per-fold totals come from that small table (every row is in
    # each grouping set once): no second pass over the data
    gid0 = [k for k, v in gids.items() if v == key_sets[0]][0]
    per_fold = {r["_f"]: r for r in agg.where(F.col("_gid") == gid0).groupBy("_f").agg(
        *[F.sum(c).alias(c) for c in ("_n", "_s", "_c1", "_c2", "_sb")]).collect()}  # K rows
    N, S, C1, C2, SB = (float(sum(r[c] or 0 for r in per_fold.values())) for c in ("_n", "_s", "_c1", "_c2", "_sb"))
    mu, pmu = S / N, SB / N
    sd = math.sqrt(max((C2 - C1 * C1 / N) / (N - 1), 0.0)) if N > 1 else 0.0
    fold_mu = None
    if prior == "oof" and fold:
        fold_mu = {f: ((S - r["_s"]) / (N - r["_n"]), (SB - r["_sb"]) / (N - r["_n"]))
                   for f, r in per_fold.items()}
    elif prior != "all":
        raise ValueError(prior)
    tables = {}
    for name, ks in zip(names, key_sets):
        gid = [k for k, v in gids.items() if v == ks][0]
        part = agg.where(F.col("_gid") == gid).select(*ks, "_f", "_n", "_s", "_c1", "_c2", "_sb")
        w = Window.partitionBy(*ks)
        tot = part.select(*ks, "_f", *[F.col(c) for c in ("_n", "_s", "_c1", "_c2", "_sb")],
                          *[F.sum(c).over(w).alias(c + "_t") for c in ("_n", "_s", "_c1", "_c2", "_sb")])
        oof = tot.select(*ks, F.col("_f").alias("_lf"),
                         *[(F.col(c + "_t") - F.col(c)).alias(c) for c in ("_n", "_s", "_c1", "_c2", "_sb")])
        full = part.groupBy(*ks).agg(*[F.sum(c).alias(c) for c in ("_n", "_s", "_c1", "_c2", "_sb")]) \
            .select(*ks, F.lit(FULL).alias("_lf"), "_n", "_s", "_c1", "_c2", "_sb")
        lut = (oof.unionByName(full) if fold else full).where(F.col("_n") > 0)
        tables[name] = bounded_broadcast(_finish(lut, ks, stats, m, mu, sd, pmu, fold_mu))
    return TargetStats(key_sets, names, tables, {"mean": mu, "p": pmu, "std": sd, "n": 0.0, "se": 0.0},
                       tuple(stats), m, fold, dict(suffix or STAT_SUFFIX), fold_mu)


def _finish(lut: DataFrame, ks, stats, m, mu, sd, pmu, fold_mu=None) -> DataFrame:
    n, s, c1, c2, sb = (F.col(c) for c in ("_n", "_s", "_c1", "_c2", "_sb"))
    nd = n.cast("double")
    var = (c2 - c1 * c1 / nd) / (nd - 1)
    std = F.when(n >= 2, F.sqrt(F.greatest(var, F.lit(0.0)))).otherwise(F.lit(sd))
    mu_c, pmu_c = F.lit(mu), F.lit(pmu)
    if fold_mu:  # per-fold priors as literals (K entries)
        mu_e, p_e = F.when(F.col("_lf") == FULL, F.lit(mu)), F.when(F.col("_lf") == FULL, F.lit(pmu))
        for f, (a, b) in sorted(fold_mu.items()):
            mu_e, p_e = mu_e.when(F.col("_lf") == f, F.lit(a)), p_e.when(F.col("_lf") == f, F.lit(b))
        mu_c, pmu_c = mu_e, p_e
    cols = {"mean": (s + F.lit(m) * mu_c) / (nd + F.lit(m)),
            "p": (sb + F.lit(m) * pmu_c) / (nd + F.lit(m)),
            "std": std,
            "n": nd,
            "se": std / F.sqrt(nd + F.lit(m))}
    return lut.select(*ks, "_lf", *[cols[st].alias(f"_st_{st}") for st in stats])


def apply_target_stats(df: DataFrame, state: TargetStats, fold: str | None = None,
                       noise: Mapping[str, float] | None = None, noise_key: str | None = None,
                       seed: int = 42) -> DataFrame:
    """Attach ``{name}_{suffix}`` columns.  Rows with a fold get the
    leave-fold-out value, rows without one the full-train value, unseen keys
    the prior.  ``noise={'mean': scale}`` adds hash-seeded N(0,1)*se*scale to
    the full-train mean (v2 encoder; needs ``stats`` to include 'se')."""
    fold = fold if fold is not None else state.fold
    lf = F.coalesce(F.col(fold).cast("int"), F.lit(FULL)) if fold else F.lit(FULL)
    out = df.withColumn("_lf", lf)
    for name, ks in zip(state.names, state.key_sets):
        t = state.tables[name]
        out = out.join(t, on=[*ks, "_lf"], how="left")
        new = {}
        for st in state.stats:
            fallback = F.lit(state.priors[st])
            if state.fold_priors and st in ("mean", "p"):
                i = 0 if st == "mean" else 1
                fb = F.when(F.col("_lf") == FULL, fallback)
                for f, pr in sorted(state.fold_priors.items()):
                    fb = fb.when(F.col("_lf") == f, F.lit(pr[i]))
                fallback = fb.otherwise(fallback)
            v = F.coalesce(F.col(f"_st_{st}"), fallback)
            if noise and st in noise:
                z = gauss_hash(F.col(noise_key), name, seed)
                se = F.coalesce(F.col("_st_se"), F.lit(0.0))
                v = F.when(F.col("_lf") == FULL, v + z * se * F.lit(float(noise[st]))).otherwise(v)
            new[f"{name}_{state.suffix[st]}"] = v
        out = out.withColumns(new).drop(*[f"_st_{st}" for st in state.stats])
    return out.drop("_lf")


def gauss_hash(key: Column, salt: str, seed: int = 42) -> Column:
    """Deterministic N(0,1) from md5(seed|salt|key) by Box-Muller; identical
    under task retries (unlike ``randn``)."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(salt), key.cast("string")))
    u1 = (F.conv(F.substring(h, 1, 8), 16, 10).cast("double") + 1.0) / F.lit(4294967297.0)
    u2 = F.conv(F.substring(h, 9, 8), 16, 10).cast("double") / F.lit(4294967296.0)
    return F.sqrt(F.lit(-2.0) * F.ln(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def loo_encode(df: DataFrame, key: str, target: str, is_train: Column, m: float = 0.0,
               out: str | None = None) -> DataFrame:
    """Leave-one-out mean: train rows (S - y + m*mu)/(n - 1 + m), others the
    full smoothed mean; n = 1 (or unseen) falls back to mu."""
    out = out or f"{key}_loo"
    tr = df.where(is_train)
    mu = float(one_row(tr.agg(F.avg(F.col(target).cast("double")).alias("mu")))["mu"])
    tot = tr.groupBy(key).agg(F.sum(F.col(target).cast("double")).alias("_ls"),
                              F.count(F.lit(1)).alias("_ln"))
    j = df.join(bounded_broadcast(tot), on=key, how="left")
    y = F.col(target).cast("double")
    s = F.when(is_train, F.col("_ls") - y).otherwise(F.col("_ls"))
    n = F.when(is_train, F.col("_ln") - 1).otherwise(F.col("_ln")).cast("double")
    val = (s + F.lit(m * mu)) / (n + F.lit(m))
    val = F.when(F.col("_ln").isNull() | (n + F.lit(m) <= 0), F.lit(mu)).otherwise(val)
    return j.withColumn(out, val).drop("_ls", "_ln")


# ------------------------------------------------------------------ k-bins

def fit_quantile_edges(df: DataFrame, cols: Sequence[str], n_bins: int = 5,
                       exact: bool = True, accuracy: int = 100000) -> dict[str, list[float]]:
    """Inner quantile edges per column, all columns in ONE aggregate."""
    from tabstack.operators.aggregates import exact_quantiles
    qs = [i / n_bins for i in range(1, n_bins)]
    if not exact:
        r = one_row(df.agg(*[F.percentile_approx(F.col(c).cast("double"), qs, accuracy).alias(c) for c in cols]))
        return {c: list(r[c]) for c in cols}
    return exact_quantiles(df, {c: qs for c in cols})  # all edges of all columns together


def kbins_columns(edges: Mapping[str, Sequence[float]], suffix: str = "_bin") -> dict[str, Column]:
    """Bin index: (-inf, e1], (e1, e2], ..., (e_last, inf)."""
    return {f"{c}{suffix}": bucketize(c, [-math.inf, *e, math.inf]) for c, e in edges.items()}


# ------------------------------------------------------------------ scalers

def fit_scaler(df: DataFrame, cols: Sequence[str], kind: str = "standard",
               exact: bool = True) -> dict[str, tuple[float, float]]:
    """(centre, scale) per column from ONE aggregate.

    standard: mean, population std (numpy/scikit-learn); minmax: min, max-min;
    robust: median, IQR (linear interpolation percentiles)."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        if kind == "standard":
            aggs += [F.avg(x).alias(f"{c}__a"), F.stddev_pop(x).alias(f"{c}__b")]
        elif kind == "minmax":
            aggs += [F.min(x).alias(f"{c}__a"), (F.max(x) - F.min(x)).alias(f"{c}__b")]
        elif kind != "robust":
            raise ValueError(kind)
    if kind == "robust":
        from tabstack.operators.aggregates import exact_quantiles, quantiles
        if exact:
            three = exact_quantiles(df, {c: (0.25, 0.5, 0.75) for c in cols})
        else:
            each = [quantiles(df, cols, q, exact=False) for q in (0.25, 0.5, 0.75)]
            three = {c: [e[c] for e in each] for c in cols}
        return {c: (float(m), float(b - a)) for c, (a, m, b) in three.items()}
    r = one_row(df.agg(*aggs))
    return {c: (float(r[f"{c}__a"]), float(r[f"{c}__b"] or 0.0)) for c in cols}


def scale_columns(state: Mapping[str, tuple[float, float]], suffix: str = "",
                  clip_at: float | None = None) -> dict[str, Column]:
    """(x - centre) / scale; a zero scale leaves x - centre (scikit-learn)."""
    out = {}
    for c, (a, b) in state.items():
        v = (F.col(c).cast("double") - F.lit(a)) / F.lit(b if b else 1.0)
        if clip_at is not None:
            v = F.least(F.greatest(v, F.lit(-clip_at)), F.lit(clip_at))
        out[f"{c}{suffix}"] = v
    return out


# ------------------------------------------------ ordered target statistics

def ordered_prefix_sums(df: DataFrame, keys: Sequence[str], order_hash: Column,
                        values: Mapping[str, Column], prefix_len: int = 2) -> DataFrame:
    """Sums of ``values`` over the rows BEFORE each row inside its key group,
    rows ordered by ``order_hash`` (a hex string).

    A window over a whole key group would put a hot key (a third of the
    rows) into one task; instead rows are split by a hash prefix, a small
    (key, prefix) table gives each prefix bucket its offset, and the running
    sum is only taken inside a bucket.
    """
    d = df.withColumns({"_oh": order_hash, **{f"_v_{k}": v for k, v in values.items()}})
    d = d.withColumn("_ob", F.substring("_oh", 1, prefix_len))
    bsum = d.groupBy(*keys, "_ob").agg(*[F.sum(f"_v_{k}").alias(f"_b_{k}") for k in values],
                                        F.count(F.lit(1)).alias("_b_n"))
    w_off = Window.partitionBy(*keys).orderBy("_ob").rowsBetween(Window.unboundedPreceding, -1)
    offs = bsum.select(*keys, "_ob", *[F.coalesce(F.sum(f"_b_{k}").over(w_off), F.lit(0)).alias(f"_o_{k}")
                                       for k in [*values, "n"]])
    d = d.join(bounded_broadcast(offs), on=[*keys, "_ob"], how="left")
    w_in = Window.partitionBy(*keys, "_ob").orderBy("_oh").rowsBetween(Window.unboundedPreceding, -1)
    out = {f"{k}_before": F.col(f"_o_{k}") + F.coalesce(F.sum(f"_v_{k}").over(w_in), F.lit(0))
           for k in values}
    out["n_before"] = F.col("_o_n") + F.coalesce(F.count(F.lit(1)).over(w_in), F.lit(0))
    d = d.withColumns(out)
    return d.drop("_oh", "_ob", *[f"_v_{k}" for k in values], *[f"_o_{k}" for k in [*values, "n"]])


def ordered_target_encode(df: DataFrame, key: str, target: str, row_key: str, is_train: Column,
                          a: float = 1.0, seed: int = 42, out: str | None = None) -> DataFrame:
    """Ordered target statistic (the re-aim of a booster's native categorical
    handling): train rows see only train rows of the same category that come
    earlier in a seeded hash permutation, (S_before + a*prior)/(n_before + a);
    other rows see all train rows of the category."""
    out = out or f"{key}_ots"
    y = F.col(target).cast("double")
    tr = df.where(is_train)
    prior = float(one_row(tr.agg(F.avg(y).alias("m")))["m"])
    h = F.md5(F.concat(F.lit(f"{seed}|"), F.col(row_key).cast("string")))
    ordered = ordered_prefix_sums(tr, [key], h, {"s": y})
    ordered = ordered.withColumn(out, (F.col("s_before") + F.lit(a * prior)) / (F.col("n_before") + F.lit(a)))
    tot = tr.groupBy(key).agg(F.sum(y).alias("_ts"), F.count(F.lit(1)).alias("_tn"))
    rest = df.where(~is_train).join(bounded_broadcast(tot), on=key, how="left").withColumn(
        out, (F.coalesce("_ts", F.lit(0.0)) + F.lit(a * prior)) / (F.coalesce("_tn", F.lit(0)) + F.lit(a)))
    cols = df.columns + [out]
    return ordered.select(*cols).unionByName(rest.select(*cols))


# ------------------------------------------------------- nominal attributes

def fit_levels(df: DataFrame, cols: Sequence[str], max_levels: int = 31) -> dict[str, list[str]]:
    """Per column its most frequent levels as text (ties by text), at most
    ``max_levels`` (the bound of what the driver and a tree's bins hold)."""
    from tabstack.operators.aggregates import unpivot
    long = unpivot(df, cols, cast="string").where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    # a column with very many levels: its own best of each hash part first
    part = F.pmod(F.xxhash64("value"), F.lit(64))
    for by in (["column", part], ["column"]):
        w = Window.partitionBy(*by).orderBy(F.desc("n"), "value")
        counts = counts.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= max_levels).drop("_r")
    out = {c: [] for c in cols}
    for r in counts.orderBy("column", F.desc("n"), "value").collect():
        out[r["column"]].append(r["value"])
    return out


def nominal(df: DataFrame, levels: Mapping[str, Sequence[str]], suffix: str = "") -> DataFrame:
    """Level codes that a tree splits as sets, not as numbers: each column
    carries a nominal attribute, which the assembled vector keeps.

    Codes follow ``levels``; the next one stands for every other level, the last
    for NULL.  A tree needs ``maxBins`` of at least the levels plus two."""
    out = {}
    for c, known in levels.items():
        other, null = len(known), len(known) + 1
        at = F.array_position(F.array(*[F.lit(v) for v in known]), F.col(c).cast("string")) if known else F.lit(0)
        code = F.when(F.col(c).isNull(), F.lit(null)).when(at > 0, at - 1).otherwise(F.lit(other)).cast("double")
        names = [*(f"={v}" for v in known), "other", "null"]
        out[c + suffix] = code.alias(c + suffix, metadata={"ml_attr": {"type": "nominal", "name": c + suffix, "vals": names}})
    return df.select(*[c for c in df.columns if c not in out], *out.values())
