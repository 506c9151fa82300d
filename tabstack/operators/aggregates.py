"""Aggregations and summaries (EDA, fitted statistics).

Rule: one ``agg`` job over all columns, never one job per column.  Per-column
results that are naturally long (value counts, null rates) are produced by an
UNPIVOT followed by one grouped aggregate; partial (map-side) aggregation
absorbs hot values before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabstack.operators._util import BROADCAST_MAX_BYTES, null_safe_join, one_row, table_bytes
from tabstack.session import written


def unpivot(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = (), cast: str | None = None,
            name: str = "column", value: str = "value") -> DataFrame:
    """Wide -> long (column name, value); values cast to one type."""
    d = df.select(*ids, *[(F.col(c).cast(cast) if cast else F.col(c)).alias(c) for c in cols])
    return d.unpivot(list(ids), list(cols), name, value)


def group_stats(df: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    y = F.col(target).cast("double")
    return df.groupBy(*keys).agg(F.sum(y).alias("sum"), F.count(y).alias("count"),
                                 F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"))


def medians(df: DataFrame, cols: Sequence[str], exact: bool = True,
            accuracy: int = 100000) -> dict[str, float]:
    """Median of every column in ONE aggregate (linear interpolation when
    exact; ``percentile_approx`` keeps memory bounded at very large scale)."""
    return quantiles(df, cols, 0.5, exact=exact, accuracy=accuracy)


QUANTILE_BINS = 2048


def quantiles(df: DataFrame, cols: Sequence[str], q: float, exact: bool = True,
              accuracy: int = 100000) -> dict[str, float]:
    """Quantile of every column: linear interpolation of the exact order
    statistics, or (``exact=False``) ``percentile_approx``."""
    if not exact:
        r = one_row(df.agg(*[F.percentile_approx(F.col(c).cast("double"), q, accuracy).alias(c) for c in cols]))
        return {c: (float(r[c]) if r[c] is not None else None) for c in cols}
    return {c: v[0] for c, v in exact_quantiles(df, {c: [q] for c in cols}).items()}


def exact_quantiles(df: DataFrame, want: Mapping[str, Sequence[float]],
                    bins: int = QUANTILE_BINS) -> dict[str, list[float | None]]:
    """Exact linear-interpolation quantiles of several columns at once.

    A quantile needs the order statistics of two ranks.  Each open rank has a
    bracket of values; one aggregate per round counts the rows of every bracket
    in ``bins`` equal slices with each slice's smallest and largest value, and
    the slice that holds the rank is the next bracket.  A bracket of one value
    is the answer, so ties, zeros and constants need no special case.  The
    driver sees at most brackets x bins rows; a round narrows by ``bins``.
    NULL and NaN are left out.
    """
    x = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in want}
    inf = float("inf")
    aggs = []
    for k, c in enumerate(want):
        finite = F.when(F.abs(x[c]) < inf, x[c])
        aggs += [F.count(x[c]).alias(f"n{k}"), F.count_if(x[c] == -inf).alias(f"low{k}"),
                 F.count_if(x[c] == inf).alias(f"high{k}"), F.min(finite).alias(f"min{k}"), F.max(finite).alias(f"max{k}")]
    r = one_row(df.agg(*aggs))
    found: dict[tuple[str, int], float] = {}
    open_ranks: dict[tuple[str, int], tuple[float, float, int]] = {}  # -> (low, high, rows below low)
    for k, (c, qs) in enumerate(want.items()):
        n, low, high = r[f"n{k}"], r[f"low{k}"], r[f"high{k}"]
        for q in qs if n else ():
            k0 = int((n - 1) * q)
            for rank in {k0, min(k0 + 1, n - 1)}:
                if rank < low or rank >= n - high:
                    found[c, rank] = -inf if rank < low else inf
                elif r[f"min{k}"] == r[f"max{k}"]:
                    found[c, rank] = r[f"min{k}"]
                else:
                    open_ranks[c, rank] = (r[f"min{k}"], r[f"max{k}"], low)
    while open_ranks:
        brackets = sorted({(c, *b) for (c, _), b in open_ranks.items()})
        cells = []
        for k, (c, lo, hi, _) in enumerate(brackets):
            width = hi / 2 - lo / 2  # halves: hi - lo may overflow
            cell = F.least(F.floor((x[c] / 2 - F.lit(lo / 2)) / F.lit(width) * bins), F.lit(bins - 1)).cast("int")
            cells.append(F.when((x[c] >= lo) & (x[c] <= hi), F.struct(F.lit(k).alias("k"), cell.alias("cell"), x[c].alias("x"))))
        slices = (df.select(F.explode(F.array(*cells)).alias("e")).where(F.col("e").isNotNull())
                  .groupBy("e.k", "e.cell").agg(F.count(F.lit(1)).alias("n"), F.min("e.x").alias("lo"), F.max("e.x").alias("hi"))
                  .orderBy("k", "cell").collect())
        for (c, rank), b in list(open_ranks.items()):
            below = b[2]
            for s in slices:
                if s["k"] != brackets.index((c, *b)):
                    continue
                if rank < below + s["n"]:
                    if s["lo"] == s["hi"]:
                        found[c, rank] = s["lo"]
                        del open_ranks[c, rank]
                    else:
                        open_ranks[c, rank] = (s["lo"], s["hi"], below)
                    break
                below += s["n"]
    out: dict[str, list[float | None]] = {}
    for k, (c, qs) in enumerate(want.items()):
        out[c] = []
        for q in qs:
            n = r[f"n{k}"]
            if not n:
                out[c].append(None)
                continue
            h = (n - 1) * q
            a, b = found[c, int(h)], found[c, min(int(h) + 1, n - 1)]
            out[c].append(float(a if a == b else a + (b - a) * (h - int(h))))
    return out


def modes(df: DataFrame, cols: Sequence[str], cast: str | None = None) -> DataFrame:
    """Most frequent non-null value per column; ties -> smallest value
    (pandas ``mode()[0]``).  Returns a long table (column, value, count)."""
    long = unpivot(df, cols, cast=cast).where(F.col("value").isNotNull())
    cnt = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by(F.struct("value", "n"), F.struct((-F.col("n")).alias("k"), F.col("value")))
    return cnt.groupBy("column").agg(best.alias("b")).select(
        "column", F.col("b.value").alias("value"), F.col("b.n").alias("count"))


def nunique(df: DataFrame, cols: Sequence[str], approx: bool = False) -> dict[str, int]:
    fn = F.approx_count_distinct if approx else F.count_distinct
    r = one_row(df.agg(*[fn(c).alias(c) for c in cols]))
    return {c: int(r[c]) for c in cols}


def null_rates(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, n_null, null_rate) from one aggregate, unpivoted."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot(["_n"], cols, "column", "n_null")
    return long.select("column", F.col("n_null").cast("long").alias("n_null"),
                       (F.col("n_null") / F.col("_n")).alias("null_rate"))


def stds(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    r = one_row(df.agg(*[F.stddev_samp(F.col(c).cast("double")).alias(c) for c in cols]))
    return {c: (float(r[c]) if r[c] is not None else 0.0) for c in cols}


def variance_filter(df: DataFrame, cols: Sequence[str], min_std: float = 1e-6) -> list[str]:
    """Columns whose sample std exceeds ``min_std`` (one aggregate)."""
    s = stds(df, cols)
    return [c for c in cols if s[c] > min_std]


def corr_pairs(df: DataFrame, cols: Sequence[str], target: str | None = None) -> DataFrame:
    """Pearson correlation of every pair (or of every column with ``target``)
    in one aggregate, as a long table (a, b, corr).  For p in the hundreds use
    ``pyspark.ml.stat.Correlation`` on an assembled vector instead."""
    if target:
        pairs = [(c, target) for c in cols]
    else:
        pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}\u0001{b}")
                    for a, b in pairs])
    long = wide.unpivot([], list(wide.columns), "pair", "corr")
    parts = F.split(F.col("pair"), "\u0001")
    return long.select(parts[0].alias("a"), parts[1].alias("b"), "corr")


def gram_sums(df: DataFrame, preds: Sequence[str], target: str,
              by: Sequence[str] = ()) -> DataFrame:
    """n, sum y, sum y^2, sum p_i, sum p_i p_j (i <= j), sum p_i y: everything
    a linear blend needs, in M(M+3)/2 + 3 sums of ONE aggregate."""
    y = F.col(target).cast("double")
    ps = [F.col(p).cast("double") for p in preds]
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(y).alias("sy"), F.sum(y * y).alias("syy")]
    for i, p in enumerate(ps):
        aggs.append(F.sum(p).alias(f"s{i}"))
        aggs.append(F.sum(p * y).alias(f"s{i}y"))
        for j in range(i, len(ps)):
            aggs.append(F.sum(p * ps[j]).alias(f"s{i}_{j}"))
    return df.groupBy(*by).agg(*aggs)


def eta_squared(df: DataFrame, group: str, target: str) -> DataFrame:
    """Share of the target variance explained by the group means:
    sum_g n_g (mean_g - mean)^2 / SST (two-level aggregate)."""
    y = F.col(target).cast("double")
    g = df.groupBy(group).agg(F.count(y).alias("_n"), F.avg(y).alias("_m"))
    gm = one_row(df.agg(F.avg(y).alias("m")))["m"]
    sst = one_row(df.agg(F.sum((y - F.lit(gm)) ** 2).alias("s")))["s"]
    return g.agg((F.sum(F.col("_n") * (F.col("_m") - F.lit(gm)) ** 2) / F.lit(sst)).alias("eta_squared"),
                 F.count(F.lit(1)).alias("n_groups"))


def crosstab_norm(df: DataFrame, a: str, b: str) -> DataFrame:
    """Row-normalised cross tabulation (a, b, count, share within a)."""
    c = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("count"))
    return c.withColumn("share", F.col("count") / F.sum("count").over(Window.partitionBy(a)))


def value_counts_top(df: DataFrame, cols: Sequence[str], k: int = 3) -> DataFrame:
    """Top-k values per column by count (ties -> smaller value first)."""
    long = unpivot(df, cols, cast="string")
    cnt = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy("column").orderBy(F.desc("count"), F.asc_nulls_last("value"))
    return cnt.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def grouped_quantiles(df: DataFrame, col: str, by: Sequence[str], qs: Sequence[float],
                      bins: int = QUANTILE_BINS) -> DataFrame:
    """Exact linear-interpolation quantiles per group (at least one column in ``by``): ``by`` and ``q0, q1, ...``.

    The brackets of :func:`exact_quantiles` as a table, one row per group and
    rank, so groups may be many or hold most rows: each round joins the rows to
    the open brackets of their group and counts slices before the shuffle; a
    group sends at most brackets x ``bins`` rows.  Null and NaN values are left
    out (a group of these alone gives no row); a null group is a group.
    """
    g = [f"_g{i}" for i in range(len(by))]
    y = F.nanvl(F.col(col).cast("double"), F.lit(None).cast("double"))
    d = df.select(*[F.col(c).alias(n) for c, n in zip(by, g)], y.alias("_y")).where(F.col("_y").isNotNull())
    inf = F.lit(float("inf"))
    finite = F.when(F.abs("_y") < inf, F.col("_y"))
    stats = d.groupBy(*g).agg(F.count("_y").alias("_n"), F.count_if(F.col("_y") == -inf).alias("_low"), F.count_if(F.col("_y") == inf).alias("_high"),
                              F.min(finite).alias("_min"), F.max(finite).alias("_max")).where("_n > 0")
    stats = written(stats, "group-stats")
    at = [F.floor((F.col("_n") - 1) * F.lit(float(q))) for q in qs]
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(k, F.least(k + 1, F.col("_n") - 1)) for k in at])))
    below, above = F.col("_rank") < F.col("_low"), F.col("_rank") >= F.col("_n") - F.col("_high")

    def bound(c: str) -> Column:
        return F.when(below, -inf).when(above, inf).otherwise(F.col(c))

    state = written(stats.withColumn("_rank", F.explode(ranks)).select(
        *g, "_rank", bound("_min").alias("_lo"), bound("_max").alias("_hi"), F.col("_low").alias("_below")), "ranks")
    while not (todo := state.where("_lo < _hi")).isEmpty():
        brackets = todo.select(*g, "_lo", "_hi", "_below").distinct()
        brackets = F.broadcast(brackets) if table_bytes(todo) <= BROADCAST_MAX_BYTES else brackets
        width = F.col("_hi") / 2 - F.col("_lo") / 2   # halves: the difference may overflow
        cell = F.when(width > 0, F.least(F.floor((F.col("_y") / 2 - F.col("_lo") / 2) / width * bins), F.lit(bins - 1))) \
            .when(F.col("_y") < F.col("_hi"), 0).otherwise(bins - 1)
        met = null_safe_join(d, brackets, g, "inner")
        key = [*g, "_lo", "_hi", "_below"]
        slices = (met.where(F.col("_y").between(F.col("_lo"), F.col("_hi"))).groupBy(*key, cell.cast("int").alias("_cell"))
                  .agg(F.count(F.lit(1)).alias("_n"), F.min("_y").alias("_from"), F.max("_y").alias("_to")))
        upto = F.col("_below") + F.sum("_n").over(Window.partitionBy(*key).orderBy("_cell"))
        slices = slices.withColumn("_end", upto).withColumn("_start", F.col("_end") - F.col("_n"))
        hit = null_safe_join(todo, slices, key, "inner").where((F.col("_start") <= F.col("_rank")) & (F.col("_rank") < F.col("_end")))
        state = written(state.where("_lo >= _hi").unionByName(
            hit.select(*g, "_rank", F.col("_from").alias("_lo"), F.col("_to").alias("_hi"), F.col("_start").alias("_below"))), "ranks")
    # at most two ranks per quantile and group
    found = state.groupBy(*g).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_lo"))).alias("_v"))
    rows = null_safe_join(stats, found, g, "inner")
    out = []
    for i, (q, k) in enumerate(zip(qs, at)):
        a, b = F.col("_v")[k], F.col("_v")[F.least(k + 1, F.col("_n") - 1)]
        part = (F.col("_n") - 1) * F.lit(float(q)) - k
        out.append(F.when((a == b) | (part == 0), a).otherwise(a + (b - a) * part).alias(f"q{i}"))
    return rows.select(*[F.col(n).alias(c) for c, n in zip(by, g)], *out)


def describe(df: DataFrame, target: str, by: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """count, mean, std, min, quartiles, max (box-plot five numbers).

    Exact quartiles come from :func:`grouped_quantiles`; ``exact=False`` takes
    ``percentile_approx`` (rank error 1e-5) and says so in the column
    ``approximate``."""
    y = F.col(target).cast("double")
    aggs = [F.count(y).alias("count"), F.avg(y).alias("mean"), F.stddev_samp(y).alias("std"), F.min(y).alias("min"), F.max(y).alias("max")]
    names = [*by, "count", "mean", "std", "min"]
    if not exact:
        q = F.percentile_approx(y, [0.25, 0.5, 0.75], 100000).alias("_q")
        return df.groupBy(*by).agg(*aggs, q).select(*names, *[F.col("_q")[i].alias(n) for i, n in enumerate(("q25", "q50", "q75"))],
                                                    "max", F.lit(True).alias("approximate"))
    base, qs = df.groupBy(*by).agg(*aggs), [0.25, 0.5, 0.75]
    if by:
        joined = null_safe_join(base, grouped_quantiles(df, target, by, qs), list(by))
    else:
        whole = exact_quantiles(df, {target: qs})[target]
        joined = base.withColumns({f"q{i}": F.lit(v).cast("double") for i, v in enumerate(whole)})
    return joined.select(*names, F.col("q0").alias("q25"), F.col("q1").alias("q50"), F.col("q2").alias("q75"), "max")


def histogram(df: DataFrame, col: str | Column, bins: int = 60, name: str = "x") -> DataFrame:
    """Equal-width histogram (matplotlib rule: the max lands in the last bin).
    min/max are one aggregate; the bin index is a projection."""
    x = (F.col(col) if isinstance(col, str) else col).cast("double")
    d = df.select(x.alias(name)).where(F.col(name).isNotNull())
    r = one_row(d.agg(F.min(name).alias("lo"), F.max(name).alias("hi")))
    lo, hi = float(r["lo"]), float(r["hi"])
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((F.col(name) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return d.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count")).select(
        "bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("left"), "count")
