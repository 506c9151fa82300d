"""Checkable queries for section 2.4 (aggregations and summaries)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabstack.operators import aggregates as A
from tabstack.plans import fixtures as FX
from tabstack.plans.flagship import acct_features
from tabstack.plans.registry import q6, query, sq6
from tabstack.sources.tables import read_table

W = FX.with_sql


@query("agg_group_stats", W("acct", f"""
SELECT CAST(nation AS VARCHAR) AS grp, {sq6('sum(rate)')} AS sum, count(rate) AS count,
       {sq6('avg(rate)')} AS mean, {sq6('stddev_samp(rate)')} AS std FROM acct GROUP BY nation
UNION ALL
SELECT segment || '|' || CAST(tier AS VARCHAR), {sq6('sum(rate)')}, count(rate), {sq6('avg(rate)')},
       {sq6('stddev_samp(rate)')} FROM acct GROUP BY segment, tier"""))
def q_group_stats(spark, sf):
    a = FX.acct(spark, sf)
    g1 = A.group_stats(a, ["nation"], "rate").select(F.col("nation").cast("string").alias("grp"), "sum", "count", "mean", "std")
    g2 = A.group_stats(a, ["segment", "tier"], "rate").select(
        F.concat_ws("|", "segment", F.col("tier").cast("string")).alias("grp"), "sum", "count", "mean", "std")
    u = g1.unionByName(g2)
    return u.select("grp", q6("sum").alias("sum"), "count", q6("mean").alias("mean"), q6("std").alias("std"))


def _one_row(spark, values: dict):
    """Fitted values as a one-row frame."""
    d = spark.createDataFrame([tuple(values.values())], ", ".join(f"{c} double" for c in values))
    return d.select(*[q6(c).alias(c) for c in values])


MEDIAN_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("agg_median", "SELECT " + ", ".join(
    f"{sq6(f'quantile_cont({c}, 0.5)')} AS {c}" for c in MEDIAN_COLS) + " FROM lineitem")
def q_median(spark, sf):
    return _one_row(spark, A.medians(read_table(spark, sf, "lineitem"), MEDIAN_COLS))


@query("agg_quantile", "SELECT " + ", ".join(
    f"{sq6(f'quantile_cont({c}, 0.995)')} AS {c}" for c in MEDIAN_COLS) + " FROM lineitem")
def q_quantile(spark, sf):
    return _one_row(spark, A.quantiles(read_table(spark, sf, "lineitem"), MEDIAN_COLS, 0.995))


def _mode_sql(col):
    return (f"(SELECT '{col}' AS column, CAST({col} AS VARCHAR) AS value, count(*) AS count FROM acct "
            f"WHERE {col} IS NOT NULL GROUP BY {col} ORDER BY count(*) DESC, {col} ASC LIMIT 1)")


MODE_NUM = ["nation", "n_orders", "late30", "late90"]


@query("agg_mode", W("acct", "\nUNION ALL ".join(
    [_mode_sql(c) for c in MODE_NUM] + [_mode_sql("segment")])))
def q_mode(spark, sf):
    a = FX.acct(spark, sf)
    num = A.modes(a, MODE_NUM, cast="long").select("column", F.col("value").cast("string").alias("value"), "count")
    txt = A.modes(a, ["segment"], cast="string")
    return num.unionByName(txt)


NUNIQUE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity"]


@query("agg_nunique", "SELECT " + ", ".join(
    f"count(DISTINCT {c}) AS {c}" for c in NUNIQUE_COLS) + " FROM lineitem")
def q_nunique(spark, sf):
    n = A.nunique(read_table(spark, sf, "lineitem"), NUNIQUE_COLS)
    return spark.createDataFrame([tuple(n[c] for c in NUNIQUE_COLS)], ", ".join(f"{c} long" for c in NUNIQUE_COLS))


ACCT_COLS = ["row_id", "segment", "nation", "balance", "n_orders", "total_value", "late30", "late60",
             "late90", "mortgage_balance", "property_value", "tier", "rate", "split"]


@query("agg_null_rate", W("acct", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count(*) - count({c}) AS BIGINT) AS n_null, "
    f"CAST(count(*) - count({c}) AS DOUBLE) / count(*) AS null_rate FROM acct" for c in ACCT_COLS)))
def q_null_rate(spark, sf):
    return A.null_rates(FX.acct(spark, sf), ACCT_COLS)


VAR_COLS = ["delinquency", "any_delinquency", "severe_delinquency", "log_total_value",
            "mortgage_ltv", "value_per_order", "late90", "n_orders"]


@query("agg_variance_filter", W("acct", "\nUNION ALL ".join(
    f"SELECT '{c}' AS column, {sq6(f'stddev_samp({c})')} AS std, "
    f"CAST(coalesce(stddev_samp({c}), 0) > 1e-6 AS INTEGER) AS keep FROM feats" for c in VAR_COLS),
    extra=["""feats AS (SELECT *, 1.0 * late30 + 3.0 * late60 + 9.0 * late90 AS delinquency,
      CAST(late30 + late60 + late90 > 0 AS INTEGER) AS any_delinquency,
      CAST(late90 > 0 AS INTEGER) AS severe_delinquency,
      ln(1 + greatest(coalesce(total_value, 0), 0)) AS log_total_value,
      CASE WHEN property_value IS NULL OR property_value = 0 OR mortgage_balance IS NULL THEN 0.0
           ELSE mortgage_balance / property_value END AS mortgage_ltv,
      CASE WHEN n_orders = 0 OR total_value IS NULL THEN 0.0 ELSE total_value / n_orders END AS value_per_order
    FROM acct)"""]))
def q_variance_filter(spark, sf):
    a = acct_features(FX.acct(spark, sf))
    std, kept = A.stds(a, VAR_COLS), set(A.variance_filter(a, VAR_COLS))
    rows = spark.createDataFrame([(c, std[c], int(c in kept)) for c in VAR_COLS], "column string, std double, keep int")
    return rows.select("column", q6("std").alias("std"), "keep")


CORR_COLS = ["balance", "n_orders", "total_value", "late30", "late60", "late90", "rate"]


@query("agg_corr_matrix", W("acct", "\nUNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {sq6(f'corr({a}, {b})')} AS corr FROM acct"
    for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:])))
def q_corr(spark, sf):
    c = A.corr_pairs(FX.acct(spark, sf), CORR_COLS)
    return c.select("a", "b", q6("corr").alias("corr"))


GRAM_PREDS = [f"m{m}_rate" for m in range(3)]


def _gram_sql():
    parts = ["count(*) AS n", f"{sq6('sum(rate)')} AS sy", f"{sq6('sum(rate * rate)')} AS syy"]
    for i, p in enumerate(GRAM_PREDS):
        parts.append(f"{sq6(f'sum({p})')} AS s{i}")
        parts.append(f"{sq6(f'sum({p} * rate)')} AS s{i}y")
        for j in range(i, len(GRAM_PREDS)):
            parts.append(f"{sq6(f'sum({p} * {GRAM_PREDS[j]})')} AS s{i}_{j}")
    return "SELECT CAST(fold AS INTEGER) AS fold, " + ", ".join(parts) + " FROM acct_pred WHERE fold IS NOT NULL GROUP BY fold"


@query("agg_gram", W("acct_pred", _gram_sql()))
def q_gram(spark, sf):
    p = FX.acct_pred(spark, sf).where(F.col("fold").isNotNull())
    g = A.gram_sums(p, GRAM_PREDS, "rate", by=["fold"])
    return g.select(*[F.col(c) if c in ("fold", "n") else q6(c).alias(c) for c in g.columns])


@query("agg_eta_squared", W("acct", f"""
SELECT 'tier' AS grp, {sq6('sum(n * (m - gm) * (m - gm)) / max(sst)')} AS eta_squared, count(*) AS n_groups
FROM (SELECT tier, count(rate) AS n, avg(rate) AS m FROM acct GROUP BY tier) g,
     (SELECT avg(rate) AS gm FROM acct) a,
     (SELECT sum((rate - (SELECT avg(rate) FROM acct)) * (rate - (SELECT avg(rate) FROM acct))) AS sst FROM acct) s
UNION ALL
SELECT 'nation', {sq6('sum(n * (m - gm) * (m - gm)) / max(sst)')}, count(*)
FROM (SELECT nation, count(rate) AS n, avg(rate) AS m FROM acct GROUP BY nation) g,
     (SELECT avg(rate) AS gm FROM acct) a,
     (SELECT sum((rate - (SELECT avg(rate) FROM acct)) * (rate - (SELECT avg(rate) FROM acct))) AS sst FROM acct) s"""))
def q_eta(spark, sf):
    a = FX.acct(spark, sf)
    e1 = A.eta_squared(a, "tier", "rate").select(F.lit("tier").alias("grp"), "*")
    e2 = A.eta_squared(a, "nation", "rate").select(F.lit("nation").alias("grp"), "*")
    return e1.unionByName(e2).select("grp", q6("eta_squared").alias("eta_squared"), "n_groups")


@query("agg_crosstab_norm", W("acct", f"""SELECT segment, tier, count(*) AS count,
  {sq6('count(*) / sum(count(*)) OVER (PARTITION BY segment)')} AS share
FROM acct GROUP BY segment, tier"""))
def q_crosstab(spark, sf):
    c = A.crosstab_norm(FX.acct(spark, sf), "segment", "tier")
    return c.select("segment", "tier", "count", q6("share").alias("share"))


VC_COLS = ["o_orderstatus", "o_orderpriority", "o_custkey"]


@query("agg_value_counts", "SELECT * FROM (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column, CAST({c} AS VARCHAR) AS value, count(*) AS count, "
    f"CAST(row_number() OVER (ORDER BY count(*) DESC, CAST({c} AS VARCHAR) ASC) AS INTEGER) AS rank "
    f"FROM orders GROUP BY {c}" for c in VC_COLS) + ") WHERE rank <= 3")
def q_value_counts(spark, sf):
    o = read_table(spark, sf, "orders")
    return A.value_counts_top(o, VC_COLS, 3).select("column", "value", "count", "rank")


@query("agg_describe", W("acct", f"""SELECT tier, count(rate) AS count, {sq6('avg(rate)')} AS mean,
  {sq6('stddev_samp(rate)')} AS std, min(rate) AS min, {sq6('quantile_cont(rate, 0.25)')} AS q25,
  {sq6('quantile_cont(rate, 0.5)')} AS q50, {sq6('quantile_cont(rate, 0.75)')} AS q75, max(rate) AS max
FROM acct GROUP BY tier"""))
def q_describe(spark, sf):
    d = A.describe(FX.acct(spark, sf), "rate", by=["tier"])
    return d.select("tier", "count", q6("mean").alias("mean"), q6("std").alias("std"), "min",
                    q6("q25").alias("q25"), q6("q50").alias("q50"), q6("q75").alias("q75"), "max")


def _hist_sql(expr, bins, name):
    return f"""SELECT '{name}' AS series, CAST(b AS INTEGER) AS bin, {sq6('lo + b * w')} AS left, count(*) AS count
FROM (SELECT least(floor((x - lo) / w), {bins - 1}) AS b, lo, w
      FROM (SELECT {expr} AS x FROM acct WHERE {expr} IS NOT NULL) d,
           (SELECT min({expr}) AS lo, (max({expr}) - min({expr})) / {bins} AS w FROM acct WHERE {expr} IS NOT NULL) s)
GROUP BY b, lo, w"""


@query("agg_histogram", W("acct", _hist_sql("balance", 60, "balance") + "\nUNION ALL\n"
                          + _hist_sql("ln(1 + greatest(coalesce(total_value, 0), 0))", 40, "log_total_value")))
def q_histogram(spark, sf):
    a = FX.acct(spark, sf)
    h1 = A.histogram(a, "balance", 60).select(F.lit("balance").alias("series"), "*")
    h2 = A.histogram(a, F.log1p(F.greatest(F.coalesce("total_value", F.lit(0.0)), F.lit(0.0))), 40) \
        .select(F.lit("log_total_value").alias("series"), "*")
    return h1.unionByName(h2).select("series", "bin", q6("left").alias("left"), "count")
