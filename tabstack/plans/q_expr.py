"""Checkable queries for section 2.2 (projections and scalar expressions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabstack.functions import expr as E
from tabstack.plans import fixtures as FX
from tabstack.plans.flagship import acct_features
from tabstack.plans.registry import q6, query, sq6
from tabstack.sources.tables import read_table

W = FX.with_sql

# fixed values: bin edges of the utilisation and age buckets
UTIL_EDGES = [-0.01, 0.1, 0.3, 0.6, 0.9, float("inf")]
AGE_EDGES = [-1, 25, 35, 45, 55, 65, 200]
# fixed values: none-like tokens of the collateral flag
NONE_TOKENS = ["NONE", "NAN", "NA", ""]


def _bucket_sql(x: str, edges) -> str:
    def lit(e):
        return "'inf'::DOUBLE" if e == float("inf") else repr(float(e))
    parts = [f"WHEN {x} IS NULL OR {x} <= {lit(edges[0])} OR {x} > {lit(edges[-1])} THEN NULL"]
    parts += [f"WHEN {x} <= {lit(e)} THEN {i}" for i, e in enumerate(edges[1:])]
    return f"CAST(CASE {' '.join(parts)} END AS INTEGER)"


def _safe_div_sql(a: str, b: str) -> str:
    return (f"(CASE WHEN ({b}) IS NULL OR ({b}) = 0 OR ({a}) IS NULL THEN 0.0 "
            f"ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END)")


def _nz(x):
    return f"coalesce({x}, 0)"


# ----------------------------------------------------------------- safe_div

@query("safe_div", W([], f"""SELECT l_orderkey, l_linenumber,
  {sq6(_safe_div_sql('l_discount', 'l_tax'))} AS discount_per_tax,
  {sq6(_safe_div_sql('l_extendedprice', 'l_quantity'))} AS unit_price
FROM lineitem"""))
def q_safe_div(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     q6(E.safe_div("l_discount", "l_tax")).alias("discount_per_tax"),
                     q6(E.safe_div("l_extendedprice", "l_quantity")).alias("unit_price"))


# ------------------------------------------------- sums and weighted scores

@query("row_sum_nullzero", W("acct", f"""SELECT row_id,
  {sq6(f"{_nz('mortgage_balance')} + {_nz('property_value')} + {_nz('total_value')}")} AS stack_total,
  CAST({_nz('late30')} + {_nz('late60')} + {_nz('late90')} AS DOUBLE) AS late_total
FROM acct"""))
def q_row_sum(spark, sf):
    a = FX.acct(spark, sf)
    return a.select("row_id",
                    q6(E.row_sum_nullzero(["mortgage_balance", "property_value", "total_value"])).alias("stack_total"),
                    E.row_sum_nullzero(["late30", "late60", "late90"]).cast("double").alias("late_total"))


# fixed values: severity weights (late 1/3/9; derogatory-style 5/3/4/10)
SEVERITY = {"late30": 1, "late60": 3, "late90": 9}
DEROGATORY = {"late30": 5, "late60": 3, "late90": 4, "n_orders": 10}


def _wsum_sql(w):
    return " + ".join(f"{float(v)} * CAST({_nz(k)} AS DOUBLE)" for k, v in w.items())


@query("weighted_severity", W("acct", f"""SELECT row_id,
  {_wsum_sql(SEVERITY)} AS delinquency_score,
  {_wsum_sql(DEROGATORY)} AS derogatory_score,
  CAST((CASE WHEN {_nz('late30')} > 0 THEN 1 ELSE 0 END) + (CASE WHEN {_nz('late60')} > 0 THEN 1 ELSE 0 END)
     + (CASE WHEN {_nz('late90')} > 0 THEN 1 ELSE 0 END) + (CASE WHEN {_nz('n_orders')} > 0 THEN 1 ELSE 0 END) AS INTEGER) AS n_marks
FROM acct"""))
def q_weighted(spark, sf):
    a = FX.acct(spark, sf)
    return a.select("row_id", E.weighted_sum(SEVERITY).alias("delinquency_score"),
                    E.weighted_sum(DEROGATORY).alias("derogatory_score"),
                    E.count_positive(list(DEROGATORY)).alias("n_marks"))


@query("difference_features", W("acct", f"""SELECT row_id,
  {sq6("total_value - " + _nz('mortgage_balance'))} AS net_value,
  {sq6(_nz('property_value') + " - total_value")} AS post_value,
  CAST({_nz('n_orders')} - {_nz('late90')} AS BIGINT) AS non_urgent
FROM acct"""))
def q_difference(spark, sf):
    a = FX.acct(spark, sf)
    return a.select("row_id",
                    q6(F.col("total_value") - E.nz("mortgage_balance")).alias("net_value"),
                    # only the left side is null-filled, as in the reference
                    q6(E.nz("property_value") - F.col("total_value")).alias("post_value"),
                    (E.nz("n_orders") - E.nz("late90")).cast("long").alias("non_urgent"))


@query("ratio_plus_one", W("acct", f"""SELECT row_id,
  {sq6(_safe_div_sql('late30', 'n_orders + 1'))} AS ok_ratio,
  {sq6(f"CASE WHEN late90 IS NULL THEN NULL ELSE greatest(0.0, least(1.0, {_safe_div_sql(_nz('late90'), _nz('late60') + ' + 0.5')})) END")} AS share,
  {sq6(_safe_div_sql('total_value', 'n_orders / 12.0 + 1'))} AS per_year
FROM acct"""))
def q_ratio_plus(spark, sf):
    a = FX.acct(spark, sf)
    return a.select("row_id",
                    q6(E.ratio_plus("late30", "n_orders", 1.0)).alias("ok_ratio"),
                    q6(E.ratio_plus(E.nz("late90"), E.nz("late60"), 0.5, lo=0.0, hi=1.0)).alias("share"),
                    q6(E.safe_div("total_value", F.col("n_orders") / 12.0 + 1)).alias("per_year"))


@query("threshold_flags", W("acct", """SELECT row_id,
  CAST(coalesce(n_orders, 0) > 10 AS INTEGER) AS busy,
  CAST(coalesce(late90, 0) >= 1 AS INTEGER) AS severe,
  CAST(coalesce(balance, 0) < 0 AS INTEGER) AS negative_balance,
  CAST(coalesce(property_value, 0) > 300000 AS INTEGER) AS big_property,
  CAST(coalesce(mortgage_balance, 0) <= 0 AS INTEGER) AS no_mortgage
FROM acct"""))
def q_flags(spark, sf):
    a = FX.acct(spark, sf)
    return a.select("row_id", E.flag("n_orders", ">", 10).alias("busy"),
                    E.flag("late90", ">=", 1).alias("severe"),
                    E.flag("balance", "<", 0).alias("negative_balance"),
                    E.flag("property_value", ">", 300000).alias("big_property"),
                    E.flag("mortgage_balance", "<=", 0).alias("no_mortgage"))


@query("bool_passthrough", W("doc_semi", """SELECT doc_id,
  CAST(coalesce(toxic, 0) AS INTEGER) AS toxic01, CAST(coalesce(quality, 0) AS INTEGER) AS quality01
FROM doc_semi"""))
def q_bool(spark, sf):
    d = FX.doc_semi(spark, sf)
    return d.select("doc_id", E.bool01("toxic").alias("toxic01"), E.bool01("quality").alias("quality01"))


@query("bucketize", f"""SELECT l_orderkey, l_linenumber,
  {_bucket_sql('l_discount * 10', UTIL_EDGES)} AS util_bucket,
  {_bucket_sql('l_quantity', AGE_EDGES)} AS qty_bucket
FROM lineitem""")
def q_bucketize(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     E.bucketize(F.col("l_discount") * 10, UTIL_EDGES).alias("util_bucket"),
                     E.bucketize("l_quantity", AGE_EDGES).alias("qty_bucket"))


@query("clip_range", W("acct_pred", """SELECT row_id,
  CASE WHEN m0_rate IS NULL THEN NULL ELSE greatest(4.99, least(35.99, m0_rate)) END AS rate_clipped,
  CASE WHEN m3_rate IS NULL THEN NULL ELSE greatest(6.0, least(20.0, m3_rate)) END AS rate_band
FROM acct_pred"""))
def q_clip(spark, sf):
    p = FX.acct_pred(spark, sf)
    return p.select("row_id", E.clip("m0_rate", 4.99, 35.99).alias("rate_clipped"),
                    E.clip("m3_rate", 6.0, 20.0).alias("rate_band"))


@query("round_rate", W("acct_pred", """SELECT row_id,
  CAST(round_even(greatest(4.99, least(35.99, m1_rate)) * 100.0, 0) AS DOUBLE) / 100.0 AS rate_2dp,
  CAST(round_even(m2_p1 * 1000.0, 0) AS DOUBLE) / 1000.0 AS p1_3dp
FROM acct_pred"""))
def q_round(spark, sf):
    p = FX.acct_pred(spark, sf)
    return p.select("row_id", E.round_half_even(E.clip("m1_rate", 4.99, 35.99), 2).alias("rate_2dp"),
                    E.round_half_even("m2_p1", 3).alias("p1_3dp"))


# fixed values: money-like name keywords of the log transform
MONEY_KEYWORDS = ("income", "amount", "balance", "value", "asset")


@query("log1p_money", W("acct", f"""SELECT row_id,
  {sq6("ln(1 + greatest(coalesce(balance, 0), 0))")} AS log_balance,
  {sq6("ln(1 + greatest(coalesce(total_value, 0), 0))")} AS log_total_value,
  {sq6("ln(1 + greatest(coalesce(mortgage_balance, 0), 0))")} AS log_mortgage_balance,
  {sq6("ln(1 + greatest(coalesce(property_value, 0), 0))")} AS log_property_value
FROM acct"""))
def q_log1p(spark, sf):
    a = FX.acct(spark, sf)
    cols = E.name_matches(a, MONEY_KEYWORDS)
    return a.select("row_id", *[q6(E.log1p_pos(c)).alias(f"log_{c}") for c in cols])


@query("log_shift_target", W("acct", f"""SELECT row_id,
  {sq6("ln(rate - 4.98)")} AS log_rate, {sq6("exp(ln(rate - 4.98)) + 4.98")} AS rate_back
FROM acct"""))
def q_log_shift(spark, sf):
    a = FX.acct(spark, sf)
    z = E.log_shift("rate")
    return a.select("row_id", q6(z).alias("log_rate"), q6(E.exp_shift(z)).alias("rate_back"))


@query("interactions", W("acct", f"""SELECT row_id,
  CAST({_nz('late30')} AS DOUBLE) * CAST({_nz('late60')} AS DOUBLE) AS late_x_late,
  {sq6(f"{_nz('total_value')} * CAST({_nz('late90')} AS DOUBLE)")} AS value_x_urgent,
  {sq6(_safe_div_sql('1.0 * late30 + 3.0 * late60 + 9.0 * late90', 'greatest(n_orders - 1, 1)'))} AS delinquency_per_order,
  {sq6(_safe_div_sql('5.0 * late30 + 3.0 * late60', _nz('n_orders') + ' / 12.0 + 1'))} AS marks_per_year
FROM acct"""))
def q_interactions(spark, sf):
    a = FX.acct(spark, sf)
    return a.select(
        "row_id",
        (E.nz("late30").cast("double") * E.nz("late60").cast("double")).alias("late_x_late"),
        q6(E.nz("total_value") * E.nz("late90").cast("double")).alias("value_x_urgent"),
        q6(E.safe_div(E.weighted_sum(SEVERITY), F.greatest(F.col("n_orders") - 1, F.lit(1)))).alias("delinquency_per_order"),
        q6(E.safe_div(E.weighted_sum({"late30": 5, "late60": 3}), E.nz("n_orders") / 12.0 + 1)).alias("marks_per_year"))


@query("str_flags", """SELECT c_custkey,
  CAST(regexp_matches(upper(trim(coalesce(c_mktsegment, 'nan'))), 'AUTO|HOUSE') AS INTEGER) AS seg_flag,
  CAST(NOT (upper(trim(coalesce(c_mktsegment, 'nan'))) IN ('NONE', 'NAN', 'NA', '')) AS INTEGER) AS has_segment
FROM customer""")
def q_str_flags(spark, sf):
    c = read_table(spark, sf, "customer")
    return c.select("c_custkey", E.str_contains_flag("c_mktsegment", "AUTO|HOUSE").alias("seg_flag"),
                    E.str_not_in_flag("c_mktsegment", NONE_TOKENS).alias("has_segment"))


@query("concat_key", W("pairs", """SELECT p_type, s_nationkey,
  coalesce(CAST(p_type AS VARCHAR), 'nan') || '__' || coalesce(CAST(s_nationkey AS VARCHAR), 'nan') AS pair_key,
  count(*) AS n
FROM pairs GROUP BY p_type, s_nationkey"""))
def q_concat_key(spark, sf):
    p = FX.pairs(spark, sf)
    # group on the columns themselves; the string key is only for output
    g = p.groupBy("p_type", "s_nationkey").agg(F.count(F.lit(1)).alias("n"))
    return g.select("p_type", "s_nationkey", E.concat_key(["p_type", "s_nationkey"]).alias("pair_key"), "n")


@query("inf_to_null_fill", f"""SELECT l_orderkey, l_linenumber,
  {sq6("CASE WHEN abs(x) < 'inf'::DOUBLE THEN x ELSE 0.0 END")} AS price_per_discount
FROM (SELECT *, CASE WHEN l_discount = 0 THEN 'inf'::DOUBLE ELSE l_extendedprice / l_discount END AS x FROM lineitem)""")
def q_inf_fill(spark, sf):
    li = read_table(spark, sf, "lineitem")
    x = F.when(F.col("l_discount") == 0, F.lit(float("inf"))).otherwise(
        F.try_divide("l_extendedprice", "l_discount"))
    return li.select("l_orderkey", "l_linenumber", q6(E.finite_or(x)).alias("price_per_discount"))


@query("coerce_numeric", """SELECT c_custkey,
  coalesce(TRY_CAST(substr(c_name, 10) AS DOUBLE), 0.0) AS name_number,
  coalesce(TRY_CAST(c_name AS DOUBLE), 0.0) AS name_as_number,
  coalesce(TRY_CAST(c_mktsegment AS DOUBLE), -1.0) AS segment_as_number
FROM customer""")
def q_coerce(spark, sf):
    c = read_table(spark, sf, "customer")
    return c.select("c_custkey", E.coerce_numeric(F.substring("c_name", 10, 100)).alias("name_number"),
                    E.coerce_numeric("c_name").alias("name_as_number"),
                    E.coerce_numeric("c_mktsegment", -1.0).alias("segment_as_number"))


def _argmax_sql(cols):
    parts = []
    for i, c in enumerate(cols[:-1]):
        rest = cols[i + 1:]
        cond = f"{c} >= greatest({', '.join(rest)})" if len(rest) > 1 else f"{c} >= {rest[0]}"
        parts.append(f"WHEN {cond} THEN {i}")
    return f"CAST(CASE {' '.join(parts)} ELSE {len(cols) - 1} END AS INTEGER)"


def _expected_sql(cols):
    s = "0.0"
    for i, c in enumerate(cols):
        s = f"({s} + {c} * {float(i)})"
    return s


@query("argmax_class", W("acct_pred", f"""SELECT row_id,
  {_argmax_sql(FX.pred_cols(0))} AS cls_m0, {_argmax_sql(FX.pred_cols(4))} AS cls_m4
FROM acct_pred"""))
def q_argmax(spark, sf):
    p = FX.acct_pred(spark, sf)
    return p.select("row_id", E.argmax_class(E.prob_array(FX.pred_cols(0))).alias("cls_m0"),
                    E.argmax_class(E.prob_array(FX.pred_cols(4))).alias("cls_m4"))


@query("expected_class", W("acct_pred", f"""SELECT row_id,
  {sq6(_expected_sql(FX.pred_cols(1)))} AS expected_m1
FROM acct_pred"""))
def q_expected(spark, sf):
    p = FX.acct_pred(spark, sf)
    return p.select("row_id", q6(E.expected_class(E.prob_array(FX.pred_cols(1)))).alias("expected_m1"))


def _norm_sql():
    avg = [f"greatest((m0_p{k} + m1_p{k}) / 2.0, 0.001)" for k in range(5)]
    tot = "0.0"
    for a in avg:
        tot = f"({tot} + {a})"
    return ", ".join(f"{sq6(f'{avg[k]} / {tot}')} AS p{k}" for k in range(5))


@query("row_normalise", W("acct_pred", f"SELECT row_id, {_norm_sql()} FROM acct_pred"))
def q_row_normalise(spark, sf):
    p = FX.acct_pred(spark, sf)
    avg = F.array(*[(F.col(f"m0_p{k}") + F.col(f"m1_p{k}")) / 2.0 for k in range(5)])
    n = E.row_normalise(avg, eps=0.001)
    return p.select("row_id", *[q6(n[k]).alias(f"p{k}") for k in range(5)])


@query("round_to_class", W("acct_pred", f"""SELECT row_id,
  CAST(least(greatest(round_even({_expected_sql(FX.pred_cols(2))}, 0), 0.0), 4.0) AS INTEGER) AS cls,
  CAST(least(greatest(round_even(m2_rate / 6.0, 0), 0.0), 4.0) AS INTEGER) AS cls_from_rate
FROM acct_pred"""))
def q_round_to_class(spark, sf):
    p = FX.acct_pred(spark, sf)
    return p.select("row_id", E.round_to_class(E.expected_class(E.prob_array(FX.pred_cols(2)))).alias("cls"),
                    E.round_to_class(F.col("m2_rate") / 6.0).alias("cls_from_rate"))


@query("filter_regime", W("acct", """
SELECT 'not_top' AS regime, row_id FROM acct WHERE tier <> 4
UNION ALL SELECT 'top', row_id FROM acct WHERE tier = 4
UNION ALL SELECT 'above_floor', row_id FROM acct WHERE rate > 5.0"""))
def q_filter_regime(spark, sf):
    a = FX.acct(spark, sf).select("row_id", "tier", "rate")
    return (a.where(F.col("tier") != 4).select(F.lit("not_top").alias("regime"), "row_id")
            .unionByName(a.where(F.col("tier") == 4).select(F.lit("top").alias("regime"), "row_id"))
            .unionByName(a.where(F.col("rate") > 5.0).select(F.lit("above_floor").alias("regime"), "row_id")))


# ------------------------------------------------------------ projections

@query("proj_drop_cols", W("acct", """SELECT row_id, balance, n_orders, total_value, late30, late60, late90,
  mortgage_balance, property_value, tier, rate, split FROM acct"""))
def q_drop(spark, sf):
    return FX.acct(spark, sf).drop("segment", "nation")


@query("proj_align", W("acct", f"""
SELECT row_id, split, CAST({_wsum_sql(SEVERITY)} AS DOUBLE) AS delinquency,
       {sq6(_safe_div_sql('mortgage_balance', 'property_value'))} AS mortgage_ltv, 0.0 AS value_per_order
FROM acct WHERE split = 'train'
UNION ALL
SELECT row_id, split, CAST({_wsum_sql(SEVERITY)} AS DOUBLE), 0.0,
       {sq6(_safe_div_sql('total_value', 'n_orders'))}
FROM acct WHERE split = 'test'"""))
def q_align(spark, sf):
    from tabstack.operators.frames import align_outer
    a = acct_features(FX.acct(spark, sf))
    tr = a.where(F.col("split") == "train").select(
        "row_id", "split", "delinquency", q6("mortgage_ltv").alias("mortgage_ltv"))
    te = a.where(F.col("split") == "test").select(
        "row_id", "split", "delinquency", q6("value_per_order").alias("value_per_order"))
    return align_outer(tr, te, fill=0.0)


@query("proj_if_present", W("acct", f"""SELECT row_id,
  CAST({_wsum_sql(SEVERITY)} AS DOUBLE) AS delinquency,
  {sq6(_safe_div_sql('total_value', 'n_orders'))} AS value_per_order
FROM acct"""))
def q_if_present(spark, sf):
    from tabstack.operators.frames import derive_if_present
    a = FX.acct(spark, sf).drop("mortgage_balance")  # one input is missing
    specs = {
        "delinquency": (["late30", "late60", "late90"], lambda: E.weighted_sum(SEVERITY)),
        "mortgage_ltv": (["mortgage_balance", "property_value"],
                         lambda: q6(E.safe_div("mortgage_balance", "property_value"))),
        "value_per_order": (["total_value", "n_orders"], lambda: q6(E.safe_div("total_value", "n_orders"))),
    }
    out = derive_if_present(a, specs)
    return out.select("row_id", *[c for c in specs if c in out.columns])
