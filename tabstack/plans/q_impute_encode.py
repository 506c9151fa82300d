"""Checkable queries for sections 2.6 (imputation) and 2.7 (encoding)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabstack.operators import encode as EN
from tabstack.operators import impute as IM
from tabstack.operators.folds import assign_folds_hash, assign_folds_stratified
from tabstack.plans import fixtures as FX
from tabstack.plans.registry import q6, query, sq6
from tabstack.sources.tables import read_table

W = FX.with_sql


def _train():
    return F.col("split") == "train"


# ---------------------------------------------------------------- 2.6 nulls

@query("missing_flags_all", W("acct", """SELECT row_id,
  CAST(mortgage_balance IS NULL AS INTEGER) AS mortgage_balance_was_missing,
  CAST(property_value IS NULL AS INTEGER) AS property_value_was_missing
FROM acct"""))
def q_missing_all(spark, sf):
    a = FX.acct(spark, sf)
    tr, te = a.where(_train()), a.where(~_train())
    cols = IM.missing_columns(tr, te, cols=[c for c in a.columns if c != "row_id"])
    return IM.missing_flags(a, cols).select("row_id", *[f"{c}_was_missing" for c in cols])


SELECTED = ["mortgage_balance", "property_value", "total_value"]


@query("missing_flags_selected", W("acct", "SELECT row_id, " + ", ".join(
    f"CAST({c} IS NULL AS INTEGER) AS {c}_was_missing" for c in SELECTED) + " FROM acct"))
def q_missing_sel(spark, sf):
    return IM.missing_flags(FX.acct(spark, sf), SELECTED).select(
        "row_id", *[f"{c}_was_missing" for c in SELECTED])


@query("impute_structural_zero", W("acct", """SELECT row_id,
  coalesce(mortgage_balance, 0.0) AS mortgage_balance, coalesce(property_value, 0.0) AS property_value
FROM acct"""))
def q_zero(spark, sf):
    a = FX.acct(spark, sf)
    fills = IM.fit_imputer(a.where(_train()), zero=["mortgage_balance", "property_value"])
    return IM.apply_imputer(a, fills).select("row_id", "mortgage_balance", "property_value")


@query("impute_median", W("acct", """SELECT row_id,
  coalesce(mortgage_balance, (SELECT quantile_cont(mortgage_balance, 0.5) FROM acct WHERE split = 'train')) AS mortgage_balance,
  coalesce(property_value, (SELECT quantile_cont(property_value, 0.5) FROM acct WHERE split = 'train')) AS property_value
FROM acct"""))
def q_median_fill(spark, sf):
    a = FX.acct(spark, sf)
    fills = IM.fit_imputer(a.where(_train()), median=["mortgage_balance", "property_value"])
    return IM.apply_imputer(a, fills).select("row_id", "mortgage_balance", "property_value")


def _acct_cat(df):
    # a nullable categorical (present only for customers with urgent orders)
    return df.withColumn("seg_urgent", F.when(F.col("late90") > 2, F.col("segment")))


ACCT_CAT_SQL = "acct_cat AS (SELECT *, CASE WHEN late90 > 2 THEN segment END AS seg_urgent FROM acct)"


@query("impute_mode", W("acct", """SELECT row_id, coalesce(seg_urgent,
  (SELECT seg_urgent FROM acct_cat WHERE split = 'train' AND seg_urgent IS NOT NULL
   GROUP BY seg_urgent ORDER BY count(*) DESC, seg_urgent ASC LIMIT 1)) AS seg_urgent
FROM acct_cat""", extra=[ACCT_CAT_SQL]))
def q_mode_fill(spark, sf):
    a = _acct_cat(FX.acct(spark, sf))
    fills = IM.fit_imputer(a.where(_train()), mode=["seg_urgent"])
    return IM.apply_imputer(a, fills).select("row_id", "seg_urgent")


@query("impute_token", W("acct", """SELECT row_id, coalesce(seg_urgent, 'NA') AS seg_urgent,
  coalesce(CASE WHEN late60 > 3 THEN segment END, 'None') AS seg_late
FROM acct_cat""", extra=[ACCT_CAT_SQL]))
def q_token(spark, sf):
    a = _acct_cat(FX.acct(spark, sf)).withColumn("seg_late", F.when(F.col("late60") > 3, F.col("segment")))
    fills = IM.fit_imputer(a.where(_train()), token={"seg_urgent": "NA", "seg_late": "None"})
    return IM.apply_imputer(a, fills).select("row_id", "seg_urgent", "seg_late")


WINS = ["l_extendedprice", "l_quantity"]


@query("winsorize", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"least({c}, (SELECT quantile_cont({c}, 0.995) FROM lineitem WHERE l_orderkey % 10 < 7)) AS {c}"
    for c in WINS) + " FROM lineitem")
def q_winsorize(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *WINS)
    caps = IM.fit_caps(li.where(F.col("l_orderkey") % 10 < 7), WINS, q=0.995)
    return IM.winsorize(li, caps)


# --------------------------------------------------------------- 2.7 encode

# fixed values: priority rank map (one level deliberately left unmapped)
PRIORITY_RANK = {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "5-LOW": 1}


@query("enc_ordinal", """SELECT o_orderkey,
  CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 3
       WHEN '5-LOW' THEN 1 ELSE -1 END AS INTEGER) AS priority_rank,
  (SELECT avg(CAST(o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') AS DOUBLE)) FROM orders) >= 0.8 AS map_accepted
FROM orders""")
def q_ordinal(spark, sf):
    o = read_table(spark, sf, "orders")
    cov = EN.ordinal_coverage(o, "o_orderpriority", PRIORITY_RANK)
    return o.select("o_orderkey", EN.ordinal_encode("o_orderpriority", PRIORITY_RANK, unknown=-1)
                    .cast("int").alias("priority_rank"), F.lit(cov >= 0.8).alias("map_accepted"))


@query("enc_onehot", """SELECT c_custkey, """ + ", ".join(
    f"CAST(coalesce(c_mktsegment = '{v}', false) AS INTEGER) AS c_mktsegment_{v}"
    for v in ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]) + " FROM customer")
def q_onehot(spark, sf):
    c = read_table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    tr, te = c.where(F.col("c_custkey") % 10 < 7), c.where(F.col("c_custkey") % 10 >= 7)
    lv_tr, lv_te = EN.fit_levels(tr, ["c_mktsegment"]), EN.fit_levels(te, ["c_mktsegment"])
    levels = {k: sorted(set(lv_tr.get(k, [])) | set(lv_te.get(k, []))) for k in set(lv_tr) | set(lv_te)}
    return EN.onehot_encode(c, levels)


@query("enc_label", """SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS BIGINT) AS p_brand_code,
  CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS BIGINT) AS p_type_code FROM part""")
def q_label(spark, sf):
    p = read_table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    out = p
    for c in ["p_brand", "p_type"]:
        out = EN.label_encode(out, c, EN.fit_label_codes(p, c))
    return out.select("p_partkey", "p_brand_code", "p_type_code")


def _te_sql(m: float, where_fold: bool) -> str:
    cond = "AND t.fold <> r.fold" if where_fold else ""
    return f"""SELECT r.row_id, {sq6(f'''CASE WHEN r.fold IS NULL OR {not where_fold} THEN
      (coalesce(f.s, 0) + {m} * g.mu) / (coalesce(f.n, 0) + {m})
    ELSE (coalesce(o.s, 0) + {m} * g.mu) / (coalesce(o.n, 0) + {m}) END''')} AS nation_te
FROM acct_folds r
CROSS JOIN (SELECT avg(rate) AS mu FROM acct_folds WHERE split = 'train') g
LEFT JOIN (SELECT nation, sum(rate) AS s, count(*) AS n FROM acct_folds WHERE split = 'train' GROUP BY nation) f
  ON f.nation = r.nation
LEFT JOIN (SELECT r2.row_id, sum(t.rate) AS s, count(t.rate) AS n FROM acct_folds r2
           JOIN acct_folds t ON t.nation = r2.nation AND t.split = 'train' {cond}
           GROUP BY r2.row_id) o ON o.row_id = r.row_id"""


@query("enc_target_smooth", W("acct_folds", _te_sql(20.0, False).replace("CASE WHEN r.fold IS NULL OR True THEN", "CASE WHEN TRUE THEN")))
def q_te_smooth(spark, sf):
    a = FX.acct_folds(spark, sf)
    st = EN.fit_target_stats(a.where(_train()), ["nation"], "rate", fold=None, m=20.0, names=["nation"])
    return EN.apply_target_stats(a, st, fold=None).select("row_id", q6("nation_te").alias("nation_te"))


@query("enc_target_kfold", W("acct_folds", _te_sql(20.0, True).replace("CASE WHEN r.fold IS NULL OR False THEN", "CASE WHEN r.fold IS NULL THEN")))
def q_te_kfold(spark, sf):
    a = FX.acct_folds(spark, sf)
    st = EN.fit_target_stats(a.where(_train()), ["nation"], "rate", fold="fold", m=20.0, names=["nation"])
    return EN.apply_target_stats(a, st).select("row_id", q6("nation_te").alias("nation_te"))


def _multi_sql(keys, m=20.0, fold_tbl="acct_folds", noise=False):
    """Leave-fold-out mean / P(tier=4) / std per key, written directly:
    aggregate the train rows of the same key in OTHER folds."""
    sel, joins = [], []
    for k in keys:
        a = f"o_{k}"
        f = f"f_{k}"
        joins.append(f"""LEFT JOIN (SELECT r2.row_id, sum(t.rate) AS s, count(t.rate) AS n,
              sum(CAST(t.tier = 4 AS INTEGER)) AS b, stddev_samp(t.rate) AS sd
            FROM {fold_tbl} r2 JOIN {fold_tbl} t ON t.{k} = r2.{k} AND t.split = 'train' AND t.fold <> r2.fold
            GROUP BY r2.row_id) {a} ON {a}.row_id = r.row_id
LEFT JOIN (SELECT {k}, sum(rate) AS s, count(rate) AS n, sum(CAST(tier = 4 AS INTEGER)) AS b,
                  stddev_samp(rate) AS sd FROM {fold_tbl} WHERE split = 'train' GROUP BY {k}) {f} ON {f}.{k} = r.{k}""")
        mean_f = f"(coalesce({f}.s, 0) + {m} * g.mu) / (coalesce({f}.n, 0) + {m})"
        if noise:
            h = f"md5('42|{k}|' || CAST(r.row_id AS VARCHAR))"
            z = (f"sqrt(-2.0 * ln((CAST(CAST(('0x' || substr({h}, 1, 8)) AS BIGINT) AS DOUBLE) + 1.0) / 4294967297.0))"
                 f" * cos({2 * 3.141592653589793!r} * (CAST(CAST(('0x' || substr({h}, 9, 8)) AS BIGINT) AS DOUBLE) / 4294967296.0))")
            se = f"coalesce(CASE WHEN {f}.n >= 2 THEN {f}.sd ELSE g.sd END / sqrt({f}.n + {m}), 0.0)"
            mean_f = f"({mean_f} + {z} * {se})"
        sel.append(sq6(f"""CASE WHEN r.fold IS NULL THEN {mean_f}
             ELSE (coalesce({a}.s, 0) + {m} * g.mu) / (coalesce({a}.n, 0) + {m}) END""") + f" AS {k}_r")
        sel.append(sq6(f"""CASE WHEN r.fold IS NULL THEN (coalesce({f}.b, 0) + {m} * g.pmu) / (coalesce({f}.n, 0) + {m})
             ELSE (coalesce({a}.b, 0) + {m} * g.pmu) / (coalesce({a}.n, 0) + {m}) END""") + f" AS {k}_p4")
        sel.append(sq6(f"""CASE WHEN r.fold IS NULL THEN (CASE WHEN {f}.n >= 2 THEN {f}.sd ELSE g.sd END)
             ELSE (CASE WHEN {a}.n >= 2 THEN {a}.sd ELSE g.sd END) END""") + f" AS {k}_sd")
    return (f"SELECT r.row_id, {', '.join(sel)}\nFROM {fold_tbl} r\n"
            f"CROSS JOIN (SELECT avg(rate) AS mu, avg(CAST(tier = 4 AS DOUBLE)) AS pmu, stddev_samp(rate) AS sd "
            f"FROM {fold_tbl} WHERE split = 'train') g\n" + "\n".join(joins))


MULTI_KEYS = ["nation", "segment"]
MULTI_SUFFIX = {"mean": "r", "p": "p4", "std": "sd", "se": "se"}


@query("enc_target_multi", W("acct_folds", _multi_sql(MULTI_KEYS)))
def q_te_multi(spark, sf):
    a = FX.acct_folds(spark, sf)
    st = EN.fit_target_stats(a.where(_train()), MULTI_KEYS, "rate", fold="fold", m=20.0,
                             stats=("mean", "p", "std"), binary=(F.col("tier") == 4).cast("int"),
                             suffix=MULTI_SUFFIX)
    out = EN.apply_target_stats(a, st)
    return out.select("row_id", *[q6(f"{k}_{s}").alias(f"{k}_{s}") for k in MULTI_KEYS for s in ("r", "p4", "sd")])


FOLDS10_SQL = f"""acct_f10 AS (SELECT row_id, segment, nation, tier, rate, split,
  {FX.fold_sql('row_id', 'tier', k=10, where="split = 'train'")} AS fold FROM acct)"""


@query("enc_target_multi_v2", W("acct", _multi_sql(MULTI_KEYS, fold_tbl="acct_f10", noise=True),
                                extra=[FOLDS10_SQL]))
def q_te_multi_v2(spark, sf):
    a = FX.acct(spark, sf).select("row_id", "segment", "nation", "tier", "rate", "split")
    a = assign_folds_stratified(a, "row_id", k=10, stratify="tier", seed=42, only_where=_train())
    st = EN.fit_target_stats(a.where(_train()), MULTI_KEYS, "rate", fold="fold", m=20.0,
                             stats=("mean", "p", "std", "se"), binary=(F.col("tier") == 4).cast("int"),
                             suffix=MULTI_SUFFIX, names=[f"{k}" for k in MULTI_KEYS])
    out = EN.apply_target_stats(a, st, noise={"mean": 1.0}, noise_key="row_id")
    return out.select("row_id", *[q6(f"{k}_{s}").alias(f"{k}_{s}") for k in MULTI_KEYS for s in ("r", "p4", "sd")])


PAIR_SETS = [("p_brand", "l_linestatus"), ("p_type", "s_nationkey")]


def _pairs_sql():
    """Per (pair, fold) sums, out-of-fold = total - own fold (checked against
    the direct definition in the tests)."""
    sel, joins = [], []
    for a, b in PAIR_SETS:
        n = f"{a}__{b}"
        joins.append(f"""LEFT JOIN (SELECT {a}, {b}, fold, sum(y) AS s, count(*) AS n, sum(is_r) AS sb,
              sum(sum(y)) OVER (PARTITION BY {a}, {b}) AS st, sum(count(*)) OVER (PARTITION BY {a}, {b}) AS nt,
              sum(sum(is_r)) OVER (PARTITION BY {a}, {b}) AS sbt
            FROM pf WHERE tr GROUP BY {a}, {b}, fold) k_{n} ON k_{n}.{a} = r.{a} AND k_{n}.{b} = r.{b} AND k_{n}.fold = r.fold""")
        sel.append(sq6(f"CASE WHEN r.tr THEN (coalesce(k_{n}.st - k_{n}.s, 0) + 20.0 * g.mu) / (coalesce(k_{n}.nt - k_{n}.n, 0) + 20.0) "
                       f"ELSE (SELECT (coalesce(sum(y), 0) + 20.0 * g.mu) / (count(*) + 20.0) FROM pf t WHERE t.tr AND t.{a} = r.{a} AND t.{b} = r.{b}) END") + f" AS {n}_te")
        sel.append(sq6(f"CASE WHEN r.tr THEN (coalesce(k_{n}.sbt - k_{n}.sb, 0) + 20.0 * g.pmu) / (coalesce(k_{n}.nt - k_{n}.n, 0) + 20.0) "
                       f"ELSE (SELECT (coalesce(sum(is_r), 0) + 20.0 * g.pmu) / (count(*) + 20.0) FROM pf t WHERE t.tr AND t.{a} = r.{a} AND t.{b} = r.{b}) END") + f" AS {n}_te_p")
    return (f"SELECT r.l_orderkey, r.l_linenumber, {', '.join(sel)}\nFROM pf r\n"
            "CROSS JOIN (SELECT avg(y) AS mu, avg(CAST(is_r AS DOUBLE)) AS pmu FROM pf WHERE tr) g\n" + "\n".join(joins))


PF_SQL = """pf AS (SELECT *, l_orderkey % 10 < 7 AS tr,
  CAST(('0x' || substr(md5('42|' || CAST(l_orderkey * 10 + l_linenumber AS VARCHAR)), 1, 8))::BIGINT % 5 AS INTEGER) AS fold
  FROM pairs)"""


@query("enc_group_pairs", W("pairs", _pairs_sql(), extra=[PF_SQL]))
def q_pairs(spark, sf):
    p = FX.pairs(spark, sf).withColumn("line_id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    p = assign_folds_hash(p, "line_id", k=5, seed=42)
    tr = F.col("l_orderkey") % 10 < 7
    st = EN.fit_target_stats(p.where(tr), [list(s) for s in PAIR_SETS], "y", fold="fold", m=20.0,
                             stats=("mean", "p"), binary="is_r")
    out = EN.apply_target_stats(p.withColumn("fold", F.when(tr, F.col("fold"))), st)
    names = [f"{a}__{b}" for a, b in PAIR_SETS]
    return out.select("l_orderkey", "l_linenumber",
                      *[q6(f"{n}_{s}").alias(f"{n}_{s}") for n in names for s in ("te", "te_p")])


@query("enc_native_cat", W("acct", f"""SELECT row_id, {sq6('''CASE WHEN split = 'train' THEN
    (coalesce(sum(rate) OVER (PARTITION BY segment, split = 'train' ORDER BY md5('42|' || CAST(row_id AS VARCHAR))
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1.0 * g.mu)
    / (coalesce(count(*) OVER (PARTITION BY segment, split = 'train' ORDER BY md5('42|' || CAST(row_id AS VARCHAR))
       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1.0)
  ELSE (coalesce(t.s, 0) + 1.0 * g.mu) / (coalesce(t.n, 0) + 1.0) END''')} AS segment_ots
FROM acct CROSS JOIN (SELECT avg(rate) AS mu FROM acct WHERE split = 'train') g
LEFT JOIN (SELECT segment AS sg, sum(rate) AS s, count(*) AS n FROM acct WHERE split = 'train' GROUP BY segment) t
  ON t.sg = acct.segment"""))
def q_native_cat(spark, sf):
    a = FX.acct(spark, sf)
    out = EN.ordered_target_encode(a, "segment", "rate", "row_id", _train(), a=1.0, seed=42)
    return out.select("row_id", q6("segment_ots").alias("segment_ots"))


@query("enc_loo", W("acct", f"""SELECT row_id, {sq6('''CASE WHEN t.n IS NULL THEN g.mu
    WHEN split = 'train' THEN CASE WHEN t.n - 1 + 0.0 <= 0 THEN g.mu ELSE (t.s - rate) / (t.n - 1) END
    ELSE t.s / t.n END''')} AS nation_loo
FROM acct CROSS JOIN (SELECT avg(rate) AS mu FROM acct WHERE split = 'train') g
LEFT JOIN (SELECT nation AS nk, sum(rate) AS s, count(*) AS n FROM acct WHERE split = 'train' GROUP BY nation) t
  ON t.nk = acct.nation"""))
def q_loo(spark, sf):
    a = FX.acct(spark, sf)
    return EN.loo_encode(a, "nation", "rate", _train()).select("row_id", q6("nation_loo").alias("nation_loo"))


@query("enc_m_estimate", W("acct", f"""SELECT row_id,
  {sq6('(coalesce(t.b, 0) + 5.0 * g.p) / (coalesce(t.n, 0) + 5.0)')} AS segment_te_p
FROM acct CROSS JOIN (SELECT avg(CAST(tier = 4 AS DOUBLE)) AS p FROM acct WHERE split = 'train') g
LEFT JOIN (SELECT segment AS sg, sum(CAST(tier = 4 AS INTEGER)) AS b, count(*) AS n FROM acct
           WHERE split = 'train' GROUP BY segment) t ON t.sg = acct.segment"""))
def q_m_estimate(spark, sf):
    a = FX.acct(spark, sf)
    st = EN.fit_target_stats(a.where(_train()), ["segment"], "rate", fold=None, m=5.0, stats=("p",),
                             binary=(F.col("tier") == 4).cast("int"))
    return EN.apply_target_stats(a, st, fold=None).select("row_id", q6("segment_te_p").alias("segment_te_p"))


KBIN_COLS = ["total_value", "balance"]


def _kbins_sql():
    sel = []
    for c in KBIN_COLS:
        q = f"(SELECT quantile_cont({c}, [0.2, 0.4, 0.6, 0.8]) FROM acct WHERE split = 'train')"
        cases = " ".join(f"WHEN {c} <= {q}[{i + 1}] THEN {i}" for i in range(4))
        sel.append(f"CAST(CASE WHEN {c} IS NULL THEN NULL {cases} ELSE 4 END AS INTEGER) AS {c}_bin")
    return "SELECT row_id, " + ", ".join(sel) + " FROM acct"


@query("enc_kbins", W("acct", _kbins_sql()))
def q_kbins(spark, sf):
    a = FX.acct(spark, sf)
    edges = EN.fit_quantile_edges(a.where(_train()), KBIN_COLS, n_bins=5)
    return a.withColumns(EN.kbins_columns(edges)).select("row_id", *[f"{c}_bin" for c in KBIN_COLS])


SCALE_COLS = ["balance", "n_orders", "late90"]


def _scale_sql(kind):
    sel = []
    for c in SCALE_COLS:
        if kind == "standard":
            a, b = f"avg({c})", f"stddev_pop({c})"
        elif kind == "minmax":
            a, b = f"min({c})", f"max({c}) - min({c})"
        else:
            a, b = f"quantile_cont({c}, 0.5)", f"quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"
        sel.append(sq6(f"(CAST({c} AS DOUBLE) - (SELECT {a} FROM acct WHERE split = 'train')) / "
                       f"(SELECT CASE WHEN {b} = 0 THEN 1.0 ELSE {b} END FROM acct WHERE split = 'train')") + f" AS {c}")
    return "SELECT row_id, " + ", ".join(sel) + " FROM acct"


def _scale_query(kind):
    def q(spark, sf):
        a = FX.acct(spark, sf)
        st = EN.fit_scaler(a.where(_train()), SCALE_COLS, kind=kind)
        cols = EN.scale_columns(st)
        return a.select("row_id", *[q6(cols[c]).alias(c) for c in SCALE_COLS])
    q.__name__ = f"q_scale_{kind}"
    return q


for _kind in ("standard", "minmax", "robust"):
    query(f"scale_{_kind}", W("acct", _scale_sql(_kind)))(_scale_query(_kind))


@query("enc_target_kfold_oof_prior", W("acct_folds", f"""SELECT r.row_id, {sq6('''CASE WHEN r.fold IS NULL
    THEN (coalesce(f.s, 0) + 20.0 * g.mu) / (coalesce(f.n, 0) + 20.0)
    ELSE (coalesce(o.s, 0) + 20.0 * gf.mu) / (coalesce(o.n, 0) + 20.0) END''')} AS nation_te
FROM acct_folds r
CROSS JOIN (SELECT avg(rate) AS mu FROM acct_folds WHERE split = 'train') g
LEFT JOIN (SELECT k.fold, avg(t.rate) AS mu FROM (SELECT DISTINCT fold FROM acct_folds WHERE fold IS NOT NULL) k
           JOIN acct_folds t ON t.split = 'train' AND t.fold <> k.fold GROUP BY k.fold) gf ON gf.fold = r.fold
LEFT JOIN (SELECT nation, sum(rate) AS s, count(*) AS n FROM acct_folds WHERE split = 'train' GROUP BY nation) f
  ON f.nation = r.nation
LEFT JOIN (SELECT r2.row_id, sum(t.rate) AS s, count(t.rate) AS n FROM acct_folds r2
           JOIN acct_folds t ON t.nation = r2.nation AND t.split = 'train' AND t.fold <> r2.fold
           GROUP BY r2.row_id) o ON o.row_id = r.row_id"""))
def q_te_kfold_oof_prior(spark, sf):
    """Leave-fold-out encoding whose smoothing prior also excludes the fold
    (a row's own label cannot reach its encoding)."""
    a = FX.acct_folds(spark, sf)
    st = EN.fit_target_stats(a.where(_train()), ["nation"], "rate", fold="fold", m=20.0, names=["nation"],
                             prior="oof")
    return EN.apply_target_stats(a, st).select("row_id", q6("nation_te").alias("nation_te"))
