"""Checkable queries for sections 2.5 (top-k / sampling), 2.9 (pseudo-labels,
adversarial pruning), 2.11 (blending) and 2.12 (metrics), on the stand-in
predictions of ``acct_pred`` (so every number has an exact oracle)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabstack.functions import expr as E
from tabstack.operators import blend as B
from tabstack.operators import metrics as MT
from tabstack.operators.aggregates import corr_pairs
from tabstack.operators.pseudo import append_pseudo, pad_pseudo, pseudo_label
from tabstack.operators.sampling import rank_borda, stratified_sample, topk_confidence
from tabstack.plans import fixtures as FX
from tabstack.plans.flagship import acct_features
from tabstack.plans.registry import q6, query, sq6

W = FX.with_sql
M = FX.N_MODELS
PROBS = [FX.pred_cols(m) for m in range(M)]


def _train(p):
    return p.where(F.col("fold").isNotNull())


def _argmax_sql(cols):
    parts = []
    for i, c in enumerate(cols[:-1]):
        rest = cols[i + 1:]
        cond = f"{c} >= greatest({', '.join(rest)})" if len(rest) > 1 else f"{c} >= {rest[0]}"
        parts.append(f"WHEN {cond} THEN {i}")
    return f"CAST(CASE {' '.join(parts)} ELSE {len(cols) - 1} END AS INTEGER)"


def _per_model_union(fn):
    return "\nUNION ALL\n".join(fn(m) for m in range(M))


# ------------------------------------------------------------------ metrics

@query("metric_accuracy", W("acct_pred", _per_model_union(lambda m: f"""SELECT 'm{m}' AS model,
  {sq6(f"avg(CAST({_argmax_sql(FX.pred_cols(m))} = tier AS DOUBLE))")} AS accuracy, count(*) AS n
FROM acct_pred WHERE fold IS NOT NULL""")))
def q_accuracy(spark, sf):
    p = _train(FX.acct_pred(spark, sf))
    parts = [MT.accuracy(p, E.argmax_class(E.prob_array(PROBS[m])), "tier").select(
        F.lit(f"m{m}").alias("model"), q6("accuracy").alias("accuracy"), "n") for m in range(M)]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def _r2_sql(m, where="fold IS NOT NULL"):
    return f"""SELECT 'm{m}' AS model,
  {sq6(f"1 - sum((rate - m{m}_rate) * (rate - m{m}_rate)) / sum((rate - (SELECT avg(rate) FROM acct_pred WHERE {where})) * (rate - (SELECT avg(rate) FROM acct_pred WHERE {where})))")} AS r2,
  {sq6(f"sqrt(sum((rate - m{m}_rate) * (rate - m{m}_rate)) / count(*))")} AS rmse, count(*) AS n
FROM acct_pred WHERE {where}"""


@query("metric_r2_rmse", W("acct_pred", _per_model_union(_r2_sql)))
def q_r2(spark, sf):
    p = _train(FX.acct_pred(spark, sf))
    out = None
    for m in range(M):
        r = MT.r2_rmse(p, f"m{m}_rate", "rate").select(
            F.lit(f"m{m}").alias("model"), q6("r2").alias("r2"), q6("rmse").alias("rmse"), "n")
        out = r if out is None else out.unionByName(r)
    return out


@query("metric_logloss", W("acct_pred", _per_model_union(lambda m: f"""SELECT 'm{m}' AS model,
  {sq6(f"avg(-ln(least(greatest(CASE tier " + " ".join(f"WHEN {k} THEN m{m}_p{k}" for k in range(5)) + " END, 1e-12), 1 - 1e-12)))")} AS logloss,
  count(*) AS n FROM acct_pred WHERE fold IS NOT NULL""")))
def q_logloss(spark, sf):
    p = _train(FX.acct_pred(spark, sf))
    out = None
    for m in range(M):
        r = MT.logloss(p, PROBS[m], "tier").select(F.lit(f"m{m}").alias("model"), q6("logloss").alias("logloss"), "n")
        out = r if out is None else out.unionByName(r)
    return out


AUC_SQL = f"""SELECT CAST(fold AS INTEGER) AS fold,
  {sq6('(sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y)))')} AS auc,
  count(*) AS n
FROM (SELECT fold, y, (rank() OVER (PARTITION BY fold ORDER BY s) + (count(*) OVER (PARTITION BY fold, s) - 1) / 2.0) AS r
      FROM (SELECT fold, CAST(tier = 4 AS INTEGER) AS y, m0_p4 + m2_p4 AS s FROM acct_pred WHERE fold IS NOT NULL))
GROUP BY fold"""


@query("metric_auc", W("acct_pred", AUC_SQL))
def q_auc(spark, sf):
    p = _train(FX.acct_pred(spark, sf)).select(
        "fold", (F.col("tier") == 4).cast("int").alias("y"), (F.col("m0_p4") + F.col("m2_p4")).alias("s"))
    a = MT.auc(p, "s", "y", by=["fold"])
    return a.select(F.col("fold").cast("int").alias("fold"), q6("auc").alias("auc"), "n")


@query("metric_combined", W("acct_pred", _per_model_union(lambda m: f"""SELECT 'm{m}' AS model, {sq6(
    f"0.5 * avg(CAST({_argmax_sql(FX.pred_cols(m))} = tier AS DOUBLE)) + 0.5 * (1 - sum((rate - m{m}_rate) * (rate - m{m}_rate)) / "
    f"sum((rate - (SELECT avg(rate) FROM acct_pred WHERE fold IS NOT NULL)) * (rate - (SELECT avg(rate) FROM acct_pred WHERE fold IS NOT NULL))))")} AS combined
FROM acct_pred WHERE fold IS NOT NULL""")))
def q_combined(spark, sf):
    p = _train(FX.acct_pred(spark, sf))
    out = None
    for m in range(M):
        acc = MT.accuracy(p, E.argmax_class(E.prob_array(PROBS[m])), "tier").withColumn("_k", F.lit(1))
        r2 = MT.r2_rmse(p, f"m{m}_rate", "rate").withColumn("_k", F.lit(1))
        c = acc.join(r2, "_k").select(F.lit(f"m{m}").alias("model"),
                                      q6(MT.combined(F.col("accuracy"), F.col("r2"))).alias("combined"))
        out = c if out is None else out.unionByName(c)
    return out


PSEUDO_SRC_SQL = f"""lab AS (
  SELECT row_id, tier AS label, 0 AS is_pseudo, m0_p0, m0_p1, m0_p2, m0_p3, m0_p4 FROM acct_pred WHERE split = 'train'
  UNION ALL
  SELECT row_id, {_argmax_sql(FX.pred_cols(4))}, 1, m0_p0, m0_p1, m0_p2, m0_p3, m0_p4 FROM acct_pred WHERE split = 'test')"""


@query("metric_real_only", W("acct_pred", f"""SELECT 'real' AS subset, {sq6(f"avg(CAST({_argmax_sql(FX.pred_cols(0))} = label AS DOUBLE))")} AS accuracy, count(*) AS n
FROM lab WHERE is_pseudo = 0
UNION ALL SELECT 'all', {sq6(f"avg(CAST({_argmax_sql(FX.pred_cols(0))} = label AS DOUBLE))")}, count(*) FROM lab""",
                              extra=[PSEUDO_SRC_SQL]))
def q_real_only(spark, sf):
    p = FX.acct_pred(spark, sf)
    cols = ["row_id", *PROBS[0]]
    lab = p.where(F.col("split") == "train").select(*cols, F.col("tier").alias("label"), F.lit(0).alias("is_pseudo")) \
        .unionByName(p.where(F.col("split") == "test").select(
            *cols, E.argmax_class(E.prob_array(PROBS[4])).alias("label"), F.lit(1).alias("is_pseudo")))
    pred = E.argmax_class(E.prob_array(PROBS[0]))
    real = MT.accuracy(lab.where(F.col("is_pseudo") == 0), pred, "label").select(F.lit("real").alias("subset"), "*")
    allr = MT.accuracy(lab, pred, "label").select(F.lit("all").alias("subset"), "*")
    return real.unionByName(allr).select("subset", q6("accuracy").alias("accuracy"), "n")


# ----------------------------------------------------------------- blending

def _blend_sql(weights, normalise=True):
    """SQL twin of blend_columns: sum_m w_m p_{m,k} left to right, / row sum."""
    acc = []
    for k in range(5):
        s = f"{float(weights[0])!r} * m0_p{k}"
        for m in range(1, M):
            s = f"({s} + {float(weights[m])!r} * m{m}_p{k})"
        acc.append(s)
    if not normalise:
        return acc
    tot = acc[0]
    for k in range(1, 5):
        tot = f"({tot} + {acc[k]})"
    return [f"({a} / {tot})" for a in acc]


EQUAL = [1.0 / M] * M


@query("blend_mean", W("acct_pred", "SELECT row_id, " + ", ".join(
    f"{sq6(b)} AS p{k}" for k, b in enumerate(_blend_sql(EQUAL))) + ", " +
    _argmax_sql(_blend_sql(EQUAL)) + " AS cls FROM acct_pred"))
def q_blend_mean(spark, sf):
    p = FX.acct_pred(spark, sf)
    b = B.blend_columns(PROBS)
    return p.select("row_id", *[q6(c).alias(f"p{k}") for k, c in enumerate(b)],
                    E.argmax_class(F.array(*b)).alias("cls"))


# fixed values: the hand-set blend weights
RATE_WEIGHTS = [0.1, 0.2, 0.3, 0.25, 0.15]


def _scalar_sql(cols, w):
    s = f"{float(w[0])!r} * {cols[0]}"
    for c, x in zip(cols[1:], w[1:]):
        s = f"({s} + {float(x)!r} * {c})"
    return s


RATES = [f"m{m}_rate" for m in range(M)]


@query("blend_weighted", W("acct_pred", f"SELECT row_id, {sq6(_scalar_sql(RATES, RATE_WEIGHTS))} AS rate_blend FROM acct_pred"))
def q_blend_weighted(spark, sf):
    p = FX.acct_pred(spark, sf)
    return p.select("row_id", q6(B.blend_scalar(RATES, RATE_WEIGHTS)).alias("rate_blend"))


def _grid_sql():
    ws = [f"w{i}" for i in range(M)]
    acc = []
    for k in range(5):
        s = f"c.w0 * m0_p{k}"
        for m in range(1, M):
            s = f"({s} + c.w{m} * m{m}_p{k})"
        acc.append(s)
    cands = ("SELECT a / 10.0 AS w0, b / 10.0 AS w1, c / 10.0 AS w2, d / 10.0 AS w3, (10 - a - b - c - d) / 10.0 AS w4 "
             "FROM range(11) t1(a), range(11) t2(b), range(11) t3(c), range(11) t4(d) WHERE a + b + c + d <= 10")
    return f"""SELECT {', '.join(f'c.{w} AS {w}' for w in ws)}, CAST(sum(CAST({_argmax_sql(acc)} = tier AS INTEGER)) AS BIGINT) AS hits,
  count(*) AS n, {sq6(f"avg(CAST({_argmax_sql(acc)} = tier AS DOUBLE))")} AS accuracy
FROM ({cands}) c, (SELECT * FROM acct_pred WHERE fold IS NOT NULL) p
GROUP BY {', '.join(f'c.{w}' for w in ws)}"""


@query("blend_grid_cls", W("acct_pred", _grid_sql()))
def q_blend_grid(spark, sf):
    """Accuracy of every step-0.1 weight vector of the five models (1,001
    candidates), scored in one scan."""
    p = _train(FX.acct_pred(spark, sf))
    grid = B.simplex_grid(M, 10)
    hits = B.candidate_hits(p, PROBS, "tier", grid)
    cands = B.candidate_table(spark, grid, [str(i) for i in range(M)])
    return hits.join(F.broadcast(cands), "cand").select(
        *[F.col(f"w_{i}").alias(f"w{i}") for i in range(M)], "hits", "n",
        q6(F.col("hits") / F.col("n")).alias("accuracy"))


@query("blend_convex_cls")
def q_blend_convex_cls(spark, sf):
    """Weights of the least log-loss, then a search by accuracy that starts there."""
    p = _train(FX.acct_pred(spark, sf))
    smooth, _, _ = B.blend_logloss_cls(p, PROBS, "tier")
    w, acc = B.blend_convex_cls(p, PROBS, "tier", rounds=3, start=smooth)
    rows = [(f"m{m}", float(w[m]), float(acc)) for m in range(M)]
    return spark.createDataFrame(rows, "model string, weight double, accuracy double")


def _logloss2_sql():
    """The two-model case by bisection: the derivative of a convex loss along the
    weight of the first model changes its sign once."""
    q = [f"greatest(CASE tier {' '.join(f'WHEN {k} THEN {c}' for k, c in enumerate(PROBS[m]))} END, 1e-12)" for m in (0, 1)]
    slope = "(SELECT sum((q0 - q1) / (mid * q0 + (1 - mid) * q1)) FROM q)"
    return W("acct_pred", f"""SELECT {sq6('w', '1e4')} AS w_m0, {sq6('1 - w', '1e4')} AS w_m1, {sq6('avg(-ln(w * q0 + (1 - w) * q1))')} AS logloss
FROM q, (SELECT (lo + hi) / 2 AS w FROM halves WHERE i = 45) GROUP BY w""", extra=[
        f"q AS (SELECT {q[0]} AS q0, {q[1]} AS q1 FROM acct_pred WHERE fold IS NOT NULL)",
        f"""halves(i, lo, hi) AS (SELECT 0, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE) UNION ALL
  SELECT i + 1, CASE WHEN up > 0 THEN mid ELSE lo END, CASE WHEN up > 0 THEN hi ELSE mid END
  FROM (SELECT i, lo, hi, mid, {slope} AS up FROM (SELECT *, (lo + hi) / 2 AS mid FROM halves WHERE i < 45)))"""]).replace("WITH ", "WITH RECURSIVE ", 1)


@query("blend_logloss_cls", _logloss2_sql())
def q_blend_logloss(spark, sf):
    """Log-loss-optimal weights of the first two models and their loss."""
    p = _train(FX.acct_pred(spark, sf))
    w, loss, _ = B.blend_logloss_cls(p, PROBS[:2], "tier", tol=1e-12)
    one = p.agg(F.count(F.lit(1)).alias("_n"))  # a one-row frame to carry the literals
    return one.select(q6(F.lit(float(w[0])), 1e4).alias("w_m0"), q6(F.lit(float(w[1])), 1e4).alias("w_m1"), q6(F.lit(loss)).alias("logloss"))


@query("blend_convex_reg")
def q_blend_convex_reg(spark, sf):
    p = _train(FX.acct_pred(spark, sf))
    st = B.gram_state(p, RATES, "rate")
    w = B.blend_convex_reg(st)
    r2 = B.r2_at(st, w)
    rows = [(f"m{m}", float(w[m]), r2) for m in range(M)]
    return spark.createDataFrame(rows, "model string, weight double, r2 double")


def _ridge2_sql(alpha=1.0):
    return f"""SELECT {sq6('ym - b1 * m1 - b2 * m2')} AS intercept, {sq6('b1')} AS w_m0, {sq6('b2')} AS w_m1
FROM (SELECT ym, m1, m2, ((a22 + {alpha}) * c1 - a12 * c2) / ((a11 + {alpha}) * (a22 + {alpha}) - a12 * a12) AS b1,
             ((a11 + {alpha}) * c2 - a12 * c1) / ((a11 + {alpha}) * (a22 + {alpha}) - a12 * a12) AS b2
      FROM (SELECT avg(rate) AS ym, avg(m0_rate) AS m1, avg(m1_rate) AS m2,
                   regr_sxx(m0_rate, m0_rate) AS a11, regr_sxy(m1_rate, m0_rate) AS a12, regr_sxx(m1_rate, m1_rate) AS a22,
                   regr_sxy(rate, m0_rate) AS c1, regr_sxy(rate, m1_rate) AS c2
            FROM acct_pred WHERE fold IS NOT NULL))"""


@query("blend_ridge_reg", W("acct_pred", _ridge2_sql()))
def q_ridge_reg(spark, sf):
    """Ridge (alpha=1, unpenalised intercept) of the rate on two models'
    predictions, from one Gram aggregate."""
    p = _train(FX.acct_pred(spark, sf))
    st = B.gram_state(p, ["m0_rate", "m1_rate"], "rate")
    b0, beta = B.blend_ridge_reg(st, 1.0)
    g = p.agg(F.count(F.lit(1)).alias("_n"))  # a one-row frame to carry the literals
    return g.select(q6(F.lit(b0)).alias("intercept"), q6(F.lit(float(beta[0]))).alias("w_m0"),
                    q6(F.lit(float(beta[1]))).alias("w_m1"))


@query("blend_ridge_cls")
def q_ridge_cls(spark, sf):
    p = FX.acct_pred(spark, sf)
    tr = _train(p)
    icpt, coef = B.blend_ridge_cls(tr, PROBS, "tier", alpha=1.0)
    feats = [c for mc in PROBS for c in mc]
    scores = []
    for k in range(5):
        s = F.lit(float(icpt[k]))
        for f, c in zip(feats, coef[k]):
            s = s + F.lit(float(c)) * F.col(f)
        scores.append(s)
    out = p.select("row_id", "split", "tier", E.argmax_class(F.array(*scores)).alias("cls"))
    return MT.accuracy(out.where(F.col("split") == "train"), "cls", "tier").select(
        F.lit("ridge_cls").alias("blend"), "accuracy", "n")


@query("blend_pick_winner")
def q_pick_winner(spark, sf):
    """Convex vs ridge rate blend: keep the higher in-sample R^2."""
    p = _train(FX.acct_pred(spark, sf))
    st = B.gram_state(p, RATES, "rate")
    w = B.blend_convex_reg(st)
    b0, beta = B.blend_ridge_reg(st, 1.0)
    r_convex, r_ridge = B.r2_at(st, w), B.r2_at(st, beta, b0)
    win = "ridge" if r_ridge > r_convex else "convex"
    return spark.createDataFrame([("convex", r_convex, win == "convex"), ("ridge", r_ridge, win == "ridge")],
                                 "method string, r2 double, chosen boolean")


def _class_weight_sql():
    b = _blend_sql(EQUAL)
    pt = "CASE tier " + " ".join(f"WHEN {k} THEN {b[k]}" for k in range(5)) + " END"
    return f"""SELECT tier, {sq6('avg(e) / (SELECT avg(e2) FROM (SELECT 1 - (' + pt + ') AS e2 FROM acct_pred WHERE fold IS NOT NULL))')} AS weight
FROM (SELECT tier, 1 - ({pt}) AS e FROM acct_pred WHERE fold IS NOT NULL) GROUP BY tier"""


@query("class_weight", W("acct_pred", _class_weight_sql()))
def q_class_weight(spark, sf):
    """Per-class sample weight = mean OOF error of the class / overall mean."""
    p = _train(FX.acct_pred(spark, sf))
    b = B.blend_columns(PROBS)
    d = p.select("tier", (F.lit(1.0) - F.element_at(F.array(*b), F.col("tier") + 1)).alias("e"))
    overall = d.agg(F.avg("e").alias("_all"), F.lit(1).alias("_k"))
    per = d.groupBy("tier").agg(F.avg("e").alias("_e")).withColumn("_k", F.lit(1))
    return per.join(F.broadcast(overall), "_k").select("tier", q6(F.col("_e") / F.col("_all")).alias("weight"))


# ------------------------------------------------------------ top-k / sample

def _conf_sql():
    b = _blend_sql(EQUAL)
    return f"greatest({', '.join(b)})"


@query("topk_confidence", W("acct_pred", f"""SELECT row_id, {sq6('conf')} AS conf FROM (
  SELECT row_id, {_conf_sql()} AS conf FROM acct_pred WHERE split = 'test')
WHERE conf >= 0.3 ORDER BY conf DESC, row_id LIMIT 100"""))
def q_topk_conf(spark, sf):
    p = FX.acct_pred(spark, sf).where(F.col("split") == "test")
    conf = F.array_max(F.array(*B.blend_columns(PROBS)))
    return topk_confidence(p, conf, 100, 0.3).select("row_id", q6("_conf").alias("conf"))


FEATS = ["delinquency", "log_total_value", "mortgage_ltv", "value_per_order", "n_orders", "late30", "late60", "late90"]
FEATS_SQL = """feats AS (SELECT *, 1.0 * late30 + 3.0 * late60 + 9.0 * late90 AS delinquency,
  ln(1 + greatest(coalesce(total_value, 0), 0)) AS log_total_value,
  CASE WHEN property_value IS NULL OR property_value = 0 OR mortgage_balance IS NULL THEN 0.0
       ELSE mortgage_balance / property_value END AS mortgage_ltv,
  CASE WHEN n_orders = 0 OR total_value IS NULL THEN 0.0 ELSE total_value / n_orders END AS value_per_order
FROM acct)"""


@query("topk_features", W("acct", "SELECT * FROM (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, {sq6(f'abs(corr({c}, rate))')} AS score FROM feats" for c in FEATS)
    + ") ORDER BY score DESC, feature LIMIT 5", extra=[FEATS_SQL]))
def q_topk_features(spark, sf):
    a = acct_features(FX.acct(spark, sf))
    c = corr_pairs(a, FEATS, target="rate").select(F.col("a").alias("feature"), q6(F.abs("corr")).alias("score"))
    return c.orderBy(F.desc("score"), "feature").limit(5)


@query("stratified_sample", W("acct", """SELECT row_id, tier FROM (
  SELECT row_id, tier, row_number() OVER (PARTITION BY tier ORDER BY md5('42|' || CAST(row_id AS VARCHAR))) AS rn
  FROM acct WHERE split = 'train') WHERE rn <= 100"""))
def q_strat_sample(spark, sf):
    a = FX.acct(spark, sf).where(F.col("split") == "train").select("row_id", "tier")
    return stratified_sample(a, "tier", 100, key="row_id", seed=42)


@query("rank_borda", W("acct", f"""SELECT feature, borda, CAST(row_number() OVER (ORDER BY borda, feature) AS INTEGER) AS borda_rank
FROM (SELECT feature, CAST(rank() OVER (ORDER BY s1 DESC) + rank() OVER (ORDER BY s2 DESC) AS BIGINT) AS borda
      FROM (""" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, {sq6(f'abs(corr({c}, rate))')} AS s1, {sq6(f'abs(corr({c}, tier))')} AS s2 FROM feats"
    for c in FEATS) + ")) QUALIFY borda_rank <= 5", extra=[FEATS_SQL]))
def q_borda(spark, sf):
    a = acct_features(FX.acct(spark, sf))
    s1 = corr_pairs(a, FEATS, target="rate").select(F.col("a").alias("feature"), q6(F.abs("corr")).alias("s1"))
    s2 = corr_pairs(a, FEATS, target="tier").select(F.col("a").alias("feature"), q6(F.abs("corr")).alias("s2"))
    r = rank_borda(s1.join(s2, "feature"), "feature", ["s1", "s2"], top=5)
    return r.select("feature", "borda", F.col("borda_rank").cast("int").alias("borda_rank"))


# ------------------------------------------------------------- pseudo labels

def _pseudo_sql(n=100, t=0.3):
    b = _blend_sql(EQUAL)
    rate = f"greatest(4.99, least(35.99, {_scalar_sql(RATES, EQUAL)}))"
    return f"""pseudo AS (SELECT row_id, {_argmax_sql(b)} AS tier, {rate} AS rate, {_conf_sql()} AS conf
  FROM acct_pred WHERE split = 'test' AND {_conf_sql()} >= {t} ORDER BY conf DESC, row_id LIMIT {n})"""


@query("pseudo_label", W("acct_pred", f"""SELECT row_id, tier, {sq6('rate')} AS rate, 0 AS is_pseudo FROM acct_pred WHERE split = 'train'
UNION ALL SELECT row_id, tier, {sq6('rate')}, 1 FROM pseudo""", extra=[_pseudo_sql()]))
def q_pseudo(spark, sf):
    p = FX.acct_pred(spark, sf)
    test = p.where(F.col("split") == "test").select(
        "row_id", *[c.alias(f"b{k}") for k, c in enumerate(B.blend_columns(PROBS))],
        B.blend_scalar(RATES).alias("rate_blend"))
    ps = pseudo_label(test, [f"b{k}" for k in range(5)], "rate_blend", n=100, threshold=0.3)
    train = p.where(F.col("split") == "train").select("row_id", "tier", "rate")
    u = append_pseudo(train, ps, p.select("row_id"))
    return u.select("row_id", "tier", q6("rate").alias("rate"), F.col("is_pseudo").cast("int").alias("is_pseudo"))


ROUND2_W = [0.05, 0.1, 0.15, 0.3, 0.4]


def _round2_sql(n=150, t=0.25):
    b = _blend_sql(ROUND2_W)
    conf = f"greatest({', '.join(b)})"
    rate = f"greatest(4.99, least(35.99, {_scalar_sql(RATES, ROUND2_W)}))"
    return W("acct_pred", f"""SELECT row_id, tier, {sq6('conf')} AS conf, {sq6('rate')} AS rate FROM (
  SELECT row_id, {_argmax_sql(b)} AS tier, {conf} AS conf, {rate} AS rate FROM acct_pred
  WHERE split = 'test' AND {conf} >= {t} ORDER BY conf DESC, row_id LIMIT {n})""")


@query("pseudo_round2", _round2_sql())
def q_pseudo2(spark, sf):
    """Second round: reweighted blend, looser threshold, more rows."""
    p = FX.acct_pred(spark, sf)
    w = ROUND2_W
    test = p.where(F.col("split") == "test").select(
        "row_id", *[c.alias(f"b{k}") for k, c in enumerate(B.blend_columns(PROBS, w))],
        B.blend_scalar(RATES, w).alias("rate_blend"))
    r = pseudo_label(test, [f"b{k}" for k in range(5)], "rate_blend", n=150, threshold=0.25)
    return r.select("row_id", "tier", q6("conf").alias("conf"), q6("rate").alias("rate"))


@query("pad_pseudo_features", W("acct_pred", f"""SELECT a.row_id, CAST(u.is_pseudo AS INTEGER) AS is_pseudo,
  {sq6("CASE WHEN u.is_pseudo = 1 THEN coalesce(CASE WHEN a.split = 'train' THEN a.m0_rate END, a.m1_rate) ELSE CASE WHEN a.split = 'train' THEN a.m0_rate END END")} AS oof_rate
FROM (SELECT row_id, 0 AS is_pseudo FROM acct_pred WHERE split = 'train' UNION ALL SELECT row_id, 1 FROM pseudo) u
JOIN acct_pred a ON a.row_id = u.row_id""", extra=[_pseudo_sql()]))
def q_pad(spark, sf):
    p = FX.acct_pred(spark, sf)
    test = p.where(F.col("split") == "test").select(
        "row_id", *[c.alias(f"b{k}") for k, c in enumerate(B.blend_columns(PROBS))])
    ps = pseudo_label(test, [f"b{k}" for k in range(5)], None, n=100, threshold=0.3).select("row_id")
    u = p.where(F.col("split") == "train").select("row_id", F.lit(0).alias("is_pseudo")).unionByName(
        ps.select("row_id", F.lit(1).alias("is_pseudo")))
    j = u.join(p.select("row_id", "split", "m0_rate", "m1_rate"), "row_id")
    oof = F.when(F.col("split") == "train", F.col("m0_rate"))
    return j.select("row_id", F.col("is_pseudo").cast("int").alias("is_pseudo"),
                    q6(pad_pseudo(oof, F.col("m1_rate"), F.col("is_pseudo"))).alias("oof_rate"))


