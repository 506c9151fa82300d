"""Queries for sections 2.3 (joins), 2.9 (neighbours, drift) and 2.10
(feature selection)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabstack.operators import drift as DR
from tabstack.operators import models as ML
from tabstack.operators import select as SL
from tabstack.operators._util import bounded_broadcast
from tabstack.operators.aggregates import corr_pairs
from tabstack.operators.frames import union_rows
from tabstack.operators.knn_info import knn_mutual_information, knn_mutual_information_numeric
from tabstack.operators.linear import gram_by
from tabstack.operators.neighbours import knn_candidates, knn_target
from tabstack.plans import fixtures as FX
from tabstack.plans.flagship import acct_features
from tabstack.plans.registry import q6, query, sq6
from tabstack.session import cut_lineage
from tabstack.sources import store as ST

W = FX.with_sql
K_NEIGHBOURS = 10


# ---------------------------------------------------------------- neighbours

def _knn_sql(k=K_NEIGHBOURS, stats=True):
    cand = f"""cand AS (
  SELECT q.vec_id AS q_id, r.vec_id AS n_id, r.label AS n_label, CAST(r.embedding[1] AS DOUBLE) AS n_y,
         list_distance(CAST(q.embedding AS DOUBLE[]), CAST(r.embedding AS DOUBLE[])) AS dist
  FROM vec q JOIN vec r ON r.split = 'train' AND (q.fold IS NULL OR r.fold <> q.fold)),
top AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY dist, n_id) AS rk FROM cand QUALIFY rk <= {k})"""
    if not stats:
        return W("vec", "SELECT q_id, n_id, CAST(rk AS INTEGER) AS rk FROM top", extra=[cand])
    fr = ", ".join(f"{sq6(f'avg(CAST(n_label = {c} AS DOUBLE))')} AS knn_frac_{c}" for c in range(10))
    return W("vec", f"""SELECT q_id AS vec_id, {sq6('avg(n_y)')} AS knn_mean, {sq6('stddev_pop(n_y)')} AS knn_std,
  count(*) AS knn_n, {fr} FROM top GROUP BY q_id""", extra=[cand])


def _vec(spark, sf):
    v = cut_lineage(FX.vec(spark, sf))     # counted and read on both sides
    return v.withColumn("y", F.col("embedding")[0].cast("double"))


@query("knn_target", _knn_sql())
def q_knn(spark, sf):
    """k=10 neighbours (Euclidean): train rows see other folds only, test
    rows all train rows; mean / population std of a target and class shares."""
    v = _vec(spark, sf)
    out = knn_target(v, v.where(F.col("split") == "train"), "vec_id", "embedding", K_NEIGHBOURS, "y",
                     label="label", classes=range(10), fold="fold")
    return out.select("vec_id", q6("knn_mean").alias("knn_mean"), q6("knn_std").alias("knn_std"), "knn_n",
                      *[q6(f"knn_frac_{c}").alias(f"knn_frac_{c}") for c in range(10)])


@query("topk_neighbour_join", _knn_sql(5, stats=False))
def q_knn_join(spark, sf):
    """The neighbour list itself (5 nearest, rank by distance then id)."""
    from pyspark.sql import Window
    v = _vec(spark, sf)
    c = knn_candidates(v, v.where(F.col("split") == "train"), "vec_id", "embedding", 5, "fold")
    w = Window.partitionBy("q_id").orderBy("dist", "n_id")  # <= 5 rows per query
    return c.select("q_id", "n_id", F.row_number().over(w).cast("int").alias("rk"))


# -------------------------------------------------------------------- drift

DOC_FEATS = ["n_chars", "n_words", "n_lines", "n_digits"]


def _uauc_sql(f):
    return f"""SELECT '{f}' AS feature, (sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y))) AS auc
FROM (SELECT y, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS r
      FROM (SELECT CAST({f} AS DOUBLE) AS x, is_labelled AS y FROM doc_semi WHERE {f} IS NOT NULL))"""


@query("adversarial_prune", W("doc_semi", f"""SELECT feature, {sq6('auc')} AS auc, {sq6('abs(auc - 0.5)')} AS drift,
  CAST(max(greatest(auc, 1 - auc)) OVER () >= 0.52 AND row_number() OVER (ORDER BY abs(auc - 0.5) DESC, feature) <= 2 AS INTEGER) AS dropped
FROM ({' UNION ALL '.join(_uauc_sql(f) for f in DOC_FEATS)})"""))
def q_adv_prune(spark, sf):
    """Univariate drift score (AUC of labelled vs unlabelled documents) per
    feature; drop the two strongest suspects if any AUC reaches 0.52."""
    d = FX.doc_semi(spark, sf)
    s = DR.univariate_auc(d, DOC_FEATS, "is_labelled").select("feature", "auc")
    p = DR.prune_suspects(s, top=2, threshold=0.52)
    return p.select("feature", q6("auc").alias("auc"), q6("drift").alias("drift"), "dropped")


@query("adversarial_auc")
def q_adv_auc(spark, sf):
    """Adversarial validation: forest out of fold, AUC + importances."""
    d = FX.doc_semi(spark, sf).select("doc_id", "is_labelled", *DOC_FEATS)
    a, imps = DR.adversarial_auc(d, DOC_FEATS, "is_labelled", "doc_id")
    auc_v = a.collect()[0]["auc"]
    return spark.createDataFrame([(f, float(v), float(auc_v)) for f, v in imps],
                                 "feature string, importance double, auc double")


# ---------------------------------------------------------------- selection

SEL = ["n_orders", "late30", "late60", "late90", "delinquency", "total_value", "log_total_value",
       "value_per_order", "mortgage_ltv", "balance"]
FEATS_SQL = """feats AS (SELECT *, 1.0 * late30 + 3.0 * late60 + 9.0 * late90 AS delinquency,
  ln(1 + greatest(coalesce(total_value, 0), 0)) AS log_total_value,
  CASE WHEN property_value IS NULL OR property_value = 0 OR mortgage_balance IS NULL THEN 0.0
       ELSE mortgage_balance / property_value END AS mortgage_ltv,
  CASE WHEN n_orders = 0 OR total_value IS NULL THEN 0.0 ELSE total_value / n_orders END AS value_per_order
FROM acct WHERE split = 'train')"""


def _sel_frame(spark, sf):
    a = acct_features(FX.acct(spark, sf)).where(F.col("split") == "train")
    return a.select("row_id", "tier", "rate", *SEL)


def _mi_sql_one(f):
    return f"""SELECT '{f}' AS feature, sum(nxy / n * ln(nxy * n / (nx * ny))) AS mi FROM (
  SELECT b, y, count(*) AS nxy, sum(count(*)) OVER (PARTITION BY b) AS nx, sum(count(*)) OVER (PARTITION BY y) AS ny,
         sum(count(*)) OVER () AS n
  FROM (SELECT CASE WHEN w > 0 THEN least(floor((CAST({f} AS DOUBLE) - lo) / w), 9) ELSE 0 END AS b, tier AS y
        FROM feats, (SELECT min(CAST({f} AS DOUBLE)) AS lo, (max(CAST({f} AS DOUBLE)) - min(CAST({f} AS DOUBLE))) / 10 AS w
                     FROM feats WHERE {f} IS NOT NULL) s WHERE {f} IS NOT NULL)
  GROUP BY b, y)"""


MI_SQL = "mi AS (" + " UNION ALL ".join(_mi_sql_one(f) for f in SEL) + ")"


@query("sel_mutual_info", W("acct", f"SELECT feature, {sq6('mi')} AS mi FROM mi", extra=[FEATS_SQL, MI_SQL]))
def q_mi(spark, sf):
    """Plug-in mutual information of 10-bin features with the class."""
    m = SL.mutual_information(_sel_frame(spark, sf), SEL, "tier", 10)
    return m.select("feature", q6("mi").alias("mi"))


def _psi_sql(e):
    y = f"(CAST({e} AS DOUBLE) + 8.0)"
    z = f"(1.0 / ({y} * {y}))"
    back = " - ".join(f"1.0 / (CAST({e} AS DOUBLE) + {j}.0)" for j in range(8))
    return f"(ln({y}) - 0.5 / {y} - {z} * (1.0 / 12.0 - {z} * (1.0 / 120.0 - {z} / 252.0)) - {back})"


KNN_MI_SQL = [
    FEATS_SQL,
    "long AS (" + " UNION ALL ".join(f"SELECT '{f}' AS feature, row_id, CAST({f} AS DOUBLE) AS x, tier AS y FROM feats WHERE {f} IS NOT NULL" for f in SEL) + ")",
    "sized AS (SELECT *, count(*) OVER (PARTITION BY feature, y) AS ny, count(*) OVER (PARTITION BY feature, y, x) AS c FROM long QUALIFY ny > 1)",
    "spread AS (SELECT *, list_sort([" + ", ".join(f"abs(x - {side}(x, {i}) OVER w)" for side in ("lag", "lead") for i in (1, 2, 3))
    + "], 'ASC', 'NULLS LAST')[least(3, ny - 1)] AS r FROM sized WINDOW w AS (PARTITION BY feature, y ORDER BY x, row_id))",
    "balls AS (SELECT *, greatest(0.0, r - 1e-15 * (abs(x) + r)) AS inn FROM spread)",
    """met AS (SELECT a.feature, a.row_id, a.ny, a.r, a.c, count(*) AS m FROM balls a JOIN balls b
  ON a.feature = b.feature AND b.x >= a.x - a.inn AND b.x <= a.x + a.inn GROUP BY ALL)"""]


@query("sel_mutual_info_knn", W("acct", f"""SELECT feature, count(*) AS n,
  {sq6(f"greatest(0.0, {_psi_sql('count(*)')} + avg({_psi_sql('CASE WHEN r = 0 THEN c ELSE least(3, ny - 1) END')} - {_psi_sql('ny')} - {_psi_sql('m')}))")} AS mi
FROM met GROUP BY feature""", extra=KNN_MI_SQL))
def q_mi_knn(spark, sf):
    """Mutual information with the class by the three nearest rows of the class."""
    m = knn_mutual_information(_sel_frame(spark, sf), SEL, "tier", 3)
    return m.select("feature", "n", q6("mi").alias("mi"))


KNN_MI_RATE_SQL = [
    FEATS_SQL,
    "long AS (" + " UNION ALL ".join(f"SELECT '{f}' AS feature, row_id, CAST({f} AS DOUBLE) AS x, CAST(rate AS DOUBLE) AS y FROM feats WHERE {f} IS NOT NULL" for f in SEL) + ")",
    """unit AS (SELECT l.feature, row_id, x / CASE WHEN sx > 0 THEN sx ELSE 1.0 END AS x, y / CASE WHEN sy > 0 THEN sy ELSE 1.0 END AS y, n
  FROM long l JOIN (SELECT feature, stddev_pop(x) AS sx, stddev_pop(y) AS sy, count(*) AS n FROM long GROUP BY feature) s ON l.feature = s.feature)""",
    """near AS (SELECT a.feature, a.row_id, a.x, a.y, a.n, min(greatest(abs(a.x - b.x), abs(a.y - b.y)), 4) AS d,
  count(CASE WHEN a.x = b.x AND a.y = b.y THEN 1 END) AS c FROM unit a JOIN unit b ON a.feature = b.feature GROUP BY ALL)""",
    "balls AS (SELECT *, d[CAST(least(3, n - 1) + 1 AS BIGINT)] AS r FROM near)",
    """met AS (SELECT a.feature, a.row_id, a.n, a.r, a.c,
  count(CASE WHEN abs(b.x - a.x) <= greatest(0.0, a.r - 1e-15 * (abs(a.x) + a.r)) THEN 1 END) AS nx,
  count(CASE WHEN abs(b.y - a.y) <= greatest(0.0, a.r - 1e-15 * (abs(a.y) + a.r)) THEN 1 END) AS ny
  FROM balls a JOIN unit b ON a.feature = b.feature GROUP BY ALL)"""]


@query("sel_mutual_info_rate", W("acct", f"""SELECT feature, n,
  {sq6(f"greatest(0.0, {_psi_sql('n')} + avg({_psi_sql('CASE WHEN r = 0 THEN c ELSE least(3, n - 1) END')} - {_psi_sql('nx')} - {_psi_sql('ny')}))")} AS mi
FROM met GROUP BY feature, n""", extra=KNN_MI_RATE_SQL))
def q_mi_rate(spark, sf):
    """Mutual information with the rate by the three nearest rows in the plane of both."""
    m = knn_mutual_information_numeric(_sel_frame(spark, sf), SEL, "rate", 3)
    return m.select("feature", "n", q6("mi").alias("mi"))


SIG_SQL = ("sig AS (SELECT c.feature, c.cr, c.ct, mi.mi FROM (" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, abs(corr({f}, rate)) AS cr, abs(corr({f}, tier)) AS ct FROM feats" for f in SEL)
    + ") c JOIN mi ON mi.feature = c.feature)")
CONS_SQL = """cons AS (SELECT feature, cr / max(cr) OVER () AS cr_n, ct / max(ct) OVER () AS ct_n, mi / max(mi) OVER () AS mi_n,
  greatest(cr / max(cr) OVER (), ct / max(ct) OVER (), mi / max(mi) OVER ()) AS max_signal FROM sig)"""


def _signals(spark, sf):
    d = _sel_frame(spark, sf)
    cr = corr_pairs(d, SEL, target="rate").select(F.col("a").alias("feature"), F.abs("corr").alias("cr"))
    ct = corr_pairs(d, SEL, target="tier").select(F.col("a").alias("feature"), F.abs("corr").alias("ct"))
    mi = SL.mutual_information(d, SEL, "tier", 10)
    return cr.join(ct, "feature").join(mi, "feature")


@query("sel_consensus", W("acct", f"""SELECT feature, {sq6('max_signal')} AS max_signal, CAST(max_signal < 0.05 AS INTEGER) AS dropped FROM cons""",
                          extra=[FEATS_SQL, MI_SQL, SIG_SQL, CONS_SQL]))
def q_consensus(spark, sf):
    """Max of the max-normalised signals (|corr| with both targets, MI with
    the class); below 5 % on every signal -> dropped."""
    c = SL.consensus(_signals(spark, sf), "feature", ["cr", "ct", "mi"], 0.05)
    return c.select("feature", q6("max_signal").alias("max_signal"), "dropped")


def _prune_sql(thr=0.95):
    pairs = " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM feats"
        for i, a in enumerate(SEL) for b in SEL[i + 1:])
    return f"""SELECT f.feature, CAST(f.feature IN (
    SELECT CASE WHEN sa.max_signal >= sb.max_signal THEN p.b ELSE p.a END
    FROM ({pairs}) p JOIN cons sa ON sa.feature = p.a JOIN cons sb ON sb.feature = p.b WHERE abs(p.r) > {thr}) AS INTEGER) AS dropped
FROM cons f"""


@query("sel_corr_prune", W("acct", _prune_sql(), extra=[FEATS_SQL, MI_SQL, SIG_SQL, CONS_SQL]))
def q_corr_prune(spark, sf):
    """Of every pair with |rho| > 0.95 the member with the weaker consensus
    signal is dropped (the later column on a tie)."""
    d = _sel_frame(spark, sf)
    corr = [(r["a"], r["b"], r["corr"]) for r in corr_pairs(d, SEL).collect()]  # p(p-1)/2 rows
    sig = {r["feature"]: r["max_signal"] for r in
           SL.consensus(_signals(spark, sf), "feature", ["cr", "ct", "mi"]).collect()}  # p rows
    losers = set(SL.corr_prune_losers(corr, SEL, sig, 0.95))
    return spark.createDataFrame([(f, int(f in losers)) for f in SEL], "feature string, dropped int")


@query("sel_chi2", W("acct", f"""SELECT {sq6('sum((coalesce(o, 0) - e) * (coalesce(o, 0) - e) / e)')} AS chi2,
  CAST((count(DISTINCT segment) - 1) * (count(DISTINCT tier) - 1) AS BIGINT) AS dof
FROM (SELECT a.segment, b.tier, a.na * b.nb / n.n AS e, c.o
      FROM (SELECT segment, count(*) AS na FROM acct WHERE split = 'train' GROUP BY segment) a
      CROSS JOIN (SELECT tier, count(*) AS nb FROM acct WHERE split = 'train' GROUP BY tier) b
      CROSS JOIN (SELECT count(*) AS n FROM acct WHERE split = 'train') n
      LEFT JOIN (SELECT segment, tier, count(*) AS o FROM acct WHERE split = 'train' GROUP BY segment, tier) c
        ON c.segment = a.segment AND c.tier = b.tier)"""))
def q_chi2(spark, sf):
    """Chi-square of segment vs class (only non-empty cells are touched)."""
    a = FX.acct(spark, sf).where(F.col("split") == "train")
    return SL.chi2_table(a, "segment", "tier").select(q6("chi2").alias("chi2"), "dof")


def _anova_sql_one(f):
    return f"""SELECT '{f}' AS feature, (sum(ng * (mg - m) * (mg - m)) / (count(*) - 1)) / (max(ssw) / (sum(ng) - count(*))) AS f
FROM (SELECT tier, count(*) AS ng, avg(CAST({f} AS DOUBLE)) AS mg FROM feats WHERE {f} IS NOT NULL GROUP BY tier) g,
     (SELECT avg(CAST({f} AS DOUBLE)) AS m FROM feats WHERE {f} IS NOT NULL) a,
     (SELECT sum((CAST({f} AS DOUBLE) - gm) * (CAST({f} AS DOUBLE) - gm)) AS ssw
      FROM (SELECT {f}, avg(CAST({f} AS DOUBLE)) OVER (PARTITION BY tier) AS gm FROM feats WHERE {f} IS NOT NULL)) w"""


@query("sel_anova_f", W("acct", f"SELECT feature, {sq6('f', '1e4')} AS f FROM (" +
                        " UNION ALL ".join(_anova_sql_one(f) for f in SEL) + ")", extra=[FEATS_SQL]))
def q_anova(spark, sf):
    """One-way ANOVA F of every feature across classes (4 decimals: the
    within-group sum of squares is computed by two different routes)."""
    a = SL.anova_f(_sel_frame(spark, sf), SEL, "tier")
    return a.select("feature", q6("f", 1e4).alias("f"))


@query("sel_stepwise_ic")
def q_stepwise(spark, sf):
    """Forward selection by AIC from one Gram aggregate."""
    d = _sel_frame(spark, sf)
    g = gram_by(d, SEL, "rate")[0]
    path = SL.stepwise_forward(g, SEL, "aic")
    return spark.createDataFrame(path, "step int, feature string, rss double, aic double")


@query("sel_l1")
def q_l1(spark, sf):
    """L1 linear model; features with zero weight are dropped (gaps: train median)."""
    from pyspark.ml.regression import LinearRegression
    from tabstack.operators.encode import fit_scaler, scale_columns
    d = cut_lineage(ML.fill_missing(_sel_frame(spark, sf), SEL))
    d = d.withColumns(scale_columns(fit_scaler(d, SEL, "standard")))
    m = LinearRegression(featuresCol="features", labelCol="rate", elasticNetParam=1.0, regParam=0.05) \
        .fit(ML.assemble(d, SEL))
    return spark.createDataFrame([(f, float(c), int(abs(c) < 1e-12)) for f, c in zip(SEL, m.coefficients)],
                                 "feature string, weight double, dropped int")


@query("sel_rfe")
def q_rfe(spark, sf):
    """Recursive elimination: refit, drop the two least important, repeat (gaps: train median)."""
    d = cut_lineage(ML.fill_missing(_sel_frame(spark, sf), SEL))
    left, rows, step = list(SEL), [], 0
    while len(left) > 4:
        imp = ML.feature_importance(d, left, "rate", "reg")
        for f, _ in imp[-2:]:
            rows.append((step, f))
            left.remove(f)
        step += 1
    return spark.createDataFrame(rows + [(step, f) for f in left], "eliminated_at int, feature string")


@query("sel_permutation")
def q_permutation(spark, sf):
    """Permutation importance: R^2 drop of a fitted linear model when one
    column is permuted (bucketed hash order, no global sort).  The rows are
    prepared once, and one pass permutes every column and scores them all."""
    from tabstack.operators.linear import linear_prediction, solve_ridge
    d = cut_lineage(_sel_frame(spark, sf).withColumn("fold", F.lit(None).cast("int")))
    g = gram_by(d, SEL, "rate")[0]
    beta = solve_ridge(g[0], g[1], 1e-6)
    y = F.col("rate").cast("double")
    mean = d.agg(F.avg(y)).first()[0]
    p = SL.permuted(d, SEL, "row_id")
    sums = [F.sum((y - F.lit(mean)) ** 2).alias("sst")]
    for at, f in enumerate([None, *SEL]):
        pred = linear_prediction([f"{c}_permuted" if c == f else c for c in SEL], {}, beta, "fold")
        sums.append(F.sum((y - pred) ** 2).alias(f"sse{at}"))
    s = p.agg(*sums).first()
    r2 = [1.0 - s[f"sse{at}"] / s["sst"] for at in range(len(SEL) + 1)]
    return spark.createDataFrame([(f, float(r2[0] - r)) for f, r in zip(SEL, r2[1:])], "feature string, r2_drop double")


GEN = ["n_orders", "late90", "total_value"]


def _gen_sql():
    parts = []
    for i, a in enumerate(GEN):
        for b in GEN[i + 1:]:
            parts.append(f"{sq6(f'CAST({a} AS DOUBLE) * CAST({b} AS DOUBLE)')} AS {a}_x_{b}")
            parts.append(sq6(f"CASE WHEN ({b} + 1) IS NULL OR ({b} + 1) = 0 OR {a} IS NULL THEN 0.0 "
                             f"ELSE CAST({a} AS DOUBLE) / CAST({b} + 1 AS DOUBLE) END") + f" AS {a}_per_{b}")
        parts.append(f"{sq6(f'sqrt(abs(CAST({a} AS DOUBLE)))')} AS {a}_sqrt")
        parts.append(f"{sq6(f'CAST({a} AS DOUBLE) * CAST({a} AS DOUBLE)')} AS {a}_sq")
        sk = (f"(SELECT avg(power(CAST({a} AS DOUBLE) - m, 3)) / power(avg(power(CAST({a} AS DOUBLE) - m, 2)), 1.5) "
              f"FROM acct, (SELECT avg(CAST({a} AS DOUBLE)) AS m FROM acct) s)")
        parts.append(sq6(f"CASE WHEN {sk} > 2 THEN ln(1 + greatest(coalesce(CAST({a} AS DOUBLE), 0), 0)) "
                         f"ELSE CAST({a} AS DOUBLE) END") + f" AS {a}_unskewed")
    return W("acct", "SELECT row_id, " + ", ".join(parts) + " FROM acct")


@query("gen_pairwise", _gen_sql())
def q_gen_pairwise(spark, sf):
    """Generated features: pairwise products and a/(b+1) ratios, sqrt and
    square, and log1p where the (population) skewness exceeds 2."""
    from tabstack.operators.generate import pairwise_columns
    a = FX.acct(spark, sf)
    cols = pairwise_columns(a, GEN, skew_threshold=2.0)
    return a.select("row_id", *[q6(c).alias(n) for n, c in cols.items()])


# ------------------------------------------------------------------ 2.3 joins

@query("join_map_lookup", W("acct", f"""SELECT row_id, {sq6('coalesce(t.m, g.mu)')} AS seg_rate
FROM acct_cat a CROSS JOIN (SELECT avg(rate) AS mu FROM acct WHERE split = 'train') g
LEFT JOIN (SELECT coalesce(seg_urgent, 'NA') AS k, avg(rate) AS m FROM acct_cat WHERE split = 'train' GROUP BY 1) t
  ON t.k = coalesce(a.seg_urgent, 'NA')""",
                            extra=["acct_cat AS (SELECT *, CASE WHEN late90 > 2 THEN segment END AS seg_urgent FROM acct)"]))
def q_map_lookup(spark, sf):
    """Left lookup into a fitted per-key table (NULL key -> 'NA' first,
    unseen key -> the default)."""
    a = FX.acct(spark, sf).withColumn("seg_urgent", F.coalesce(
        F.when(F.col("late90") > 2, F.col("segment")), F.lit("NA")))
    tr = a.where(F.col("split") == "train")
    table = tr.groupBy("seg_urgent").agg(F.avg("rate").alias("m"))
    mu = tr.agg(F.avg("rate")).collect()[0][0]
    j = a.join(bounded_broadcast(table), "seg_urgent", "left")
    return j.select("row_id", q6(F.coalesce(F.col("m"), F.lit(mu))).alias("seg_rate"))


@query("join_columns_by_row", W("acct_pred", f"""SELECT a.row_id, a.tier, {', '.join(f"{sq6(f'p.m{m}_rate')} AS m{m}" for m in range(5))}
FROM acct a JOIN acct_pred p ON p.row_id = a.row_id"""))
def q_columns_by_row(spark, sf):
    """Side-by-side alignment by key: long OOF table pivoted to one column
    per model, joined to the feature rows on row_id (never by position)."""
    p = FX.acct_pred(spark, sf)
    long = None
    for m in range(5):
        x = p.select("row_id", F.lit(f"m{m}").alias("model"), F.col(f"m{m}_rate").alias("v"))
        long = x if long is None else long.unionByName(x)
    wide = ST.pivot_models(long, [f"m{m}" for m in range(5)], value="v")
    a = FX.acct(spark, sf).select("row_id", "tier")
    j = a.join(wide, "row_id")
    return j.select("row_id", "tier", *[q6(f"m{m}").alias(f"m{m}") for m in range(5)])


@query("union_rows", W("acct", """SELECT row_id, rate, 'train' AS source FROM acct WHERE split = 'train'
UNION ALL SELECT row_id, NULL, 'test' FROM acct WHERE split = 'test'"""))
def q_union(spark, sf):
    """Stack train over test by column name with a source tag."""
    a = FX.acct(spark, sf)
    return union_rows({"train": a.where(F.col("split") == "train").select("row_id", "rate"),
                       "test": a.where(F.col("split") == "test").select("row_id")}).select("row_id", "rate", "source")

