"""Findings of round 3, each on rows built here."""

import importlib

import pytest
from pyspark.sql import functions as F

from tabstack.plans.registry import QUERIES, load_all


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """600 customers, every tenth without an order (so without an order value)."""
    d = str(tmp_path_factory.mktemp("sf"))
    h = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "id"), F.lit(n))
    spark.range(600).select(
        F.col("id").alias("c_custkey"), F.concat(F.lit("SEG"), h("s", 3)).alias("c_mktsegment"), h("n", 5).cast("int").alias("c_nationkey"),
        (h("b", 1_100_000) / 100.0 - 1000).alias("c_acctbal")).write.parquet(f"{d}/customer.parquet")
    orders = spark.range(6000).select(
        F.col("id").alias("o_orderkey"), h("c", 600).alias("o_custkey"), F.element_at(F.array(*map(F.lit, "FOP")), (h("t", 3) + 1).cast("int")).alias("o_orderstatus"),
        (h("p", 40_000_000) / 100.0).alias("o_totalprice"), F.when(h("u", 3) == 0, "1-URGENT").when(h("u", 3) == 1, "5-LOW").otherwise("3-MEDIUM").alias("o_orderpriority"))
    orders.where("o_custkey % 10 <> 3").write.parquet(f"{d}/orders.parquet")
    load_all()
    return d


def test_sel_l1_and_sel_rfe_with_customers_without_orders(spark, tables):
    l1 = {r["feature"]: r for r in QUERIES["sel_l1"](spark, tables).collect()}
    assert len(l1) == 10 and l1["balance"]["weight"] < 0 and not l1["balance"]["dropped"]
    rfe = {r["feature"]: r["eliminated_at"] for r in QUERIES["sel_rfe"](spark, tables).collect()}
    assert sorted(rfe.values()) == [0, 0, 1, 1, 2, 2, 3, 3, 3, 3] and rfe["balance"] == 3


def test_fill_missing_takes_the_median_of_known_values(spark):
    ML = importlib.import_module("tabstack.operators.models")
    d = spark.createDataFrame([(1.0, None, 1), (3.0, None, None), (None, None, 5), (float("nan"), None, 7)], "a double, b double, c int")
    rows = ML.fill_missing(d, ["a", "b", "c"]).collect()
    assert [tuple(r) for r in rows] == [(1.0, 0.0, 1.0), (3.0, 0.0, 5.0), (2.0, 0.0, 5.0), (2.0, 0.0, 7.0)]


def _plain_nearest(Q, qf, R, ids, rf, k):
    np = importlib.import_module("numpy")
    out = []
    for i, q in enumerate(Q):
        d = np.zeros(len(R))
        for j in range(R.shape[1]):
            d += (q[j] - R[:, j]) ** 2
        d = np.sqrt(d)
        seen = [c for c in range(len(R)) if (qf[i] < 0 or rf[c] != qf[i]) and np.isfinite(d[c])]
        out += [(i, ids[c], d[c]) for c in sorted(seen, key=lambda c: (d[c], ids[c]))[:k]]
    return out


@pytest.mark.parametrize("kind", ["random", "copies", "far", "huge", "one fold"])
def test_nearest_in_block_equals_the_plain_way(kind):
    np = importlib.import_module("numpy")
    N = importlib.import_module("tabstack.operators.neighbours")
    rng = np.random.default_rng(1)
    R = rng.normal(size=(300, 8)).astype(np.float32).astype(float)
    if kind == "copies":        # many ties
        R = R[rng.integers(0, 12, 300)]
    if kind == "far":           # a large offset: the product loses most digits
        R = R + 1e6
    if kind == "huge":          # squares beyond a double
        R = R * np.where(rng.random((300, 1)) < 0.5, 1e200, 1.0)
    Q, ids = R[rng.integers(0, 300, 90)], rng.permutation(300) + 1000
    qf, rf = rng.integers(-1, 3, 90), rng.integers(0, 1 if kind == "one fold" else 3, 300)
    rows, cols, dist = N.nearest_in_block(Q, qf, R, ids, rf, 7)
    with np.errstate(over="ignore", invalid="ignore"):
        assert [*zip(rows, ids[cols], dist)] == _plain_nearest(Q, qf, R, ids, rf, 7)


def test_neighbour_blocks_stay_few_and_rows_without_vector_stay_out(spark, monkeypatch):
    """Each row is copied to every block of the other side: with blocks of 100 rows the copies outgrew the disk."""
    N = importlib.import_module("tabstack.operators.neighbours")
    v = spark.range(1200).select(F.col("id").alias("vec_id"), F.array(*[F.rand(s).cast("float") for s in range(6)]).alias("embedding"),
                                 (F.col("id") % 5).cast("int").alias("fold"))
    v = v.withColumn("embedding", F.when(F.col("vec_id") == 7, None).otherwise(F.col("embedding"))).localCheckpoint()
    few = N.knn_candidates(v, v, "vec_id", "embedding", 3)
    many = N.knn_candidates(v, v, "vec_id", "embedding", 3, block_rows=100)
    key = lambda d: sorted((r["q_id"], r["n_id"], r["dist"]) for r in d.collect())
    got = key(few)
    assert got == key(many) and len(got) == 3 * 1199 and not any(7 in r[:2] for r in got)
    blocks = []
    monkeypatch.setattr(N, "_block", lambda col, n: blocks.append(n) or F.pmod(F.xxhash64(F.col(col)), F.lit(n)).cast("int"))
    v = spark.range(40_000).select(F.col("id").alias("vec_id"), F.array(F.lit(0.5)).alias("embedding"), F.lit(None).cast("int").alias("fold"))
    N.knn_candidates(v, v, "vec_id", "embedding", 3)
    assert max(blocks) <= 16


def test_fit_quantile_gives_the_quantiles_of_each_rows_score_bin(spark, tables):
    entry = importlib.import_module("tabstack.plans.registry")
    assert "quantile_cont" in entry.ORACLES["fit_quantile"]
    got = {r["row_id"]: r for r in QUERIES["fit_quantile"](spark, tables).collect()}
    bins = {r["bin"]: r for r in QUERIES["quantile_bins"](spark, tables).collect()}
    np = importlib.import_module("numpy")
    rows = importlib.import_module("tabstack.plans.fixtures").acct_pred(spark, tables).select("row_id", "rate", "m0_rate").collect()
    lo, hi = min(r["m0_rate"] for r in rows), max(r["m0_rate"] for r in rows)
    where = {r["row_id"]: min(9, int((r["m0_rate"] - lo) // ((hi - lo) / 10))) for r in rows}
    assert len(got) == 600
    for i, b in where.items():
        rates = [r["rate"] for r in rows if where[r["row_id"]] == b]
        assert got[i]["bin"] == b and got[i]["n"] == len(rates) == bins[b]["n"] and got[i]["finite"] == got[i]["consistent"] == 1
        assert [got[i][c] for c in ("q10", "q50", "q90")] == pytest.approx(np.quantile(rates, [0.1, 0.5, 0.9]), abs=2e-6)


def test_permuted_moves_every_column_by_the_same_order_in_one_pass(spark):
    SL = importlib.import_module("tabstack.operators.select")
    d = spark.range(500).select("id", (F.col("id") * 2).alias("a"), F.when(F.col("id") % 7 > 0, F.col("id")).alias("b"))
    rows = SL.permuted(d, ["a", "b"], "id", rows_per_bucket=60).collect()
    assert sorted(r["a_permuted"] for r in rows) == [2 * i for i in range(500)] and all(r["a_permuted"] != r["a"] for r in rows)
    for c in "ab":
        alone = {r["id"]: r[c] for r in SL.permutation_shift(d, c, "id", rows_per_bucket=60).collect()}
        assert alone == {r["id"]: r[f"{c}_permuted"] for r in rows}


def test_few_parts_follow_the_rows_not_the_shuffle(spark, monkeypatch):
    ML = importlib.import_module("tabstack.operators.models")
    cores = spark.sparkContext.defaultParallelism
    d = spark.range(0, 40_000, 1, 64 + cores)
    assert ML.few_parts(d).rdd.getNumPartitions() == cores and ML.few_parts(spark.range(0, 9, 1, 2)).rdd.getNumPartitions() == 2
    monkeypatch.setattr(ML, "ROWS_A_PART", 40_000 // (cores + 4))
    assert cores + 4 <= ML.few_parts(d).rdd.getNumPartitions() <= cores + 5


def test_meta_model_of_the_nested_stack_does_not_carry_the_base_models(spark, monkeypatch):
    """Each of its hundreds of jobs sent the lineage of the frame it learns from, base models included."""
    ML = importlib.import_module("tabstack.operators.models")
    plain, plans = ML.LogisticRegression, []

    class Watched(plain):
        def fit(self, dataset, params=None):
            plans.append((self.getFeaturesCol(), dataset._jdf.queryExecution().withCachedData().toString()))
            return super().fit(dataset, params)

    monkeypatch.setattr(ML, "LogisticRegression", Watched)
    d = spark.range(300).select(F.col("id").alias("row_id"), F.when(F.col("id") < 240, F.col("id") % 2).cast("int").alias("fold"),
                                (F.xxhash64("id") % 100 / 10.0).alias("a"))
    d = d.withColumn("c", F.when(F.col("row_id") == 7, None).otherwise((F.col("a") > 0).cast("int")))
    rows = ML.nested_stack_cls(d, {"trees": lambda s: ML.rf_cls(s, 2, 2)}, ["a"], "c", inner=2, n_classes=2).collect()
    assert sorted(r["row_id"] for r in rows) == list(range(300)) and all(abs(r["p0"] + r["p1"] - 1) < 1e-9 for r in rows)
    meta = [plan for column, plan in plans if column == "_meta"]
    assert len(meta) == 3 and not any("UDF" in plan for plan in meta)


def test_halving_fits_on_few_partitions(spark):
    """every fit of a rung has hundreds of stages, so their frame must not keep the partitions that a shuffle left."""
    ML, S = (importlib.import_module(f"tabstack.operators.{m}") for m in ("models", "search"))
    cores, seen = spark.sparkContext.defaultParallelism, []

    class Watched:
        def __init__(self, est):
            self.est = est

        def setLabelCol(self, label):
            self.est.setLabelCol(label)
            return self

        def fit(self, frame):
            seen.append((frame.rdd.getNumPartitions(), frame.count()))
            return self.est.fit(frame)

    d = spark.range(0, 300, 1, 5 * cores).select((F.col("id") % 3).cast("int").alias("fold"), (F.col("id") / 10).alias("a"), (F.col("id") % 50 / 5).alias("y"))
    rows = S.successive_halving(d, lambda c, trees: Watched(ML.rf_reg(42, trees, **c)), {"depth": (1, 3)}, ["a"], "y", draws=3, budgets=(1, 2)).collect()
    assert seen == [(cores, 200)] * 12      # 3 candidates, then 1, each on 3 folds, all of them on every row of the other two
    assert [(r.rung, r.budget) for r in rows] == [(0, 1)] * 3 + [(1, 2)] and [r.kept for r in rows].count(True) == 2


def _builds(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [step for step in ("Join", "Window", "Aggregate") if step in plan]


def test_flow_learners_read_written_tables(spark, monkeypatch):
    """counts, assemblies and joins over a learner's table must not build it again."""
    flow = importlib.import_module("tabstack.plans.flow")
    h = lambda c, n: F.pmod(F.xxhash64(F.lit(c), "id"), F.lit(n))
    t = spark.range(300).select(
        F.col("id").alias("row_id"), h("n", 4).cast("int").alias("nation"), F.concat(F.lit("S"), h("s", 3)).alias("segment"), h("t", 5).cast("int").alias("tier"),
        (h("r", 3100) / 100.0 + 4.99).alias("rate"), F.when(F.col("id") % 10 < 7, h("f", 5).cast("int")).alias("fold"), F.lit(0).alias("is_pseudo"),
        *[h(c, 1000).cast("double").alias(c) for c in flow.BASE])
    seen = []

    def oof(df, make, features, label, fold, kind):
        seen.append(_builds(df.select("row_id", fold, label, *features)))
        if kind == "cls":
            return df.select("row_id", fold, *[F.lit(0.2).alias(p) for p in flow.PROBS])
        noise = F.pmod(F.xxhash64(F.lit(type(make(0)).__name__), "row_id"), F.lit(100)) / 100.0
        return df.select("row_id", fold, (F.col(label) + noise).alias("pred"))

    monkeypatch.setattr(flow.ML, "oof_predict", oof)
    scored, w = flow.fit_bases(t, [])
    assert seen == [[], [], []] and _builds(scored) == []
    rows = scored.collect()
    assert sorted(r.row_id for r in rows) == list(range(300)) and abs(sum(w.values()) - 1) < 1e-9
    assert all(abs(r.rate_pred - w["w_gbt"] * r.r_gbt - w["w_rf"] * r.r_rf) < 1e-9 for r in rows)


def test_enlarged_table_is_written(spark):
    """the folds of an enlarged table are dealt once, not by every pass of the fit."""
    GE = importlib.import_module("tabstack.operators.generations")
    t = spark.range(100).select(F.col("id").alias("row_id"), (F.col("id") % 5).cast("int").alias("tier"), F.lit(7.5).alias("rate"),
                                F.when(F.col("id") < 70, (F.col("id") % 5).cast("int")).alias("fold"))
    chosen = spark.range(80, 90).select(F.col("id").alias("row_id"), F.lit(3).alias("tier"), F.lit(9.0).alias("rate"))
    out = GE.enlarge(t, chosen, ("tier", "rate"))
    assert _builds(out) == [] and out.where("is_pseudo = 1 AND tier = 3 AND rate = 9.0 AND fold IS NOT NULL").count() == 10
    assert out.count() == 100 and out.where("fold IS NULL").count() == 20
