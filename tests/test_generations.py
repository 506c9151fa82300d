"""Retraining on pseudo-labels: enlarged tables, store versions, leaks."""

import pytest
from pyspark.sql import functions as F

from tabstack.operators import generations as GE
from tabstack.operators import models as ML
from tabstack.operators.folds import assign_folds_stratified
from tabstack.session import scratch_path
from tabstack.sources.store import latest_versions, read_oof

PROBS = ["p0", "p1"]


@pytest.fixture(scope="module")
def table(spark):
    """300 rows, two thirds labelled; the class follows x, the rate too."""
    d = spark.range(300).select(F.col("id").alias("row_id"), ((F.col("id") * 37) % 101 / 101.0).alias("x"), ((F.col("id") * 53) % 89 / 89.0).alias("z"))
    d = d.withColumns({"tier": (F.col("x") > 0.5).cast("int"), "rate": 5 + 20 * F.col("x") + F.col("z"), "split": F.when(F.col("row_id") % 3 < 2, "train").otherwise("test")})
    return assign_folds_stratified(d, "row_id", 5, "tier", only_where=F.col("split") == "train").checkpoint()


def fit(t):
    """Nearest class by x alone (a stand-in that learns from rows with a fold only): shares by distance to the fold's boundary."""
    p = ML.oof_predict(t, lambda f: ML.rf_cls(f, 10, 3), ["x", "z"], "tier", "fold", "cls", n_classes=2)
    r = ML.oof_predict(t, lambda f: ML.linear_reg(), ["x", "z"], "rate", "fold", "reg")
    out = t.drop("p0", "p1", "pred").join(p.drop("fold"), "row_id").join(r.drop("fold"), "row_id")
    return out.checkpoint(), {"n": float(t.where(F.col("fold").isNotNull()).count())}


MODELS = {("tier", "rf"): PROBS, ("rate", "lin"): ["pred"]}


def test_versions_rows_and_scores(spark, table):
    store = scratch_path(spark, "gen-store")
    found = GE.run_generations(table, fit, store, MODELS, PROBS, "pred", rounds=2, n=40, threshold=0.6)
    assert [g.version for g in found] == ["v1", "v2", "v3"]
    assert [g.notes["n"] for g in found] == [200, 240, 240]
    saved = read_oof(spark, store)
    assert {(r.task, r.model, r.version): r["count"] for r in saved.groupBy("task", "model", "version").count().collect()} == {
        (t, m, v): 300 for t, m in MODELS for v in ("v1", "v2", "v3")}
    assert {r.version for r in latest_versions(saved).select("version").distinct().collect()} == {"v3"}
    real = {r.row_id: (r.fold, r.tier, r.rate) for r in table.where("fold is not null").collect()}
    for g in found[1:]:
        rows = g.scored.collect()
        assert len(rows) == 300 and len({r.row_id for r in rows}) == 300
        assert {r.row_id: (r.fold, r.tier, r.rate) for r in rows if r.fold is not None and not r.is_pseudo} == real     # labels and folds stay
        added = [r for r in rows if r.is_pseudo]
        assert len(added) == 40 and not {r.row_id for r in added} & set(real)
        assert max(sum(r.fold == k for r in added) for k in range(5)) - min(sum(r.fold == k for r in added) for k in range(5)) <= 2
        assert all(r.split == "test" for r in added)
    # the labels are the previous generation's answers
    before = {r.row_id: r for r in found[0].scored.collect()}
    for r in (r for r in found[1].scored.collect() if r.is_pseudo):
        b = before[r.row_id]
        assert r.tier == (0 if b.p0 >= b.p1 else 1) and max(b.p0, b.p1) >= 0.6 and abs(r.rate - min(35.99, max(4.99, b.pred))) < 1e-9


def test_true_test_labels_never_teach(spark, table):
    """Test rows' own labels are replaced before anything learns: changing them changes nothing."""
    def last(t):
        g = GE.run_generations(t, fit, scratch_path(spark, "gen-store"), MODELS, PROBS, "pred", rounds=1, n=30, threshold=0.6)[-1]
        return sorted((r.row_id, r.is_pseudo, r.p0, round(r.pred, 9)) for r in g.scored.collect())
    test = F.col("fold").isNull()
    moved = table.withColumns({"tier": F.when(test, 1 - F.col("tier")).otherwise(F.col("tier")), "rate": F.when(test, 1000.0).otherwise(F.col("rate"))})
    assert last(table) == last(moved)


def test_own_label_never_reaches_an_enlarged_prediction(spark, table):
    chosen = spark.createDataFrame([(i, 1, 20.0) for i in range(2, 60, 3)], "row_id long, tier int, rate double")
    one = GE.enlarge(table, chosen, ("tier", "rate"))
    other = table.withColumn("rate", F.when(F.col("fold") == 2, F.col("rate") * 9).otherwise(F.col("rate")))
    a = {r.row_id: (r.fold, r.pred) for r in fit(one)[0].collect()}
    b = {r.row_id: (r.fold, r.pred) for r in fit(GE.enlarge(other, chosen, ("tier", "rate")))[0].collect()}
    real = {r.row_id for r in table.where("fold = 2").collect()}
    assert all(abs(a[i][1] - b[i][1]) < 1e-9 for i in real) and any(abs(a[i][1] - b[i][1]) > 1 for i in a if a[i][0] not in (2, None))


def test_nobody_is_confident(spark, table):
    found = GE.run_generations(table, fit, scratch_path(spark, "gen-store"), MODELS, PROBS, "pred", rounds=2, n=40, threshold=1.1)
    assert [g.version for g in found] == ["v1"]


def test_pseudo_labels_of_labelled_rows_are_ignored(spark, table):
    known = table.where("fold is not null").first()
    chosen = spark.createDataFrame([(known.row_id, 1 - known.tier, -5.0)], "row_id long, tier int, rate double")
    out = GE.enlarge(table, chosen, ("tier", "rate"))
    row = out.where(F.col("row_id") == known.row_id).first()
    assert (row.tier, row.rate, row.is_pseudo, row.fold) == (known.tier, known.rate, 0, known.fold) and out.where("is_pseudo = 1").count() == 0
