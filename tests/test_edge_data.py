"""Fitted state on NULL, NaN, tied, offset and missing data."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabstack.operators import aggregates as A
from tabstack.operators import encode as EN
from tabstack.operators import metrics as MT
from tabstack.operators import select as SL
from tabstack.operators.folds import assign_folds_stratified
from tabstack.operators.sampling import stratified_sample
from tabstack.sources import sinks as SK
from tabstack.sources import store as ST
from tabstack.sources.tables import nan_to_null


def test_exact_quantiles_with_ties_nan_and_infinity(spark):
    n = 4000
    d = spark.range(n).select(
        F.when(F.col("id") < 2500, 0.0).otherwise(F.col("id") * 1.5).alias("zeros"),
        F.when(F.col("id") % 7 == 0, float("nan")).when(F.col("id") % 5 == 0, None).otherwise(F.col("id").cast("double")).alias("holes"),
        (F.col("id") % 3 - 1).cast("double").alias("three"), F.lit(4.25).alias("one"), F.lit(None).cast("double").alias("none"),
        F.when(F.col("id") < 3, float("-inf")).when(F.col("id") == 9, 1e308).otherwise(-1e308).alias("wide"))
    qs = [0.0, 0.25, 0.5, 0.62, 0.6252, 0.995, 1.0]
    got = A.exact_quantiles(d, {c: qs for c in d.columns}, bins=5)
    p = d.toPandas()
    for c in ("zeros", "holes", "three", "one"):
        v = np.array([x for x in p[c] if x is not None and not math.isnan(x)])
        assert np.allclose(got[c], np.quantile(v, qs)), c
    assert got["none"] == [None] * len(qs)
    assert got["wide"][0] == float("-inf") and got["wide"][2] == -1e308 and got["wide"][-1] == 1e308


def test_grouped_quantiles_equal_numpy(spark):
    d = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"),
        (F.col("id") % 2).alias("h"),
        F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 13 == 0, float("nan"))
        .when(F.col("id") % 40 == 4, None).when(F.col("id") % 40 == 5, 2.5)
        .otherwise(F.exp((F.hash("id") % 100) / 3.0)).alias("y"), F.lit("clash").alias("_n"))
    rows = {}
    for r in d.collect():
        if r.y is not None and not math.isnan(r.y):
            rows.setdefault((r.g, r.h), []).append(r.y)
    qs = [0.0, 0.25, 0.5, 0.9, 1.0]
    for bins in (512,):
        got = {(r.g, r.h): [r[f"q{i}"] for i in range(len(qs))] for r in A.grouped_quantiles(d, "y", ["g", "h"], qs, bins).collect()}
        assert set(got) == set(rows)
        assert all(np.allclose(got[k], np.quantile(v, qs), rtol=1e-12) for k, v in rows.items())
    assert A.grouped_quantiles(d.limit(0), "y", ["g"], qs).count() == 0
    inf = spark.createDataFrame([(1, float("-inf")), (1, 0.0), (1, 5e-324), (1, float("inf")), (1, float("inf"))], "g int, y double")
    assert list(A.grouped_quantiles(inf, "y", ["g"], qs).first())[1:] == [float("-inf"), 0.0, 5e-324, float("inf"), float("inf")]


def test_describe_with_and_without_groups(spark):
    d = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("b", None), (None, 3.0)], "g string, y double")
    got = {r.g: (r["count"], r.min, r.q25, r.q50, r.q75, r.max) for r in A.describe(d, "y", ["g"]).collect()}
    assert got == {"a": (2, 1.0, 1.75, 2.5, 3.25, 4.0), "b": (0, None, None, None, None, None), None: (1, 3.0, 3.0, 3.0, 3.0, 3.0)}
    r = A.describe(d, "y").first()
    assert (r["count"], r.q25, r.q50, r.q75) == (3, 2.0, 3.0, 3.5)
    assert A.describe(d.limit(0), "y").first()["count"] == 0


def test_null_stratum_gets_folds_and_samples(spark):
    d = spark.range(1000).select(F.col("id").alias("row_id"), F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("s"))
    f = assign_folds_stratified(d, "row_id", 5, "s")
    assert f.where("fold is null").count() == 0
    assert {(r.s, r.fold): r.n for r in f.groupBy("s", "fold").agg(F.count(F.lit(1)).alias("n")).collect()} == {
        (s, k): 50 for s in (None, 1, 2, 3) for k in range(5)}
    got = stratified_sample(d, "s", 20)
    assert {r.s: r.n for r in got.groupBy("s").agg(F.count(F.lit(1)).alias("n")).collect()} == {None: 20, 1: 20, 2: 20, 3: 20}
    assert stratified_sample(d, "s", 10_000).count() == 1000


def test_null_group_in_metrics(spark):
    d = spark.range(400).select(F.when(F.col("id") % 2 == 0, "a").alias("g"), (F.col("id") % 10).cast("double").alias("p"),
                                ((F.col("id") % 10) > 4).cast("int").alias("y"))
    assert {r.g for r in MT.r2_rmse(d, "p", "y", by=["g"]).collect()} == {None, "a"}
    assert {r.g: r.auc for r in MT.auc(d, "p", "y", by=["g"]).collect()} == {None: 1.0, "a": 1.0}
    assert {r.g: r.auc for r in MT.auc(d, "p", "y", by=["g"], rows_per_bucket=1).collect()} == {None: 1.0, "a": 1.0}


def test_auc_equals_brute_force_for_any_buckets(spark):
    rng = np.random.default_rng(0)
    s, y = rng.integers(0, 40, 600) / 7.0, rng.integers(0, 2, 600)
    d = spark.createDataFrame([(float(a), int(b)) for a, b in zip(s, y)], "s double, y int")
    pos, neg = s[y == 1][:, None], s[y == 0][None]
    want = float(((pos > neg) + 0.5 * (pos == neg)).mean())
    for rows in (1, 7, 1000):
        assert abs(MT.auc(d, "s", "y", rows_per_bucket=rows).first()["auc"] - want) < 1e-12


def test_anova_does_not_depend_on_an_offset(spark):
    d = spark.range(3000).select(F.col("id") % 3, (F.rand(1) + F.col("id") % 3 * 0.1).alias("x")).toDF("g", "x")
    d = d.withColumn("far", F.col("x") + 1e9)
    f = {r.feature: r.f for r in SL.anova_f(d, ["x", "far"], "g").collect()}
    assert abs(f["far"] / f["x"] - 1) < 1e-4


def test_null_targets_are_not_counted(spark):
    d = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("a", None), ("b", None), ("c", 5.0)], "k string, y double")
    st = EN.fit_target_stats(d, ["k"], "y", fold=None, m=0.0)
    got = {r.k: r.k_te for r in EN.apply_target_stats(d, st).distinct().select("k", "k_te").collect()}
    assert got["a"] == 2.0 and got["b"] == 3.0 and got["c"] == 5.0


def test_latest_version_is_by_number(spark):
    d = spark.createDataFrame([("A", "m", v) for v in ("v2", "v9", "v10")] + [("B", "m", "x")], "task string, model string, version string")
    assert {(r.task, r.version) for r in ST.latest_versions(d).collect()} == {("A", "v10"), ("B", "x")}


def test_validate_reports_missing_columns(spark):
    d = spark.createDataFrame([(1, 2), (2, 7)], "Id long, RiskTier int")
    r = SK.validate(d).first()
    assert r.missing_columns == 1 and r.bad_tiers == 1 and r.rate_out_of_range == 2
    with pytest.raises(ValueError):
        SK.assert_valid(SK.validate(d))


def test_publish_if_better_over_runs(spark, tmp_path):
    path, seen = str(tmp_path / "scores"), []
    for score in (0.5, 0.4, 0.6):
        SK.publish_if_better(spark, path, "r", score, lambda s=score: seen.append(s))
    assert seen == [0.5, 0.6]
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        SK.publish_if_better(spark, str(broken), "r", 0.9, lambda: seen.append(0.9))
    assert seen == [0.5, 0.6]


def test_permutation_moves_every_row(spark):
    d = spark.range(300).select(F.col("id").alias("k"), F.col("id").alias("v"), F.lit("x").alias("other"))
    for rows in (1, 2, 10, 1000):
        got = SL.permutation_shift(d, "v", "k", rows_per_bucket=rows).collect()
        assert len(got) == 300 and all(r.k != r.v for r in got) and {r.v for r in got} == set(range(300))


def test_chi2_equals_numpy_with_nulls(spark):
    rng = np.random.default_rng(3)
    rows = [(int(a) if a else None, int(b)) for a, b in zip(rng.integers(0, 4, 500), rng.integers(0, 3, 500))]
    d = spark.createDataFrame(rows, "a int, b int")
    t = np.zeros((4, 3))
    for a, b in rows:
        t[a or 0, b] += 1
    e = t.sum(1, keepdims=True) * t.sum(0) / t.sum()
    assert abs(SL.chi2_table(d, "a", "b").first()["chi2"] - ((t - e) ** 2 / e).sum()) < 1e-9


def test_nan_becomes_null_at_the_source(spark):
    d = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "x double")
    assert A.medians(nan_to_null(d), ["x"]) == {"x": 2.0}
