"""Successive halving, nominal splits inside trees, bucketed alignment."""

import json

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tabstack.operators import encode as EN
from tabstack.operators import models as ML
from tabstack.operators.search import draw, successive_halving
from tabstack.session import scratch_path
from tabstack.sources import store as ST


def _frame(spark, n=600):
    rng = np.random.default_rng(1)
    x = rng.uniform(-2, 2, (n, 2))
    city = rng.permutation([f"c{i}" for i in range(12)])[rng.integers(0, 12, n)]
    odd = np.array([int(c[1:]) % 2 for c in city])
    y = np.sin(3 * x[:, 0]) + 3 * odd + rng.normal(0, 0.05, n)
    return spark.createDataFrame(pd.DataFrame({"row_id": range(n), "fold": np.arange(n) % 3, "a": x[:, 0], "b": x[:, 1], "city": city, "y": y})).cache()


def test_halving_keeps_the_best_of_each_rung(spark):
    d = _frame(spark)
    space = {"depth": (1, 6), "reg": (1e-3, 1.0, "log"), "kind": ["p", "q"]}
    assert draw(space, 5, 1) == draw(space, 5, 1) != draw(space, 5, 2)
    make = lambda c, trees: ML.rf_reg(42, trees, c["depth"])
    got = successive_halving(d, make, space, ["a"], "y", draws=6, eta=3, budgets=(1, 3)).toPandas()
    assert got.groupby("rung").size().tolist() == [6, 2] and got.groupby("rung").kept.sum().tolist() == [2, 1]
    for _, g in got.groupby("rung"):
        assert g[g.kept].score.max() <= g[~g.kept].score.min()
    assert set(got[got.rung == 1].candidate) == set(got[(got.rung == 0) & got.kept].candidate)
    win = got[(got.rung == 1) & got.kept].iloc[0]
    oof = ML.oof_predict(d, lambda f: make(json.loads(win.params), 3), ["a"], "y", kind="reg").join(d.select("row_id", "y"), "row_id")
    assert abs(oof.agg(F.sqrt(F.avg((F.col("pred") - F.col("y")) ** 2))).first()[0] - win.score) < 1e-9
    one = successive_halving(d.where("fold = 0"), make, space, ["a"], "y", draws=2, budgets=(1,))
    assert one.count() == 0


def test_trees_split_levels_as_sets(spark):
    d = _frame(spark)
    coded = EN.nominal(d, EN.fit_levels(d, ["city"], 20))
    m = ML.rf_reg(42, 1, 1, featureSubsetStrategy="all", subsamplingRate=1.0, bootstrap=False).setLabelCol("y").fit(ML.assemble(coded, ["a", "city"]))
    text = m.trees[0].toDebugString
    assert "in {" in text                     # a set of levels
    levels = EN.fit_levels(d, ["city"], 20)["city"]
    chosen = {levels[int(float(v))] for v in text.split(" in {")[1].split("}")[0].split(",")}
    assert len({int(c[1:]) % 2 for c in chosen}) == 1 and len(chosen) == 6


def test_levels_are_bounded_and_null_has_its_own(spark):
    d = spark.createDataFrame([("x",), ("x",), ("y",), ("z",), (None,)], "g string")
    assert EN.fit_levels(d, ["g"], 2) == {"g": ["x", "y"]}
    assert [r.g for r in EN.nominal(d, {"g": ["x", "y"]}).collect()] == [0.0, 0.0, 1.0, 2.0, 3.0]
    empty = d.limit(0)
    assert EN.fit_levels(empty, ["g"]) == {"g": []} and EN.nominal(d, {"g": []}).first().g == 0.0


def test_bucketed_models_align_without_exchange(spark):
    ids = spark.range(1000).select(F.col("id").alias("row_id"))
    tables, paths = {}, {}
    for m in range(5):
        paths[m] = scratch_path(spark, f"b{m}")
        tables[f"m{m}"] = "t_" + paths[m].rsplit("-", 1)[1]
        ST.write_bucketed(ids.where(F.col("row_id") % 7 != (m or 9)).withColumn("pred", F.col("row_id") * 10.0 + m), tables[f"m{m}"], paths[m], "row_id", 4)
    out = ST.align_bucketed(spark, tables, "row_id")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.row_id: tuple(r)[1:] for r in out.collect()}
    assert got == {i: tuple(None if m and i % 7 == m else i * 10.0 + m for m in range(5)) for i in range(1000)}
    again = ST.open_bucketed(spark, "again_" + tables["m0"], paths[0], "row_id", 4)
    j = again.join(spark.table(tables["m1"]).hint("merge"), "row_id")
    assert "Exchange" not in j._jdf.queryExecution().executedPlan().toString()
    assert again.count() == spark.table(tables["m0"]).count()
