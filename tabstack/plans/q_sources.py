"""Checkable queries for section 2.1 (sources and sinks)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabstack.operators import blend as B
from tabstack.plans import fixtures as FX
from tabstack.plans.q_blend_metrics import _argmax_sql, _blend_sql, _scalar_sql
from tabstack.plans.registry import q6, query, sq6
from tabstack.session import scratch_path
from tabstack.sources import sinks as SK
from tabstack.sources import store as ST
from tabstack.sources.tables import read_table, with_row_id

W = FX.with_sql
M = FX.N_MODELS
PROBS = [FX.pred_cols(m) for m in range(M)]

ORDERS_CSV_SCHEMA = ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                     "o_orderday string, o_orderpriority string")


@query("src_csv", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d') AS o_orderday, o_orderpriority FROM orders""")
def q_src_csv(spark, sf):
    """Round trip through CSV with an explicit schema (no inference)."""
    o = read_table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderday"), "o_orderpriority")
    path = scratch_path(spark, "orders_csv")
    o.write.mode("overwrite").option("header", "true").csv(path)
    return ST.read_csv(spark, path, ORDERS_CSV_SCHEMA)


@query("src_row_id", "SELECT CAST(row_number() OVER () - 1 AS BIGINT) AS row_id, n_nationkey, n_name FROM nation")
def q_row_id(spark, sf):
    """Dense positional key for a table without one (zipWithIndex once)."""
    return with_row_id(read_table(spark, sf, "nation").select("n_nationkey", "n_name"))


def _oof_long(spark, sf):
    p = FX.acct_pred(spark, sf)
    parts = []
    for m in range(M):
        parts.append(p.select("row_id", "split", "fold", F.lit("B").alias("task"), F.lit(f"m{m}").alias("model"),
                              F.lit("v1").alias("version"), F.array(F.col(f"m{m}_rate")).alias("pred")))
        parts.append(p.select("row_id", "split", "fold", F.lit("A").alias("task"), F.lit(f"m{m}").alias("model"),
                              F.lit("v1").alias("version"), F.array(*[F.col(c) for c in PROBS[m]]).alias("pred")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


@query("src_oof_roundtrip", W("acct_pred", "SELECT row_id, " + ", ".join(
    f"{sq6(f'm{m}_rate')} AS m{m}" for m in range(M)) + " FROM acct_pred"))
def q_oof_roundtrip(spark, sf):
    """Write task A and B predictions of five models to the partitioned store,
    read task B back (partition pruning) and pivot models to columns."""
    path = scratch_path(spark, "oof_store")
    ST.write_oof(_oof_long(spark, sf), path, mode="overwrite")
    back = ST.read_oof(spark, path, task="B", version="v1").select("row_id", "model", F.col("pred")[0].alias("v"))
    wide = ST.pivot_models(back, [f"m{m}" for m in range(M)], value="v")
    return wide.select("row_id", *[q6(f"m{m}").alias(f"m{m}") for m in range(M)])


@query("src_latest_version", """SELECT user_id, event_type,
  arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value, count(*) AS n_versions
FROM events GROUP BY user_id, event_type""")
def q_latest(spark, sf):
    """Latest row per (user, event type) by timestamp (ties -> higher id)."""
    e = read_table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return ST.latest_rows(e, ["user_id", "event_type"], ["ts", "event_id"], ["event_id", "value"])


@query("src_latest_oof", W("acct_pred", """SELECT t.task, m.model, CASE WHEN m.model IN ('m0', 'm3') THEN 'v2' ELSE 'v1' END AS version,
  (SELECT count(*) FROM acct_pred) AS rows
FROM (VALUES ('A'), ('B')) t(task), (VALUES ('m0'), ('m1'), ('m2'), ('m3'), ('m4')) m(model)"""))
def q_latest_oof(spark, sf):
    """Newest version per (task, model) in the OOF store; older versions and
    missing models are skipped."""
    path = scratch_path(spark, "oof_store_v")
    long = _oof_long(spark, sf)
    ST.write_oof(long, path, mode="overwrite")
    ST.write_oof(long.where(F.col("model").isin("m0", "m3")).withColumn("version", F.lit("v2")), path)
    latest = ST.latest_versions(ST.read_oof(spark, path))
    return latest.groupBy("task", "model", "version").agg(F.count(F.lit(1)).alias("rows"))


def _sub_sql():
    eq = [1.0 / M] * M
    rate = f"greatest(4.99, least(35.99, {_scalar_sql([f'm{m}_rate' for m in range(M)], eq)}))"
    return (f"SELECT CAST(row_id AS BIGINT) AS Id, {_argmax_sql(_blend_sql(eq))} AS RiskTier, "
            f"CAST(round_even({rate} * 100.0, 0) AS DOUBLE) / 100.0 AS InterestRate FROM acct_pred WHERE split = 'test'")


def _submission(spark, sf):
    p = FX.acct_pred(spark, sf).where(F.col("split") == "test")
    d = p.select("row_id", *[c.alias(f"b{k}") for k, c in enumerate(B.blend_columns(PROBS))],
                 B.blend_scalar([f"m{m}_rate" for m in range(M)]).alias("rate"))
    return SK.submission(d, "row_id", [f"b{k}" for k in range(5)], "rate")


@query("sink_submission", W("acct_pred", _sub_sql()))
def q_submission(spark, sf):
    """Prediction table written and read back."""
    path = scratch_path(spark, "submission")
    SK.write_submission(_submission(spark, sf), path)
    return spark.read.parquet(path)


@query("sink_validate", W("acct_pred", """SELECT 0 AS missing_columns, count(*) - count(DISTINCT Id) AS duplicate_ids,
  count(*) FILTER (WHERE Id IS NULL OR Id < 0) AS bad_ids,
  count(*) FILTER (WHERE RiskTier IS NULL OR RiskTier < 0 OR RiskTier > 4) AS bad_tiers,
  count(*) FILTER (WHERE InterestRate IS NULL OR InterestRate < 4.99 OR InterestRate > 35.99) AS rate_out_of_range,
  count(*) FILTER (WHERE abs(InterestRate * 100 - round(InterestRate * 100, 0)) > 1e-6) AS rate_not_2dp,
  count(*) AS rows FROM sub""", extra=["sub AS (" + _sub_sql() + ")"]))
def q_validate(spark, sf):
    """Output contract as one row of violation counts."""
    return SK.validate(_submission(spark, sf))


@query("sink_if_better", W("acct_pred", f"""SELECT 'blend_mean' AS run,
  {sq6("avg(CAST(" + _argmax_sql(_blend_sql([0.2] * 5)) + " = tier AS DOUBLE))")} AS score,
  CAST(NULL AS DOUBLE) AS previous_best, true AS published FROM acct_pred WHERE split = 'train'"""))
def q_if_better(spark, sf):
    """Publish the submission only when its in-sample score beats the best
    recorded so far (first run publishes)."""
    p = FX.acct_pred(spark, sf).where(F.col("split") == "train")
    from tabstack.operators.metrics import accuracy
    from tabstack.functions.expr import argmax_class
    acc = accuracy(p, argmax_class(F.array(*B.blend_columns(PROBS))), "tier").collect()[0]["accuracy"]
    scores = scratch_path(spark, "scores")
    out = scratch_path(spark, "published")
    r = SK.publish_if_better(spark, scores, "blend_mean", acc,
                             lambda: SK.write_submission(_submission(spark, sf), out))
    return r.select("run", q6("score").alias("score"), "previous_best", "published")


@query("sink_score_json")
def q_score_json(spark, sf):
    """Run summary: blend weights and scores as a JSON document."""
    p = FX.acct_pred(spark, sf).where(F.col("fold").isNotNull())
    st = B.gram_state(p, [f"m{m}_rate" for m in range(M)], "rate")
    w = B.blend_convex_reg(st)
    doc = SK.score_json({"method": "convex", "r2": B.r2_at(st, w),
                         "weights": {f"m{m}": float(w[m]) for m in range(M)}})
    path = scratch_path(spark, "score_json")
    spark.createDataFrame([(doc,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return spark.read.text(path)


@query("src_oof_write", W("acct_pred", "SELECT 'A' AS task, CAST(count(*) * 5 AS BIGINT) AS rows FROM acct_pred "
                          "UNION ALL SELECT 'B', CAST(count(*) * 5 AS BIGINT) FROM acct_pred"))
def q_oof_write(spark, sf):
    """Predictions of five models for both tasks appended to the partitioned
    store; row counts per task read back from the written folders."""
    path = scratch_path(spark, "oof_store_w")
    ST.write_oof(_oof_long(spark, sf), path, mode="overwrite")
    return spark.read.parquet(path).groupBy("task").agg(F.count(F.lit(1)).alias("rows"))


@query("src_oof_read", W("acct_pred", "SELECT row_id, " + ", ".join(
    f"{sq6(f'm{m}_p4')} AS m{m}_p4" for m in range(M)) + " FROM acct_pred"))
def q_oof_read(spark, sf):
    """Task A read back (partition filter on task/version) and pivoted to one
    column per model (probability of the top class)."""
    path = scratch_path(spark, "oof_store_r")
    ST.write_oof(_oof_long(spark, sf), path, mode="overwrite")
    back = ST.read_oof(spark, path, task="A", version="v1").select("row_id", "model", F.col("pred")[4].alias("v"))
    wide = ST.pivot_models(back, [f"m{m}" for m in range(M)], value="v")
    return wide.select("row_id", *[q6(f"m{m}").alias(f"m{m}_p4") for m in range(M)])
