"""Sinks: the prediction table, its contract check, and run summaries."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabstack.functions.expr import argmax_class, clip, round_half_even

RATE_MIN, RATE_MAX = 4.99, 35.99
N_CLASSES = 5


def submission(df: DataFrame, key: str, prob_cols, rate_col: str) -> DataFrame:
    """Id, RiskTier (argmax, ties -> lower class), InterestRate (clipped,
    rounded half to even to 2 decimals)."""
    return df.select(F.col(key).cast("long").alias("Id"),
                     argmax_class(F.array(*[F.col(c) for c in prob_cols])).alias("RiskTier"),
                     round_half_even(clip(rate_col, RATE_MIN, RATE_MAX), 2).alias("InterestRate"))


def write_submission(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.select("Id", "RiskTier", "InterestRate").write.mode("overwrite").format(fmt) \
        .options(**({"header": "true"} if fmt == "csv" else {})).save(path)


def validate(df: DataFrame, expected_rows: int | None = None) -> DataFrame:
    """One aggregate, one row of violation counts (all zero = valid)."""
    need = ("Id", "RiskTier", "InterestRate")
    missing = [c for c in need if c not in df.columns]
    # a missing column is reported as such and makes every row of its checks bad
    df = df.withColumns({c: F.lit(None).cast("double") for c in missing}) if missing else df
    r, t = F.col("InterestRate"), F.col("RiskTier")
    out = df.agg(
        F.lit(len(missing)).alias("missing_columns"),
        (F.count(F.lit(1)) - F.count_distinct("Id")).alias("duplicate_ids"),
        F.count_if(F.col("Id").isNull() | (F.col("Id") < 0)).alias("bad_ids"),
        F.count_if(t.isNull() | (t < 0) | (t > N_CLASSES - 1)).alias("bad_tiers"),
        F.count_if(r.isNull() | (r < RATE_MIN) | (r > RATE_MAX)).alias("rate_out_of_range"),
        F.count_if(F.abs(r * 100 - F.round(r * 100, 0)) > 1e-6).alias("rate_not_2dp"),
        F.count(F.lit(1)).alias("rows"))
    if expected_rows is not None:
        out = out.withColumn("row_count_mismatch", (F.col("rows") != expected_rows).cast("long"))
    return out


def assert_valid(report: DataFrame) -> None:
    r = report.collect()[0].asDict()
    bad = {k: v for k, v in r.items() if k != "rows" and v}
    if bad:
        raise ValueError(f"submission contract violated: {bad}")


def publish_if_better(spark: SparkSession, scores_path: str, name: str, score: float,
                      publish) -> DataFrame:
    """Read the best recorded score, publish only when the new one is higher,
    and append the new score to the (small) score table."""
    try:
        best_row = spark.read.parquet(scores_path).agg(F.max("score").alias("b")).collect()[0]
        best = best_row["b"]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # any other failure must not publish
            raise
        best = None  # the first run
    better = best is None or score > best
    if better:
        publish()
    rec = spark.createDataFrame([(name, float(score), bool(better))], "run string, score double, published boolean")
    rec.write.mode("append").parquet(scores_path)
    return spark.createDataFrame([(name, float(score), best, bool(better))],
                                 "run string, score double, previous_best double, published boolean")


def score_json(summary: Mapping) -> str:
    """Run summary (scores, weights, method) as JSON text."""
    return json.dumps(summary, sort_keys=True, default=float)
