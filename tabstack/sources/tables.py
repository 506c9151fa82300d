"""Readers for the input tables.

Rule kept everywhere: NaN is turned into NULL once, at the source, and never
again (Spark orders NaN above every number, pandas treats it as missing).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabstack.operators._util import bounded_broadcast

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of one input table; column pruning and filter pushdown are
    left to Catalyst, so callers should select what they need."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return nan_to_null(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def nan_to_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Replace NaN by NULL in floating columns (one projection)."""
    floating = {f.name for f in df.schema.fields
                if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    todo = [c for c in (cols or df.columns) if c in floating]
    if not todo:
        return df
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast(df.schema[c].dataType))
                           for c in todo})


def with_row_id(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Add a dense 0-based row position (partition order, then row order)
    when a table has no natural key -- once, at ingest.

    JVM-side ``zipWithIndex``: ``monotonically_increasing_id`` is
    (partition << 33) + position; one small job counts rows per partition,
    their running sum (a table of #partitions rows) is broadcast, and the id
    is offset + position.  No global ``row_number`` window (one task) and no
    Python round trip.  The input must have a deterministic partitioning
    (a file scan, or a checkpointed frame).
    """
    if name in df.columns:
        return df
    d = df.withColumns({"_pid": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()})
    counts = d.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # #partitions rows
    offs = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    j = d.join(bounded_broadcast(offs), "_pid")
    pos = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return j.select((F.col("_off") + pos).cast("long").alias(name), *df.columns)
