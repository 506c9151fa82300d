"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabstack.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_BYTES = 4 << 20


def map_batches(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` with batches bounded by bytes: rows hold whole texts, some of them very long."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts lineage: what reads the result survives the loss of executors, and
    an expensive branch (a Python stage) runs once.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_remainder(col: str, mod: int) -> Column:
    """crc32(id as text) mod ``mod``: the fixed split rule of the learned operators (null id: empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(mod))


def blocks_for(rows: int, per_block: int) -> int:
    """How many blocks of about ``per_block`` rows hold ``rows`` rows."""
    return max(1, -(-rows // per_block))


def range_of(value: Column, bounds: list) -> Column:
    """How many of the sorted ``bounds`` are at most ``value`` (null: none), in about 2 sqrt(n) comparisons."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    every, top = F.array(*map(F.lit, bounds)), F.array(*map(F.lit, bounds[step - 1::step]))
    group = F.size(F.filter(top, lambda x: x <= value)) * step
    return F.when(value.isNull(), F.lit(0)).otherwise(
        group + F.size(F.filter(F.slice(every, group + 1, step), lambda x: x <= value)))
