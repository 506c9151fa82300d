"""OOF prediction store and file sources.

Long form, one row per (row, model): ``(row_id, split, fold, task, model,
version, pred ARRAY<DOUBLE>)``, partitioned by task/model/version so a reader
that names a task or version only lists those folders (partition pruning).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabstack.operators._util import bounded_broadcast

OOF_PARTITIONS = ["task", "model", "version"]


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True) -> DataFrame:
    """CSV with an explicit schema (no inference pass); a missing path raises."""
    return spark.read.csv(path, schema=schema, header=header, mode="FAILFAST")


def write_oof(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append predictions to the store (partitioned write)."""
    df.write.mode(mode).partitionBy(*OOF_PARTITIONS).parquet(path)


def read_oof(spark: SparkSession, path: str, task: str | None = None,
             version: str | None = None, models: Sequence[str] | None = None) -> DataFrame:
    d = spark.read.parquet(path)
    if task is not None:
        d = d.where(F.col("task") == task)
    if version is not None:
        d = d.where(F.col("version") == version)
    if models is not None:
        d = d.where(F.col("model").isin(list(models)))
    return d


def latest_versions(store: DataFrame, by: Sequence[str] = ("task", "model"),
                    version: str = "version") -> DataFrame:
    """Newest version per (task, model) -- a small aggregate over the
    partition columns -- then a semi join keeps only those rows.  Versions are
    ordered by their run number (v10 after v9), then by name."""
    digits = F.regexp_extract(F.col(version).cast("string"), r"(\d+)\D*$", 1)
    number = F.when(digits != "", digits.cast("decimal(38,0)"))
    newest = store.groupBy(*by).agg(F.max_by(version, F.struct(F.coalesce(number, F.lit(-1).cast("decimal(38,0)")).alias("n"), version)).alias(version))
    return store.join(bounded_broadcast(newest), on=[*by, version], how="left_semi")


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Latest row per key by ``order`` (ties broken by the later columns of
    ``order``) with ``max_by``: a hash aggregate with partial aggregation, so
    a hot key does not pull all its rows into one task (no window sort)."""
    best = F.max_by(F.struct(*payload), F.struct(*order))
    return df.groupBy(*keys).agg(best.alias("_b"), F.count(F.lit(1)).alias("n_versions")) \
        .select(*keys, *[F.col(f"_b.{c}").alias(c) for c in payload], "n_versions")


def pivot_models(long: DataFrame, models: Sequence[str], value: str = "pred",
                 key: str = "row_id") -> DataFrame:
    """Long (row, model) -> wide (row, one column per model); the model list
    is given so the pivot needs no distinct pass."""
    return long.groupBy(key).pivot("model", list(models)).agg(F.first(value))


# ------------------------------------------------------------ bucketed models

def oof_buckets(rows: int, rows_per_bucket: int = 2_000_000) -> int:
    """Buckets for tables of this many rows; all tables to be aligned share one number."""
    return max(1, -(-rows // rows_per_bucket))


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """A model's predictions as a table bucketed and sorted by ``key``, a file per
    bucket.  The one shuffle is paid here, by the writer."""
    df.repartition(buckets, key).write.mode("overwrite").format("parquet") \
        .bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)


def open_bucketed(spark: SparkSession, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """The table again in another session, whose catalog does not know it.  Key
    and number of buckets are to be those it was written with."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def align_bucketed(spark: SparkSession, tables: Mapping[str, str], key: str, value: str = "pred") -> DataFrame:
    """(key, a column per model): equally bucketed tables joined bucket by bucket,
    with no shuffle.  ``tables`` maps a column to a table.  The first table's rows
    are aligned; what another model lacks is NULL, a NULL key matches nothing.
    (A full join would merge the two keys into a new one, and with it lose the
    buckets for the next join.)"""
    out = None
    for col, name in tables.items():
        t = spark.table(name).select(key, F.col(value).alias(col))
        out = t if out is None else out.join(t.hint("merge"), key, "left")
    return out
