"""Small shared helpers for fitted state."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_MAX_BYTES = 64 << 20


def _width(field: T.StructField) -> Column:
    """Bytes of one value, about."""
    c, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 8
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.greatest(F.size(c), F.lit(0)) * 16 + 16
    return F.lit(16 if isinstance(kind, (T.DecimalType, T.StructType)) else 8)


def table_bytes(df: DataFrame) -> int:
    """Size of a table by its rows and the width of their values (one aggregate)."""
    width = reduce(lambda a, b: a + b, [_width(f) for f in df.schema.fields], F.lit(8)).cast("long")
    return int(df.agg(F.sum(width)).first()[0] or 0)


def bounded_broadcast(small: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast a fitted lookup table only after checking its size in bytes.

    The table is persisted first so the check and the later join do not
    recompute the aggregate.  Above the bound the caller gets a plain
    DataFrame and Catalyst plans a shuffle join (AQE splits skewed keys).
    """
    small = small.persist(StorageLevel.MEMORY_AND_DISK)
    return F.broadcast(small) if table_bytes(small) <= max_bytes else small


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` where NULL equals NULL (a group of its own); the keys come from ``left``."""
    names = {k: f"_r_{k}" for k in keys}
    r = right.withColumnsRenamed(names)
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(v)) for k, v in names.items()])
    return left.join(r, cond, how) if how in ("left_semi", "left_anti") else left.join(r, cond, how).drop(*names.values())


def one_row(df: DataFrame) -> dict:
    """Collect a one-row aggregate (fitted literals) as a dict."""
    rows = df.limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected one row, got {len(rows)}")
    return rows[0].asDict()
