"""Frame-level helpers: schema-defensive projections, column alignment and
row unions (all driver-side schema work; no data is touched)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def derive_if_present(df: DataFrame,
                      specs: Mapping[str, tuple[Sequence[str], Callable[[], Column]]]) -> DataFrame:
    """Build each derived column only when all its inputs exist; one
    ``withColumns`` for the whole block.  Specs are evaluated in order, so a
    derived column may feed a later one only through a second call."""
    cols = {name: build() for name, (inputs, build) in specs.items()
            if all(c in df.columns for c in inputs)}
    return df.withColumns(cols) if cols else df


def align_inner(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Keep the columns present in both frames (in ``a``'s order)."""
    common = [c for c in a.columns if c in set(b.columns)]
    return a.select(*common), b.select(*common)


def align_outer(a: DataFrame, b: DataFrame, fill=0.0) -> DataFrame:
    """Union by name over the union of columns; missing values -> ``fill``
    (only for columns that were missing on one side)."""
    only_a = [c for c in a.columns if c not in b.columns]
    only_b = [c for c in b.columns if c not in a.columns]
    u = a.unionByName(b, allowMissingColumns=True)
    return u.withColumns({c: F.coalesce(F.col(c), F.lit(fill)) for c in only_a + only_b})


def union_rows(frames: Mapping[str, DataFrame], tag: str = "source") -> DataFrame:
    """Stack frames by column name with a tag column (real/pseudo, train/test)."""
    out = None
    for name, df in frames.items():
        d = df.withColumn(tag, F.lit(name))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out
