"""Null handling: fit on train, apply to every split.

``fit_imputer`` computes all fill values with at most three aggregates
(medians, modes, nothing for constants); ``apply_imputer`` is one projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabstack.operators._util import one_row
from tabstack.operators.aggregates import medians, modes, quantiles


def missing_columns(*frames: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    """Columns with at least one NULL in ANY of the frames (flag if null in
    train or test), one aggregate per frame."""
    cols = list(cols or frames[0].columns)
    hit = set()
    for f in frames:
        present = [c for c in cols if c in f.columns]
        r = one_row(f.agg(*[F.max(F.col(c).isNull().cast("int")).alias(c) for c in present]))
        hit |= {c for c in present if r[c]}
    return [c for c in cols if c in hit]


def missing_flags(df: DataFrame, cols: Sequence[str], suffix: str = "_was_missing") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": F.col(c).isNull().cast("int") for c in cols})


def fit_imputer(train: DataFrame, zero: Sequence[str] = (), median: Sequence[str] = (),
                mode: Sequence[str] = (), token: Mapping[str, str] | None = None,
                exact: bool = True) -> dict:
    """Fill values: structural zeros, train medians, train modes (ties ->
    smallest), literal tokens."""
    fills: dict = {c: 0 for c in zero}
    if median:
        fills.update(medians(train, median, exact=exact))
    if mode:
        for r in modes(train, mode, cast="string").collect():  # one row per column
            fills[r["column"]] = r["value"]
    fills.update(dict(token or {}))
    return fills


def apply_imputer(df: DataFrame, fills: Mapping[str, object]) -> DataFrame:
    """One projection: coalesce(c, fill) with the fill cast to c's type."""
    cols = {}
    for c, v in fills.items():
        if c not in df.columns or v is None:
            continue
        cols[c] = F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
    return df.withColumns(cols) if cols else df


def fit_caps(train: DataFrame, cols: Sequence[str], q: float = 0.995, exact: bool = True) -> dict:
    """Upper caps at the train quantile (linear interpolation), one aggregate."""
    return quantiles(train, cols, q, exact=exact)


def winsorize(df: DataFrame, caps: Mapping[str, float]) -> DataFrame:
    """least(c, cap); NULL stays NULL."""
    return df.withColumns({c: F.when(F.col(c).isNull(), F.lit(None))
                           .otherwise(F.least(F.col(c).cast("double"), F.lit(float(v))))
                           for c, v in caps.items() if v is not None})
