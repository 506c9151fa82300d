"""Generated features: pairwise products and ratios, powers, and log1p of
skewed columns (skewness from ONE aggregate)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabstack.functions.expr import log1p_pos, safe_div
from tabstack.operators._util import one_row


def skewness(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Population skewness m3 / m2^1.5 of every column."""
    r = one_row(df.agg(*[F.skewness(F.col(c).cast("double")).alias(c) for c in cols]))
    return {c: (float(r[c]) if r[c] is not None else 0.0) for c in cols}


def pairwise_columns(df: DataFrame, cols: Sequence[str], skew_threshold: float = 2.0) -> dict[str, Column]:
    """{name: expression}: a*b and a/(b+1) for pairs, sqrt|a| and a^2, and
    ``{a}_unskewed`` = log1p(a) when skew(a) > threshold else a."""
    sk = skewness(df, cols)
    out: dict[str, Column] = {}
    for i, a in enumerate(cols):
        x = F.col(a).cast("double")
        for b in cols[i + 1:]:
            out[f"{a}_x_{b}"] = x * F.col(b).cast("double")
            out[f"{a}_per_{b}"] = safe_div(a, F.col(b) + 1)
        out[f"{a}_sqrt"] = F.sqrt(F.abs(x))
        out[f"{a}_sq"] = x * x
        out[f"{a}_unskewed"] = log1p_pos(a) if sk[a] > skew_threshold else x
    return out
