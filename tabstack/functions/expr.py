"""Column expressions: pure ``Column -> Column`` builders.

Everything here compiles to Catalyst expressions, so it stays inside
whole-stage codegen and costs nothing beyond the projection it sits in.
Callers build a whole feature block with ONE ``select``/``withColumns``.

Null rules follow the reference pipeline: "null" means "does not have one",
so most inputs are read as 0 before a comparison or a sum.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INF = float("inf")


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def nz(x, fill=0) -> Column:
    """NULL -> fill (the reference's ``fillna(0)``)."""
    return F.coalesce(_c(x), F.lit(fill))


# ---------------------------------------------------------------- arithmetic

def safe_div(num, den) -> Column:
    """num / den as DOUBLE; NULL or zero denominator, NULL numerator, +-inf and
    NaN all give 0.0.  Plain ``/`` raises under ANSI mode, ``try_divide`` gives
    NULL instead and the finite test removes inf/NaN."""
    q = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    return F.when(F.abs(q) < F.lit(INF), q).otherwise(F.lit(0.0))


def row_sum_nullzero(cols: Iterable) -> Column:
    """Sum of columns, NULL read as 0."""
    cols = list(cols)
    out = nz(cols[0], 0.0)
    for c in cols[1:]:
        out = out + nz(c, 0.0)
    return out


def weighted_sum(weights: Mapping[str, float], nulls=0) -> Column:
    """Linear score sum(w * coalesce(c, nulls)) from a weight dict."""
    out = None
    for c, w in weights.items():
        term = F.lit(float(w)) * nz(c, nulls).cast("double")
        out = term if out is None else out + term
    return out if out is not None else F.lit(0.0)


def count_positive(cols: Iterable) -> Column:
    """Number of columns with a value > 0 (NULL read as 0)."""
    out = F.lit(0)
    for c in cols:
        out = out + (nz(c) > 0).cast("int")
    return out


def ratio_plus(num, den, offset: float = 1.0, lo=None, hi=None) -> Column:
    """num / (den + offset), optionally clipped (e.g. same-employer share)."""
    r = safe_div(num, _c(den) + F.lit(offset))
    return clip(r, lo, hi) if (lo is not None or hi is not None) else r


def clip(x, lo=None, hi=None) -> Column:
    """Clip both sides; NULL stays NULL (``greatest``/``least`` skip NULLs, so
    they are guarded)."""
    x = _c(x)
    y = x
    if hi is not None:
        y = F.least(y, F.lit(hi))
    if lo is not None:
        y = F.greatest(y, F.lit(lo))
    return F.when(x.isNull(), F.lit(None)).otherwise(y)


def flag(x, op: str, threshold, null_as=0) -> Column:
    """0/1 INT flag of ``coalesce(x, null_as) <op> threshold``."""
    v = nz(x, null_as)
    t = F.lit(threshold)
    cond = {">": v > t, ">=": v >= t, "<": v < t, "<=": v <= t,
            "==": v == t, "!=": v != t}[op]
    return cond.cast("int")


def bool01(x) -> Column:
    """Nullable 0/1 flag -> INT 0/1."""
    return nz(x, 0).cast("int")


def bucketize(x, edges: Sequence[float], right_closed: bool = True) -> Column:
    """0-based bin index for bins (e0,e1], (e1,e2], ...  (``pd.cut`` semantics).
    Values outside (e0, e_last] give NULL.  Not ml ``Bucketizer``: that one is
    left-closed."""
    x = _c(x)
    edges = [float(e) for e in edges]
    if right_closed:
        out = F.when(x.isNull() | (x <= F.lit(edges[0])) | (x > F.lit(edges[-1])), F.lit(None))
        for i, e in enumerate(edges[1:]):
            out = out.when(x <= F.lit(e), F.lit(i))
    else:
        out = F.when(x.isNull() | (x < F.lit(edges[0])) | (x >= F.lit(edges[-1])), F.lit(None))
        for i, e in enumerate(edges[1:]):
            out = out.when(x < F.lit(e), F.lit(i))
    return out.cast("int")


def round_half_even(x, digits: int = 2) -> Column:
    """numpy ``np.round`` semantics: scale, round half to even, unscale.
    (``F.round`` is half-up; ``bround`` on the scaled value matches numpy also
    where the decimal digits are not exactly representable.)"""
    s = float(10 ** digits)
    return F.bround(_c(x) * F.lit(s), 0) / F.lit(s)


def log1p_pos(x) -> Column:
    """log1p(max(0, coalesce(x, 0)))."""
    return F.log1p(F.greatest(nz(x, 0.0).cast("double"), F.lit(0.0)))


def log_shift(y, shift: float = 4.98) -> Column:
    """Target transform log(y - shift) (rates bounded below by the floor)."""
    return F.ln(_c(y) - F.lit(shift))


def exp_shift(z, shift: float = 4.98) -> Column:
    """Inverse of :func:`log_shift`."""
    return F.exp(_c(z)) + F.lit(shift)


def coerce_numeric(x, fill: float = 0.0) -> Column:
    """``to_numeric(errors='coerce')`` then fill: bad strings become ``fill``.
    (``cast`` raises under ANSI; ``try_cast`` gives NULL.)"""
    return F.coalesce(_c(x).try_cast("double"), F.lit(fill))


def finite_or(x, fill: float = 0.0) -> Column:
    """+-inf / NaN / NULL -> fill."""
    x = _c(x)
    return F.when(F.abs(x) < F.lit(INF), x).otherwise(F.lit(fill))


# ------------------------------------------------------------------- strings

def str_norm(x) -> Column:
    """upper(trim(x)); NULL reads as the string 'NAN' like ``astype(str)``."""
    return F.upper(F.trim(F.coalesce(_c(x).cast("string"), F.lit("nan"))))


def str_contains_flag(x, pattern: str) -> Column:
    """0/1: normalised string matches a regex (e.g. 'OWN|MORTGAGE')."""
    return str_norm(x).rlike(pattern).cast("int")


def str_not_in_flag(x, tokens: Sequence[str]) -> Column:
    """0/1: normalised string is NOT one of the none-like tokens."""
    return (~str_norm(x).isin([t.upper() for t in tokens])).cast("int")


def concat_key(cols: Sequence, sep: str = "__") -> Column:
    """Composite string key for output; group on the columns themselves."""
    return F.concat_ws(sep, *[F.coalesce(_c(c).cast("string"), F.lit("nan")) for c in cols])


# -------------------------------------------------------------- probabilities

def prob_array(cols: Sequence) -> Column:
    return F.array(*[_c(c).cast("double") for c in cols])


def argmax_class(p) -> Column:
    """Index of the largest entry; ties -> lowest index (numpy argmax)."""
    p = _c(p)
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def expected_class(p) -> Column:
    """sum_i p_i * i."""
    return F.aggregate(F.transform(_c(p), lambda x, i: x * i.cast("double")),
                       F.lit(0.0), lambda acc, v: acc + v)


def array_sum(p) -> Column:
    return F.aggregate(_c(p), F.lit(0.0), lambda acc, v: acc + v)


def row_normalise(p, eps: float | None = None) -> Column:
    """Divide each probability by the row sum (after clipping to >= eps)."""
    p = _c(p)
    if eps is not None:
        p = F.transform(p, lambda x: F.greatest(x, F.lit(float(eps))))
    s = array_sum(p)
    return F.transform(p, lambda x: x / s)


def round_to_class(x, n_classes: int = 5) -> Column:
    """Ordinal trick: class regressed as a number -> round (half even) ->
    clip to [0, K-1] -> INT."""
    r = F.bround(_c(x).cast("double"), 0)
    return F.least(F.greatest(r, F.lit(0.0)), F.lit(float(n_classes - 1))).cast("int")


def one_hot(k, n_classes: int = 5) -> Column:
    """INT class -> one-hot probability array."""
    k = _c(k)
    return F.transform(F.sequence(F.lit(0), F.lit(n_classes - 1)),
                       lambda i: F.when(i == k, F.lit(1.0)).otherwise(F.lit(0.0)))


def clip_prob(p, eps: float = 1e-12) -> Column:
    return F.least(F.greatest(_c(p), F.lit(eps)), F.lit(1.0 - eps))


# ----------------------------------------------------------- schema helpers

def has(df: DataFrame, *cols: str) -> bool:
    """Driver-side check that every input of a derived column exists."""
    return all(c in df.columns for c in cols)


NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ex]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in ex]


def name_matches(df: DataFrame, keywords: Sequence[str], numeric_only: bool = True,
                 exclude_prefix: str | None = None) -> list[str]:
    """Columns whose lower-case name contains any keyword (name-driven lists)."""
    pool = numeric_columns(df) if numeric_only else list(df.columns)
    out = []
    for c in pool:
        if exclude_prefix and c.startswith(exclude_prefix):
            continue
        if any(k in c.lower() for k in keywords):
            out.append(c)
    return out
