"""Registry of checkable queries: ``name -> (spark builder, DuckDB SQL)``.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
input tables (or tables Spark derives from them).  The SQL twin, when given,
computes the same rows in DuckDB over the same parquet files.

Floating results are snapped with :func:`q6` / :func:`sq6`, the same IEEE
operations in both engines (``floor(x * 1e6 + SNAP) / 1e6``), so the value
hash does not depend on either engine's rounding routine.  ``SNAP`` is 0.5
plus a small irrational-looking offset: means of short decimals (money, rates)
often land exactly on a half step, where a last-bit difference between the
engines' summation orders would flip a plain half-up rounding.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}

MODULES = [
    "tabstack.plans.q_sources",
    "tabstack.plans.q_expr",
    "tabstack.plans.q_aggregate",
    "tabstack.plans.q_impute_encode",
    "tabstack.plans.q_folds_models",
    "tabstack.plans.q_blend_metrics",
    "tabstack.plans.q_neighbours_select",
]


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def load_all() -> None:
    for m in MODULES:
        try:
            importlib.import_module(m)
        except ModuleNotFoundError as e:  # module not written yet
            if e.name != m:
                raise


SNAP = 0.5007071


def q6(c, scale: float = 1e6) -> Column:
    """floor(c * scale + SNAP) / scale in DOUBLE.  ``F.floor`` returns a
    BIGINT (saturating above 9.2e18), so the floor is taken in the double
    domain: y - fmod(y, 1) is exact, minus one for negative fractions."""
    c = F.col(c) if isinstance(c, str) else c
    y = c.cast("double") * F.lit(scale) + F.lit(SNAP)
    r = y % F.lit(1.0)
    fl = (y - r) - F.when(r < 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return fl / F.lit(scale)


def sq6(expr: str, scale: str = "1e6") -> str:
    return f"(floor(CAST({expr} AS DOUBLE) * {scale} + {SNAP}) / {scale})"
