"""Hyper-parameter search by successive halving.

Seeded draws start with a small budget (trees, iterations); each rung scores the
candidates left by cross-validation over the fold column, keeps the best share
and raises the budget.  The frame is assembled and persisted once; all fits of a
rung are independent jobs, and a rung's scores are one row per candidate.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabstack.operators.models import assemble, few_parts, parallel


def draw(space: Mapping[str, object], n: int, seed: int = 42) -> list[dict]:
    """``n`` candidates from a space of lists (a choice), ``(lo, hi)`` (whole
    numbers where both are, else real) and ``(lo, hi, "log")``."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        c = {}
        for name, spec in space.items():
            if isinstance(spec, list):
                c[name] = spec[int(rng.integers(len(spec)))]
            elif len(spec) == 3:
                c[name] = float(math.exp(rng.uniform(math.log(spec[0]), math.log(spec[1]))))
            elif all(isinstance(v, int) for v in spec):
                c[name] = int(rng.integers(spec[0], spec[1] + 1))
            else:
                c[name] = float(rng.uniform(*spec))
        out.append(c)
    return out


def successive_halving(df: DataFrame, make: Callable[[dict, int], Estimator], space: Mapping[str, object],
                       features: Sequence[str], label: str, fold: str = "fold", draws: int = 27, eta: int = 3,
                       budgets: Sequence[int] = (10, 30, 90), kind: str = "reg", seed: int = 42,
                       parallelism: int = 8) -> DataFrame:
    """(rung, budget, candidate, params, score, kept): every score of the search.

    ``make(params, budget)`` gives the estimator.  ``score`` is the out-of-fold
    RMSE (``reg``, less is better) or accuracy (``cls``) over all rows with a
    fold and a label.  After each rung the best ``1 / eta`` stay, at least one,
    ties to the earlier draw; in the last rung ``kept`` marks the winner alone.
    Without two folds there is no row."""
    spark = df.sparkSession
    d = df.where(F.col(fold).isNotNull() & F.col(label).isNotNull()).select(fold, F.col(label).cast("double").alias(label), *features)
    d = assemble(few_parts(d), features).drop(*features).persist(StorageLevel.MEMORY_AND_DISK)
    folds = sorted(r[0] for r in d.select(fold).distinct().collect())
    rows, alive = [], dict(enumerate(draw(space, draws, seed)))

    def judge(job):
        i, f, budget = job
        model = make(alive[i], budget).setLabelCol(label).fit(d.where(F.col(fold) != f))
        miss = (F.col("prediction") - F.col(label)) ** 2 if kind == "reg" else (F.col("prediction") == F.col(label)).cast("double")
        r = model.transform(d.where(F.col(fold) == f)).agg(F.sum(miss), F.count(F.lit(1))).first()
        return i, r[0], r[1]

    for rung, budget in enumerate(budgets if len(folds) > 1 else ()):
        sums = {i: [0.0, 0] for i in alive}
        for i, s, n in parallel(judge, [(i, f, budget) for i in alive for f in folds], parallelism):
            sums[i][0] += s
            sums[i][1] += n
        score = {i: math.sqrt(s / n) if kind == "reg" else s / n for i, (s, n) in sums.items()}
        order = sorted(alive, key=lambda i: (score[i] if kind == "reg" else -score[i], i))
        last = rung == len(budgets) - 1
        stay = set(order[:1 if last else max(1, math.ceil(len(order) / eta))])
        rows += [(rung, int(budget), i, json.dumps(alive[i], sort_keys=True), float(score[i]), i in stay) for i in sorted(alive)]
        alive = {i: alive[i] for i in sorted(stay)}
    d.unpersist()
    return spark.createDataFrame(rows, "rung int, budget int, candidate int, params string, score double, kept boolean")
