"""Retraining on pseudo-labels: generations of out-of-fold models.

Generation v1 learns from the labelled rows.  Each further one takes the most
confident predictions for unlabelled rows as labels, appends these rows to the
training table, deals mixed folds (real and pseudo rows stratified apart, so
every fold has its share of both and real rows keep their folds), and fits all
base learners again on the enlarged table.  Labels of real rows never change;
a pseudo-label is chosen anew in each round from the latest generation, so a
row that is no longer confident goes back to the unlabelled ones.

Every generation is a version in the out-of-fold store.  Scores count real
rows only: a pseudo row's label is a prediction itself.

A labelled row is scored by models that saw neither it nor its label, and so is
a pseudo row.  What remains, as with any pseudo-labelling, is the indirect way:
fold models that saw a label voted on pseudo-labels that others learn from.

The table of pseudo-labels has at most ``n`` rows; its join is a broadcast
behind a size check.  Nothing else depends on it, so a generation costs what
the first one does.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabstack.operators._util import bounded_broadcast
from tabstack.operators.folds import assign_folds_mixed
from tabstack.operators.pseudo import pseudo_label
from tabstack.session import cut_lineage
from tabstack.sources.store import write_oof

Fit = Callable[[DataFrame], tuple[DataFrame, dict[str, float]]]


@dataclass
class Generation:
    """``scored``: the table with its predictions; ``notes``: what the fit reports (weights, ..)."""
    version: str
    scored: DataFrame
    notes: dict[str, float]


def enlarge(table: DataFrame, pseudo: DataFrame, labels: Sequence[str], key: str = "row_id", fold: str = "fold", k: int = 5,
            stratify: str = "tier", seed: int = 42) -> DataFrame:
    """``table`` (labelled rows have a fold, others none) with pseudo-labels and mixed folds.

    ``pseudo`` has the key and ``labels``; keys of labelled rows in it are
    ignored.  ``is_pseudo`` is 1 for rows that train by a pseudo-label."""
    base = table.drop("is_pseudo")
    named = bounded_broadcast(pseudo.select(F.col(key), *[F.col(c).alias(f"_ps_{c}") for c in labels], F.lit(1).alias("_ps")))
    d = base.join(named, key, "left")
    takes = F.col(fold).isNull() & F.col("_ps").isNotNull()
    d = d.withColumns({c: F.when(takes, F.col(f"_ps_{c}").cast(base.schema[c].dataType)).otherwise(F.col(c)) for c in labels}
                      | {"is_pseudo": F.when(takes, 1).otherwise(0)})
    d = d.withColumn("_learns", F.col(fold).isNotNull() | takes).drop("_ps", *[f"_ps_{c}" for c in labels])
    d = cut_lineage(d)      # read twice below, and the folds it is dealt must not change
    dealt = assign_folds_mixed(d.where("_learns").drop(fold), key, k, stratify, "is_pseudo", seed, fold)
    rest = d.where("NOT _learns").withColumn(fold, F.lit(None).cast("int"))
    return cut_lineage(dealt.drop("_learns").unionByName(rest.drop("_learns")))     # a fit reads it several times


def long_predictions(scored: DataFrame, version: str, models: dict[tuple[str, str], Sequence[str]], key: str = "row_id", fold: str = "fold") -> DataFrame:
    """Store rows of a generation; ``models`` maps (task, model) to its prediction columns."""
    entries = F.array(*[F.struct(F.lit(task).alias("task"), F.lit(model).alias("model"), F.array(*[F.col(c).cast("double") for c in cols]).alias("pred"))
                        for (task, model), cols in models.items()])
    return scored.select(F.col(key), F.when(F.col(fold).isNull(), "test").otherwise("train").alias("split"), F.col(fold), "is_pseudo",
                         F.explode(entries).alias("e")).select(key, "split", fold, "is_pseudo", "e.task", "e.model", F.lit(version).alias("version"), "e.pred")


def run_generations(table: DataFrame, fit: Fit, store: str, models: dict[tuple[str, str], Sequence[str]], prob_cols: Sequence[str], rate_col: str,
                    labels: tuple[str, str] = ("tier", "rate"), key: str = "row_id", fold: str = "fold", rounds: int = 2,
                    n: int = 5_000, threshold: float = 0.9, k: int = 5, seed: int = 42) -> list[Generation]:
    """Generations v1 .. v(rounds + 1); fewer when no unlabelled row is confident.

    ``fit(table)`` returns the table with the prediction columns of ``models``
    (labelled rows out of fold, others by all fold models) and its notes; it
    must learn from rows with a fold only."""
    real = table.withColumn("is_pseudo", F.lit(0))
    out: list[Generation] = []
    now = real
    for r in range(rounds + 1):
        scored, notes = fit(now)
        out.append(Generation(f"v{r + 1}", scored, notes))
        write_oof(long_predictions(scored, f"v{r + 1}", models, key, fold), store)
        if r == rounds:
            break
        # unlabelled rows: those without a real label, whether or not they carried a pseudo-label
        unlabelled = scored.join(real.where(F.col(fold).isNull()).select(key), key, "left_semi")
        chosen = cut_lineage(pseudo_label(unlabelled.drop(*labels), prob_cols, rate_col, n=n, threshold=threshold, key=key)
                             .select(key, F.col("tier").alias(labels[0]), F.col("rate").alias(labels[1])))
        if chosen.isEmpty():
            break
        now = enlarge(real, chosen, labels, key, fold, k, labels[0], seed)
    return out
