"""tabstack: feature engineering, leakage-safe encoding and out-of-fold
stacking for tabular prediction, written as Spark DataFrame jobs.

Layout
------
sources/    readers, the OOF prediction store, sinks and the output contract
functions/  column expressions (pure ``Column -> Column`` builders)
operators/  fit/transform operators: imputation, encoding, folds, target
            statistics, aggregates, neighbours, selection, models, blending,
            metrics
plans/      derived fixtures, the end-to-end flow and the query registry
streaming/  fitted (stateless) transforms applied to a streaming DataFrame
"""

__version__ = "0.1.0"
