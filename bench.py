"""Benchmark the headline operators.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}

Every query is forced to full execution with the ``noop`` sink (no collect);
fitting steps inside a query (aggregates, fold offsets, models) run as part
of its wall time.  A warm-up query absorbs JVM start-up.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabstack.plans.registry import QUERIES, load_all  # noqa: E402
from tabstack.session import get_spark  # noqa: E402

HEADLINE = [
    "flagship",              # features -> folds -> fold-safe encoding -> OOF linear -> CV R^2
    "fold_stratified",       # exact stratified folds (bucketed ranks)
    "enc_target_kfold",      # leave-fold-out target statistics
    "enc_target_multi",      # mean / P(top) / std for two keys, one grouping-sets scan
    "enc_group_pairs",       # category-pair statistics over lineitem x part x supplier
    "safe_div",              # wide projection over lineitem
    "bucketize",
    "winsorize",             # exact 0.995 quantiles + cap over lineitem
    "agg_median",
    "agg_value_counts",
    "impute_median",
    "knn_target",            # exact blocked k-NN over embeddings
    "blend_grid_cls",        # 1,001 blend candidates scored in one scan
    "blend_convex_reg",
    "metric_auc",
    "sel_mutual_info",
    "stratified_sample",
    "pseudo_label",
    "fit_gbt_reg",           # 5 OOF boosted-tree models
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [a for a in sys.argv[1:] if not a.startswith("-")]
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app="tabstack-bench",
                      extra={"spark.driver.memory": "16g"})
    load_all()
    from tabstack.plans.flagship import flagship
    queries = dict(QUERIES)
    queries["flagship"] = flagship
    # warm-up: JVM, Python workers, parquet footers
    queries["safe_div"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    from tabstack.plans import fixtures as FX
    for name in HEADLINE:
        if only and name not in only:
            continue
        FX._MEMO.clear()  # each query pays for its own fixtures
        t0 = time.perf_counter()
        df = queries[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_operators_total_wall", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
