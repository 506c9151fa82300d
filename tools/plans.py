"""Print condensed physical plans of the key queries (scans with their read
schema and pushed filters, exchanges, joins, aggregates, windows, Python
stages).  Usage: python tools/plans.py [sf_dir] [query ...]"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from tabstack.plans.registry import QUERIES, load_all  # noqa: E402
from tabstack.session import get_spark  # noqa: E402

KEEP = re.compile(r"Exchange|Join|FileScan|HashAggregate|Window|Expand|FlatMapCoGroups|MapInArrow|"
                  r"TakeOrdered|InMemoryTableScan|Scan ExistingRDD|ReusedExchange")
DEFAULT = ["acct", "enc_target_kfold", "fold_stratified", "knn_target", "blend_grid_cls",
           "stratified_sample", "safe_div", "winsorize", "src_oof_roundtrip"]


def condensed(df) -> list[str]:
    out = []
    for line in df._jdf.queryExecution().executedPlan().toString().split("\n"):
        if not KEEP.search(line):
            continue
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        m = re.search(r"(FileScan parquet) \[(.*?)\].*?(PushedFilters: \[.*?\])?, ReadSchema: (struct<.*?>)", line)
        if m:
            indent = line[:len(line) - len(line.lstrip())]
            line = f"{indent}{m.group(1)} {m.group(4)} {m.group(3) or ''}"
        out.append(line.rstrip()[:200])
    return out


def main():
    args = sys.argv[1:]
    sf = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.1"
    names = args or DEFAULT
    load_all()
    spark = get_spark()
    from tabstack.plans import fixtures as FX
    for n in names:
        df = FX.acct(spark, sf) if n == "acct" else QUERIES[n](spark, sf)
        print(f"### {n}\n```")
        print("\n".join(condensed(df)))
        print("```\n")


if __name__ == "__main__":
    main()
