"""Summarise the final physical plan of every registered query.

usage: python tools/plans.py [sf_dir] [name ...]  -> markdown table on stdout
Each query is executed (collect) so the adaptive plan is final; the summary
counts scans, shuffle exchanges, broadcasts, join strategies, codegen
stages and any Python evaluation.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def final_part(plan: str) -> str:
    """The final adaptive plan only (the string also holds the initial one)."""
    if "== Final Plan ==" in plan:
        plan = plan.split("== Final Plan ==", 1)[1]
    return plan.split("== Initial Plan ==", 1)[0]


def summarise(plan: str) -> dict:
    plan = final_part(plan)
    return {
        "scans": len(re.findall(r"FileScan \w+|Scan parquet|BatchScan", plan)),
        "shuffles": len(re.findall(r"\bExchange (hashpartitioning|rangepartitioning|"
                                   r"RoundRobinPartitioning|SinglePartition|rebalance)", plan))
        ,
        "broadcasts": plan.count("BroadcastExchange"),
        "smj": plan.count("SortMergeJoin"),
        "bhj": plan.count("BroadcastHashJoin"),
        "partial_agg": len(re.findall(r"partial_\w+", plan)) > 0,
        "pushed": len(re.findall(r"PushedFilters: \[[^\]]+\]", plan)),
        "codegen": len(re.findall(r"\*\(\d+\)|WholeStageCodegen", plan)),
        "python": bool(re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython", plan)),
        "cartesian": bool(re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)),
    }


def main():
    args = sys.argv[1:]
    sf = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)]
    from strata.queries import QUERIES
    from strata.session import build_session
    spark = build_session(master="local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    cols = ["scans", "shuffles", "broadcasts", "smj", "bhj", "partial_agg", "pushed", "codegen",
            "python", "cartesian"]
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name in names or list(QUERIES):
        df = QUERIES[name](spark, sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)


if __name__ == "__main__":
    main()
