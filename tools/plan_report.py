"""One line per registered query summarising its physical plan: shuffles,
broadcasts, join strategies, partial window-group limits, Python stages, and
any nested-loop/cartesian join (there should be none).

Usage: python tools/plan_report.py [--sf DIR] [--md OUT] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidewater.plans.registry import all_queries  # noqa: E402
from tidewater.session import build_session  # noqa: E402

PATTERNS = {
    "shuffles": r"Exchange hashpartitioning|Exchange RoundRobinPartitioning|Exchange rangepartitioning|Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "bhj": r"BroadcastHashJoin",
    "smj": r"SortMergeJoin",
    "shj": r"ShuffledHashJoin",
    "win_limit": r"WindowGroupLimit",
    "topk": r"TakeOrderedAndProject",
    "python": r"MapInPandas|MapInArrow|FlatMapCoGroupsInPandas|ArrowEvalPython|BatchEvalPython",
    "BAD_nested_loop": r"BroadcastNestedLoopJoin|CartesianProduct",
}


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.001")
    ap.add_argument("--md")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    spark = build_session()
    rows = []
    for n, q in all_queries().items():
        if a.names and not any(n.startswith(p) for p in a.names):
            continue
        if n.startswith("ml_") and q.sql is None:
            continue  # model fits: plans live inside pyspark.ml
        plan = q.fn(spark, a.sf)._jdf.queryExecution().executedPlan().toString()
        counts = {k: len(re.findall(v, plan)) for k, v in PATTERNS.items()}
        rows.append((n, counts))
        print(n, " ".join(f"{k}={v}" for k, v in counts.items() if v))
    if a.md:
        with open(a.md, "w") as f:
            f.write("# Physical plan summary (sf0.001, initial adaptive plan)\n\n")
            f.write("Generated by `tools/plan_report.py`. Columns count plan nodes: hash/range/single "
                    "shuffles, broadcast exchanges, broadcast-hash / sort-merge / shuffled-hash joins, "
                    "partial window-group limits (top-k before the shuffle), top-k sorts, Python stages, "
                    "and nested-loop or cartesian joins.\n\n")
            keys = list(PATTERNS)
            f.write("| query | " + " | ".join(keys) + " |\n|---|" + "---|" * len(keys) + "\n")
            for n, c in rows:
                f.write(f"| {n} | " + " | ".join(str(c[k]) for k in keys) + " |\n")
    spark.stop()


if __name__ == "__main__":
    main()
