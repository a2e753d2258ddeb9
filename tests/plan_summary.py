"""Write PLANS.md: the physical-plan shape of every registered read query.

Usable as a script: ``python tests/plan_summary.py [sf_dir] > PLANS.md``. For each
query it lists the exchanges (hash, range, single-partition, broadcast), the join
strategies, the aggregate operators and the top-k / window nodes of the executed
(adaptive, initial) plan. Queries that write tables are summarised by their final
read.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402

NODES = ("SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct", "HashAggregate", "SortAggregate", "ObjectHashAggregate",
         "TakeOrderedAndProject", "WindowGroupLimit", "Window", "Expand", "Generate",
         "BatchEvalPython", "ArrowEvalPython")


def shape(plan: str) -> dict[str, Counter]:
    ex = Counter()
    for kind in re.findall(r"Exchange (\w+)", plan):
        ex[{"hashpartitioning": "hash", "rangepartitioning": "range",
            "SinglePartition": "single", "RoundRobinPartitioning": "round-robin"}
           .get(kind, "broadcast" if "Broadcast" in kind else kind)] += 1
    nodes = Counter()
    for n in NODES:
        nodes[n] = len(re.findall(rf"\b{n}\b", plan))
    return {"exchanges": ex, "nodes": +nodes}


def main(argv) -> int:
    from clinark.session import local_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    print("# PLANS — physical-plan shape of every registered query\n")
    print(f"Generated by `python tests/plan_summary.py {sf_dir}` (initial adaptive plans; "
          "the fixture's star joins included). Exchanges: hash / range / single-partition "
          "shuffles and broadcasts.\n")
    print("| Query | Exchanges | Operators |")
    print("|---|---|---|")
    for key, q in E.queries().items():
        plan = q(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        s = shape(plan)
        ex = ", ".join(f"{k} {v}" for k, v in sorted(s["exchanges"].items())) or "none"
        ops = ", ".join(f"{k} {v}" for k, v in sorted(s["nodes"].items())) or "—"
        print(f"| `{key}` | {ex} | {ops} |")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
