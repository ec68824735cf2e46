"""List what a plan would do at scale: joins without keys, single partitions, full scans.

    python tools/plans.py [name or prefix ...]

Automatic broadcasting is off, so every join shows the strategy it has when no
side is small.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from weekfold.queries import QUERIES  # noqa: E402
from weekfold.session import build_session  # noqa: E402


def main() -> None:
    spark = build_session(
        "plans", "local[2]",
        **{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.001")
    for name, fn in QUERIES.items():
        if sys.argv[1:] and not any(name.startswith(n) for n in sys.argv[1:]):
            continue
        plan = fn(spark, root)._jdf.queryExecution().executedPlan().toString()
        count = {
            "nested_loop": plan.count("BroadcastNestedLoopJoin"),
            "cartesian": plan.count("CartesianProduct"),
            "single": plan.count("SinglePartition"),
            "hash_ex": len(re.findall(r"Exchange hashpartitioning", plan)),
            "range_ex": len(re.findall(r"Exchange rangepartitioning", plan)),
            "smj": plan.count("SortMergeJoin"),
            "window": len(re.findall(r"\bWindow \[", plan)),
            "python": plan.count("Python") + plan.count("Pandas"),
        }
        print(name, {k: v for k, v in count.items() if v}, flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
