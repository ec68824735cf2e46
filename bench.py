"""Headline timings: prints one JSON line.

    BENCH_SF_DIR   folder with the test tables (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from weekfold.queries import QUERIES  # noqa: E402
from weekfold.session import build_session  # noqa: E402

HEADLINE = [
    "w00_rolling_all", "w10_calendar_window", "i03_new_row_filter", "f01_lifecycle",
    "f02_weekly_snapshot", "f03_rolling_features", "f03_rolling_full", "f05_home_away_splits", "f06_opponent_history",
    "f07_defence_rank", "f08_opponent_allowed", "f08_matchup_features", "f14_team_aggregates",
    "f15_vector_assembly", "q05_quality_filter", "g01_prediction_targets", "v06_validation_log",
    "l02_ratio_split", "l08_regression_metrics",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{root}/nation.parquet").count()  # start the session outside the timings
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total seconds of headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
