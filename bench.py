"""Benchmark: wall time of every mart from the raw tables, and of the whole staged build.

Reads ``BENCH_SF_DIR`` (default sf0.1) on ``local[BENCH_CPUS]`` and prints one JSON line. Every
result is computed in full through the no-op sink; one untimed query warms the session up.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemart.session import local_session
from tidemart.workload.queries import QUERIES, all_marts

HEADLINE = (
    "job_demand",
    "skill_demand",
    "role_skill_associations",
    "salary_distribution",
    "trajectory_features_row",
    "trajectory_features_role",
    "trajectory_labels_row",
    "trajectory_labels_role",
)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def build(spark, folder: str) -> None:
    for df in all_marts(spark, folder).values():
        consume(df)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    consume(QUERIES["job_demand"](spark, folder))
    seconds = {name: timed(lambda: consume(QUERIES[name](spark, folder))) for name in HEADLINE}
    seconds["full_build"] = timed(lambda: build(spark, folder))
    print(
        json.dumps(
            {
                "metric": "marts_wall_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
