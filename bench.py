"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query is built and run to completion with a sink that reads every row and column. The first
query runs once before the clock starts, so that its time is not that of starting the JVM, and the
payloads that builders parse are made and stored before it, so that their time is that of parsing.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from qualitymart.queries import QUERIES, payloads
from qualitymart.queries.registry import Inputs
from qualitymart.session import local_session

HEADLINE = [
    "v1_qa_health_by_release",
    "v2_defect_density",
    "v3_requirement_coverage",
    "v4_execution_trend",
    "v5_test_type_breakdown",
    "v6_test_run_detail",
    "v7_environment_health",
    "v8_release_snapshot",
    "v9_quality_effectiveness",
    "m1_run_measures_by_release",
    "m5_pass_rate_month_over_month",
    "m17_etmi_by_release",
    "w4_trailing_7_days",
    "a13_environment_subtotals",
    "g6_requirement_release_matrix",
    "g8_slowest_tests",
    "r2_manager_sees_program",
    "d1_tests_without_recent_run",
    "d14_resolved_but_failing",
    "u1_overwrite",
    "b3_defects",
    "b6_test_runs_parsed",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    folder = tempfile.mkdtemp(prefix="bench-")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, memory="16g", folder=folder)
    spark.sparkContext.setLogLevel("ERROR")
    run = lambda name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in ("defects", "runs"):
        path = f"{folder}/payloads/{name}"
        getattr(payloads, name)(Inputs(spark, sf_dir)).repartition(32).write.parquet(path)  # as many small files, as pages are landed
        setattr(payloads, name, lambda i, path=path: i.spark.read.parquet(path))
    run(HEADLINE[0])
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run(name)
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
