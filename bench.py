"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Each
query runs once to warm up and then three times; its figure is the median. The whole result is
computed each time and discarded. Streaming queries include starting and stopping the stream.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lapframe.session import build_session  # noqa: E402
from lapframe.workloads.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "leaderboard",
    "race_summary",
    "car_telemetry",
    "lap_positions",
    "historical_race_analysis",
    "stint_spans",
    "stint_weather",
    "compound_performance",
    "session_filters",
    "dq_sustained_burst",
    "dq_report",
    "merge_upsert",
    "slice_rows",
    "encode_decode",
    "throttle_batch",
    "stream_throttle",
    "stream_dedup",
    "stream_sink",
    "stream_counts",
]
RUNS = 3


def main() -> None:
    base = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "lapframe-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    events = spark.read.parquet(f"{base}/events.parquet").count()
    times = {}
    for name in HEADLINE:
        taken = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, base).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(base.rstrip("/")).removeprefix("sf"),
                "stream_rows_per_sec": round(events / times["stream_sink"]),
            }
        )
    )


if __name__ == "__main__":
    main()
