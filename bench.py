"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table folder and BENCH_CPUS the cores. Each query runs
in full into the noop sink; the time covers building the query and running it.
Before the clock starts, every query runs once on the smallest tables next to
the folder, if there are any, so that class loading and code generation are paid.
"""

from __future__ import annotations

import json
import os
import time

from headway.registry.queries import QUERIES
from headway.session import local_session

HEADLINES = [
    "stop_events_scope",
    "observations_dedup",
    "append_new_snapshots",
    "decode_flatten",
    "stop_observations",
    "canonical_stop_events",
    "route_reliability",
    "stop_reliability",
    "route_stop_reliability",
    "route_direction_reliability",
    "route_hourly_reliability",
    "route_weekday_reliability",
    "hourly_patterns",
    "daily_metrics",
    "delay_propagation_events",
    "route_delay_propagation",
    "silver_report",
    "tail_risk_routes",
    "direction_gap",
    "weekday_coverage",
    "next_stops",
    "board_kpis",
    "route_catalog",
    "feed_freshness",
    "stream_observations",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    smallest = os.path.join(os.path.dirname(folder.rstrip("/")), "sf0.001")
    if os.path.isdir(smallest):
        for name in HEADLINES:
            run(spark, name, smallest)
    seconds = {name: run(spark, name, folder) for name in HEADLINES}
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cores": cores,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
