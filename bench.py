"""Times the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

BENCH_QUERIES picks others: names separated by commas, or ``all``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fleetpulse.checks.queries import QUERIES  # noqa: E402
from fleetpulse.session import local_session  # noqa: E402

HEADLINE = [
    "delay_by_hour", "delay_alerts", "fct_delay_alerts", "stg_trip_updates", "positions_keep_first",
    "headway_lag", "headway_set_form", "fct_headway_regularity", "bunching_top20", "stalls", "stalls_latest",
    "fct_stall_incidents", "enrich_positions", "enrich_trip_updates", "event_time_status", "feed_json_positions",
    "feed_json_trip_updates", "decode_messages", "alert_envelope", "alerts_upsert", "incremental_replace",
    "incremental_refresh", "live_summary", "route_cv_top15", "live_board", "quality_report", "profile",
    "stream_bronze", "stream_delay", "stream_headway", "stream_stalls", "stream_alerts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "")
    chosen = list(QUERIES) if names == "all" else names.split(",") if names else HEADLINE
    spark = local_session("bench", cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - begin, 3)

    # Class loading and code generation of the first query are not what is measured.
    run("delay_by_hour")
    if "stalls" in chosen:
        run("stalls")
    seconds = {name: run(name) for name in chosen}
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "stream_rows_per_sec": {n: round(rows / s) for n, s in seconds.items() if n.startswith("stream_")},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
