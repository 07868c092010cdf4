"""Headline queries, timed. Prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times; the best time
counts. Results go to Spark's noop sink, so all columns of all rows are computed.
"""

from __future__ import annotations

import json
import os
import time

from checks.compare import session
from checks.registry import QUERIES

HEADLINE = [
    "src_geojson_quakes", "dq_validation_rate", "dedup_quakes", "dedup_weather", "region_assign",
    "nearest_city", "dist_severity", "dist_weather", "zscore_flags", "frequency_anomaly",
    "rolling_baseline_range", "grid_anomaly", "fuse_grid", "weather_anomaly", "cluster_score_fixed",
    "cluster_anomaly", "anomaly_fusion", "anomaly_summary", "alert_rules", "alert_card_json",
    "alert_recipients", "events_timeline", "cap_points", "sink_append_partitioned", "stream_hourly",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = session(cpus)
    seconds = {}
    for name in names:
        timings = []
        for _ in range(1 + runs):
            begin = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings.append(time.perf_counter() - begin)
        seconds[name] = round(min(timings[1:] or timings), 3)
    print(json.dumps({
        "metric": "headline queries, total of best times",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
        "cpus": cpus,
        "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
