"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the test tables, BENCH_CPUS the local cores. Each query
runs once to warm up, with its result counted, and the best of the timed runs
that follow is reported. Rows go to a sink that drops them, so every column is
computed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dockline.plans.catalog import QUERIES  # noqa: E402

HEADLINES = (
    "sum_by_area", "parse_station", "make_envelope", "enrich_names", "enrich_department",
    "kpi_counts", "kpi_totals", "kpi_percent", "bike_split", "stations_table", "station_tooltip",
    "map_filter_full", "latest_snapshot", "distance_m", "nearest_to_point", "nearest_station",
    "geocode_join", "topic_offsets", "lookup_write", "snapshot_scan", "poll_source",
    "topic_mirror", "stream_to_json", "stream_enrich", "stream_kpis",
)
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in HEADLINES:
        rows[name] = QUERIES[name](spark, sf_dir).count()
        best = float("inf")
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "rows": rows, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
