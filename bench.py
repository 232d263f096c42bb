"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
data and cores. Every query runs once to warm up, then BENCH_RUNS times
(default 3); the median counts. Results are written to the no-op sink, so all
columns of all rows are computed and nothing passes through the driver.
"""

import json
import os
import re
import statistics
import sys
import time

from listenhouse.registry import QUERIES
from listenhouse.session import local_session

HEADLINE = [
    "scan_events", "surrogate_md5", "repair_text", "listen_features", "is_moving",
    "dim_user", "scd_user_versions", "dim_artist", "dim_song", "dim_location", "dim_session",
    "dim_datetime", "user_level_history", "dim_user_sql", "dim_artist_sql",
    "level_changes_tiled", "level_changes_merged", "join_artist", "fact_streams",
    "fact_streams_natural", "load_new_users", "load_new_facts", "ingest_stream",
]


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cpus)
    times = {}
    for name in names:
        seconds(spark, name, sf_dir)
        times[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(runs)), 3)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total time of headline queries, median of warm runs",
        "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": float(found.group(1)) if found else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
