"""Times the headline queries and prints one JSON line.

Reads ``$BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) on ``local[$BENCH_CPUS]``. Every query is
run to the end into a sink that discards its rows; building the query, and whatever jobs that takes,
is part of its time. Each is run once to warm up, and its time is the median of three further runs.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

HEADLINE = [
    "report_province_city",
    "report_ad_region",
    "report_ad_app",
    "report_ad_device",
    "report_ad_network",
    "report_ad_operator",
    "report_ad_channel",
    "report_bundle",
    "ip_geo_enrich",
    "build_district_dictionary",
    "geohash_district_join",
    "dictionary_lookup_join",
    "null_safe_left_join",
    "skew_join_hot_keys",
    "skew_join_full_salt",
    "salted_two_phase_agg",
    "tag_all",
    "connected_components",
    "user_profile_today",
    "user_profile_with_history",
]


RUNS = 3


def main(shared: str) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("adspindle-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        # Larger generated methods are never compiled by the JVM; wide rows run faster without them.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.checkpoint.dir", shared)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from workload.queries import QUERIES

    def timed(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name in HEADLINE:
        timed(name)
        seconds[name] = round(statistics.median(timed(name) for _ in range(RUNS)), 3)
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    with tempfile.TemporaryDirectory(prefix="adspindle-bench-") as folder:
        main(folder)
